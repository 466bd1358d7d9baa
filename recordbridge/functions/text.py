"""Text helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common English stop words, our own list.
STOP_WORDS = (
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any",
    "are", "as", "at", "be", "because", "been", "before", "being", "below", "between",
    "both", "but", "by", "could", "did", "do", "does", "doing", "down", "during", "each",
    "few", "for", "from", "further", "had", "has", "have", "having", "he", "her", "here",
    "hers", "herself", "him", "himself", "his", "how", "i", "if", "in", "into", "is", "it",
    "its", "itself", "me", "more", "most", "my", "myself", "no", "nor", "not", "of", "off",
    "on", "once", "only", "or", "other", "ought", "our", "ours", "ourselves", "out", "over",
    "own", "same", "she", "should", "so", "some", "such", "than", "that", "the", "their",
    "theirs", "them", "themselves", "then", "there", "these", "they", "this", "those",
    "through", "to", "too", "under", "until", "up", "very", "was", "we", "were", "what",
    "when", "where", "which", "while", "who", "whom", "why", "with", "would", "you", "your",
    "yours", "yourself", "yourselves",
)


def squish_newlines(col: Column) -> Column:
    """Line breaks become blanks, runs of white space one blank, ends trimmed."""
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def strip_suffix(col: Column, pattern: str) -> Column:
    """Remove the first match of ``pattern`` only; later matches stay."""
    return F.regexp_replace(col, f"(?s)^(.*?)(?:{pattern})", "$1")


def cut_at_paren(col: Column) -> Column:
    """Text before the first opening parenthesis; null where there is none."""
    return F.substring(col, F.lit(1), F.nullif(F.instr(col, "("), F.lit(0)) - 1)


def address_line(line1: Column, line2: Column, name: Column) -> Column:
    """Both address lines, the one that is there, or a confidential label."""
    present = line1.isNotNull() | line2.isNotNull()
    hidden = F.concat(F.lit("Confidential - "), F.coalesce(name, F.lit("NA")))
    return F.when(present, F.concat_ws(" ", line1, line2)).otherwise(hidden)


def suffix_if_present(col: Column, suffix: str) -> Column:
    """Append text; a null stays null."""
    return F.concat(col, F.lit(suffix))


def name_length(col: Column) -> Column:
    return F.char_length(col)


def short_zip(col: Column) -> Column:
    return F.substring(col, 1, 5)


def strip_punctuation(col: Column) -> Column:
    return F.regexp_replace(col, r"\p{Punct}", "")


def login_name(first: Column, last: Column) -> Column:
    """First initial and last name, no punctuation, lower case."""
    initial = F.substring(strip_punctuation(first), 1, 1)
    return F.lower(
        F.concat(F.coalesce(initial, F.lit("NA")), F.coalesce(strip_punctuation(last), F.lit("NA")))
    )


def contains_any(col: Column, needles: Iterable[str]) -> Column:
    """True if any of the literal texts occurs; null text gives null."""
    found = F.lit(False)
    for needle in needles:
        found = found | col.contains(needle)
    return found


def text_flags(col: Column, needle: str) -> dict[str, Column]:
    """The three text tests: holds, does not hold, does not start with."""
    return {
        "holds": col.contains(needle),
        "lacks": ~col.contains(needle),
        "starts": col.startswith(needle),
    }


def any_word(words: Iterable[str]) -> str:
    """Pattern for one of the words, written as a tree of shared beginnings.

    A text position is then tried against one branch per letter, not against each word.
    """
    branches: dict[str, list[str]] = {}
    for word in words:
        branches.setdefault(word[:1], []).append(word[1:])
    ends = "" in branches
    parts = [first + any_word(rest) for first, rest in sorted(branches.items()) if first]
    body = f"(?:{'|'.join(parts)})" if len(parts) > 1 or (ends and parts) else "".join(parts)
    return body + "?" if ends and parts else body


#: All but letters and white space (a-z, A-Z, \x20, \x09 to \x0D), as ranges: Java tests these ten times as fast as a negated class.
NO_LETTERS = r"[\x00-\x08\x0E-\x1F!-@\[-`{-\x{10FFFF}]+"


def strip_stopwords(col: Column, words: Iterable[str] = STOP_WORDS) -> Column:
    """Drop whole stop words (case kept as written), then all but letters and white space."""
    word = r"[\p{L}\p{N}_]"
    without = F.regexp_replace(col, f"(?<!{word}){any_word(words)}(?!{word})", "")
    return F.regexp_replace(without, NO_LETTERS, "")
