"""Approximate substrings: is a short pattern found anywhere in some text of its key, but for a few edits?

No pairing of all patterns with all texts of a key. With d edits allowed, one of d + 1 separate pieces
of the pattern must stand unchanged in the text. The pieces are chosen pattern by pattern: of all
ways to place them, the one whose pieces occur in the fewest texts of the key, by a small dynamic
programme over the counts. A piece that thousands of texts share is therefore only used where a
pattern has nothing rarer, and a pattern with a piece that no text has needs no comparison for it.
What meets on a piece must hold enough of the pattern's letter pairs, by an exact bound on hashed sets,
and is then compared by the edit distances to the left and to the right of it. A piece that many
texts have is spread over parts of those texts.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .joins import anti_exclude, ns_join

PREFIX_LENGTH = 30  # letters by which two texts are compared, unless told otherwise
PIECE_LETTERS = 5  # of a piece at most; shorter ones leave more choice, longer ones are rarer
NEVER = 10**15  # cost of what cannot be placed
MASKS = 2  # numbers of 64 bits that mark the letter pairs of a text
SPREAD = 1024  # places of a piece that are compared in one part


def distance_limit(text: Column) -> Column:
    """Edits allowed when ``text`` is looked for: a tenth of the length, rounded up."""
    return F.ceil(F.char_length(text) / F.lit(10.0)).cast("int")


def _grams(df: DataFrame, text: str, letters: Column) -> DataFrame:
    """Every run of ``letters`` letters of ``text``: the columns and ``spot`` (from 0), ``gram``."""
    spots = F.sequence(F.lit(0), F.char_length(text) - letters)
    fits = df.where(F.char_length(text) >= letters)
    return fits.select("*", F.explode(spots).alias("spot")).withColumn("gram", F.substring(F.col(text), F.col("spot") + 1, letters))


#: Places of d + 1 separate pieces of q letters with the least sum of ``costs``: rows[i][j] is the best for j pieces within the first i letters.
_PLACES = f"""
aggregate(
  sequence(1, n),
  array(transform(sequence(0, d + 1), j -> named_struct('cost', if(j = 0, 0L, {NEVER}L), 'places', cast(array() AS array<int>)))),
  (rows, i) -> concat(rows, array(transform(sequence(0, d + 1), j ->
    if(j = 0 OR i < q, rows[i - 1][j], least(rows[i - 1][j],
      named_struct('cost', rows[i - q][j - 1].cost + costs[i - q], 'places', concat(rows[i - q][j - 1].places, array(i - q)))))))),
  rows -> rows[n][d + 1].places)"""


def rare_pieces(patterns: DataFrame, grams: DataFrame, key: str, pattern: str) -> DataFrame:
    """(key, pattern, n, d, spot, gram, texts): the chosen pieces of each pattern that some text has.

    ``grams`` has (key, q, gram) of the texts, once for each place.
    """
    counts = grams.groupBy(key, "gram").agg(F.count(F.lit(1)).alias("texts"))
    own = _grams(patterns, pattern, F.col("q"))
    known = ns_join(own, counts, [key, "gram"], "left").withColumn("texts", F.coalesce("texts", F.lit(0)))
    listed = known.groupBy(key, pattern, "n", "d", "q").agg(F.transform(F.array_sort(F.collect_list(F.struct("spot", "texts"))), lambda x: x["texts"]).alias("costs"))
    chosen = listed.select("*", F.explode(F.expr(_PLACES)).alias("spot")).withColumn("texts", F.get("costs", F.col("spot")))
    return chosen.where("texts > 0").select(key, pattern, "n", "d", "q", "spot", F.substring(F.col(pattern), F.col("spot") + 1, F.col("q")).alias("gram"), "texts")


def pair_masks(text: Column, name: str) -> dict[str, Column]:
    """The letter pairs of ``text`` as bits, by their hash, in ``MASKS`` numbers."""
    starts = F.when(F.char_length(text) > 1, F.sequence(F.lit(1), F.char_length(text) - 1)).otherwise(F.array().cast("array<int>"))
    bits = F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(2))), F.lit(64 * MASKS)).cast("int"))
    one = F.lit(1).cast("bigint")
    marked = lambda n: lambda mask, bit: F.when(F.floor(bit / 64) == n, mask.bitwiseOR(F.call_function("shiftleft", one, bit % 64))).otherwise(mask)
    return {f"{name}{n}": F.aggregate(bits, F.lit(0).cast("bigint"), marked(n)) for n in range(MASKS)}


def _may_hold(text: str, pattern: str, d: Column) -> Column:
    """Whether the masks of a text and a pattern allow ``d`` edits: each edit takes at most two letter pairs from the pattern."""
    return reduce(add, [F.bit_count(F.col(f"{pattern}{n}").bitwiseAND(F.bitwise_not(F.col(f"{text}{n}")))) for n in range(MASKS)]) <= 2 * d


def _side(pattern: Column, text_from, d: Column) -> Column:
    """Fewest edits, if at most ``d``, between ``pattern`` and a stretch of the text whose length differs by at most ``d``; ``text_from(e)`` is null where there is none."""
    edits = F.transform(F.sequence(-d, d), lambda e: F.call_function("levenshtein", pattern, text_from(e), d))
    return F.array_min(F.filter(edits, lambda n: n >= 0))  # -1: more than d


def candidates(patterns: DataFrame, texts: DataFrame, key: str, pattern: str, text: str) -> DataFrame:
    """Patterns (n, d, q known) beside the texts of their key that share one of their pieces where it may lie, both places included."""
    lengths = texts.withColumns(pair_masks(F.col(text), "__held")).withColumn("q", F.explode(F.sequence(F.lit(1), F.lit(PIECE_LETTERS))))
    grams = _grams(lengths.join(patterns.select("q").distinct(), "q", "left_semi"), text, F.col("q"))
    held = [f"__held{n}" for n in range(MASKS)]
    grams = materialise(grams.select(key, F.col(text).alias("__text"), F.col("spot").alias("__spot"), "gram", *held), "pieces")
    pieces = materialise(rare_pieces(patterns, grams, key, pattern).withColumns(pair_masks(F.col(pattern), "__mask")), "rare-pieces")
    parts = F.ceil(F.col("texts") / SPREAD).cast("int")
    wanted = pieces.select(key, "gram", parts.alias("__parts")).distinct()
    near = ns_join(grams, wanted, [key, "gram"], "inner").withColumn("__part", F.pmod(F.xxhash64("__text", "__spot"), F.col("__parts")).cast("int")).drop("__parts")
    near = ns_join(pieces.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))), near, [key, "gram", "__part"], "inner")
    shift, room = F.col("__spot") - F.col("spot"), F.char_length("__text") - F.col("n")
    near = near.where((shift >= -F.col("d")) & (shift <= room + 2 * F.col("d")) & _may_hold("__held", "__mask", F.col("d")))
    return near.drop("__part", *held, *[f"__mask{n}" for n in range(MASKS)])


def unmatched_substrings(left: DataFrame, right: DataFrame, key: str, pattern: str = "prefix", text: str = "prefix") -> DataFrame:
    """Rows (key, pattern) of ``left`` that stand in no text of the same key in ``right``, not even approximately.

    Approximately means that some substring of the text is within ``distance_limit(pattern)`` edits.
    Both sides are distinct rows without null texts; a null key equals a null key. A pattern of at
    most as many letters as edits (none or one) stands in every text. Equal texts are taken out first.
    """
    given = key, pattern
    left, right = (df.select(F.col(key).alias("__key"), F.col(c).alias("__pattern")) for df, c in ((left, pattern), (right, text)))
    key, pattern = "__key", "__pattern"
    left = anti_exclude(left, right, [key, pattern])
    sized = left.withColumns({"n": F.char_length(pattern), "d": distance_limit(F.col(pattern))})
    # Written once: the patterns are looked at several times below.
    sized = materialise(sized.withColumn("q", F.least(F.lit(PIECE_LETTERS), F.floor(F.col("n") / (F.col("d") + 1))).cast("int")), "patterns")
    long, left = sized.where("n > d"), sized.select(key, pattern)
    other, spot, here, d = F.col("__text"), F.col("spot"), F.col("__spot"), F.col("d")
    # Of the text: the letters just before the piece, and those just behind it.
    before = lambda e: F.when((spot + e >= 0) & (here - spot - e >= 0), F.substring(other, here - spot - e + 1, spot + e))
    rest = F.col("n") - spot - F.col("q")
    behind = lambda e: F.when((rest + e >= 0) & (here + F.col("q") + rest + e <= F.char_length(other)), F.substring(other, here + F.col("q") + 1, rest + e))
    left_of = _side(F.substring(F.col(pattern), F.lit(1), spot), before, d)
    right_of = _side(F.substring(F.col(pattern), spot + F.col("q") + 1, rest), behind, d)
    near = candidates(long, right.withColumnRenamed(pattern, "__of"), key, pattern, "__of")
    found = near.where(F.when(left_of <= d, left_of + right_of) <= d).select(key, pattern).distinct()
    anywhere = sized.where("n <= d").select(key, pattern)
    found = found.unionByName(ns_join(anywhere, right.select(key).distinct(), [key], "left_semi"))
    return anti_exclude(left, found, [key, pattern]).toDF(*given)
