"""Personal data replaced by surrogates, with DataFrame operations only.

Detected entities (e-mail addresses, phone numbers, card numbers, IPv4 addresses, secrets, titled
names) get replacements made from a keyed hash of their canonical form: the same entity gets the same
surrogate wherever it occurs, in the form in which it is written there. Card surrogates keep the first
digit and a right check digit; name surrogates keep the title, its gender, and the script. Names are
replaced word by word, so that "Mr. Smith" remains the person of "Mr. John Smith".

Surrogates are checked against each other and against all entities found: where two meet, or one is a
real value, all but one entity try again with the next attempt, until every surrogate is its entity's
own. Only texts that hold entities are shuffled, and only different ones are taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# Titles by gender, and the stock of given names and name parts by script.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    "latin m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Leon", "Martin", "Oscar", "Paul", "Simon"],
    "latin f": ["Alma", "Bella", "Clara", "Diana", "Emma", "Flora", "Helen", "Laura", "Maria", "Nora", "Petra", "Sofia"],
    "latin n": ["Alex", "Andrea", "Charlie", "Jean", "Kim", "Noel", "Robin", "Sascha", "Toni", "Uli"],
    "cyrillic m": ["Антон", "Борис", "Виктор", "Иван", "Лев", "Максим", "Олег", "Павел"],
    "cyrillic f": ["Анна", "Вера", "Дарья", "Елена", "Зоя", "Ирина", "Мария", "Ольга"],
    "cyrillic n": ["Женя", "Саша", "Валя", "Слава"],
    "greek m": ["Γιάννης", "Νίκος", "Πέτρος", "Κώστας"],
    "greek f": ["Άννα", "Ελένη", "Μαρία", "Σοφία"],
    "greek n": ["Αλέξης", "Χάρις"],
}
SYLLABLES = {
    "latin": ["ba", "dor", "fen", "gal", "hol", "kem", "lin", "mar", "nol", "per", "rau", "sen", "tor", "ul", "ven", "wal"],
    "cyrillic": ["ба", "вор", "гал", "дем", "зор", "кал", "лин", "мар", "ник", "пер", "рав", "сен", "тор", "фил", "хол", "чар"],
    "greek": ["βα", "γορ", "δελ", "θαν", "καλ", "λιν", "μαρ", "νικ", "παπ", "ραν", "σεν", "τορ", "φιλ", "χαρ", "ψαλ", "ζορ"],
}

_WORD = r"\p{Lu}\p{Ll}{1,30}"
_ANY_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"
PHONE = r"\+[0-9]{1,3}[^\p{L}\p{N}]{1,6}\([0-9]{3}\)[^\p{L}\p{N}]{0,6}[0-9]{3}-[0-9]{4}(?![0-9])"
CARD = r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}(?![0-9])"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])"
SECRET = r"(?<=\")[0-9a-fA-F]{32,64}(?=\")|(?<=(?i:token|secret|password|api[_-]key)\s{0,2}[=:]\s{0,2})[0-9A-Za-z_+/-]{16,128}"
NAME = rf"(?<!\p{{L}})(?:{_ANY_TITLE})\.?[ ]{_WORD}(?:[ ]{_WORD})?(?!\p{{L}})"
PATTERN = "|".join((EMAIL, PHONE, CARD, IP, SECRET, NAME))
#: A text without a match of this has none of the pattern.
HINT = rf"[0-9@]|(?:{_ANY_TITLE})\.?[ ]\p{{Lu}}|(?i:token|secret|password|api[_-]key)\s{{0,2}}[=:]"


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def _luhn(digits: Column, odd_doubled: bool) -> Column:
    """Sum of the check of a card number; of a number without its last digit, the other places are doubled."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when((i % 2 == 1) == F.lit(odd_doubled), F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.try_cast("int"))).otherwise(c.try_cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _kind(raw: Column) -> Column:
    """What a match is; null for a number with a wrong check digit, which is no card."""
    return (
        F.when(raw.contains("@"), "email").when(raw.startswith("+"), "phone")
        .when(raw.rlike(f"^(?:{CARD})$"), F.when(_luhn(_digits(raw), True) % 10 == 0, "card"))
        .when(raw.rlike(f"^(?:{IP})$"), "ip").when(raw.rlike(f"^(?:{NAME})$"), "name").otherwise("secret")
    )


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _parts(raw: Column) -> Column:
    """A match as parts: kind (null: kept as it is), canonical form, and text."""
    part = lambda kind, canon, text: F.struct(kind.alias("kind"), canon.alias("canon"), text.alias("raw"))
    nothing = F.lit(None).cast("string")
    kind = _kind(raw)
    words = F.split(raw, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").otherwise("n")
    family, given = F.element_at(words, -1), F.get(words, 1)
    named = lambda role, word: part(F.concat(F.lit(role), _script(word)), F.lower(word), word)
    name = F.concat(
        F.array(part(nothing, nothing, F.concat(words[0], F.lit(" ")))),
        F.when(F.size(words) == 3, F.array(part(F.concat(F.lit("given "), _script(given), F.lit(" "), gender), F.lower(given), given), part(nothing, nothing, F.lit(" ")))).otherwise(F.array().cast("array<struct<kind:string,canon:string,raw:string>>")),
        F.array(named("family ", family)),
    )
    canon = F.when(kind.isin("phone", "card"), _digits(raw)).otherwise(F.lower(raw))
    return F.when(kind == "name", name).otherwise(F.array(part(kind, canon, raw)))


def _surrogate(key: str) -> Column:
    """Canonical form of the surrogate of (kind, canon, attempt)."""
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    hashed = lambda *more: F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"), *more), 256)
    h = hashed()
    figures = F.translate(h, "abcdef", "012345")
    letters = F.translate(h, "0123456789", "ghijklmnop")
    at = lambda text, i: F.substring(text, i % 64 + 1, F.lit(1))
    number = lambda i: F.conv(F.substring(h, 2 * i + 1, 2), 16, 10).cast("int")
    pick = lambda stock, i: F.get(F.array(*map(F.lit, stock)), F.pmod(number(i), F.lit(len(stock))))
    digits = lambda n: F.substring(figures, F.lit(1), n)
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    shaped = F.array_join(F.transform(F.split(local, ""), lambda c, i: F.when(c.rlike("[0-9]"), at(figures, i)).when(c.rlike(r"\p{L}"), at(letters, i)).otherwise(c)), "")
    longer = F.when(attempt > 1, F.substring(letters, F.lit(1), 2 * attempt)).otherwise("")
    place = F.translate(F.substring(F.sha2(F.concat_ws("|", F.lit(key), domain), 256), 1, 6), "abcdef", "012345")
    body = F.concat(F.substring(canon, 1, 1), digits(F.length(canon) - 2))
    check = F.pmod(10 - _luhn(body, False) % 10, F.lit(10)).cast("string")
    out = (
        F.when(kind == "email", F.concat(shaped, longer, F.lit("@mail"), place, F.lit(".example.net")))
        .when(kind == "phone", F.concat(F.substring(canon, F.lit(1), F.length(canon) - 10), digits(F.lit(10))))
        .when(kind == "card", F.concat(body, check))
        .when(kind == "ip", F.concat_ws(".", *[(number(i) % 254 + 1).cast("string") for i in range(4)]))
    )
    for script, syllables in SYLLABLES.items():
        tail = F.when(attempt > 0, F.concat(pick(syllables, 5), pick(syllables, 6), F.when(attempt > 3, F.concat(pick(syllables, 7), pick(syllables, 8))).otherwise(""))).otherwise("")
        out = out.when(kind == f"family {script}", F.concat(*[pick(syllables, i) for i in range(3)], tail))
        for gender in "mfn":
            out = out.when(kind == f"given {script} {gender}", F.lower(F.concat(pick(GIVEN[f"{script} {gender}"], 0), tail)))
    many = F.concat(h, hashed(F.lit("more")))
    return out.otherwise(F.substring(many, F.lit(1), F.length(canon)))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) of distinct entities (kind, canon): no surrogate twice, none a real value.

    Colliding entities try again, round by round; the smallest canonical form of those that meet stays.
    """
    real = entities.select("kind", F.col("canon").alias("surrogate"))
    group = F.split("kind", " ")[0]
    now = entities.select("kind", "canon", F.lit(0).alias("attempt"), F.lit(False).alias("held")).withColumn("surrogate", _surrogate(key))
    while True:
        nth = F.row_number().over(Window.partitionBy(group, "surrogate").orderBy(F.desc("held"), "canon", "kind"))
        taken = real.select(group.alias("__g"), F.col("surrogate").alias("__s")).distinct()
        seen = now.withColumn("nth", nth).withColumn("__group", group)
        seen = seen.join(taken, (F.col("__group") == F.col("__g")) & (F.col("surrogate") == F.col("__s")), "left")
        seen = materialise(seen.select("kind", "canon", "attempt", "surrogate", ((F.col("nth") == 1) & F.col("__s").isNull()).alias("held")), "surrogates")
        if seen.where("NOT held").isEmpty():
            return seen.select("kind", "canon", "surrogate")
        now = seen.withColumn("attempt", F.col("attempt") + (~F.col("held")).cast("int")).withColumn("surrogate", F.when(F.col("held"), F.col("surrogate")).otherwise(_surrogate(key)))


def _written(kind: Column, raw: Column, surrogate: Column) -> Column:
    """A surrogate in the form in which the entity is written."""
    s = surrogate
    cut = lambda a, n: F.substring(s, a, n)
    code = F.regexp_extract(raw, r"^\+([0-9]+)", 1)
    own = F.substring(s, F.length(code) + 1, F.lit(10))
    gaps = lambda i: F.regexp_extract(raw, r"^\+[0-9]+([^0-9(]+)\([0-9]{3}\)([^0-9]*)", i)
    sep = lambda i: F.regexp_extract(raw, r"^[0-9]{4}([ -]?)[0-9]{4}([ -]?)[0-9]{4}([ -]?)", i)
    cased = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(s)).otherwise(s)
    return (
        F.when(kind == "phone", F.concat(F.lit("+"), code, gaps(1), F.lit("("), F.substring(own, 1, 3), F.lit(")"), gaps(2), F.substring(own, 4, 3), F.lit("-"), F.substring(own, 7, 4)))
        .when(kind == "card", F.concat(cut(1, 4), sep(1), cut(5, 4), sep(2), cut(9, 4), sep(3), cut(13, 4)))
        .when(kind.startswith("family") | kind.startswith("given"), F.initcap(s)).otherwise(cased)
    )


def replace(df: DataFrame, text: str, key: str = "surrogates", count: str | None = None) -> DataFrame:
    """Every row with its entities replaced in ``text``; ``count`` names a column for their number.

    Texts without entities, null and empty ones stay as they are. Rows may repeat and lack ids: texts
    are followed by their SHA-256. ``key`` decides the surrogates; keep it secret.
    """
    has = F.coalesce(F.col(text).rlike(HINT) & F.col(text).rlike(PATTERN), F.lit(False))
    marked = df.drop(*([count] if count else [])).withColumn("__has", has)
    names = [c for c in marked.columns if c != "__has"]
    with_count = [F.lit(0).cast("bigint").alias(count)] if count else []
    clean = marked.where(~F.col("__has")).select(*[F.col(f"`{c}`") for c in names], *with_count)
    # Written once: three steps read the texts with entities, and finding them is what costs most.
    dirty = materialise(marked.where("__has").drop("__has").withColumn("__key", F.sha2(F.col(text).cast("binary"), 256)), "texts-with-entities")
    found = dirty.select("__key", F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0)).alias("all")).groupBy("__key").agg(F.first("all").alias("all"))
    found = found.select("__key", F.posexplode("all").alias("pos", "match"))
    parts = found.select("__key", "pos", F.posexplode(_parts(F.col("match"))).alias("nth", "p")).select("__key", "pos", "nth", "p.kind", "p.canon", "p.raw")
    parts = materialise(parts, "mentions")
    mapping = assign(materialise(parts.where("kind IS NOT NULL").select("kind", "canon").distinct(), "entities"), key)
    named = parts.join(mapping, ["kind", "canon"], "left").withColumn("value", F.when(F.col("surrogate").isNull(), F.col("raw")).otherwise(_written(F.col("kind"), F.col("raw"), F.col("surrogate"))))
    matches = named.groupBy("__key", "pos").agg(F.array_join(F.array_sort(F.collect_list(F.struct("nth", "value")))["value"], "").alias("value"), F.max(F.col("surrogate").isNotNull().cast("int")).alias("done"))
    texts = matches.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("pos", "value")))["value"].alias("__values"), F.sum("done").alias("__done"))
    joined = dirty.join(texts, "__key")
    new = F.array_join(F.zip_with(F.split(F.col(text), PATTERN, -1), F.col("__values"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = joined.select(*[new.alias(text) if c == text else F.col(f"`{c}`") for c in names], *([F.col("__done").cast("bigint").alias(count)] if count else []))
    return clean.unionByName(changed)
