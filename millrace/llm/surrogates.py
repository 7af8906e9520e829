"""Personal data replaced by keyed surrogates of the same type and format.

One pattern finds all mentions: e-mail addresses, phone numbers, IPv4 addresses,
payment card and social security numbers, cloud access keys, assigned secrets
and titled names. A mention has a type and a canonical form (digits of a phone
number, lower-case e-mail address, ...), so mentions in different formats are
one entity and get one surrogate, everywhere: coreference is kept.

A surrogate is drawn from SHA-512 digests of key, type, entity and attempt. Letters
become letters, digits digits; separators and lengths stay. Card numbers that
satisfy the Luhn check still do. E-mail domains are entities of their own, so
addresses of one domain share a surrogate domain. Names keep their title and
thereby gender; given and family names are made of syllables of the same script
(Latin, Cyrillic or Greek), given names with the ending of the gender, and each
is mapped by itself, so "Mr. Ada Byron" and "Mr. Byron" still agree.

Entities of one type whose surrogates meet, or meet an entity of the text
itself, draw again until all differ: no two entities become one.

Everything is made of built-in functions. Texts without mentions pass through.
NULL text stays NULL. Repeated rows are treated each, with equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize

KEY = "millrace"
HEAVY_SHARE = 1000
MAX_ATTEMPTS = 64

# Titles by gender.
_MALE = "Mr|Herr|Monsieur|Señor|Sr|Г-н|Господин|Κος|Κύριος"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Г-жа|Госпожа|Κα|Κυρία"
_WORD = r"\p{Lu}\p{L}+(?:-\p{Lu}\p{L}+)?"

PATTERNS = {
    "email": r"(?<![\w.+-])[\w+-][\w.+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}\b",
    "secret": (
        r"(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b)"
        r"[ \t]{0,3}[=:][ \t]{0,3}\"?[A-Za-z0-9_\-+/.]{8,}\"?"
    ),
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ipv4": (
        r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"
    ),
    "card": r"(?<![\d-])(?:\d{4}[ -]?){3}\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\d)",
    "name": rf"(?<![\p{{L}}-])(?:{_MALE}|{_FEMALE})\.? {_WORD}(?: {_WORD})?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())

# Syllables for names, and endings of given names.
_SYLLABLES = {
    "latin": "bar bel cor dan del fen gar hol jor kal lam lin mar mon nel nor pel ran ros sel tam tor val ven wil".split(),
    "cyrillic": "бар бел вас вер гор дан зар иль кор лен мар мир нов ост пав пет рад рос сав сол тар тих уль фед яр".split(),
    "greek": "αλ αν βασ γερ δημ ελ ζωγ θεο ιων καλ κων λαμ λεο μαν μιχ νικ παν παπ πετ σαβ σπυ στα τασ φιλ χρι".split(),
}
_ENDINGS = {
    "latin": ("o", "a", "er"),
    "cyrillic": ("ий", "ия", "ов"),
    "greek": ("ος", "α", "ης"),
}


def _secret_value(mention: Column) -> Column:
    return F.regexp_extract(mention, r"[=:][ \t]*\"?([^\"\s]*)", 1)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def kind_of(mention: Column) -> Column:
    """Type of a mention: the first pattern it is, as a whole."""
    kind = F
    for name, pattern in PATTERNS.items():
        kind = kind.when(mention.rlike(rf"\A(?:{pattern})\z"), F.lit(name))
    return kind.otherwise(F.lit("secret"))


def _script(word: Column) -> Column:
    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(word.rlike(r"\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def _name_words(mention: Column) -> Column:
    return F.slice(F.split(mention, " "), 2, 2)


def entities_of(kind: Column, mention: Column) -> Column:
    """The entities a mention is made of, as ``type:canonical`` strings.

    An e-mail address has two, the address and its domain; a name has one or
    two: given and family name, the first of two being given.
    """
    lower = F.lower(mention)
    number = _digits(mention)
    national = F.when(F.length(number) > 10, F.right(number, F.lit(10))).otherwise(number)
    words = _name_words(mention)
    gender = F.when(mention.rlike(rf"\A(?:{_FEMALE})\b"), "f").otherwise("m")
    named = F.transform(
        words,
        lambda w, i: F.concat(
            F.when((i == 0) & (F.size(words) == 2), F.concat(F.lit("given_"), gender)).otherwise("family"),
            F.lit("_"),
            _script(w),
            F.lit(":"),
            F.lower(w),
        ),
    )
    single = (
        F.when(kind == "phone", national)
        .when(kind.isin("card", "ssn"), number)
        .when(kind == "secret", _secret_value(mention))
        .otherwise(mention)
    )
    address = F.array(
        F.concat(F.lit("email:"), lower),
        F.concat(F.lit("domain:"), F.substring_index(lower, "@", -1)),
    )
    return (
        F.when(kind == "email", address)
        .when(kind == "name", named)
        .otherwise(F.array(F.concat(kind, F.lit(":"), single)))
    )


def _draw(stream: Column, i: Column, below: int) -> Column:
    """Number ``i`` of a stream of hexadecimal digits, two bytes each."""
    at = F.pmod(i, F.lit(64)) * 4 + 1
    return F.pmod(F.conv(F.substr(stream, at, F.lit(4)), 16, 10).cast("int"), F.lit(below))


def _pick(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), n + 1, F.lit(1))


def _shuffled(value: Column, stream: Column) -> Column:
    """Each letter or digit becomes another of its kind."""
    small, large = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chars = F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))
    is_hex = value.rlike(r"\A[0-9a-f]+\z") & value.rlike("[a-f]")
    return F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(is_hex, _pick("0123456789abcdef", _draw(stream, i, 16)))
            .when(c.rlike("[0-9]"), _draw(stream, i, 10).cast("string"))
            .when(c.rlike("[a-z]"), _pick(small, _draw(stream, i, 26)))
            .when(c.rlike("[A-Z]"), _pick(large, _draw(stream, i, 26)))
            .otherwise(c),
        ),
        "",
    )


def _luhn_sum(number: Column) -> Column:
    """Luhn sum of a number of even length, its last digit included."""
    digits = F.regexp_extract_all(number, F.lit("."), F.lit(0))

    def add(total, pair):
        doubled = pair["d"] * 2
        folded = F.when(doubled > 9, doubled - 9).otherwise(doubled)
        return total + F.when(pair["i"] % 2 == 0, folded).otherwise(pair["d"])

    pairs = F.transform(digits, lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(pairs, F.lit(0), add)


def _card(number: Column, stream: Column) -> Column:
    drawn = F.concat(F.left(number, F.lit(1)), _shuffled(F.substr(number, F.lit(2), F.lit(14)), stream))
    check = F.pmod(-_luhn_sum(F.concat(drawn, F.lit("0"))), F.lit(10))
    valid = _luhn_sum(number) % 10 == 0
    other = _draw(stream, F.lit(31), 10)
    return F.concat(drawn, F.when(valid, check).otherwise(other).cast("string"))


def _ipv4(stream: Column, attempt: Column) -> Column:
    """Addresses nobody has: private ones first, reserved ones after some attempts."""
    octet = [_draw(stream, F.lit(i), 256) for i in range(4)]
    head = F.when(attempt < 8, F.lit(10)).otherwise(240 + _draw(stream, F.lit(5), 16))
    return F.concat_ws(".", head.cast("string"), *[o.cast("string") for o in octet[1:]])


def _name(kind: Column, stream: Column, attempt: Column) -> Column:
    def made(script: str) -> Column:
        parts = F.array(*[F.lit(s) for s in _SYLLABLES[script]])
        count = len(_SYLLABLES[script])
        # More syllables after some attempts: there are always enough names.
        used = F.transform(
            F.sequence(F.lit(0), F.least(F.lit(2) + F.floor(attempt / 8), F.lit(20)).cast("int")),
            lambda i: F.element_at(parts, _draw(stream, i, count) + 1),
        )
        male, female, family = _ENDINGS[script]
        ending = (
            F.when(kind.startswith("given_f"), female)
            .when(kind.startswith("given_m"), male)
            .otherwise(family)
        )
        return F.concat(F.array_join(used, ""), ending)

    return (
        F.when(kind.endswith("cyrillic"), made("cyrillic"))
        .when(kind.endswith("greek"), made("greek"))
        .otherwise(made("latin"))
    )


def _surrogate(key: str) -> Column:
    """Surrogate of ``kind, canonical`` at ``attempt``."""
    kind, value, attempt = F.col("kind"), F.col("canonical"), F.col("attempt")
    drawn = [F.concat_ws("\x1f", F.lit(key), F.lit(i), kind, value, attempt.cast("string")) for i in "ab"]
    stream = F.concat(*[F.sha2(d, 512) for d in drawn])
    domain = F.concat(
        _shuffled(F.regexp_replace(value, r"\.[^.]*\z", ""), stream),
        F.lit("."),
        F.substring_index(value, ".", -1),
    )
    return (
        F.when(kind == "email", _shuffled(F.substring_index(value, "@", 1), stream))
        .when(kind == "domain", domain)
        .when(kind == "card", _card(value, stream))
        .when(kind == "ipv4", _ipv4(stream, attempt))
        .when(
            kind == "access_key",
            F.concat(F.left(value, F.lit(4)), _shuffled(F.substr(value, F.lit(5)), stream)),
        )
        .when(kind.startswith("given") | kind.startswith("family"), _name(kind, stream, attempt))
        .otherwise(_shuffled(value, stream))
    )


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, canonical, surrogate`` with different surrogates for the entities of a kind.

    Addresses are compared by their local part alone, which keeps them apart in
    whatever domain they are. Of entities that meet, the first by a keyed hash
    keeps its surrogate; the others and those that meet an entity draw again.
    """
    local = F.when(F.col("kind") == "email", F.substring_index("canonical", "@", 1))
    entities = entities.withColumn("own", F.coalesce(local, F.col("canonical")))
    taken = entities.select("kind", F.col("own").alias("surrogate")).distinct()
    open_ones = entities.withColumn("attempt", F.lit(0))
    done = None
    for _ in range(MAX_ATTEMPTS):
        drawn = materialize(open_ones.withColumn("surrogate", _surrogate(key)), "drawn")
        if drawn.isEmpty():
            break
        order = F.min(F.struct(F.xxhash64(F.lit(key), "canonical"), "canonical")).alias("best")
        used = taken if done is None else taken.unionByName(done.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(order)
        first = first.join(used, ["kind", "surrogate"], "left_anti").select(
            "kind", F.col("best.canonical").alias("canonical")
        )
        first = materialize(first, "settled")
        settled = drawn.join(first, ["kind", "canonical"], "left_semi")
        done = settled if done is None else done.unionByName(settled)
        open_ones = drawn.join(first, ["kind", "canonical"], "left_anti").select(
            "kind", "canonical", "own", (F.col("attempt") + 1).alias("attempt")
        )
    else:
        raise RuntimeError(f"surrogates still meet after {MAX_ATTEMPTS} attempts")
    return materialize((done if done is not None else drawn).select("kind", "canonical", "surrogate"), "surrogates")


def _refilled(mention: Column, drawn: Column) -> Column:
    """The digits of a mention replaced from the right; a country code stays."""
    chars = F.regexp_extract_all(mention, F.lit("(?s)."), F.lit(0))
    skipped = F.length(_digits(mention)) - F.length(drawn)

    def place(c, i):
        seen = F.length(_digits(F.substr(mention, F.lit(1), i + 1))) - skipped
        return F.when(c.rlike("[0-9]") & (seen > 0), F.substr(drawn, seen, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(chars, place), "")


def _as_written(value: Column, mention: Column) -> Column:
    """Capitals as in the mention."""
    capital = F.substr(mention, F.lit(1), F.lit(1)).rlike(r"\p{Lu}")
    return (
        F.when((F.upper(mention) == mention) & (F.length(mention) > 1), F.upper(value))
        .when(capital, F.initcap(value))
        .otherwise(value)
    )


def rewritten(kind: Column, mention: Column, drawn: Column) -> Column:
    """A mention with the surrogates of its entities."""
    one, two = F.element_at(drawn, 1), F.get(drawn, F.lit(1))
    upper = F.upper(mention) == mention
    address = F.concat(one, F.lit("@"), two)
    words = F.zip_with(_name_words(mention), drawn, lambda w, s: _as_written(s, w))
    return (
        F.when(kind == "email", F.when(upper, F.upper(address)).otherwise(address))
        .when(kind.isin("phone", "card", "ssn"), _refilled(mention, one))
        .when(kind == "secret", F.replace(mention, _secret_value(mention), one))
        .when(kind == "name", F.concat_ws(" ", F.substring_index(mention, " ", 1), F.array_join(words, " ")))
        .otherwise(one)
    )


def replace(df: DataFrame, text: str = "text", doc_id: str = "doc_id", key: str = KEY) -> DataFrame:
    """Add ``clean`` (text with surrogates) and ``found`` (kind and surrogate of each mention)."""
    value = F.col(f"`{text}`").cast("string")
    df = df.drop("clean", "found")
    names = [F.col(f"`{c}`") for c in df.columns]
    number = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    rows = df.select(
        *names, F.sha2(F.concat(number, F.lit(":"), F.coalesce(value, F.lit(""))), 256).alias("__row")
    )
    # Every mention has one of these, and most texts have none: a quick first look.
    possible = value.rlike("[0-9@=:]")
    for start in ["AKIA", "ASIA", *f"{_MALE}|{_FEMALE}".split("|")]:
        possible = possible | value.contains(start)
    has = F.coalesce(possible & value.rlike(PATTERN), F.lit(False))
    mention = F.col("mention")
    mentions = (
        rows.where(has)
        .select("__row", F.posexplode(F.regexp_extract_all(value, F.lit(PATTERN), F.lit(0))).alias("at", "mention"))
        .withColumn("kind", kind_of(mention))
        .select("__row", "at", "mention", "kind", entities_of(F.col("kind"), mention).alias("parts"))
    )
    mentions = materialize(mentions, "mentions")
    part = F.col("part")
    exploded = mentions.select("__row", "at", F.posexplode("parts").alias("nth", "part"))
    counts = materialize(exploded.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "entities")
    entities = counts.select(
        F.substring_index(part, ":", 1).alias("kind"),
        F.substr(part, F.instr(part, ":") + 1).alias("canonical"),
    )
    drawn = assign(entities, key).select(
        F.concat("kind", F.lit(":"), "canonical").alias("part"), "surrogate"
    )
    filled = _with_surrogates(exploded, counts, drawn)
    ordered = F.transform(
        F.array_sort(F.collect_set(F.struct("nth", "surrogate"))), lambda s: s["surrogate"]
    )
    filled = filled.groupBy("__row", "at").agg(ordered.alias("drawn"))
    done = (
        mentions.dropDuplicates(["__row", "at"])
        .join(filled, ["__row", "at"])
        .select("__row", "at", "kind", rewritten(F.col("kind"), mention, F.col("drawn")).alias("new"))
        .groupBy("__row")
        .agg(F.array_sort(F.collect_list(F.struct("at", "kind", "new"))).alias("news"))
    )
    gaps = F.split(value, PATTERN, -1)
    woven = F.zip_with(
        gaps, F.col("news"), lambda gap, new: F.concat(gap, F.coalesce(new["new"], F.lit("")))
    )
    found = F.transform("news", lambda n: F.struct(n["kind"].alias("kind"), n["new"].alias("surrogate")))
    none = F.array().cast("array<struct<kind:string,surrogate:string>>")
    changed = rows.where(has).join(done, "__row").select(
        *names, F.array_join(woven, "").alias("clean"), found.alias("found")
    )
    return rows.where(~has).select(*names, value.alias("clean"), none.alias("found")).unionByName(changed)


def _with_surrogates(exploded: DataFrame, counts: DataFrame, drawn: DataFrame) -> DataFrame:
    """Mentions with surrogates; fewer than ``HEAVY_SHARE`` frequent entities go to every task."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(total // HEAVY_SHARE, 1)
    heavy = drawn.join(counts.where(F.col("n") > least), "part", "left_semi")
    marked = exploded.join(F.broadcast(heavy.withColumnRenamed("surrogate", "hot")), "part", "left")
    hot = marked.where(F.col("hot").isNotNull()).withColumnRenamed("hot", "surrogate")
    cold = marked.where(F.col("hot").isNull()).drop("hot").join(drawn, "part")
    columns = ["__row", "at", "nth", "surrogate"]
    return hot.select(*columns).unionByName(cold.select(*columns))
