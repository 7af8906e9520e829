"""One query for each operator, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    collocations,
    decontaminate,
    exact,
    language_model,
    licenses,
    line_rules,
    quality,
    resample,
    simhash,
    surrogates,
    toxicity,
    warc,
)
from millrace.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file; ``MILLRACE_VOCABULARY`` names another one."""
    if given := os.environ.get("MILLRACE_VOCABULARY"):
        return given
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.find_copies(documents(spark, folder))


SQL["op1_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(documents(spark, folder), table(spark, folder, "labels"))


@query
def op3_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    found = surrogates.replace(documents(spark, folder))
    return found.select(
        "doc_id", F.size("found").alias("n_mentions"), "found", F.col("clean").alias("clean_text")
    )


@query
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.classify(documents(spark, folder))
    return found.select("doc_id", "votes", "weak_label", "score", "keep")


@query
def op5_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score(documents(spark, folder))


@query
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.reported(warc.round_trip(table(spark, folder, "pages")))


SQL["op6_warc"] = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
),
coded AS (
    SELECT page_id, strlen(html) AS payload_bytes, array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))) & 31) + 1, 1)
        FOR i IN range(32)], '') AS payload_digest
    FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM coded
WINDOW same AS (PARTITION BY payload_digest, payload_bytes)
"""


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = table(spark, folder, "benchmark")
    return decontaminate.reported(decontaminate.find_matches(documents(spark, folder), benchmark))


@query
def op8_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(documents(spark, folder), vocabulary()))


@query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.reported(simhash.components(documents(spark, folder)))


@query
def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


@query
def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.ranks(documents(spark, folder), table(spark, folder, "benchmark"))


# CRC-32 is linear: a byte's effect depends on itself and the bytes behind it, and the
# effects add up by exclusive or.
SQL["op11_resampling"] = r"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS place, doc_id, 1 AS side, text FROM documents
    UNION ALL
    SELECT 0, NULL, 2, text FROM benchmark
),
lists AS (
    SELECT place, doc_id, side, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts
),
features AS (
    SELECT place, side, unnest(words) AS feature FROM lists
    UNION ALL
    SELECT place, side, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
    FROM lists
),
different AS (SELECT feature, strlen(feature) AS size, hex(feature) AS code FROM (SELECT DISTINCT feature FROM features)),
effects AS (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS t(b)
),
behind AS (
    SELECT 0::BIGINT AS d, b, v FROM effects
    UNION ALL
    SELECT d + 1, h.b, xor(h.v >> 8, e.v) FROM behind AS h JOIN effects AS e ON e.b = h.v & 255
    WHERE d < (SELECT max(size) FROM different)
),
empty AS (
    SELECT 0::BIGINT AS size, 4294967295::BIGINT AS v
    UNION ALL
    SELECT size + 1, xor(z.v >> 8, e.v) FROM empty AS z JOIN effects AS e ON e.b = z.v & 255
    WHERE size < (SELECT max(size) FROM different)
),
letters AS (
    SELECT feature, size, i, ('0x' || substr(code, 2 * i + 1, 2))::BIGINT AS b
    FROM (SELECT *, unnest(range(size)) AS i FROM different)
),
hashed AS (
    SELECT l.feature, xor(xor(bit_xor(h.v), any_value(z.v)), 4294967295) % 10000 AS bucket
    FROM letters AS l JOIN behind AS h ON h.b = l.b AND h.d = l.size - 1 - l.i JOIN empty AS z ON z.size = l.size
    GROUP BY l.feature
),
counted AS (
    SELECT bucket, count(*) FILTER (WHERE side = 1) AS s, count(*) FILTER (WHERE side = 2) AS t
    FROM features JOIN hashed USING (feature) GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS gain
    FROM counted
),
means AS (
    SELECT place, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
    FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 1 GROUP BY place
),
scores AS (
    SELECT place, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
               + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM lists LEFT JOIN means USING (place) WHERE side = 1
),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, n_features) AS position,
           count(*) FILTER (WHERE n_words >= 20) OVER () AS able
    FROM scores
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND position <= 25 * able // 100 THEN position END AS rank
FROM ordered
"""


@query
def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.verdicts(documents(spark, folder))


def _texts_in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


SQL["op12_quality_rules"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS text FROM documents),
lists AS (SELECT place, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
windows AS (
    SELECT place, i, count(*) OVER (PARTITION BY place, a, b, c) AS n
    FROM (SELECT place, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
          FROM (SELECT place, words, unnest(range(1, len(words) - 1)) AS i FROM lists))
),
repeats AS (
    SELECT place, count(DISTINCT spot) AS n FROM (
        SELECT place, unnest([i, i + 1, i + 2]) AS spot FROM windows WHERE n > 1
    ) GROUP BY place
),
lines AS (
    SELECT place, line, i, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words,
           length(line) - length(regexp_replace(line, '[#*$%&|<>!]', '', 'g')) AS signs,
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower
    FROM (SELECT place, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
          FROM docs)
),
judged AS (
    SELECT place, length(array_to_string(words, '')) AS chars,
           row_number() OVER (PARTITION BY place, line ORDER BY i) > 1 AS again,
           (len(words) < {line_rules.SENTENCE}
                AND NOT list_contains([{_texts_in(line_rules.ENDS)}], right(words[-1], 1)))
           OR 2 * signs > len(words) AS unmarked,
           len(list_filter(words, lambda w: w IN ({_texts_in(line_rules.SEPARATORS)}))) AS separators,
           len(words) AS n_words,
           len(list_filter([{_texts_in(line_rules.PHRASES)}], lambda p: contains(lower, p))) > 0 AS phrase
    FROM lines WHERE len(words) > 0
),
lost AS (
    SELECT place, count(*) AS n_lines, count_if(again) AS n_dup_lines, count_if(failed) AS n_failed_lines,
           coalesce(sum(chars) FILTER (WHERE failed), 0)::BIGINT AS lost_chars
    FROM (SELECT *, unmarked OR (separators >= 2 AND 5 * separators >= n_words) OR again OR phrase AS failed FROM judged)
    GROUP BY place
),
counted AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines,
           coalesce(lost_chars, 0) AS lost_chars
    FROM lists LEFT JOIN repeats AS r USING (place) LEFT JOIN lost USING (place)
),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND 100 * lost_chars <= {line_rules.MOST_LOST} * word_chars AS kept FROM based
"""


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("lang", "text")
    return collocations.top_phrases(collocations.mine(docs))


SQL["op13_collocations"] = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
),
counts AS (
    SELECT lang, size, phrase, count(*) AS n FROM (
        SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2),
                                  lambda i: array_to_string(words[i : i + size - 1], ' '))) AS phrase
        FROM pieces, range(1, 5) AS sizes(size))
    GROUP BY ALL
),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE n >= 30),
cuts AS (
    SELECT c.lang, c.phrase, c.size, c.n AS a, k, f.n AS l, g.n AS r,
           ((2000000::HUGEINT * c.n) // (f.n + g.n))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1) AS c
    JOIN frequent AS f ON f.lang = c.lang AND f.phrase = array_to_string(c.words[1 : k], ' ')
    JOIN frequent AS g ON g.lang = c.lang AND g.phrase = array_to_string(c.words[k + 1 :], ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
    SELECT lang, array_to_string(words[i : i + part - 1], ' ') AS phrase, max(n) AS longer
    FROM (SELECT *, unnest(range(1, size - part + 2)) AS i
          FROM (SELECT *, unnest(range(2, size)) AS part FROM frequent WHERE size > 2))
    GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM best LEFT JOIN inner_phrases USING (lang, phrase) JOIN totals AS t USING (lang)
WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
QUALIFY rank <= 2000
"""
