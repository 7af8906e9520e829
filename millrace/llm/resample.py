"""Resampling documents towards the distribution of a target text set.

Features are the runs of one to ``LONGEST`` words, hashed into ``BUCKETS``
buckets. One pass over each side counts the buckets: a task adds up an array and
sends it as at most ``BUCKETS`` rows. A bucket's gain is the logarithm of its
share in the target over its share in the documents; the array of gains has a
fixed length and scores each document in a second pass. A document's weight is
the mean gain of its features, its score adds Gumbel noise made from its id, so
that the documents with the highest scores are a sample without replacement.

The k-th score is found by distributed quickselect. The keys are (score
descending, id ascending, number of features, place in the stored scores), so no
two are equal. Each round draws ``PIVOTS`` random keys of those still possible,
counts in one aggregate how many are below and equal to each, and stores the keys
between the two pivots that enclose the k-th: about one in ``PIVOTS`` of them. Only
the winners are sorted, over ranges of their keys, and numbered.

NULL texts have no words. A document without features has the weight 0; one of fewer
than ``LEAST_WORDS`` words is scored and never drawn. A NULL id is hashed as the
empty text and comes after others in ties. Repeated rows take part each; rows of
equal score and id differ by their rank alone, unless their texts differ, where the
shorter comes first. Of an empty table nothing is drawn; with an empty target all
its counts are 0. Long texts are read in parts of ``PART`` bytes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import clean_text, materialize, slices, text_bytes
from millrace.sources.position import with_row_number

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
PIVOTS = 15
PART = 1 << 20

# Words are made of digits, letters and all bytes above 7F.
_WORD = {*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)}
_PLAIN = bytes(c if c in _WORD else ord(" ") for c in bytes(range(256)).lower())

KEY = ("_low", "_last", "_id", "n_features", "_place")


def _parts(text: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PART)
        end = len(text) if end < 0 else end
        yield text[start:end]
        start = end


def features(text: bytes, buckets: int = BUCKETS, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray]]:
    """For each part of the text: its words, and the buckets of the features that end in them."""
    before: list[bytes] = []
    for part in _parts(text.translate(_PLAIN)):
        new = part.split()
        if not new:
            continue
        words = before + new
        later = [b" " + w for w in words]
        codes = list(map(crc32, words))
        found = [codes[len(before) :]]
        for size in range(2, longest + 1):
            codes = list(map(crc32, later[size - 1 :], codes))
            found.append(codes[max(0, len(before) - size + 1) :])
        total = sum(map(len, found))
        yield len(new), np.fromiter(chain.from_iterable(found), np.int64, total) % buckets
        before = words[len(words) - longest + 1 :] if len(words) >= longest else words


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How often each bucket occurs in all texts: ``buckets`` numbers, whatever the table's size."""

    def count(batches):
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches, "text"):
            for value in batch.column("text"):
                for _, found in features(text_bytes(value), buckets, longest):
                    counts += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    texts = df.select(F.encode(clean_text(f"`{text}`"), "UTF-8").alias("text"))
    parts = texts.mapInArrow(count, "bucket long, n long")
    counts = np.zeros(buckets, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the source."""
    size = len(source)
    all_source, all_target = float(int(source.sum()) + size), float(int(target.sum()) + size)
    ratios = [(t + 1.0) * all_source / ((s + 1.0) * all_target) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def noise(doc_id, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the id alone."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(df: DataFrame, gain: np.ndarray, text: str = "text", doc_id: str = "doc_id", longest: int = LONGEST, seed: int = SEED, whole: bool = False) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row, and the whole row as ``row``."""
    id_type = df.select(f"`{doc_id}`").schema[0].dataType
    fields = [T.StructField("doc_id", id_type)]
    if whole:
        fields.append(T.StructField("row", df.schema, False))
    kept = [f.name for f in fields]
    names = ("n_words", "n_features", "weight", "score")
    schema = T.StructType([*fields, *[T.StructField(n, T.LongType()) for n in names]])
    buckets = len(gain)

    def run(batches):
        for batch in slices(batches, "_text"):
            made = []
            for value, name in zip(batch.column("_text"), batch.column("_name").to_pylist(), strict=True):
                words = n = total = 0
                for new, found in features(text_bytes(value), buckets, longest):
                    words, n, total = words + new, n + len(found), total + int(gain[found].sum())
                weight = total // n if n else 0
                made.append((words, n, weight, weight + noise(name, seed)))
            columns = zip(*made, strict=True) if made else [[]] * 4
            arrays = [batch.column(k) for k in kept] + [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    columns = [F.col(f"`{doc_id}`").alias("doc_id")]
    if whole:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    columns.append(F.col(f"`{doc_id}`").cast("string").alias("_name"))
    columns.append(F.encode(clean_text(f"`{text}`"), "UTF-8").alias("_text"))
    return df.select(*columns).mapInArrow(run, schema)


def _key() -> Column:
    return F.struct(*KEY)


def _pivot(row, keys: DataFrame) -> Column:
    return F.struct(*[F.lit(row[k]).cast(keys.schema[k].dataType).alias(k) for k in KEY])


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS):
    """The row of the k-th smallest of different ``KEY`` values, by quickselect; 1 <= k <= their number."""
    turn = 0
    while True:
        turn += 1
        drawn = keys.orderBy(F.xxhash64("_place", F.lit(turn))).limit(pivots).collect()
        drawn.sort(key=lambda r: tuple(r[name] for name in KEY))
        counts = []
        for pivot in (_pivot(row, keys) for row in drawn):
            below, equal = F.count_if(_key() < pivot), F.count_if(_key() == pivot)
            counts.append(F.struct(below.alias("below"), equal.alias("equal")))
        found = keys.agg(F.array(*counts).alias("counts")).first()["counts"]
        least = greatest = None
        passed = 0
        for pivot, count in zip(drawn, found, strict=True):
            if count["below"] >= k:
                greatest = pivot
                break
            if count["below"] + count["equal"] >= k:
                return pivot
            least, passed = pivot, count["below"] + count["equal"]
        if least is not None:
            keys, k = keys.where(_key() > _pivot(least, keys)), k - passed
        if greatest is not None:
            keys = keys.where(_key() < _pivot(greatest, keys))
        keys = materialize(keys, "quickselect")


def ranks(
    df: DataFrame,
    target: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    whole: bool = False,
) -> DataFrame:
    """Every row's ``doc_id, n_features, weight, score, rank``; the rank of what is not drawn is NULL.

    ``percent`` of the rows with ``least_words`` words are drawn. ``whole`` adds the row as ``row``.
    """
    gain = gains(bucket_counts(df, text), bucket_counts(target, "text"))
    rows = scored(df, gain, text, doc_id, seed=seed, whole=whole)
    kept = [c for c in rows.columns if c != "n_words"]
    rows = rows.select(
        "*",
        (-F.col("score")).alias("_low"),
        F.col("doc_id").isNull().alias("_last"),
        F.coalesce("doc_id", F.lit("" if rows.schema["doc_id"].dataType == T.StringType() else 0)).alias("_id"),
        F.monotonically_increasing_id().alias("_place"),
    )
    rows = materialize(rows, "scores")
    able = rows.where(F.col("n_words") >= least_words)
    k = percent * able.count() // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return rows.select(*kept, unranked)
    last = kth_key(able.select(*KEY), k)
    won = (F.col("n_words") >= least_words) & (_key() <= _pivot(last, rows))
    winners = with_row_number(rows.where(won).orderBy(*KEY), "rank")
    winners = winners.select(*kept, (F.col("rank") + 1).alias("rank"))
    return winners.unionByName(rows.where(~won).select(*kept, unranked))


def resampled(df: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that are drawn, with their own columns."""
    return ranks(df, target, whole=True, **options).where("rank IS NOT NULL").select("row.*")
