"""Exact deduplication over an extendible-hash index on shared files.

Every text has a 64-bit key. A directory maps the leading bits of keys to
buckets: a bucket with too many bytes is split by its next bit, and the
directory doubles when the split bucket already used all its bits. Only counts
by leading bits reach the driver, at most ``2 ** MAX_DEPTH`` of them.

A bucket is a range of keys with one owner task. Tasks first drop the copies
they see themselves, so a text that makes up a third of all rows reaches its
owner once from each task. The owner reads its texts in key order, chains the
different texts of one key and compares their bytes; what it keeps in memory is
the chain of one key. It writes an index entry for each text: bucket, key,
place in the chain, digest, the row that stays and the number of copies.

Rows find their entry by key and digest. Two texts of one key with one digest
would make that ambiguous, so the owner refuses them.

NULL text counts as empty, and empty texts are copies of each other. A NULL id
is smaller than all others. Each row is returned, repeated rows too; of several
rows with the id that stays, each is marked as kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import clean_text, materialize, slices, text_bytes

BUCKET_BYTES = 16 * 1024 * 1024
MAX_DEPTH = 16
HEAVY_SHARE = 1000  # a group with more than 1/HEAVY_SHARE of the rows is heavy


@dataclass
class Directory:
    """``slots[p]`` is the bucket of the keys whose leading ``depth`` bits are ``p``."""

    depth: int
    slots: list[int]
    local_depth: list[int]

    @classmethod
    def grown(cls, loads: np.ndarray, capacity: int) -> Directory:
        """Split overfull buckets; ``loads`` has a load for each of ``2 ** n`` prefixes."""
        deepest = int(len(loads)).bit_length() - 1
        total = np.concatenate([[0], np.cumsum(loads)])
        new = cls(0, [0], [0])
        pending = [(0, 0)]  # bucket, its prefix
        while pending:
            bucket, prefix = pending.pop()
            bits = new.local_depth[bucket]
            wide = deepest - bits
            load = total[(prefix + 1) << wide] - total[prefix << wide]
            if load <= capacity or bits == deepest:
                continue
            if bits == new.depth:
                new.slots = [b for b in new.slots for _ in range(2)]
                new.depth += 1
            sibling = len(new.local_depth)
            new.local_depth[bucket] += 1
            new.local_depth.append(new.local_depth[bucket])
            below = new.depth - new.local_depth[bucket]
            first = (2 * prefix + 1) << below
            new.slots[first : first + (1 << below)] = [sibling] * (1 << below)
            pending += [(bucket, 2 * prefix), (sibling, 2 * prefix + 1)]
        return new

    @property
    def buckets(self) -> int:
        return len(self.local_depth)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row for each directory entry."""
        rows = [(p, b, self.local_depth[b]) for p, b in enumerate(self.slots)]
        return spark.createDataFrame(rows, "prefix int, bucket int, local_depth int")


def _prefix(depth: int):
    return F.shiftrightunsigned("key", 64 - depth).cast("int") if depth else F.lit(0)


def keyed(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Key, digest and length of every text."""
    value = clean_text(f"`{text}`")
    return df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.xxhash64(value).alias("key"),
        F.sha2(F.encode(value, "UTF-8"), 256).alias("text_sha256"),
        F.octet_length(value).alias("n_bytes"),
    )


def directory_for(keys: DataFrame, capacity: int = BUCKET_BYTES) -> Directory:
    """Directory for texts of which each key counts once."""
    texts = keys.groupBy("key").agg(F.max("n_bytes").alias("n_bytes"))
    found = (
        texts.groupBy(_prefix(MAX_DEPTH).alias("prefix"))
        .agg(F.sum(F.col("n_bytes") + 16).alias("load"))
        .collect()
    )
    loads = np.zeros(1 << MAX_DEPTH, dtype=np.int64)
    for row in found:
        loads[row["prefix"]] = row["load"]
    return Directory.grown(loads, capacity)


def _larger(a: int | None, b: int | None) -> int | None:
    """A NULL id is smaller than all others."""
    return max((x for x in (a, b) if x is not None), default=None)


def _combine(batches):
    """Map side: a text that a batch repeats leaves it once."""
    for batch in batches:
        for part in slices([batch], "content"):
            made: dict[bytes, list] = {}
            ids, keys = part.column("doc_id").to_pylist(), part.column("key").to_pylist()
            for i, (key, doc) in enumerate(zip(keys, ids, strict=True)):
                text = text_bytes(part.column("content")[i])
                found = made.setdefault(text, [key, doc, 0])
                found[1] = _larger(found[1], doc)
                found[2] += 1
            keys, keep, copies = zip(*made.values(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(list(made), pa.binary()),
                    pa.array(keep, pa.int64()),
                    pa.array(copies, pa.int64()),
                ],
                ["key", "content", "keep_id", "group_size"],
            )


def _own(batches):
    """Owner task: chain the different texts of a key, in key order."""
    import hashlib

    key, chain = None, []  # of the chain: text, row that stays, copies
    bucket = None

    def entries():
        digests = [hashlib.sha256(t).hexdigest() for t, _, _ in chain]
        if len(set(digests)) < len(digests):
            raise ValueError("two texts of one key have one digest")
        return [
            (bucket, key, place, digest, len(text), keep, copies)
            for place, (digest, (text, keep, copies)) in enumerate(zip(digests, chain, strict=True))
        ]

    def packed(rows):
        names = ["bucket", "key", "place", "text_sha256", "n_bytes", "keep_id", "group_size"]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        for part in slices([batch], "content"):
            rows = []
            columns = [part.column(n).to_pylist() for n in ("bucket", "key", "keep_id", "group_size")]
            for i, (at, k, keep, copies) in enumerate(zip(*columns, strict=True)):
                if k != key and chain:
                    rows += entries()
                    chain = []
                bucket, key = at, k
                text = text_bytes(part.column("content")[i])
                for place, (known, kept, n) in enumerate(chain):
                    if known == text:
                        chain[place] = (known, _larger(kept, keep), n + copies)
                        break
                else:
                    chain.append((text, keep, copies))
            if rows:
                yield packed(rows)
    if chain:
        yield packed(entries())


def build_index(
    df: DataFrame, directory: Directory, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Write the index: an entry for each different text, sorted by key within its bucket."""
    spark = df.sparkSession
    value = clean_text(f"`{text}`")
    combined = df.select(
        F.xxhash64(value).alias("key"),
        F.encode(value, "UTF-8").alias("content"),
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
    ).mapInArrow(_combine, "key long, content binary, keep_id long, group_size long")
    slots = F.broadcast(directory.frame(spark).select("prefix", "bucket"))  # 2 ** MAX_DEPTH at most
    owned = (
        combined.withColumn("prefix", _prefix(directory.depth))
        .join(slots, "prefix")
        .repartition(directory.buckets, "bucket")
        .sortWithinPartitions("key")
        .select("bucket", "key", "content", "keep_id", "group_size")
    )
    schema = (
        "bucket int, key long, place int, text_sha256 string, n_bytes long, "
        "keep_id long, group_size long"
    )
    return materialize(owned.mapInArrow(_own, schema), "hash-index")


def find_copies(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = BUCKET_BYTES
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    keys = materialize(keyed(df, text, doc_id), "text-keys")
    index = build_index(df, directory_for(keys, capacity), text, doc_id)
    entries = index.select("key", "text_sha256", "keep_id", "group_size")
    return _looked_up(keys, entries).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _looked_up(keys: DataFrame, entries: DataFrame) -> DataFrame:
    """Each row with its entry.

    The rows of heavy groups stay where they are: there are fewer than
    ``HEAVY_SHARE`` such entries, which every task gets. All others are small
    groups and meet their entry by a shuffle.
    """
    rows = keys.agg(F.count(F.lit(1))).first()[0]
    least = max(rows // HEAVY_SHARE, 1)
    heavy = entries.where(F.col("group_size") > least)
    marked = F.broadcast(heavy.withColumnsRenamed({"keep_id": "h_id", "group_size": "h_size"}))
    on = ["key", "text_sha256"]
    first = keys.select(*on, "doc_id").join(marked, on, "left")
    hot = first.where(F.col("h_size").isNotNull()).select(
        *on, "doc_id", F.col("h_id").alias("keep_id"), F.col("h_size").alias("group_size")
    )
    cold = first.where(F.col("h_size").isNull()).select(*on, "doc_id")
    light = entries.where(F.col("group_size") <= least)
    return hot.unionByName(cold.join(light, on))


def without_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay; of rows that repeat the staying id, one.

    The rows move once: the join and the choice among repeated rows use the
    same partitions and order.
    """
    decisions = find_copies(df, text, doc_id)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))  # no number reads ""
    stay = decisions.where("kept").select(name.alias("__id"), F.col("text_sha256").alias("__sha"))
    on = ["__id", "__sha"]
    rows = df.withColumns(
        {
            "__id": F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")),
            "__sha": F.sha2(F.encode(clean_text(f"`{text}`"), "UTF-8"), 256),
        }
    )
    place = F.row_number().over(Window.partitionBy(*on).orderBy(*on))
    return (
        rows.join(stay, on, "left_semi")
        .withColumn("__place", place)
        .where(F.col("__place") == 1)
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )
