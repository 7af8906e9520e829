"""SimHash near-duplicates: fingerprints, BK-trees and connected components.

Two fingerprints within ``radius`` differ in at most ``radius`` of the
``radius + 1`` blocks their bits are cut into, so they share a block. A shard
is the set of different fingerprints with one value of one block; it has a
BK-tree of its own, and each fingerprint is looked up in its own shards only.
(Sending every tree to every fingerprint would compare each shard with the
whole table.) A shard with more than ``SHARD_SIZE`` fingerprints is cut again by
the blocks of its remaining bits, as often as there are bits left.

A BK-tree hangs a fingerprint under the child whose key is the integer Hamming
distance to the parent. A search follows the edges whose key is within the
radius of the distance it has found. A tree's task keeps sets of fingerprints
that are linked already and emits an edge only when it joins two sets: at most
one edge for a fingerprint, and no link is lost.

Equal fingerprints are one node, so copies cost nothing. NULL text counts as
empty; texts without words have fingerprint zero and are linked like any other.
Rows with a NULL id take part; ``component_id`` is the smallest id that is not
NULL, or NULL when there is none.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import appended, clean_text, materialize
from millrace.llm.components import connected_components

BITS = 64
RADIUS = 2
WORDS = 3
SEED = 42
SHARD_SIZE = 512
_CHUNK = 1 << 16  # shingles whose bits are counted at a time


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """The hash of every shingle, repeats included; none without words."""
    from xxhash import xxh64_intdigest

    tokens = text.lower().split()
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxh64_intdigest(line, SEED)] if tokens else [], dtype=np.uint64)
    starts, at = [], 0
    for token in tokens:
        starts.append(at)
        at += len(token) + 1
    ends = [*starts[words:], at]
    hashes = [xxh64_intdigest(line[i : j - 1], SEED) for i, j in zip(starts, ends, strict=False)]
    return np.array(hashes, dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """64 bits: each is 1 if it is set in over half the hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    packed = hashes.astype(">u8")
    for i in range(0, len(packed), _CHUNK):
        part = packed[i : i + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(packed)).tobytes(), "big")


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """64 bits: each is 1 if it is set in over half the shingle hashes of the text."""
    return majority(shingle_hashes(text, words))


def fingerprints(df: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """Add ``simhash``, the fingerprint as a signed 64-bit integer."""

    def work():
        def act(texts):
            found = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
            return (found.astype(np.int64),)

        return act

    return appended(df, text, [T.StructField("simhash", T.LongType())], work)


class BkTree:
    """Fingerprints by Hamming distance; children are keyed by the distance to their parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        node = len(self.values)
        if node:
            at = 0
            while True:
                key = (self.values[at] ^ value).bit_count()
                below = self.children[at].get(key)
                if below is None:
                    self.children[at][key] = node
                    break
                at = below
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Nodes no further than ``radius``; only edges within it are followed."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            edges = self.children[at]
            for key in range(distance - radius, distance + radius + 1):
                if key in edges:
                    open_nodes.append(edges[key])
        return found


def spanning_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what lies within ``radius``, one less than the values of a set."""
    tree, parent, links = BkTree(), list(range(len(values))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values):
        for j in tree.within(value, radius):
            if (a := root(i)) != (b := root(j)):
                parent[a] = b
                links.append((value, values[j]))
        tree.add(value)
    return links


def _blocks(bits: list[tuple[int, int]], parts: int) -> list[list[tuple[int, int]]]:
    """Cut bit ranges (start, length) into parts of about the same number of bits."""
    single = [b for start, length in bits for b in range(start, start + length)]
    cuts = [round(i * len(single) / parts) for i in range(parts + 1)]
    return [_ranges(single[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _ranges(bits: list[int]) -> list[tuple[int, int]]:
    ranges: list[tuple[int, int]] = []
    for b in bits:
        if ranges and sum(ranges[-1]) == b:
            ranges[-1] = (ranges[-1][0], ranges[-1][1] + 1)
        else:
            ranges.append((b, 1))
    return ranges


def _mask(bits: list[tuple[int, int]]) -> int:
    mask = sum(((1 << length) - 1) << start for start, length in bits)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _without(bits: list[tuple[int, int]], block: list[tuple[int, int]]) -> list[tuple[int, int]]:
    gone = {b for s, n in block for b in range(s, s + n)}
    return _ranges([b for s, n in bits for b in range(s, s + n) if b not in gone])


def _tree_tasks(radius: int):
    """Rows come sorted by shard; each shard's tree lives only while its rows pass."""

    def flush(values, out):
        for a, b in spanning_links(values, radius):
            out.append((a, b))

    def run(batches):
        shard, values = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            keys = zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), strict=True)
            found = batch.column("simhash").to_numpy(zero_copy_only=False).astype(np.uint64).tolist()
            for key, value in zip(keys, found, strict=True):
                if key != shard:
                    flush(values, out)
                    shard, values = key, []
                values.append(value)
            yield _edges(out)
        out = []
        flush(values, out)
        yield _edges(out)

    def _edges(pairs):
        both = np.array(pairs, dtype=np.uint64).reshape(-1, 2).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return run


def links(
    prints: DataFrame, radius: int = RADIUS, shard_size: int = SHARD_SIZE, keep: Callable = materialize
) -> DataFrame:
    """``a, b``: links that connect all fingerprints within ``radius`` of each other.

    ``prints`` has one column ``simhash`` of different values. ``keep`` stores a table under a label.
    """
    found = None
    # (bits still free, rows, text that names the shard so far)
    level = [([(0, BITS)], prints.withColumn("path", F.lit("")))]
    while level:
        deeper = []
        for free, rows in level:
            blocks = _blocks(free, radius + 1)
            wide = rows.select(
                "simhash",
                F.explode(
                    F.array(
                        *[
                            F.struct(
                                F.lit(i).alias("block"),
                                F.xxhash64(
                                    "path", F.lit(i), F.col("simhash").bitwiseAND(F.lit(_mask(b)))
                                ).alias("part"),
                            )
                            for i, b in enumerate(blocks)
                        ]
                    )
                ).alias("at"),
            ).select("simhash", "at.block", "at.part")
            counts = wide.groupBy("block", "part").agg(F.count(F.lit(1)).alias("n"))
            shared = counts.where("n > 1")
            sized = keep(wide.join(shared, ["block", "part"]), "shards")
            small = (
                sized.where(F.col("n") <= shard_size)
                .repartition("block", "part")
                .sortWithinPartitions("block", "part", "simhash")
                .select("block", "part", "simhash")
                .mapInArrow(_tree_tasks(radius), "a long, b long")
            )
            found = small if found is None else found.unionByName(small)
            large = sized.where(F.col("n") > shard_size)
            if large.isEmpty():
                continue
            for i, block in enumerate(blocks):
                rest = _without(free, block)
                own = large.where(F.col("block") == i)
                if len(_bits(rest)) > radius:
                    path = F.concat_ws(".", F.lit(str(i)), F.col("part").cast("string"))
                    deeper.append((rest, own.select("simhash", path.alias("path"))))
                else:  # no bits left to cut by: such a shard has few different values
                    found = found.unionByName(
                        own.repartition("block", "part")
                        .sortWithinPartitions("block", "part", "simhash")
                        .select("block", "part", "simhash")
                        .mapInArrow(_tree_tasks(radius), "a long, b long")
                    )
        level = deeper
    return found


def _bits(ranges: list[tuple[int, int]]) -> list[int]:
    return [b for s, n in ranges for b in range(s, s + n)]


def components(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, words: int = WORDS
) -> DataFrame:
    """``doc_id, simhash, component_id`` of every row, and whether it is its component's first.

    ``row_name`` is made of id and text; the first row has the smallest id, NULL
    last, then the smallest name.
    """
    rows = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        row_name(text, doc_id).alias("row_name"),
        F.col(f"`{text}`").alias("text"),
    )
    prints = materialize(
        fingerprints(rows, "text", words).select("doc_id", "row_name", "simhash"), "fingerprints"
    )
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_name")
    nodes = materialize(prints.groupBy("simhash").agg(F.min(order).alias("first")), "nodes")
    roots = connected_components(links(nodes.select("simhash"), radius))
    named = nodes.join(roots.withColumnRenamed("node", "simhash"), "simhash", "left").select(
        "simhash", F.coalesce("root", "simhash").alias("root"), "first"
    )
    least = named.groupBy("root").agg(F.min("first").alias("first"))
    found = named.select("simhash", "root").join(least, "root").select("simhash", "first")
    return prints.join(found, "simhash").select(
        "doc_id",
        "simhash",
        F.col("first.doc_id").alias("component_id"),
        "row_name",
        (F.col("row_name") == F.col("first.row_name")).alias("is_first"),
    )


def row_name(text: str, doc_id: str):
    """Names rows by id and text; only repeated rows share one."""
    number = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    return F.concat(number, F.lit(":"), F.sha2(F.encode(clean_text(f"`{text}`"), "UTF-8"), 256))


def reported(found: DataFrame) -> DataFrame:
    """Fingerprints as 16 lower-case hexadecimal digits."""
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The first row of every component; of rows that repeat it, one."""
    first = components(df, text, doc_id).where("is_first").select(F.col("row_name").alias("name")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    named = df.select(row_name(text, doc_id).alias("name"), whole).join(first, "name", "left_semi")
    return named.groupBy("name").agg(F.first("row").alias("row")).select("row.*")
