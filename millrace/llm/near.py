"""Near copies: texts that share ``SIMILARITY`` of their shingles, found by SimHash and MinHash, checked exactly.

Two texts are alike when the Jaccard similarity of their sets of ``WORDS``-word
shingles is ``SIMILARITY`` or more; a text of fewer words is one shingle. Near
copies are the connected components of that relation.

The method is that of ``simhash``: fingerprints (of ``WORDS``-word shingles), links within
its radius by BK-trees, connected components. Its links are checked exactly on the shingles;
texts with one fingerprint are checked against the first of them.

That radius leaves copies apart: texts at 0.8 differ by about 7 of 64 bits, and by over 10
often, and blocks for such a radius have five bits or fewer, so each shard would be a
large part of the table. So what BK-trees have not connected is searched further, by
MinHash. A text has ``BANDS`` bands of ``ROWS`` minima over its shingles' hashes. Two texts at
0.8 share no band with a chance of (1 - 0.8 ** 4) ** 32, under one in ten million.
Bands with texts that are not connected yet are compared in two passes, each checking the
shingles exactly:

* every text with the hub of each of its bands, one comparison for a band;
* bands that are not connected by that make clusters with a hub each, the text in most
  of their bands. ``D`` is what a text's set and the hub's have apart. Two sets at
  similarity s have at most c = (1 - s) / (1 + s) of their sizes apart, and that is what
  their ``D`` have apart. So texts that are alike have ``o`` elements of ``D`` in common, half
  of what the two ``D`` hold beyond that. In any order of elements, the first they have in
  common is among the first ``c (1 + 1 / s) / 2`` of the size, plus one, in the smaller
  ``D``, among the first ``c (1 + 1 / s)`` of the size, plus one, in the larger, and has
  ``o - 1`` elements or more behind it in both. Elements that only texts connected already
  hold come first in that order, then rare ones: pairs that meet in such an element are
  compared. No other can be alike.

A large group of near copies costs one comparison for a text and band, and texts that
are each a bit too far from all others meet only where they share what is rare. No
band or cluster is gathered in one task. Tables between the steps are removed at the end.

NULL text counts as empty. Equal texts are one node, named by 128 bits of digest. Rows
with a NULL id take part, repeated rows count once, and columns may have any names. A
very long text is one set. An empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import simhash
from millrace.llm.common import appended, clean_text, materialize, shared_dir, slices, text_bytes
from millrace.llm.components import connected_components
from millrace.llm.simhash import row_name
from millrace.session import remove

WORDS = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
SEED = 42
_CHUNK = 1 << 10  # shingles whose minima are taken at a time


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """Different hashes of a text's shingles, sorted."""
    return _different(simhash.shingle_hashes(text, words))


def _different(hashes: np.ndarray) -> np.ndarray:
    """Sorted, each once; a text without words is one shingle too."""
    return np.unique(hashes) if len(hashes) else np.zeros(1, dtype=np.uint64)


def _bands():
    """A function from shingle hashes to the names of their bands."""
    from xxhash import xxh64_intdigest

    rng = np.random.default_rng(SEED)
    top = np.iinfo(np.uint64).max
    factor = rng.integers(0, top, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    mask = rng.integers(0, top, BANDS * ROWS, dtype=np.uint64)

    def of(hashes: np.ndarray) -> list[int]:
        least = np.full(BANDS * ROWS, top, dtype=np.uint64)
        for i in range(0, len(hashes), _CHUNK):
            part = (hashes[i : i + _CHUNK, None] ^ mask) * factor
            np.minimum(least, part.min(axis=0), out=least)
        rows = least.reshape(BANDS, ROWS)
        names = [xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)]
        return np.array(names, dtype=np.uint64).astype(np.int64).tolist()

    return of


def _signed(rows: DataFrame, words: int) -> DataFrame:
    """Number of shingles, fingerprint and bands in place of the text."""

    def work():
        of = _bands()

        def act(texts):
            every = [simhash.shingle_hashes(t, words) for t in texts]
            found = [_different(h) for h in every]
            prints = np.array([simhash.majority(h) for h in every], dtype=np.uint64).astype(np.int64)
            return [len(h) for h in found], prints, [of(h) for h in found]

        return act

    added = [
        T.StructField("size", T.LongType()),
        T.StructField("simhash", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
    return appended(rows, "text", added, work, without=["text"])


def _as_sets(texts: DataFrame, words: int) -> DataFrame:
    """Sorted shingle hashes, eight bytes each, in place of the text."""

    def act(found):
        return [[shingle_hashes(t, words).tobytes() for t in found]]

    return appended(texts, "text", [T.StructField("shingles", T.BinaryType())], lambda: act, without=["text"])


def _set(value) -> np.ndarray:
    return np.frombuffer(text_bytes(value), dtype=np.uint64)


def _both_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    return pairs


def _common(one: np.ndarray, other: np.ndarray) -> int:
    return len(np.intersect1d(one, other, assume_unique=True))


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs(a, b)`` that share enough shingles."""

    def run(batches):
        for batch in slices(batches, "set_b"):
            kept = []
            for a, b in zip(map(_set, batch.column("set_a")), map(_set, batch.column("set_b")), strict=True):
                common = _common(a, b)
                kept.append(common / (len(a) + len(b) - common) >= similarity)
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"]
            )

    return _both_sets(pairs, sets).select("a", "b", "set_a", "set_b").mapInArrow(run, "a string, b string")


class _Scratch:
    """Stored tables that are removed together."""

    def __init__(self):
        self.paths: list[tuple] = []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        spark, path = df.sparkSession, shared_dir(df.sparkSession, label)
        self.paths.append((spark, path))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for spark, path in self.paths:
            remove(spark, path)
        self.paths.clear()


def _connected(nodes: DataFrame, links: DataFrame, scratch: _Scratch) -> DataFrame:
    """``nodes`` with the ``root`` that the links give them, else their own name."""
    roots = connected_components(links, scratch.paths)
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _apart(clustered: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """For each node what its set and its hub's have apart, and whether the two are alike.

    ``clustered(a, b, cluster, root)`` has a node as ``a`` and its hub as ``b``.
    """

    def run(batches):
        for batch in slices(batches, "set_a"):
            linked, size, elements = [], [], []
            for a, b in zip(map(_set, batch.column("set_a")), map(_set, batch.column("set_b")), strict=True):
                common = _common(a, b)
                linked.append(common / (len(a) + len(b) - common) >= similarity)
                size.append(len(a))
                elements.append(np.setxor1d(a, b, assume_unique=True).view(np.int64))
            arrays = [batch.column(c) for c in ("a", "b", "cluster", "root")]
            arrays += [pa.array(linked, pa.bool_()), pa.array(size, pa.int64()), pa.array(elements, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "hub", "cluster", "root", "linked", "size", "apart"])

    both = _both_sets(clustered, sets).select("a", "b", "cluster", "root", "set_a", "set_b")
    schema = "node string, hub string, cluster string, root string, linked boolean, size long, apart array<long>"
    return both.mapInArrow(run, schema)


def _rest(apart: DataFrame, similarity: float, scratch: _Scratch) -> DataFrame:
    """Pairs of nodes of one cluster that may be alike and are not connected yet."""
    # Nodes alike with the hub are one group; others go with what they are connected to.
    group = F.when(F.col("linked"), F.lit("hub")).otherwise(F.col("root"))
    held = apart.select(
        "cluster", "node", "size", group.alias("own"), F.size("apart").alias("n_apart"), F.explode("apart").alias("element")
    )
    held = scratch.keep(held, "near-apart")
    counts = held.groupBy("cluster", "element").agg(
        F.count(F.lit(1)).alias("holders"), F.min("own").alias("x"), F.max("own").alias("y")
    )
    # Elements that only one group holds name no pair; they come first in a node's order.
    mixed = held.join(counts.where("x <> y").select("cluster", "element", "holders"), ["cluster", "element"])
    c = (1 - similarity) / (1 + similarity)
    reach = F.col("size") * (c * (1 + 1 / similarity))
    all_mixed = Window.partitionBy("cluster", "node")
    behind = F.count(F.lit(1)).over(all_mixed) - F.row_number().over(all_mixed.orderBy("holders", "element"))
    mixed = mixed.withColumn("place", F.col("n_apart") - behind).drop("holders")
    mixed = scratch.keep(mixed.where(F.col("place") <= F.floor(reach + 1e-9) + 1), "near-mixed")
    index = mixed.where(F.col("place") <= F.floor(reach / 2 + 1e-9) + 1)
    near = F.least("size", "other.size") / F.greatest("size", "other.size") >= similarity
    smaller = F.struct("n_apart", "node") < F.struct("other.n_apart", "other.node")
    shared = (F.col("n_apart") + F.col("other.n_apart") - c * (F.col("size") + F.col("other.size"))) / 2
    after = F.least(F.col("n_apart") - F.col("place"), F.col("other.n_apart") - F.col("other.place"))
    other = index.select("cluster", "element", F.struct("node", "size", "own", "n_apart", "place").alias("other"))
    # The index side is the smaller one, so it stands for ``other`` once turned round.
    may_be = (F.col("own") != F.col("other.own")) & near & ~smaller & (after + 1 >= shared - 1e-9)
    met = mixed.join(other, ["cluster", "element"]).where(may_be)
    return met.select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b")).where("a <> b").distinct()


def _by_fingerprint(signed: DataFrame, similarity: float, scratch: _Scratch) -> DataFrame:
    """Pairs to check: links of BK-trees, and texts with the first text of their fingerprint."""
    nodes = scratch.keep(signed.select("node", "size", "simhash").distinct(), "near-prints")
    first = scratch.keep(nodes.groupBy("simhash").agg(F.min(F.struct("node", "size")).alias("first")), "near-firsts")
    same = nodes.join(first, "simhash").select(F.struct("node", "size").alias("x"), F.col("first").alias("y"))
    close = simhash.links(first.select("simhash"), keep=scratch.keep)
    for side, name in (("a", "x"), ("b", "y")):
        close = close.join(first.select(F.col("simhash").alias(side), F.col("first").alias(name)), side)
    both = same.unionByName(close.select("x", "y")).where("x.node <> y.node")
    fits = F.least("x.size", "y.size") / F.greatest("x.size", "y.size") >= similarity
    pairs = both.where(fits).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    return scratch.keep(pairs, "near-fingerprints")


def roots(rows: DataFrame, signed: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """``node, root`` of every node with a near copy; ``rows`` has the texts of ``signed``."""
    scratch = _Scratch()
    within = _by_fingerprint(signed, similarity, scratch)
    wide = signed.select("node", "size", F.explode("bands").alias("band")).distinct()
    hubs = wide.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "size")).alias("hub"))
    members = scratch.keep(wide.join(hubs.where("n > 1").select("band", "hub"), "band"), "near-members")
    ends = within.select(F.explode(F.array("a", "b")).alias("node"))
    texts = rows.select("node", "text").join(members.select("node").union(ends).distinct(), "node", "left_semi")
    sets = scratch.keep(_as_sets(texts.dropDuplicates(["node"]), words), "near-sets")

    printed = scratch.keep(_alike(within, sets, similarity), "near-printed")
    known = scratch.keep(_connected(members, printed, scratch), "near-known")
    hub_root = F.max(F.when(F.col("node") == F.col("hub.node"), F.col("root"))).alias("hub_root")
    state = known.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"), hub_root)
    open_bands = scratch.keep(known.join(state.where("x <> y").select("band", "hub_root"), "band"), "near-open-bands")
    members = open_bands.drop("root", "hub_root")

    close = F.least("size", "hub.size") / F.greatest("size", "hub.size") >= similarity
    met = open_bands.where((F.col("root") != F.col("hub_root")) & close)
    pairs = met.select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct()
    links = scratch.keep(_alike(pairs, sets, similarity).unionByName(printed), "near-links")

    rooted = scratch.keep(_connected(members, links, scratch), "near-rooted")
    state = rooted.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    left = scratch.keep(rooted.join(state.where("x <> y").select("band"), "band", "left_semi"), "near-left")
    clusters = connected_components(left.select(F.col("node").alias("a"), F.col("hub.node").alias("b")), scratch.paths)
    weight = left.groupBy("node").agg(F.count(F.lit(1)).alias("bands"), F.first("root").alias("root"))
    weight = scratch.keep(weight.join(clusters.withColumnRenamed("root", "cluster"), "node"), "near-clusters")
    chosen = weight.groupBy("cluster").agg(F.max(F.struct("bands", "node")).alias("hub"))
    clustered = weight.join(chosen.select("cluster", F.col("hub.node").alias("b")), "cluster")
    clustered = clustered.select(F.col("node").alias("a"), "b", "cluster", "root")
    apart = scratch.keep(_apart(clustered, sets, similarity), "near-hubs")

    more = apart.where("linked AND node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    rest = _alike(_rest(apart, similarity, scratch), sets, similarity)
    found = connected_components(links.unionByName(more).unionByName(rest))
    scratch.clear()
    return found


def one_of_each(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    similarity: float = SIMILARITY,
    words: int = WORDS,
) -> DataFrame:
    """The first row of every component (smallest id, NULL last); of rows that repeat it, one."""
    name = row_name(text, doc_id).alias("name")
    rows = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        name,
        F.md5(F.encode(clean_text(f"`{text}`"), "UTF-8")).alias("node"),
        clean_text(f"`{text}`").alias("text"),
    )
    signed = materialize(_signed(rows, words), "near-signatures")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "name")
    nodes = signed.groupBy("node").agg(F.min(order).alias("first"))
    named = nodes.join(roots(rows, signed, similarity, words), "node", "left")
    least = named.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    first = least.select(F.col("first.name").alias("name"))
    # Repeated rows share a name; each task leaves one of them.
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    kept = df.select(name, whole).join(first, "name", "left_semi")
    return kept.groupBy("name").agg(F.first("row").alias("row")).select("row.*")
