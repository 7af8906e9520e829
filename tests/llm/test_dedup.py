"""Exact dedup and SimHash components against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from millrace.llm import exact, simhash
from millrace.llm.components import connected_components

SCHEMA = "doc_id long, text string, keep_id long, simhash string"

TEXTS = [
    (1, "same", 1, "x"),
    (2, "same", 1, "x"),
    (3, None, 1, "x"),
    (4, "", None, None),
    (5, "Same", 1, "x"),
    (None, "same", 1, "x"),
    (None, "alone", 1, "x"),
    (7, "twice", 1, "x"),
    (7, "twice", 1, "x"),
    (8, "long " * 30_000, 1, "x"),
    (9, "long " * 30_000, 1, "x"),
    (10, "é漢😀", 1, "x"),
]


def test_copies(spark, rows):
    docs = spark.createDataFrame(TEXTS, SCHEMA).repartition(3)
    found = rows(exact.find_copies(docs, capacity=64))
    wanted = []
    for i, t, _, _ in TEXTS:
        same = [j for j, u, _, _ in TEXTS if (u or "") == (t or "")]
        keep = max((j for j in same if j is not None), default=None)
        digest = hashlib.sha256((t or "").encode()).hexdigest()
        wanted.append((i, keep, len(same), i == keep, digest))
    assert found == sorted(wanted, key=repr)


def test_without_copies_keeps_columns_and_one_row(spark, rows):
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    kept = exact.without_copies(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted([(2,), (4,), (5,), (None,), (7,), (9,), (10,)], key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact.find_copies(docs).count() == 0
    assert exact.without_copies(docs).count() == 0
    assert simhash.components(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0


def test_directory_doubles_until_buckets_fit():
    loads = np.zeros(16, dtype=np.int64)
    loads[[0, 1, 9]] = (50, 60, 70)
    grown = exact.Directory.grown(loads, 100)
    assert len(grown.slots) == 1 << grown.depth
    inside = {}
    for prefix, load in enumerate(loads):
        bucket = grown.slots[prefix >> (4 - grown.depth)]
        inside[bucket] = inside.get(bucket, 0) + int(load)
    assert max(inside.values()) <= 100
    assert exact.Directory.grown(np.full(4, 1000), 10).depth == 2  # no bits left to split by
    assert exact.Directory.grown(loads, 1000).slots == [0]


def test_chain_tells_texts_of_one_key_apart():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([0, 0, 0], pa.int32()),
            pa.array([5, 5, 5], pa.int64()),
            pa.array([b"a", b"b", b"a"], pa.binary()),
            pa.array([1, 2, 3], pa.int64()),
            pa.array([1, 1, 4], pa.int64()),
        ],
        ["bucket", "key", "content", "keep_id", "group_size"],
    )
    made = pa.Table.from_batches(list(exact._own([batch]))).to_pylist()
    assert [(r["place"], r["keep_id"], r["group_size"]) for r in made] == [(0, 3, 5), (1, 2, 1)]


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    size = len(words)
    shingles = [b" ".join(words[i : i + 3]) for i in range(size - 2)] if size >= 3 else [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "a b", "a b c", "A\tb\x0bc d É é", "w " * 500, "x y z"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def near_texts():
    rng = np.random.default_rng(5)
    made = []
    for group in range(12):
        base = [f"w{x}" for x in rng.integers(0, 900, 150)]
        for copy in range(6):
            text = list(base)
            text[int(rng.integers(0, 150))] = f"new{group}{copy}"
            made.append(" ".join(text))
    return [*made, None, "", "one", "ONE", "one"]


def brute_components(values, radius=2):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_components(spark):
    texts = near_texts()
    docs = spark.createDataFrame(
        [(i, t, 1, "clash") for i, t in enumerate(texts)], SCHEMA
    ).repartition(4)
    found = {r["doc_id"]: r for r in simhash.reported(simhash.components(docs)).collect()}
    values = [plain_fingerprint(t) for t in texts]
    assert [found[i]["component_id"] for i in range(len(texts))] == brute_components(values)
    assert [found[i]["fingerprint"] for i in range(len(texts))] == [f"{v:016x}" for v in values]
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect())
    assert kept == sorted(set(brute_components(values)))


def test_rows_without_id_and_repeated_rows(spark, rows):
    docs = spark.createDataFrame(
        [(None, "a b c d", 1, ""), (4, "a b c d", 1, ""), (4, "a b c d", 1, ""), (None, "q", 1, "")], SCHEMA
    )
    assert rows(simhash.components(docs), "doc_id", "component_id") == sorted(
        [(None, 4), (4, 4), (4, 4), (None, None)], key=repr
    )
    assert rows(simhash.one_of_each(docs), "doc_id") == sorted([(4,), (None,)], key=repr)


def test_large_shards_are_cut_and_lose_no_link(spark):
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 1 << 62))
    values = {base ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (300, 3))}
    values = sorted(values | {int(x) for x in rng.integers(0, 1 << 62, 100)})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "simhash long"), shard_size=8)
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in found)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in found:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    wanted = brute_components(values)
    assert [find(v) for v in values] == [values[i] for i in wanted]


def test_bk_tree_finds_all_within_radius():
    rng = np.random.default_rng(2)
    values = [int(x) for x in rng.integers(0, 1 << 10, 400)]
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    for v in values[:40]:
        found = sorted(tree.within(v, 2))
        assert found == [i for i, w in enumerate(values) if (v ^ w).bit_count() <= 2]


def test_components_of_chains_and_stars(spark, rows):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 40)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (200, 201), (201, 200)], "a long, b long")
    found = dict(rows(connected_components(edges)))
    wanted = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 200, 201: 200}
    assert found == wanted
