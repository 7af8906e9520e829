"""Pigeonhole matching against a plain edit distance."""

import numpy as np

from millrace.llm import decontaminate as dc


def plain_distance(pattern, text):
    last = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        row = [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != t)))
        last = row
    return min(last)


def test_bit_parallel_search_is_edit_distance():
    rng = np.random.default_rng(3)
    for _ in range(300):
        pattern = rng.integers(0, 4, int(rng.integers(1, 90))).tolist()
        text = rng.integers(0, 4, int(rng.integers(0, 120))).tolist()
        assert dc.search(pattern, text)[0] == min(plain_distance(pattern, text), len(pattern))


def test_matches_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"word{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(3, 40))))) for i in range(12)]
    items += [(50, None), (51, "!!"), (None, "just four words here"), (0, items[0][1])]
    docs = []
    for i in range(120):
        text = rng.choice(vocabulary, int(rng.integers(0, 60))).tolist()
        item = items[int(rng.integers(0, 12))][1].split()
        for _ in range(int(rng.integers(0, 9))):
            at = int(rng.integers(0, len(item)))
            item[at : at + int(rng.integers(0, 2))] = rng.choice(vocabulary, int(rng.integers(0, 2))).tolist()
            item = item or ["x"]
        docs.append((i, " ".join([*text, *item, *text[::-1]]).upper() + ".", "clash"))
    docs += [(500, None, "x"), (501, "", "x"), (502, "Just four, words HERE", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, matches string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    old, dc.BLOCK_WORDS = dc.BLOCK_WORDS, 20  # several blocks
    try:
        rows = dc.reported(dc.find_matches(frame, bench)).collect()
        kept = sorted(r["doc_id"] for r in dc.without_matches(frame, bench).collect())
    finally:
        dc.BLOCK_WORDS = old
    split = {t: dc.words((t or "").encode()) for _, t in items}
    for row in rows:
        words = dc.words((dict((d, t) for d, t, _ in docs)[row["doc_id"]] or "").encode())
        wanted = [
            i
            for i, t in items
            if split[t] and plain_distance(split[t], words) <= int(0.2 * len(split[t]) + 1e-9)
        ]
        assert sorted(row["item_ids"], key=repr) == sorted(wanted, key=repr)
        assert row["contaminated"] == bool(wanted)
    assert kept == sorted(r["doc_id"] for r in rows if not r["contaminated"])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["contaminated"] for r in dc.reported(dc.find_matches(docs, none)).collect()] == [False]
    assert dc.find_matches(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0
