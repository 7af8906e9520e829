"""Quality classifier, toxicity and language model: held-out accuracy and brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from millrace.llm import language_model as lm
from millrace.llm import quality, toxicity

TEXT = "doc_id long, text string, score string, votes string"


def words(rng, n, vocabulary=400):
    return [f"{'abcdefghij'[x % 10]}{'lmnopqr'[x % 7]}en{'tuvw'[x % 4]}o" for x in rng.integers(0, vocabulary, n)]


def quality_rows(n=360):
    rng = np.random.default_rng(8)
    made = []
    for i in range(n):
        text = words(rng, int(rng.integers(20, 160)))
        kind = i % 8
        if kind == 0:
            text = [w + "***" for w in text]
        elif kind == 1:
            text = [x for w in text for x in (w, "|")]
        elif kind == 2:
            text = [w.upper() + "!!" for w in text]
        elif kind == 3:
            text = [w for w in text[:9] for _ in range(14)]
        made.append((i, " ".join(text) + ".", kind >= 4))
    return made


def test_quality_agrees_with_how_texts_were_made(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([(i, t, "s", "v") for i, t, _ in rows], TEXT).repartition(3)
    found = {r["doc_id"]: r for r in quality.classify(docs).collect()}
    right = sum(found[i]["keep"] == good for i, _, good in rows)
    assert right >= 0.98 * len(rows)
    weak = sum((found[i]["weak_label"] >= 0.5) == good for i, _, good in rows)
    assert weak >= 0.98 * len(rows)
    kept = quality.good_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["keep"] for r in found.values())


def test_quality_of_empty_and_missing_texts(spark, rows):
    docs = spark.createDataFrame(
        [(1, None, "", ""), (None, "", "", ""), (2, " \n", "", ""), (3, "x " * 90_000, "", "")], TEXT
    )
    found = rows(quality.classify(docs), "doc_id", "keep")
    assert [r for r in found if r[0] != 3] == sorted([(1, False), (None, False), (2, False)], key=repr)
    assert quality.classify(docs.limit(0)).count() == 0


def test_labellers_are_told_apart_without_labels():
    patterns = [((1, 1, 1), 800), ((-1, 1, 1), 60), ((1, -1, 1), 50), ((1, -1, -1), 40), ((0, 1, 1), 30)]
    posterior = quality.fit_labellers(patterns)
    assert posterior[1, 1, 1] > 0.9 and posterior[0, 1, 1] > 0.9
    assert max(posterior[-1, 1, 1], posterior[1, -1, 1], posterior[1, -1, -1]) < 0.2
    assert quality.fit_labellers([]) == {}


def toxic_rows(n=400):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(n):
        text, bad = words(rng, int(rng.integers(15, 60))), i % 4 == 0
        for _ in range(int(rng.integers(2, 5)) if bad else 0):
            text.insert(int(rng.integers(0, len(text))), ["zorch", "vexling", "vexlate", "vexler"][int(rng.integers(0, 4))])
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "doc_id long, toxic int, score string")
    found = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i]["held_out"] for i, _ in held)
    assert sum(r["held_out"] for r in found.values()) == len(held)
    right = sum(found[i]["predicted"] == y for i, y in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_search_equals_comparing_with_every_example():
    rows = toxic_rows(200)
    index = toxicity.ExampleIndex([(i, y, t.encode()) for i, t, y in rows], 0.25)
    assert index.terms
    vectors = [index._vector(toxicity.words(t.encode())) for _, t, _ in rows]

    def dense(vector):
        full = np.zeros(len(index.terms))
        full[vector[0]] = vector[1]
        return full

    every = np.array([dense(v) for v in vectors])
    for vector in vectors[:60]:
        cosines = np.round(every @ dense(vector), 12)
        order = [i for i in np.lexsort((np.arange(len(cosines)), -cosines)) if cosines[i] > 0]
        numbers, got = index.nearest(*vector, count=5)
        assert np.allclose(got, cosines[order[:5]])
        assert numbers.tolist() == order[:5] or np.allclose(cosines[numbers], cosines[order[:5]])


def test_toxicity_without_examples(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (2, None)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, labels).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).count() == 0


def tokens_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [None]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


@pytest.fixture
def small_batches(monkeypatch):
    monkeypatch.setattr(lm, "BATCH_TOKENS", 700)
    monkeypatch.setattr(lm, "PART_BYTES", 6000)


def lm_rows():
    rng = np.random.default_rng(11)
    rows = []
    for i in range(240):
        text = words(rng, int(rng.integers(5, 80)), 150)
        for at in range(0, len(text), 2):
            text[at] = "hot"  # half of all tokens
        rows.append((i, " ".join(text)))
    return [*rows, (900, None), (None, "Hot hot new"), (901, ""), (5, "hot again"), (902, "unseen" + "x" * 5000)]


def test_language_model_counts_and_scores(spark, small_batches):
    rows = lm_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    found = lm.score(docs).collect()
    count = Counter()
    for i, t in rows:
        if not held_out(i):
            count.update(tokens_of(t))
    total, known = sum(count.values()), len(count)

    def wanted(i, t):
        own = tokens_of(t)
        base = sum(math.log10((count[x] + 1) / (total + known + 1)) for x in own)
        return (repr(i), held_out(i), len(own), sum(count[x] > 0 for x in own), total, round(base, 6))

    got = [
        (repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in found
    ]
    assert sorted(got) == sorted(wanted(i, t) for i, t in rows)
    held = [r for r in found if r["held_out"] and r["n_tokens"] > 5]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    again = {(r["doc_id"], r["n_tokens"]): r["score"] for r in lm.score(docs).collect()}
    assert all(abs(again[r["doc_id"], r["n_tokens"]] - r["score"]) < 1e-9 for r in found)


def test_hot_words_are_dealt_over_parts(spark, small_batches):
    docs = spark.createDataFrame(lm_rows(), "doc_id long, text string").coalesce(3)
    parts = lm.prepared(docs, lm.held_out_rows()).select("part", "hot", "n_words").collect()
    hot = [r for r in parts if r["hot"] is not None]
    assert len({r["part"] for r in hot}) > 1 and all(r["n_words"] == 1 for r in hot)


def test_probabilities_sum_to_one(spark, small_batches):
    """All known words and "unknown" share the probability of any context."""
    docs = spark.createDataFrame(lm_rows(), "doc_id long, text string").coalesce(2)
    parts = lm.prepared(docs, lm.held_out_rows())
    model = lm.fit(parts, 2)
    sums = np.zeros(lm.CONTEXTS)
    flat = 1 / (model.known_words + 1)
    totals, d = model.totals[2], model.discount
    back = (lm.STRENGTH[2] + d[2] * totals.tables[2]) / (lm.STRENGTH[2] + totals.customers[2])
    group = np.arange(lm.CONTEXTS) // (lm.CONTEXTS // lm.PARENTS)
    for row in parts.toPandas().itertuples(index=False):
        if pd.notna(row.hot):
            continue
        seats = lm._after(row, model, 2)
        _, cell = seats.word_parents(model, totals)
        known = seats.word_customers > 0
        sums += back * cell[known].sum(axis=0)[group]
        own = (seats.customers - d[2] * seats.tables) / (lm.STRENGTH[2] + totals.customers[2][seats.context])
        sums += np.bincount(seats.context, own, lm.CONTEXTS)
    unknown = (lm.STRENGTH[0] + d[0] * totals.tables[0][0]) * flat / (lm.STRENGTH[0] + totals.customers[0][0])
    parent = (lm.STRENGTH[1] + d[1] * totals.tables[1]) / (lm.STRENGTH[1] + totals.customers[1])
    sums += back * parent[group] * unknown
    assert np.allclose(sums, 1, atol=1e-9)


def test_language_model_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(docs).count() == 0


def test_seating_follows_the_restaurant_process():
    """The mean number of tables of a lone dish against its exact expectation."""
    rng = np.random.default_rng(1)
    customers, discount, strength = 30, 0.5, 1.0
    ones = np.full(4000, customers)
    tables = lm.seat(ones, strength, np.ones(4000), np.zeros(4000), discount, rng)
    expected = 1.0
    for n in range(1, customers):
        expected += (strength + discount * expected) / (strength + n)
    assert abs(tables.mean() - expected) < 0.15
    assert lm.seat(np.array([0, 1, 5]), 1.0, np.full(3, 0.1), np.zeros(3), 0.5, rng).tolist()[:2] == [0, 1]


def test_whole_words_name_the_contexts(spark):
    """Words with one ending that different words follow."""
    rows = [(i, " ".join(["walking alone", "talking aloud"][(i + k) % 2] for k in range(8))) for i in range(60)]
    asked = ["walking alone " * 4, "walking aloud " * 4, "talking aloud " * 4, "talking alone " * 4]
    assert lm.context_of(b"walking") == lm.context_of(b"talking")
    names = [i for i in range(2000, 3000) if held_out(i)][:4]
    rows += zip(names, asked)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = dict(lm.score(docs).select("doc_id", "score").collect())
    right, wrong, also_right, also_wrong = (score[i] for i in names)
    assert right > wrong + 2 and also_right > also_wrong + 2


def test_totals_of_words_and_slices(spark, small_batches):
    """Every part knows the sums of all parts; slices have their word's upper levels."""
    docs = spark.createDataFrame(lm_rows(), "doc_id long, text string").coalesce(2)
    parts = lm.prepared(docs, lm.held_out_rows())
    model = lm.fit(parts, 2)
    every = [lm._after(row, model, 2) for row in parts.toPandas().itertuples(index=False)]
    sums, count = {}, Counter()
    for seats in every:
        for name, c, t in zip(seats.guests[seats.guest], seats.pair_customers, seats.pair_tables):
            assert min(c, 1) <= t <= c
            sums[name] = sums.get(name, np.zeros(2)) + (c, t)
    for seats in every:
        assert all((seats.told[:, i] == sums[name]).all() for i, name in enumerate(seats.guests))
        assert (seats.of_pairs(model, model.totals[2]) > 0).all()
    for i, text in lm_rows():
        line = tokens_of(text)
        if not held_out(i):
            count.update(zip([None, *line], line))
    wanted = sum(n for (_, w), n in count.items() if w == b"hot")
    sliced = [s for s in every if s.is_slice]
    own = [s for s in every if len(s.hot_places)]
    assert len(sliced) > 1 and own
    assert wanted in {int(s.counts[0]) for s in sliced}
    for seats in sliced:
        home = next(s for s in own if s.part == seats.home and seats.first in s.routes)
        upper = home.of_endings(model, model.totals[2])[home.hot_cells].reshape(-1, lm.CONTEXTS)
        assert np.allclose(seats.of_endings(model, model.totals[2]), upper[home.routes[seats.first][0]])
    assert sum(int(s.pair_customers.sum()) for s in every) == sum(count.values()) == model.tokens


def test_answers_are_passed_on_within_a_part(spark, small_batches, monkeypatch):
    """A part that many batches ask does not hold sums for all their texts."""
    docs = spark.createDataFrame(lm_rows(), "doc_id long, text string").repartition(6, "doc_id")
    parts = lm.prepared(docs, lm.held_out_rows())
    model = lm.fit(parts, 1)
    rows = lm._with_letters(parts.drop("hot").join(model.held, "part", "left"), model.stored[1]).toPandas()

    def sums(frames):
        found, most = {}, 0
        for frame in frames:
            most = max(most, len(frame))
            for batch, known, score in zip(frame["batch"], frame["known"], frame["score"]):
                values = np.frombuffer(known, "<i4"), np.frombuffer(score, "<f8")
                found[batch] = found.get(batch, 0) + np.stack(values)
        return found, most

    whole, most = sums(lm._answered([rows], model, [1]))
    assert most == len(whole) > 3
    monkeypatch.setattr(lm, "HELD_BYTES", 1)
    dealt, most = sums(lm._answered([rows], model, [1]))
    assert most == 1 and all(np.allclose(dealt[b], whole[b]) for b in whole)


def test_answers_grow_with_pairs_and_not_with_parts(spark, small_batches, monkeypatch):
    """Batches add up their pairs' probabilities as parts that have the places do."""
    docs = spark.createDataFrame(lm_rows(), "doc_id long, text string").repartition(3, "doc_id")
    sizes = []
    for part_bytes in (24_000, 1500):
        monkeypatch.setattr(lm, "PART_BYTES", part_bytes)
        parts, kept, _ = lm._parts(docs, lm.held_out_rows(), "text", "doc_id", True)
        model = lm.fit(parts, 1)
        rows = lm._with_letters(parts.drop("hot").join(model.held, "part", "left"), model.stored[1]).toPandas()
        sent = [lm._answers(r, model, [1]) for r in rows.itertuples(index=False) if len(r.requests)]
        pairs = sum(len(lm._numbers(r["uses"])) for r in kept.collect())
        found = pd.concat(sent)
        assert sum(len(lm._numbers(x)) for x in found["chances"]) == pairs
        sizes.append((len(rows), pairs))
    assert sizes[1][0] > 4 * sizes[0][0] and sizes[1][1] == sizes[0][1]
    inline = lm.prepared(docs, lm.held_out_rows())
    assert inline.where("size(requests) > 0").count() == sizes[1][0]
    rows = lm._with_letters(inline.drop("hot").join(model.held, "part", "left"), model.stored[1]).toPandas()
    wanted = []
    for frame in lm._answered([rows], model, [1]):
        for r in frame.itertuples(index=False):
            wanted += zip(np.frombuffer(r.tokens, "<i8"), np.frombuffer(r.score, "<f8"), np.frombuffer(r.base, "<f8"))
    got = lm.score(docs, sweeps=1, burn_in=0).select("n_tokens", "score", "base_score").collect()
    assert np.allclose(sorted(wanted), sorted(tuple(r) for r in got), rtol=0, atol=1e-6)
