"""Near copies of the pipeline's stage against brute force on shingle sets."""

import random

import corpus_pipeline
from millrace.llm import near


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def brute_first(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            if len(one & sets[j]) / len(one | sets[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted({find(i) for i in range(len(texts))})


def near_texts():
    """Copies with about 2% of their words replaced (0.8 to 0.9 alike), chains of them, and 0.6 alike ones."""
    rng = random.Random(7)
    made = []
    for group in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(200)]
        made.append(" ".join(base))
        for copy in range(4):
            for share in (4, 10):
                text = list(base)
                for i in rng.sample(range(200), share):
                    text[i] = f"n{group}x{copy}x{i}"
                made.append(" ".join(text))
        for step in range(4):  # each like the one before, not like the base
            for i in rng.sample(range(200), 4):
                base[i] = f"c{group}x{step}x{i}"
            made.append(" ".join(base))
    return [*made, None, "", "one", "ONE", "one two", "a b c d e", "A b c d e"]


def test_stage_keeps_one_of_near_copies(spark):
    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.unlike(spark, docs, "")
    wanted = brute_first(texts)
    assert len(wanted) < len(texts) / 2
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == wanted


def test_rows_without_id_repeated_rows_and_no_rows(spark):
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(near.one_of_each(docs).collect(), key=repr) == sorted([(4, "a b c d"), (None, "q")], key=repr)
    assert near.one_of_each(docs.limit(0)).count() == 0


def fringe_texts(n=120, words=120, changed=3):
    """Copies of one text that are each a bit too far from the text and from one another, but for a few."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    made = []
    for copy in range(n):
        text = list(base)
        for i in rng.sample(range(words), changed):
            text[i] = f"n{copy}x{i}"
        made.append(text)
    for copy in range(0, 24, 3):  # alike with one copy only
        text = list(made[copy])
        text[rng.randrange(words)] = f"m{copy}"
        made.append(text)
    for copy in range(40, 52, 3):  # cut off at the end, as others are
        made.append(made[copy][: words - 8])
        made.append(base[: words - 20 - copy % 2])
    return [" ".join(t) for t in made]


def test_groups_just_below_the_similarity(spark, monkeypatch):
    for changed in (2, 3, 5):
        texts = fringe_texts(changed=changed)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        checked = []
        plain = near._alike

        def counted(pairs, sets, similarity):
            checked.append(pairs.count())
            return plain(pairs, sets, similarity)

        with monkeypatch.context() as patched:
            patched.setattr(near, "_alike", counted)
            kept = sorted(r["doc_id"] for r in near.one_of_each(docs).collect())
        assert kept == brute_first(texts)
        assert sum(checked) < len(texts) * 32 + len(texts) ** 2 / 4


def test_any_column_names_and_long_texts(spark):
    long = " ".join(f"w{i % 7001}x{i // 13}" for i in range(60_000))
    rows = [(1, long, "a", "b", 1, "p"), (2, long + " end", "a", "b", 2, "q"), (3, "other", None, None, 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_name string, name string, node int, `__place` string")
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


def test_no_table_between_the_steps_is_left(spark):
    import glob

    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/millrace"
    before = set(glob.glob(f"{folder}/near-*")) | set(glob.glob(f"{folder}/stars-*"))
    near.one_of_each(docs).count()
    new = (set(glob.glob(f"{folder}/near-*")) | set(glob.glob(f"{folder}/stars-*"))) - before
    assert len([n for n in new if "near-signatures" not in n]) <= 3  # results of components that others still read


def test_fingerprints_and_trees_link_what_shares_no_band(spark, monkeypatch):
    """The stage's links within two bits come from ``simhash``, checked on the shingles."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(9000)}" for _ in range(3000)]
    texts = [" ".join(base), " ".join([*base, "end"]), " ".join(["start", *base]), "one two", "three four"]
    seen = []
    plain = near.simhash.links

    def counted(prints, *args, **named):
        seen.append(prints.count())
        return plain(prints, *args, **named)

    def alone():
        numbers = iter(range(10**6))
        return lambda hashes: [hash((next(numbers), hashes.tobytes())) >> 1]

    monkeypatch.setattr(near.simhash, "links", counted)
    monkeypatch.setattr(near, "_bands", alone)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    prints = [near.simhash.fingerprint(t.encode(), 5) for t in texts]
    assert max((prints[0] ^ p).bit_count() for p in prints[1:3]) <= 2
    assert sorted(r["doc_id"] for r in corpus_pipeline.unlike(spark, docs, "").collect()) == [0, 3, 4]
    assert len(seen) == 1 and seen[0] >= 3
    # One fingerprint for all: none is taken for a copy unless its shingles say so.
    monkeypatch.setattr(near.simhash, "majority", lambda hashes: 5)
    assert sorted(r["doc_id"] for r in corpus_pipeline.unlike(spark, docs, "").collect()) == [0, 3, 4]


def test_candidates_of_groups_just_below_the_similarity(spark, monkeypatch):
    """Texts that share few words of their differences with the hub are not compared."""
    texts = fringe_texts(n=400)
    met = []
    plain = near._rest

    def counted(apart, similarity, scratch):
        found = plain(apart, similarity, scratch)
        met.append(found.count())
        return found

    monkeypatch.setattr(near, "_rest", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = sorted(r["doc_id"] for r in near.one_of_each(docs).collect())
    assert kept == brute_first(texts)
    assert sum(met) < 8 * len(texts)
