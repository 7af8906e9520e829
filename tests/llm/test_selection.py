"""Resampling, line rules and collocations against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import collocations, line_rules, resample

TEXT = "doc_id long, text string, score string, rank string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain_buckets(text):
    words = plain_words(text)
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return [zlib.crc32(f.encode()) % 10_000 for f in words + pairs]


def brute_ranks(rows, target):
    source = Counter(b for _, t in rows for b in plain_buckets(t))
    wanted = Counter(b for t in target for b in plain_buckets(t))
    all_s, all_t = sum(source.values()), sum(wanted.values())
    made = []
    for doc_id, text in rows:
        found = plain_buckets(text)
        gains = [
            math.floor(1000 * math.log((wanted[b] + 1) * (all_s + 10_000) / ((source[b] + 1) * (all_t + 10_000))))
            for b in found
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append([doc_id, len(found), weight, score, None])
    able = [m for m, (_, t) in zip(made, rows, strict=True) if len(plain_words(t)) >= 20]
    able.sort(key=lambda m: (-m[3], m[0] is None, m[0] or 0, m[1]))
    for i, m in enumerate(able[: 25 * len(able) // 100]):
        m[4] = i + 1
    return sorted((tuple(m) for m in made), key=repr)


def sample_rows():
    rng = random.Random(3)
    names = [f"{a}{b}" for a in ("Ab", "el", "ñu", "q7") for b in ("o", "RA", "12", "ß")]
    rows = [(i, " ".join(rng.choices(names, k=rng.randrange(5, 60))) + ".") for i in range(160)]
    rows += [(7, rows[7][1])] * 60  # one row a quarter of the table
    return [*rows, (900, None), (901, ""), (None, "x " * 30), (902, "wide-word " * 40_000)]


def test_resampling(spark, rows):
    made, target = sample_rows(), ["el12 elo Abo", None, "ñura elo"]
    docs = spark.createDataFrame([(i, t, "s", "r") for i, t in made], TEXT).repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    wanted = brute_ranks(made, target)
    assert rows(resample.ranks(docs, goal)) == wanted
    drawn = resample.resampled(docs, goal)
    assert drawn.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in drawn.collect()) == sorted(w[0] or -1 for w in wanted if w[4])
    assert resample.ranks(docs.limit(0), goal).count() == 0
    assert resample.ranks(docs, goal.limit(0)).where("rank IS NOT NULL").count() == sum(w[4] is not None for w in wanted)


def test_features_do_not_depend_on_parts(monkeypatch):
    text = ("One two-three FOUR é5 " * 50).encode()
    whole = sorted(np.concatenate([f for _, f in resample.features(text)]).tolist())
    for part in (1, 7, 64):
        monkeypatch.setattr(resample, "PART", part)
        assert sorted(np.concatenate([f for _, f in resample.features(text)]).tolist()) == whole
    assert whole == sorted(plain_buckets(text.decode()))


@pytest.mark.parametrize("k", [1, 2, 40, 99, 100])
def test_kth_key(spark, k):
    made = [(-(i // 7), i % 5 == 0, i % 11, i % 3, i) for i in range(100)]
    schema = "_low long, _last boolean, _id long, n_features long, _place long"
    found = resample.kth_key(spark.createDataFrame(made, schema).repartition(4), k, pivots=3)
    assert tuple(found) == sorted(made)[k - 1]


def brute_repeats(words):
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    return len({j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)})


def test_base_counts():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 4, 50, 400):
        words = [rng.choice("abcdé") for _ in range(n)]
        text = "".join(w + rng.choice([" ", "\n", "\t", "\r\n", "\x0b", "  "]) for w in words)
        plain = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = line_rules.measure(text.encode())
        assert found[0] == len(plain) and found[1] == sum(map(len, plain)) and found[4] == brute_repeats(plain)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert found[3] == len(lines) - len(set(lines))
    assert line_rules.measure(b"#*$%&|<>! a")[2] == 8


def sentence(i, n=12):
    return " ".join(f"w{i}x{j}" for j in range(n)) + "."


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        (sentence(1), None),
        ("a heading without an end", "punctuation"),
        ("Licensed under a licence.", None),
        (sentence(2).replace(" ", "*** "), "punctuation"),
        ("home | news | about us | contact | imprint.", "navigation"),
        ("a | b is one way to write a conditional probability in a text of many words.", None),
        ("By going on you accept our Terms of Use, whatever they are in your country.", "boilerplate"),
        ("seen before, and more than once.", "boilerplate"),
    ],
)
def test_rules_of_a_line(line, rule):
    assert line_rules.broken_rule(line.encode(), {b"seen before, and more than once."}) == rule


def test_documents_that_lose_too_much_go(spark, rows):
    good = "\n".join(sentence(i) for i in range(6))
    menu = "\n".join(f"menu {i} | item {i} | more {i} | end" for i in range(40))
    mixed = good + "\n\nShort heading\n" + "Read more\n" * 3
    made = [(1, good), (2, menu), (3, mixed), (4, None), (5, " \n"), (6, mixed), (6, mixed), (None, good)]
    docs = spark.createDataFrame([(i, t, "s", "k") for i, t in made], "doc_id long, text string, clean_text string, kept string")
    found = rows(line_rules.verdicts(docs), "doc_id", "kept", "n_failed_lines")
    assert found == sorted(
        [(1, True, 0), (2, False, 40), (3, True, 4), (4, False, 0), (5, False, 0), (6, True, 4), (6, True, 4), (None, True, 0)],
        key=repr,
    )
    kept = line_rules.cleaned(docs)
    assert kept.columns == docs.columns
    texts = {r["doc_id"]: (r["text"], r["clean_text"]) for r in kept.collect()}
    assert texts[1] == (good, "s") and texts[3][0].strip() == good
    assert line_rules.verdicts(docs.limit(0)).count() == 0
    assert line_rules.measure(b"word " * 400_000)[0] == 400_000


def phrase_rows():
    rng = random.Random(5)
    texts = []
    for i in range(120):
        words = [rng.choice("abcdefgh") if rng.random() < 0.8 else f"r{i}" for _ in range(40)]
        words[5:8] = ["new", "York", "city"]
        if i % 2:
            words[20:22] = ["new", "york"]
        texts.append((rng.choice(["x", "y", None, "und"]), " ".join(words).replace(" a ", ", ", 2)))
    return texts + [("x", "same same same same same")] * 40 + [("y", None), ("y", ""), ("z", "rare."), ("x", "long tail " * 30_000)]


def brute_counts(texts, least):
    counts = Counter()
    for lang, text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts[lang or "und", "", 0] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", " ".join(words[i : i + size]), size] += 1
    return {k: n for k, n in counts.items() if n and (n >= least or not k[2])}


@pytest.mark.parametrize(("shards", "cells"), [(3, 1 << 16), (1, 1 << 16), (5, 64), (2, 512), (3, 2048)])
def test_phrases_are_counted_whole(spark, shards, cells):
    """Also with so few cells that every phrase is taken for frequent."""
    texts = phrase_rows()
    docs = spark.createDataFrame(texts, "lang string, text string").repartition(4)
    found = {tuple(r)[:3]: r["n"] for r in collocations.mine(docs, shards=shards, cells=cells).groupBy("lang", "phrase", "size").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert found == brute_counts(texts, 30)


def brute_top(texts, top):
    counts = {(lang, tuple(p.split(" "))): n for (lang, p, size), n in brute_counts(texts, 30).items() if size}
    totals = {lang: n for (lang, _, size), n in brute_counts(texts, 30).items() if not size}
    made = {}
    for (lang, words), a in counts.items():
        if len(words) == 1:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        covered = any(
            other == lang and len(longer) > len(words) and 100 * n >= 80 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), n in counts.items()
        )
        if not covered:
            made.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, totals[lang], -score)
        for lang, rows in made.items()
        for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top])
    )


def test_top_phrases(spark, rows):
    texts = phrase_rows()
    docs = spark.createDataFrame(texts, "lang string, text string").repartition(4)
    found = rows(collocations.top_phrases(collocations.mine(docs, cells=1 << 16), top=25))
    assert sorted(found) == brute_top(texts, 25)
    assert collocations.top_phrases(collocations.mine(docs.limit(0), cells=1 << 16)).count() == 0


def test_scores_beyond_64_bits(spark, rows):
    n = 3 * 10**15
    frequent = [("x", "", 0, 9 * n), ("x", "a", 1, n), ("x", "b", 1, n + 1), ("x", "a b", 2, n - 1)]
    table = spark.createDataFrame(frequent, "lang string, phrase string, size int, n long")
    assert rows(collocations.top_phrases(table)) == [("x", 1, "a b", n - 1, n, n + 1, 9 * n, 2_000_000 * (n - 1) // (2 * n + 1))]


def test_forgotten_words_lose_no_count(spark, monkeypatch):
    from millrace.llm.collocations import _Counter

    steps = np.zeros(64, np.uint8)  # everything is active
    counter = _Counter(steps, 1, 1, 4)
    seen = Counter()
    for _ in range(3):
        for row in [*counter.count(counter.number("x", [b"a b.", b"c "])), *counter.word_rows()]:
            for r in row.to_pylist():
                seen[r["key"].decode().rpartition("\n")[2]] += r["n"]
        counter.forget()
    assert seen == {"a": 3, "b": 3, "c": 3, "a b": 3, "": 9}
    assert counter.number("x", [b" \tA  b,", b"", b"b"]).tolist() == [1, 2, 0, 0, 0, 2, 0]
