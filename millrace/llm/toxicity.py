"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are at most ``EXAMPLES`` labelled texts of each class, chosen by a hash
of their id among the rows to learn from. Terms are words and the beginnings of
words (4 and 5 characters) whose occurrence in examples depends on the label, by
a likelihood ratio; everything else would add noise to the cosine. An example
counts for a term only where it has the term behind a word that no example of
its class had before it, since copies of a text say no more than one. A text's
vector holds ``(1 + ln tf) * idf`` of its terms over its whole length.

The index is inverted: each term has its examples in the order of their number,
and the largest weight in every block of ``BLOCK`` examples. A search bounds the
cosine in each block by those maxima, reads blocks from the highest bound on,
and ends when no unread block can hold one of the ``NEIGHBOURS`` best: the
result is that of comparing with every example. Equal cosines go to the smaller
number.

Neighbours vote with ``1 / (distance + 0.05)``. The vote, the best cosine and
the number of neighbours are turned into a probability by a logistic curve that
is fitted on the examples themselves, each judged without itself, weighted to
the share of the classes among all rows to learn from. The neighbours and shared
terms are the evidence.

A text without any term (an empty one, too; NULL counts as empty) gets the share
of toxic texts among such examples. Without examples of both classes the score
is the share of toxic labels, 0 if there are none. Several labels of one id
count as toxic if one is; NULL labels do not count. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import string
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import appended, clean_text

EXAMPLES = 2_500  # of each class
NEIGHBOURS = 15
BLOCK = 64
TOXIC_FROM = 0.3
PREFIXES = (4, 5)
LEAST_DOCS = 4
LEAST_RATIO = 20.0  # likelihood ratio a term needs; noise among 10^6 terms stays below
MOST_TERMS = 20_000
CACHED_TOKENS = 400_000
_CHUNK = 8  # blocks read at a time

_APART = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))

EVIDENCE = T.ArrayType(
    T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("toxic", T.IntegerType()),
            T.StructField("cosine", T.DoubleType()),
            T.StructField("terms", T.ArrayType(T.StringType())),
        ]
    )
)


def words(text: bytes) -> list[str]:
    return text.decode("utf-8", "replace").lower().encode().translate(_APART).decode().split()


def word_terms(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) > n]]


def _ratio(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> np.ndarray:
    """Likelihood ratio of a term's document counts in two classes of examples."""

    def part(x, n, p):
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return x * np.log(p) + (n - x) * np.log(1 - p)

    both = (a + b) / (n_a + n_b)
    own = part(a, n_a, a / n_a) + part(b, n_b, b / n_b)
    return 2 * (own - part(a, n_a, both) - part(b, n_b, both))


class ExampleIndex:
    """Block-max inverted index of labelled examples, and the calibrated vote."""

    def __init__(self, examples: list[tuple[int | None, int, bytes]], share: float) -> None:
        self.share = share  # of toxic labels among all rows to learn from
        self.ids = [i for i, _, _ in examples]
        self.labels = np.array([y for _, y, _ in examples], dtype=np.int64)
        self.known: dict[str, tuple[int, ...]] = {}
        tokens = [words(x) for _, _, x in examples]
        self.terms, self.idf = self._choose(tokens)
        self.number = {t: i for i, t in enumerate(self.terms)}
        vectors = [self._vector(t) for t in tokens]
        self._invert(vectors)
        self._calibrate(vectors)

    def _choose(self, tokens: list[list[str]]) -> tuple[list[str], np.ndarray]:
        n_a, n_b = int(self.labels.sum()), int((1 - self.labels).sum())
        if not n_a or not n_b:
            return [], np.zeros(0)

        def telling(counts: list[Counter]) -> list[str]:
            clean, toxic = counts
            terms = sorted(t for t in toxic | clean if toxic[t] + clean[t] >= LEAST_DOCS)
            a = np.array([toxic[t] for t in terms], dtype=float)
            b = np.array([clean[t] for t in terms], dtype=float)
            ratio = _ratio(a, n_a, b, n_b) if terms else np.zeros(0)
            best = np.argsort(-ratio, kind="stable")[:MOST_TERMS]
            return [terms[i] for i in sorted(best[ratio[best] >= LEAST_RATIO].tolist())]

        docs = [Counter(), Counter()]  # by label
        for own, label in zip(tokens, self.labels.tolist(), strict=True):
            docs[label].update({t for w in set(own) for t in word_terms(w)})
        likely = set(telling(docs))
        fresh, seen = [Counter(), Counter()], set()
        for own, label in zip(tokens, self.labels.tolist(), strict=True):
            new = set()
            for before, word in zip(["", *own], own, strict=False):
                for term in word_terms(word):
                    if term in likely and (place := (label, term, before)) not in seen:
                        seen.add(place)
                        new.add(term)
            fresh[label].update(new)
        terms = telling(fresh)
        df = [docs[0][t] + docs[1][t] for t in terms]
        return terms, np.array([math.log((1 + len(tokens)) / (1 + n)) + 1 for n in df])

    def _numbers(self, word: str) -> tuple[int, ...]:
        got = tuple(n for t in word_terms(word) if (n := self.number.get(t)) is not None)
        if len(self.known) >= CACHED_TOKENS:
            self.known.clear()
        self.known[word] = got
        return got

    def _vector(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights, of length one."""
        get, counts = self.known.get, Counter()
        for word in tokens:
            numbers = get(word)
            if numbers is None:
                numbers = self._numbers(word)
            if numbers:
                counts.update(numbers)
        at = np.array(sorted(counts), dtype=np.int64)
        weight = np.array([1 + math.log(counts[i]) for i in at.tolist()], float) * self.idf[at]
        return at, weight / max(float(np.sqrt((weight**2).sum())), 1e-12)

    def _invert(self, vectors) -> None:
        term = np.concatenate([at for at, _ in vectors] or [np.zeros(0, np.int64)])
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        example = np.repeat(np.arange(len(vectors)), np.array([len(at) for at, _ in vectors], int))
        order = np.lexsort((example, term))
        self.example, self.weight = example[order], weight[order]
        self.blocks = -(-len(vectors) // BLOCK)
        key = term[order] * max(self.blocks, 1) + self.example // BLOCK
        cells = len(self.terms) * max(self.blocks, 1)
        self.start = np.searchsorted(key, np.arange(cells + 1))
        self.highest = np.zeros(cells)
        np.maximum.at(self.highest, key, self.weight)
        self.highest = self.highest.reshape(len(self.terms), max(self.blocks, 1))

    def nearest(self, at, weight, without: int | None = None, count: int = NEIGHBOURS):
        """Numbers and cosines of the nearest examples, the nearest first."""
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weight @ self.highest[at]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        numbers, cosines = np.zeros(0, np.int64), np.zeros(0)
        for i in range(0, len(order), _CHUNK):
            if len(cosines) >= count and bound[order[i]] < cosines[count - 1] - 1e-12:
                break
            sums: dict[int, np.ndarray] = {}
            for block in order[i : i + _CHUNK].tolist():
                sums[block] = score = np.zeros(BLOCK)
                for t, w in zip(at.tolist(), weight.tolist(), strict=True):
                    cell = t * self.blocks + block
                    a, b = self.start[cell], self.start[cell + 1]
                    if a < b:
                        score[self.example[a:b] - block * BLOCK] += w * self.weight[a:b]
            new = np.concatenate([np.arange(BLOCK) + b * BLOCK for b in sums])
            score = np.round(np.concatenate(list(sums.values())), 12)
            use = (score > 0) & (new != (-1 if without is None else without))
            numbers = np.concatenate([numbers, new[use]])
            cosines = np.concatenate([cosines, score[use]])
            best = np.lexsort((numbers, -cosines))[:count]
            numbers, cosines = numbers[best], cosines[best]
        return numbers, cosines

    def _signals(self, numbers, cosines) -> np.ndarray:
        votes = 1 / (1 - np.minimum(cosines, 1) + 0.05)
        vote = float((votes * self.labels[numbers]).sum() / votes.sum())
        return np.array([1.0, vote - 0.5, float(cosines[0]), len(numbers) / NEIGHBOURS])

    def _calibrate(self, vectors) -> None:
        """Logistic curve by Newton's method on the examples, each judged without itself."""
        self.curve, self.bare = np.zeros(4), self.share
        n = len(vectors)
        if not self.terms or not n:
            return
        toxic = self.labels.mean()
        balance = np.where(self.labels == 1, self.share / toxic, (1 - self.share) / (1 - toxic))
        rows, labels, weights, bare = [], [], [], [0.0, 0.0]
        for i, vector in enumerate(vectors):
            numbers, cosines = self.nearest(*vector, without=i)
            if len(numbers):
                rows.append(self._signals(numbers, cosines))
                labels.append(self.labels[i])
                weights.append(balance[i])
            else:
                bare[self.labels[i]] += balance[i]
        self.bare = float((bare[1] + self.share) / (sum(bare) + 1))
        if not rows:
            return
        x, y, w = np.array(rows), np.array(labels), np.array(weights)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))
            slope = x.T @ (w * (y - p)) - 0.05 * self.curve
            bend = (x * (w * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(4)
            step = np.linalg.solve(bend, slope)
            self.curve = self.curve + step
            if np.abs(step).max() < 1e-9:
                break

    def judge(self, text: bytes) -> tuple[float, list[dict]]:
        """Probability that the text is toxic, and the neighbours that say so."""
        at, weight = self._vector(words(text))
        numbers, cosines = self.nearest(at, weight)
        if not len(numbers):
            return self.bare, []
        raw = float(self._signals(numbers, cosines) @ self.curve)
        shown = []
        for i, cosine in zip(numbers[:3].tolist(), cosines.tolist(), strict=False):
            cells = at * self.blocks + i // BLOCK
            shared = [
                self.terms[t]
                for t, c in zip(at.tolist(), cells.tolist(), strict=True)
                if i in self.example[self.start[c] : self.start[c + 1]]
            ]
            label = int(self.labels[i])
            shown.append({"doc_id": self.ids[i], "toxic": label, "cosine": cosine, "terms": shared[:8]})
        return 1 / (1 + math.exp(-min(max(raw, -30), 30))), shown


def held_out_rows(doc_id: str = "doc_id", folds: int = 4, fold: int = 2):
    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    return F.crc32(F.encode(name, "UTF-8")) % folds == fold


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> ExampleIndex:
    """Index of at most ``examples`` texts of each class."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(~held_out_rows())
    )
    size = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = size.get(1, 0) / max(sum(size.values()), 1)
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label)
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text").collect()
    rows = sorted((r["doc_id"], r["toxic"], r["text"].encode()) for r in found)
    return ExampleIndex(rows, share)


def score(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` of every row."""
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, examples))

    def work():
        def act(texts):
            judged = [index.value.judge(t) for t in texts]
            return [s for s, _ in judged], [e for _, e in judged]

        return act

    rows = docs.select("doc_id", "text")
    added = [T.StructField("score", T.DoubleType()), T.StructField("evidence", EVIDENCE)]
    found = appended(rows, "text", added, work)
    return found.select(
        "doc_id",
        held_out_rows().alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "evidence",
    )
