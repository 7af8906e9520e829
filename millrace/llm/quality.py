"""Quality classifier from weak labels.

Labellers look at one surface feature of a text each and vote good, bad or not
at all. Their votes overlap and err, and nobody says how often: expectation
maximisation estimates, for each labeller and class, how it votes, from how
often each combination of votes occurs among all documents. The classes are good
text and a kind of bad text for each labeller, since junk of one kind looks good
to the labellers of the others. There are at most
``3 ** len(LABELLERS)`` combinations, so the counts fit the driver at any size.
A document's posterior follows from its combination.

Posterior labels train a linear scorer on hashed features: words, shapes of
words and repeated words, as shares of the text. It is fitted on about
``TRAIN_ROWS`` documents chosen by a hash of their text; tasks run stochastic
gradient descent on their part and the weights are averaged. Every document is
scored as a whole.

NULL counts as empty. A text without words gets the score ``EMPTY_SCORE`` and is
not kept. Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import appended, clean_text

TRAIN_ROWS = 20_000
TRAIN_TASKS = 8
EPOCHS = 12
RATE = 4.0
HASHED = 1 << 16
KEEP_FROM = 0.5
EMPTY_SCORE = 0.0
ROUNDS = 60
CACHED_TOKENS = 400_000

GOOD, BAD, NONE = 1, -1, 0

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LETTERS = _UPPER + _UPPER.lower()
_SIGNS = b"*$#&%@^~"


def _share(text: bytes, among: bytes) -> float:
    return (len(text) - len(text.translate(None, among))) / max(len(text), 1)


def _signs(text, tokens):
    return _share(text, _SIGNS)


def _bars(text, tokens):
    return text.count(b"|") / len(tokens)


def _capitals(text, tokens):
    return _share(text, _UPPER) / max(_share(text, _LETTERS), 1e-9)


def _stutter(text, tokens):
    return sum(map(eq, tokens, tokens[1:])) / len(tokens)


def _shouts(text, tokens):
    return text.count(b"!") / len(tokens)


def _sameness(text, tokens):
    return 1 - len(set(tokens)) / len(tokens) if len(tokens) >= 40 else 0.5


def _repeated_lines(text, tokens):
    lines = [x for x in text.split(b"\n") if x]
    return 1 - len(set(lines)) / len(lines) if len(lines) > 3 else 0.3


# Feature, good up to, bad from; in between a labeller does not vote.
LABELLERS = (
    (_signs, 0.004, 0.02),
    (_bars, 0.02, 0.12),
    (_capitals, 0.20, 0.45),
    (_stutter, 0.08, 0.30),
    (_shouts, 0.05, 0.25),
    (_sameness, 0.45, 0.80),
    (_repeated_lines, 0.25, 0.55),
)


def votes(text: bytes) -> list[int]:
    tokens = text.split()
    if not tokens:
        return [NONE] * len(LABELLERS)
    found = []
    for feature, good, bad in LABELLERS:
        value = feature(text, tokens)
        found.append(GOOD if value <= good else BAD if value >= bad else NONE)
    return found


def fit_labellers(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> dict:
    """Posterior of "good" for each combination of votes, given how often each occurs.

    To start with, texts without a bad vote are good and the others are of the
    kinds that vote so.
    """
    if not patterns:
        return {}
    seen = np.array([p for p, _ in patterns])
    counts = np.array([n for _, n in patterns], dtype=float)
    bad = (seen == BAD).astype(float)
    share = np.column_stack([0.02 + ~bad.any(axis=1), 0.02 / len(LABELLERS) + bad])
    share /= share.sum(axis=1, keepdims=True)
    votes_as = [(seen == kind).astype(float) for kind in (GOOD, BAD)]  # no vote says nothing
    for _ in range(rounds):
        weight = counts[:, None] * share
        rates = np.stack([weight.T @ v for v in votes_as]) + 0.1  # vote, class, labeller
        rates /= rates.sum(axis=0)
        log = sum(v @ np.log(r).T for v, r in zip(votes_as, rates, strict=True))
        log += np.log((weight.sum(axis=0) + 0.1) / (counts.sum() + 1))
        share = np.exp(log - log.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
    good = share[:, 0]
    return {tuple(int(v) for v in p): float(g) for (p, _), g in zip(patterns, good, strict=True)}


_SHAPES = (
    (re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a"),
    (re.compile(r"\d+"), lambda m: "9"),
    (re.compile(r"([^\w\s])\1+"), lambda m: m[1] * 2),
)


def shape(token: str) -> str:
    for pattern, to in _SHAPES:
        token = pattern.sub(to, token)
    return token[:16]


def _slot(kind: str, value: str) -> int:
    from xxhash import xxh32_intdigest

    return xxh32_intdigest(f"{kind}:{value}", 0) % HASHED


def hashed_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and shares of a text's words, shapes and repeated words."""
    tokens = text.decode("utf-8", "replace").split()
    slots: Counter = Counter()
    for token, n in Counter(tokens).items():
        slots[_slot("word", token.lower())] += n
        slots[_slot("shape", shape(token))] += n
    slots[_slot("again", "")] += sum(map(eq, tokens, tokens[1:]))
    size = max(len(tokens), 1)
    return np.fromiter(slots, dtype=np.int32), np.fromiter(slots.values(), dtype=np.float64) / size


class Scorer:
    """Weights for hashed features; remembers what a token adds to the sum."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.known: dict[str, float] = {}
        self.again = float(weights[_slot("again", "")])

    def _token(self, token: str) -> float:
        value = float(
            self.weights[_slot("word", token.lower())] + self.weights[_slot("shape", shape(token))]
        )
        if len(self.known) >= CACHED_TOKENS:
            self.known.clear()
        self.known[token] = value
        return value

    def score(self, text: bytes) -> float:
        tokens = text.decode("utf-8", "replace").split()
        if not tokens:
            return EMPTY_SCORE
        get, total = self.known.get, 0.0
        for token in tokens:
            value = get(token)
            total += self._token(token) if value is None else value
        total += self.again * sum(map(eq, tokens, tokens[1:]))
        return float(1 / (1 + np.exp(-np.clip(total / len(tokens) + self.bias, -60, 60))))


def _descend(rows: list[tuple[np.ndarray, np.ndarray, float]], seed: int) -> np.ndarray:
    """Logistic regression by stochastic gradient descent; the last weight is the bias."""
    weights = np.zeros(HASHED + 1)
    rng = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for i in rng.permutation(len(rows)):
            slots, shares, label = rows[i]
            raw = float(weights[slots] @ shares + weights[-1])
            step = rate * (label - 1 / (1 + np.exp(-np.clip(raw, -60, 60))))
            weights[slots] += step * shares
            weights[-1] += 0.1 * step
    return weights


def fit(df: DataFrame, posterior: dict, text: str = "text", train_rows: int = TRAIN_ROWS):
    """Weights and bias from a bounded sample of texts."""
    value = clean_text(f"`{text}`")
    count = df.count()
    share = min(1.0, train_rows / max(count, 1))
    chosen = F.pmod(F.xxhash64(value, F.lit("sample")), F.lit(1_000_000)) < round(share * 1_000_000)
    sample = df.where(chosen & (value != "")).select(value.alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(posterior)

    def train(frames):
        rows = []
        for frame in frames:
            for content in frame["text"]:
                content = content.encode()
                slots, shares = hashed_features(content)
                rows.append((slots, shares, shared.value.get(tuple(votes(content)), 0.5)))
        if rows:
            import pandas as pd

            yield pd.DataFrame({"weights": [_descend(rows, len(rows)).tobytes()], "n": [len(rows)]})

    def averaged(frames):
        import pandas as pd

        total, rows = np.zeros(HASHED + 1), 0
        for frame in frames:
            for weights, n in zip(frame["weights"], frame["n"], strict=True):
                total += np.frombuffer(weights) * n
                rows += n
        if rows:
            yield pd.DataFrame({"weights": [(total / rows).tobytes()], "n": [rows]})

    # One task averages the few weight vectors, so that the driver gets one.
    schema = "weights binary, n long"
    trained = sample.repartition(TRAIN_TASKS).mapInPandas(train, schema).repartition(1)
    found = trained.mapInPandas(averaged, schema).first()
    if found is None:
        return np.zeros(HASHED), 0.0
    mean = np.frombuffer(found["weights"])
    return mean[:-1], float(mean[-1])


def classify(
    df: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS, without: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``votes``, ``weak_label`` (posterior), ``score`` and ``keep``; leave out columns ``without``."""
    context = df.sparkSession.sparkContext
    field = T.StructField("votes", T.ArrayType(T.IntegerType()))
    texts = df.select(F.col(f"`{text}`").alias("text"))
    seen = appended(texts, "text", [field], lambda: lambda t: ([votes(x) for x in t],))
    patterns = seen.groupBy("votes").count().collect()  # 3 ** len(LABELLERS) at most
    posterior = fit_labellers(sorted((tuple(r["votes"]), r["count"]) for r in patterns))
    weights, bias = fit(texts, posterior, "text", train_rows)
    shared = context.broadcast((posterior, weights.astype(np.float32), bias))

    def work():
        posterior, weights, bias = shared.value
        scorer = Scorer(weights, bias)

        def act(contents):
            found = [votes(c) for c in contents]
            scores = [scorer.score(c) for c in contents]
            return found, [posterior.get(tuple(v), 0.5) for v in found], scores

        return act

    added = [
        field,
        T.StructField("weak_label", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
    return appended(df, text, added, work, without).withColumn("keep", F.col("score") >= KEEP_FROM)


def good_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text the scorer accepts."""
    named = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    named = named.withColumn("content", F.col(f"row.`{text}`"))
    found = classify(named, "content", without=("content",)).where("keep")
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])
