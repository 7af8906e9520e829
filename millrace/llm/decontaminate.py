"""Benchmark decontamination by pigeonhole edit matching.

Texts are words: lower case, ASCII punctuation and white space between them. An
item of ``m`` words may be changed in ``k = floor(0.2 m)`` words (put in, left
out or replaced) and still counts. It is cut into ``k + 1`` pieces, one of which
must be in such a passage unchanged. Every piece found in a document names a
window around it, and Myers' bit-parallel search gives the least edit distance
between the item and any part of that window.

Items go to the tasks in blocks of at most about ``BLOCK_WORDS`` words, and all
documents are read for each block: memory is bounded for any benchmark, and no
document is moved. Only words of the block have numbers; all others are 0, which
no piece contains, so most places of a text are passed over at once.

NULL and empty texts match nothing, and items without words are in no text.
Items of fewer than five words must be there as they are. Repeated items are
reported each, repeated documents too. NULL item ids are reported as NULL.
"""

from __future__ import annotations

import math
import string
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import appended, clean_text

ERRORS = 0.2  # share of an item's words that may differ
BLOCK_WORDS = 200_000

_APART = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))

MATCH = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("distance", T.IntegerType()),
        T.StructField("item_words", T.IntegerType()),
        T.StructField("last_word", T.IntegerType()),
    ]
)


def words(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(_APART).split()


def search(pattern: list[int], window: list[int]) -> tuple[int, int]:
    """Least edit distance between the pattern and a part of the window, and where that part ends."""
    size = len(pattern)
    all_ones, top = (1 << size) - 1, 1 << (size - 1)
    equal: dict[int, int] = defaultdict(int)
    for i, symbol in enumerate(pattern):
        equal[symbol] |= 1 << i
    up, down, score = all_ones, 0, size  # vertical differences +1 and -1
    best, end = size, -1
    for at, symbol in enumerate(window):
        eq = equal.get(symbol, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        right_up = down | (~(diagonal | up) & all_ones)
        right_down = up & diagonal
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = (right_up << 1) & all_ones
        right_down = (right_down << 1) & all_ones
        up = right_down | (~(vertical | right_up) & all_ones)
        down = right_up & vertical
        if score < best:
            best, end = score, at
    return best, end


@dataclass
class PieceIndex:
    """The pieces of a block of items, by length and by the hash of their word numbers."""

    errors: float = ERRORS
    items: list[tuple[int | None, list[int], int]] = field(default_factory=list)  # id, words, budget
    numbers: dict[bytes, int] = field(default_factory=dict)
    pieces: dict[int, dict[int, list[tuple[int, int]]]] = field(default_factory=dict)

    def add(self, item_id: int | None, text: bytes) -> None:
        found = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)]
        if not found:
            return
        budget = math.floor(self.errors * len(found) + 1e-9)
        item = len(self.items)
        self.items.append((item_id, found, budget))
        cuts = [i * len(found) // (budget + 1) for i in range(budget + 2)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            by_hash = self.pieces.setdefault(b - a, {})
            code = int(self._codes(np.array(found[a:b]), b - a)[0])
            by_hash.setdefault(code, []).append((item, a))

    @staticmethod
    def _codes(numbers: np.ndarray, length: int) -> np.ndarray:
        """A 64-bit code of every run of ``length`` numbers."""
        count = len(numbers) - length + 1
        code = np.zeros(count, dtype=np.uint64)
        for j in range(length):
            code = code * np.uint64(0x9E3779B97F4A7C15) + numbers[j : j + count].astype(np.uint64)
            code ^= code >> np.uint64(29)
        return code

    def matches(self, texts: list[bytes]) -> list[list[dict]]:
        """For each text, the best match of every item within its budget."""
        numbers: list[int] = []
        starts = []
        get = self.numbers.get
        for text in texts:
            starts.append(len(numbers))
            numbers += [get(w, 0) for w in words(text)]
            numbers.append(0)
        line, starts = np.array(numbers, dtype=np.int64), np.array([*starts, len(numbers)])
        windows: dict[tuple[int, int], set[int]] = defaultdict(set)  # (text, item): starts
        for length, by_hash in self.pieces.items():
            for at, places in self._hits(line, length, by_hash):
                text = int(np.searchsorted(starts, at, "right")) - 1
                for item, offset in places:
                    if (line[at : at + length] == self.items[item][1][offset : offset + length]).all():
                        windows[text, item].add(at - offset)
        found: list[list[dict]] = [[] for _ in texts]
        for (text, item), places in sorted(windows.items()):
            best = self._verified(numbers, int(starts[text]), int(starts[text + 1]) - 1, item, places)
            if best:
                found[text].append(best)
        return found

    def _hits(self, line: np.ndarray, length: int, by_hash: dict):
        count = len(line) - length + 1
        if count <= 0:
            return
        known = line != 0
        whole = known[:count].copy()
        for j in range(1, length):
            whole &= known[j : j + count]
        at = np.flatnonzero(whole)
        code = np.zeros(len(at), dtype=np.uint64)
        for j in range(length):
            code = code * np.uint64(0x9E3779B97F4A7C15) + line[at + j].astype(np.uint64)
            code ^= code >> np.uint64(29)
        keys = np.array(sorted(by_hash), dtype=np.uint64)
        slot = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
        for i in np.flatnonzero(keys[slot] == code):
            yield int(at[i]), by_hash[int(code[i])]

    def _verified(self, numbers, first, last, item, places) -> dict | None:
        """Windows that overlap are searched as one."""
        item_id, pattern, budget = self.items[item]
        best = None
        spans: list[list[int]] = []
        for place in sorted(places):
            a, b = max(first, place - budget), min(last, place + len(pattern) + budget)
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        for a, b in spans:
            distance, end = search(pattern, numbers[a:b])
            if distance <= budget and (best is None or distance < best["distance"]):
                best = {
                    "item_id": item_id,
                    "distance": distance,
                    "item_words": len(pattern),
                    "last_word": a + end - first,
                }
        return best


def _blocks(benchmark: DataFrame, text: str, item_id: str):
    """Indexes of the benchmark's blocks, one at a time."""
    items = benchmark.select(
        F.col(f"`{item_id}`").cast("long").alias("item_id"), clean_text(f"`{text}`").alias("text")
    ).withColumn("size", F.octet_length("text"))
    total = items.agg(F.sum("size")).first()[0] or 0
    count = max(1, math.ceil(total / (6 * BLOCK_WORDS)))
    for block in range(count):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        index = PieceIndex()
        for row in own.select("item_id", "text").sort("item_id", "text").toLocalIterator():
            index.add(row["item_id"], row["text"].encode())
        if index.items:
            yield index


def find_matches(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    name: str = "matches",
) -> DataFrame:
    """Add ``name``: for every item in the row's text, its best match within the budget."""
    context = df.sparkSession.sparkContext
    df = df.drop(name)
    parts = []
    for number, index in enumerate(_blocks(benchmark, item_text, item_id)):
        part = f"__matches_{number}"
        shared = context.broadcast(index)

        def work(shared=shared):
            return lambda texts: (shared.value.matches(texts),)

        df = appended(df, text, [T.StructField(part, T.ArrayType(MATCH))], work)
        parts.append(part)
    none = F.array().cast(T.ArrayType(MATCH))
    matches = F.concat(*[F.col(p) for p in parts]) if parts else none
    return df.withColumn(name, matches).drop(*parts)


def reported(found: DataFrame) -> DataFrame:
    """Per document: whether it holds a benchmark passage, of which items, and how alike."""
    alike = F.transform("matches", lambda m: 1 - m["distance"] / m["item_words"])
    return found.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.array_sort(F.col("matches.item_id")).alias("item_ids"),
        F.array_max(alike).alias("similarity"),
        F.array_min("matches.distance").alias("distance"),
    )


def without_matches(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark passage."""
    found = find_matches(df, benchmark, text, name="__matches")
    return found.where(F.size("__matches") == 0).select(*[F.col(f"`{c}`") for c in df.columns])
