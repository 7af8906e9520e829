"""Collocations by dynamic itemset counting: phrases of two to ``LONGEST`` words that occur often.

The texts are dealt over ``SHARDS`` stored shards, which steps scan in a cycle. Words
are counted from the first step on. A longer phrase is activated once both phrases it
holds that are one word shorter have been seen ``LEAST`` times, whatever the lengths
counted beside it: it is counted from the next step for one full cycle, so that every
shard counts it once. Its total is then exact. The work ends when nothing was activated
for a full cycle.

What has reached the threshold, and in which step, is told to the tasks by a filter of
``CELLS`` cells, one byte each, whatever the table's size: a phrase owns two cells, which
hold the first step that set them. A phrase counts as reached at the later one. The
cells only ever gain steps, so a phrase that is taken for reached by chance is counted
for its full cycle like any other, which costs time and changes no count; none is missed.
A table with more frequent phrases than the cells tell apart is counted with less
pruning, down to counting all phrases.

Tasks turn ``BATCH_WORDS`` words into numbers and count phrases on sorted arrays; counts
meet by phrase, so a phrase in a third of all places is one row for a task. Phrases
that are not complete are carried to the next step, the others are stored when they are
frequent.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, and
pieces into words at spaces and tabs. NULL texts count as empty, a NULL language as
``NO_LANGUAGE``. Repeated rows are counted each, and equal scores are told apart by
count and phrase; an empty table has no phrases. Memory grows with the longest text of a
batch, not with the table: a task forgets its words beyond ``MOST_WORDS``.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from millrace.llm.common import clean_text, shared_dir, slices, text_bytes
from millrace.session import remove

LEAST = 30
LONGEST = 4
SHARDS = 2
CELLS = 1 << 25
BATCH_WORDS = 2_000_000
MOST_WORDS = 1 << 19
NO_LANGUAGE = "und"
SCALE = 2_000_000
COVERED = 80  # percent of a phrase's places that a longer one takes away
TOP = 2000

NEVER = 255  # a cell no step has set
COUNTS = "key binary, last int, n long"  # the key is the language, a line feed and the phrase

_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes(10 if c in _ENDS else 32 if c == 9 else c for c in bytes(range(256)).lower())
_BREAK = b"."  # an end mark, so never a word
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT, _HALF = np.uint64(29), np.uint64(32)


def tokens(texts: Iterable[bytes]) -> pa.DictionaryArray:
    """The words of texts, with ``_BREAK`` where a piece ends; runs of spaces leave empty ones."""
    line = b"\n".join([*texts, b""]).translate(_PLAIN).replace(b"\n", b" . ")
    return pc.split_pattern(pa.array([line], pa.large_binary()), pattern=b" ").flatten().dictionary_encode()


def _joined(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases that are one word longer."""
    mixed = hashes * _FACTOR + words
    return mixed ^ (mixed >> _SHIFT)


def seed_of(lang: str) -> int:
    """Words of a language are hashed with its seed."""
    return xxh64_intdigest(lang.encode())


def _cells(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(size - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> _HALF) & mask).astype(np.int64)


def _reached(hashes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The step in which each phrase reached the threshold, or ``NEVER``."""
    one, other = _cells(hashes, len(steps))
    return np.maximum(steps[one], steps[other])


class _Numbers(dict):
    """Words of one language to numbers, given out in order over all languages."""

    def __init__(self, lang: int, langs: list[int], words: list[bytes]):
        super().__init__({_BREAK: 0, b"": -1})
        self.lang, self.langs, self.words = lang, langs, words

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return number


class _Counter:
    """Phrase counts of one task in one step."""

    def __init__(self, steps: np.ndarray, step: int, shards: int, longest: int):
        self.steps, self.step, self.shards, self.longest = steps, step, shards, longest
        self.forget()

    def forget(self) -> None:
        self.words, self.langs, self.names = [_BREAK], [0], [""]
        self.numbers: dict[str, _Numbers] = {}
        self.hashes, self.reached = np.zeros(1, np.uint64), np.full(1, NEVER, np.uint8)
        self.text, self.keys = pa.array([b""], pa.binary()), pa.array([b""], pa.binary())
        self.seen = np.zeros(1, np.int64)

    def number(self, lang: str, texts: Iterable[bytes]) -> np.ndarray:
        """Word numbers of texts of one language, 0 where a piece ends."""
        if lang not in self.numbers:
            self.numbers[lang] = _Numbers(len(self.names), self.langs, self.words)
            self.names.append(lang)
        found = tokens(texts)
        own = map(self.numbers[lang].__getitem__, found.dictionary.to_pylist())
        numbers = np.fromiter(own, np.int32, len(found.dictionary))
        ids = numbers[found.indices.to_numpy()]
        return ids[ids >= 0]

    def _learn(self) -> None:
        known = len(self.hashes)
        new = self.words[known:]
        if not new:
            return
        seeds = [seed_of(name) for name in self.names]
        own = map(seeds.__getitem__, self.langs[known:])
        hashes = np.fromiter(map(xxh64_intdigest, new, own), np.uint64, len(new))
        self.hashes = np.concatenate([self.hashes, hashes])
        self.reached = np.concatenate([self.reached, _reached(hashes, self.steps)])
        starts = [f"{n}\n".encode() for n in self.names]
        firsts = [starts[i] + w for i, w in zip(self.langs[known:], new, strict=True)]
        self.text = pa.concat_arrays([self.text, pa.array(new, pa.binary())])
        self.keys = pa.concat_arrays([self.keys, pa.array(firsts, pa.binary())])
        self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int64)])

    def _rows(self, columns: list[np.ndarray], last, counts: np.ndarray) -> pa.RecordBatch:
        words = [self.keys.take(pa.array(columns[0]))]
        words += [self.text.take(pa.array(c)) for c in columns[1:]]
        keys = pc.binary_join_element_wise(*words, b" ") if len(words) > 1 else words[0]
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(last, pa.int32()), pa.array(counts, pa.int64())], ["key", "last", "n"]
        )

    def count(self, ids: np.ndarray):
        """Rows of the active phrases of two words and more; words are added up."""
        self._learn()
        if self.step <= self.shards:
            self.seen += np.bincount(ids, minlength=len(self.seen))
        word, reached = self.hashes[ids], self.reached[ids]
        # Places where a phrase of the last length starts, by the step it reached the threshold.
        at, hashes, names, table = np.arange(len(ids)), word, ids.astype(np.int64), None
        for size in range(2, self.longest + 1):
            # Both inner phrases stand side by side and have reached the threshold.
            both = np.flatnonzero((at[1:] == at[:-1] + 1) & (np.maximum(reached[1:], reached[:-1]) < self.step))
            if not len(both):
                return
            active, place = np.maximum(reached[both], reached[both + 1]).astype(np.int64), at[both]
            codes = (names[both] << 32) | ids[place + size - 1]
            different, counts = np.unique(codes[active + self.shards >= self.step], return_counts=True)
            if len(different):
                yield self._counted(different, counts, table, size)
            if size == self.longest:
                return
            hashes = _joined(hashes[both], word[place + size - 1])
            later = np.maximum(active, _reached(hashes, self.steps))
            # Only what has reached the threshold can be part of a longer phrase.
            kept = np.flatnonzero(later < self.step)
            at, hashes, reached = place[kept], hashes[kept], later[kept]
            codes, names = np.unique(codes[kept], return_inverse=True)
            table = self._words_of(codes, table)

    def _words_of(self, codes: np.ndarray, table: np.ndarray | None) -> np.ndarray:
        """The word numbers of phrases, one row for each, from their codes and those of the length before."""
        before = (codes >> 32)[:, None] if table is None else table[codes >> 32]
        return np.column_stack([before, codes & 0xFFFFFFFF])

    def _counted(self, codes, counts, table, size) -> pa.RecordBatch:
        words = self._words_of(codes, table)
        # A phrase is active once all phrases within it have reached the threshold.
        active = np.zeros(len(codes), dtype=np.int64)
        for start in range(size):
            hashes = self.hashes[words[:, start]]
            active = np.maximum(active, self.reached[words[:, start]])
            for end in range(start + 1, min(start + size - 1, size)):
                hashes = _joined(hashes, self.hashes[words[:, end]])
                active = np.maximum(active, _reached(hashes, self.steps))
        return self._rows(list(words.T), active + self.shards, counts)

    def word_rows(self):
        used = np.flatnonzero(self.seen[1:]) + 1
        if not len(used):
            return
        yield self._rows([used], np.full(len(used), self.shards), self.seen[used])
        # All words of a language, as the phrase of no word.
        langs = np.array(self.langs[: len(self.seen)])[used]
        totals = np.bincount(langs, weights=self.seen[used]).astype(np.int64)
        some = np.flatnonzero(totals)
        keys = pa.array([f"{self.names[i]}\n".encode() for i in some], pa.binary())
        last = pa.array([self.shards] * len(some), pa.int32())
        yield pa.RecordBatch.from_arrays([keys, last, pa.array(totals[some])], ["key", "last", "n"])


def _counted(texts: DataFrame, steps, step: int, shards: int, longest: int) -> DataFrame:
    def run(batches):
        counter = _Counter(steps.value, step, shards, longest)
        parts, size = [], 0
        for batch in slices(batches, "text"):
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                texts.setdefault(lang, []).append(text_bytes(text))
            for lang, own in texts.items():
                parts.append(counter.number(lang, own))
                size += len(parts[-1])
            if size >= BATCH_WORDS or len(counter.words) > MOST_WORDS:
                yield from counter.count(np.concatenate(parts))
                parts, size = [], 0
                if len(counter.words) > MOST_WORDS:
                    yield from counter.word_rows()
                    counter.forget()
        if parts:
            yield from counter.count(np.concatenate(parts))
        yield from counter.word_rows()

    return texts.select("lang", F.encode("text", "UTF-8").alias("text")).mapInArrow(run, COUNTS)


def _set_cells(rows: DataFrame, steps: np.ndarray, step: int) -> bool:
    """Give the cells of the phrases in ``rows`` the step, where they have none; whether one had none."""
    size = len(steps)

    def run(batches):
        for batch in batches:
            found = []
            for key in batch.column("key").to_pylist():
                lang, _, phrase = key.decode().rpartition("\n")
                seed = seed_of(lang)
                words = [np.array([xxh64_intdigest(w, seed)], np.uint64) for w in phrase.encode().split(b" ")]
                mixed = words[0]
                for word in words[1:]:
                    mixed = _joined(mixed, word)
                found += [int(c[0]) + 1 for c in _cells(mixed, size)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["cell"])

    cells = rows.select("key").mapInArrow(run, "cell long")
    maps = cells.groupBy(F.bitmap_bucket_number("cell").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )
    changed = False
    for row in maps.collect():  # at most a bit for a cell
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        places = (row["part"] - 1) * len(bits) + np.flatnonzero(bits)
        new = places[steps[places] == NEVER]
        steps[new] = step
        changed = changed or len(new) > 0
    return changed


def mine(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    shards: int = SHARDS,
    cells: int = CELLS,
) -> DataFrame:
    """``lang, phrase, size, n`` of every phrase of up to ``longest`` words with ``n >= least``.

    The phrase of no word stands for all words of a language. ``cells`` is a power of two.
    """
    spark = df.sparkSession
    language = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    place = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard")
    path = shared_dir(spark, "phrase-shards")
    dealt = df.select(language, clean_text(f"`{text}`").alias("text"), place)
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    texts = spark.read.schema(dealt.schema).parquet(path)

    steps = np.full(cells, NEVER, dtype=np.uint8)
    found, carried, old, step, newest = None, None, None, 0, 0
    while step < newest + shards:
        step += 1
        told = spark.sparkContext.broadcast(steps)
        shard = texts.where(F.col("shard") == (step - 1) % shards)
        counted = _counted(shard, told, step, shards, longest)
        if carried is not None:
            counted = counted.unionByName(carried)
        totals = counted.groupBy("key", "last").agg(F.sum("n").alias("n"))
        phrase = F.substring_index(F.col("key").cast("string"), "\n", -1)
        kept = totals.where((F.col("last") > step) | (F.col("n") >= least) | (phrase == ""))
        folder = shared_dir(spark, "phrases")
        stored = kept.withColumn("state", F.when(F.col("last") > step, "carried").otherwise("complete"))
        stored.write.partitionBy("state").parquet(folder)
        state = spark.read.schema(stored.schema).parquet(folder)
        told.destroy()
        if old is not None:
            remove(spark, f"{old}/state=carried")
        old = folder
        complete = state.where("state = 'complete'").select("key", "n")
        found = complete if found is None else found.unionByName(complete)
        carried = state.where("state = 'carried'").select("key", "last", "n")
        reached = state.where((F.col("n") >= least) & (phrase != "") & (F.size(F.split(phrase, " ")) < longest))
        if _set_cells(reached, steps, step):
            newest = step
    remove(spark, path)
    key = F.col("key").cast("string")
    phrase = F.substring_index(key, "\n", -1).alias("phrase")
    lang = F.left(key, F.char_length(key) - F.char_length(phrase) - 1)
    size = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ", -1))).alias("size")
    return found.select(lang.alias("lang"), phrase, size, "n")


def scored_cuts(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, score``: the lowest-scoring cut of each phrase of two words or more.

    Products are decimals of up to 38 digits; of equal scores the cut after fewer words counts.
    """
    counts = frequent.where("size > 0").select("lang", "phrase", "n")
    words = F.split("phrase", " ", -1)
    cut = frequent.where("size > 1").select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select(
        "lang",
        "phrase",
        "size",
        F.col("n").alias("a"),
        "k",
        F.array_join(F.slice(words, 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"),
    )
    cut = cut.join(counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cut = cut.join(counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    exact = f"CAST(a AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0)) div (CAST(l AS DECIMAL(20, 0)) + r)"
    least = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    best = cut.groupBy("lang", "phrase", "size", "a").agg(least)
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def uncovered(candidates: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Without the phrases that lie in a longer one which takes ``COVERED`` percent of their places."""
    words = F.split("phrase", " ", -1)
    inner = candidates.where("size > 2").select("lang", words.alias("words"), "size", F.col("a").alias("longer"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)).alias("at"))
    inner = inner.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("part")), " ").alias("phrase"), "longer")
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.expr(f"CAST(longer AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * {COVERED}")
    joined = candidates.join(most, ["lang", "phrase"], "left")
    return joined.where(F.col("longer").isNull() | ~covered).drop("longer")


def top_phrases(frequent: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = uncovered(scored_cuts(frequent)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = frequent.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
