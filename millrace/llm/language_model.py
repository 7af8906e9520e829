"""Hierarchical Pitman-Yor language model: training, Gibbs seating and scoring.

Tokens are words (ASCII letters in lower case, cut at ASCII white space) and one
end for each text. The restaurant of a token is the whole word before it (the end of
the text before stands before a text's first word). Its parents have ever shorter
endings of that word: all words with the same last three bytes, hashed to ``CONTEXTS``
names, then those with the same last byte (``PARENTS``), then all tokens; that one
serves every known word and "unknown" alike. No count is cut off: rare words and
contexts take part, and there are as many restaurants as there are words.

Pairs of a word and the one before it are spread over parts by the hash of the word. A
part has the pairs' counts and tables, those of its words on all levels above, and the
places it is asked for. A word with more than a part's share of all tokens is hot: its
pairs are dealt over further parts, slices, by the word before, and its upper levels
stay in its own part. So no part grows with a word. Which words are hot is told by
``SAMPLE_BYTES`` of text and all long texts; it changes where pairs are, nothing else.

The places of pairs in texts stay in one row for each batch of texts, beside the parts. A
part answers a batch with the probability of each pair it was asked for, and the batch adds
them up by text. So answers grow with the pairs of the batches, not with parts times texts.
Their decimal logarithms are sent in steps of ``1 / LOG_STEPS``.

What parts need of each other they are told once a sweep, in letters that Spark shuffles:

* Customers and tables of a word's restaurant come from all parts. Parts send their
  sums to books, each of which has a share of the words, and a book tells every part that
  has the word the sums. Who has which words is stored once, in the order of the letters.
  Customers are told once.
* Slices send their tables by ending to the word's own part, and get its upper levels.
* Totals of endings, parents and all tokens, a small table of fixed size, go through the driver.

Parts and books are stored in buckets, so that joins move the letters only.

In a sweep all customers of one dish in one restaurant leave and sit down again
one by one: at a new table with probability in proportion to
``(strength + discount * tables) * parent probability``, else at one of the
dish's tables in proportion to ``customers - discount * tables``. Customers
behind the first 64 of a dish come in groups of a sixteenth of those seated, as
one binomial draw. New tables send customers to the parent, which seats them
next. The restaurants' totals, and what slices and own parts know of each other, are
those of the sweep before, so that parts are independent. Seats are stored after each
sweep. Draws are seeded by part and sweep: a task that runs again finds the same seats.

A text's score is the sum of the logarithms of probabilities averaged over the
sweeps after ``BURN_IN``. Discounts follow from the numbers of dishes with one
and two customers.

NULL counts as empty, which has one token, the end. A NULL id counts as the
empty text when rows are held out. Repeated rows are separate texts. With
nothing to learn from, every token is unknown and has probability one.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import clean_text, materialize, shared_dir, slices, text_bytes
from millrace.session import remove

CONTEXTS = 4096
PARENTS = 32
_CHILDREN = CONTEXTS // PARENTS
SWEEPS = 4
BURN_IN = 1
STRENGTH = (1.0, 1.0, 1.0, 1.0)  # all tokens, parents, endings, words
BATCH_TOKENS = 1_000_000
BATCH_TEXTS = 60_000
PART_BYTES = 4_000_000  # text for each part of the vocabulary
PARTS_A_BOOK = 8
PARTS_A_SUM = 64
SAMPLE_BYTES = 16_000_000  # text that tells which words are hot
LONG_TEXT = 1_000_000  # bytes from which a text always is in that sample
HELD_BYTES = 32_000_000  # sums a task holds before it passes them on
LOG_STEPS = 1 << 28  # of a decimal logarithm that is sent
ONE_BY_ONE = 64
SEED = 42
_HASH_BITS = 52  # of a context's name; above them is the ending's

_REQUEST = (
    "part int, hot long, home int, first int, batch long, n_texts int, words binary, spread binary, "
    "guests binary, train binary, uses binary, place binary, n binary, ids binary, tokens binary"
)
_STATIC = (
    "part int, home int, first int, n_words long, spread binary, pairs binary, customers binary, "
    "guests binary, hot_places binary, hot_routes binary"
)
_PART = (
    f"{_STATIC}, hot long, requests array<struct<batch:bigint,n_texts:int,pairs:binary,"
    "uses:binary,place:binary,n:binary,ids:binary,tokens:binary>>, "
    "kept array<struct<batch:bigint,n_texts:int,parts:binary,spread:binary,"
    "uses:binary,place:binary,n:binary,ids:binary,tokens:binary>>"
)
_LETTER = "part int, kind string, key long, payload binary"
_PARTIAL = "batch long, ids binary, tokens binary, known binary, base binary, score binary"
_ANSWER = "part int, batch long, source int, counts binary, chances binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _packed(numbers) -> bytes:
    """Whole numbers from zero on in as few bytes as the largest needs, byte by byte."""
    values = np.asarray(numbers).astype("<i8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view("u1").reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(value: bytes) -> np.ndarray:
    planes = np.frombuffer(value, "u1", offset=1).reshape(value[0], -1)
    found = np.zeros((planes.shape[1], 8), "u1")
    found[:, : value[0]] = planes.T
    return found.view("<i8").ravel()


def _all(arrays) -> bytes:
    """Several arrays, packed one by one."""
    made = [_packed(x) for x in arrays]
    return b"".join(len(x).to_bytes(8, "little") + x for x in made)


def _each(value: bytes) -> list[np.ndarray]:
    found, at = [], 0
    while at < len(value):
        size = int.from_bytes(value[at : at + 8], "little")
        found.append(_numbers(value[at + 8 : at + 8 + size]))
        at += 8 + size
    return found


def context_of(word: bytes) -> int:
    """The name of a word's ending; that of the parent is ``name // _CHILDREN``."""
    return (zlib.crc32(word[-1:]) % PARENTS) * _CHILDREN + zlib.crc32(word[-3:]) % _CHILDREN


def _cuts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]]))


def _hash(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word, SEED)


class _Batch:
    """Texts of one task whose tokens travel together."""

    def __init__(self) -> None:
        self.number = {b"": 0}  # the end of a text
        self.texts: list[tuple[bool, int | None, np.ndarray]] = []
        self.size = 0

    def add(self, held_out: bool, doc_id: int | None, text: bytes) -> None:
        tokens, number = text.lower().split(), self.number
        for word in set(tokens).difference(number):
            number[word] = len(number)
        codes = np.zeros(len(tokens) + 1, dtype=np.int32)
        codes[:-1] = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
        self.texts.append((held_out, doc_id, codes))
        self.size += len(codes)

    def full(self) -> bool:
        return self.size >= BATCH_TOKENS or len(self.texts) >= BATCH_TEXTS

    def requests(self, name: int, parts: int, hot: dict[int, tuple[int, int]], apart: bool):
        """For each part, its pairs of words and the texts they stand in.

        ``hot`` has the first part and the number of slices by hash. ``apart``: where the
        pairs stand is left to one further row, which is the batch's own.
        """
        texts = sorted(self.texts, key=lambda t: t[0])  # training texts first
        n_train = sum(not held for held, _, _ in texts)
        hashes = np.array([_hash(w) for w in self.number], dtype=np.uint64)
        endings = np.array([context_of(w) for w in self.number], dtype=np.uint64)
        names = (endings << np.uint64(_HASH_BITS)) | (hashes >> np.uint64(64 - _HASH_BITS))
        line = np.concatenate([codes for _, _, codes in texts])
        home = (hashes % np.uint64(parts)).astype(np.int64)
        often = np.flatnonzero(np.isin(hashes, np.array(list(hot), np.uint64)))
        lot = home.copy()
        lot[often] = parts + np.arange(len(often))  # hot words stand alone, behind the parts
        order = np.lexsort((hashes, lot))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        by_name = np.argsort(names, kind="stable")  # pairs of a word come in the order of a part's
        named_rank = np.empty(len(by_name), dtype=np.int64)
        named_rank[by_name] = np.arange(len(by_name))
        before = named_rank[np.concatenate([[0], line[:-1]])]
        place = np.repeat(np.arange(len(texts), dtype=np.int32), [len(c) for _, _, c in texts])
        pair, place, n = _counted(rank[line] * len(order) + before, place, len(texts))
        del line, before
        starts = _cuts(pair)
        uses = np.diff(np.append(starts, len(pair)))
        train = np.add.reduceat(np.where(place < n_train, n, 0), starts)
        word, guest = pair[starts] // len(order), names[by_name][pair[starts] % len(order)]
        ids = np.array([0 if i is None else i for _, i, _ in texts], "<i8")
        nulls = np.array([i is None for _, i, _ in texts], "u1")
        named = (ids.tobytes() + nulls.tobytes(), np.array([len(c) for _, _, c in texts], "<i8").tobytes())
        lots = lot[order][word]
        firsts, kept = _cuts(lots), []
        for low, high in zip(firsts, np.append(firsts[1:], len(word)), strict=True):
            dealt = [(int(lots[low]), None, -1, -1, np.arange(low, high))]
            if lots[low] >= parts:
                at = order[word[low]]
                first, count = hot[int(hashes[at])]
                which = (guest[low:high] % np.uint64(count)).astype(np.int64)
                by_slice = np.argsort(which, kind="stable")
                cuts = _cuts(which[by_slice])
                own = (int(hashes[at : at + 1].view(np.int64)[0]), int(home[at]), first)
                dealt = [(first + int(which[s[0]]), *own, low + s) for s in np.split(by_slice, cuts[1:])]
            for part, hash_of, own_part, first, chosen in dealt:
                own_uses = uses[chosen]
                ends = np.cumsum(own_uses)
                entries = np.arange(ends[-1]) + np.repeat(starts[chosen] - ends + own_uses, own_uses)
                own_words = word[chosen]
                spread = np.diff(np.append(_cuts(own_words), len(own_words)))
                where = (_packed(own_uses), place[entries].astype("<u2").tobytes(), _packed(n[entries]), *named)
                if apart:
                    kept.append((part, spread, own_uses, entries))
                    where = (b"",) * 5
                named = (b"", b"") if not apart else named  # one row of each batch carries what names its texts
                yield (
                    part,
                    hash_of,
                    own_part,
                    first,
                    name,
                    len(texts),
                    hashes[order[own_words[_cuts(own_words)]]].astype("<u8").tobytes(),
                    _packed(spread),
                    guest[chosen].astype("<u8").tobytes(),
                    _packed(train[chosen]),
                    *where,
                )
        if apart:
            asked, spread, uses, entries = zip(*kept, strict=True)
            entries = np.concatenate(entries)
            yield (
                _home(name),
                None,
                -1,
                -1,
                name,
                len(texts),
                _packed(asked),
                _packed(np.concatenate(spread)),
                b"",
                b"",
                _packed(np.concatenate(uses)),
                place[entries].astype("<u2").tobytes(),
                _packed(n[entries]),
                *named,
            )


def _home(batch: int) -> int:
    """The number of the row that keeps a batch's places, where parts have theirs; below zero."""
    return -1 - _hash(batch.to_bytes(8, "little")) % (1 << 31)


def _counted(pair: np.ndarray, place: np.ndarray, n_texts: int):
    """Different pairs and places, sorted, and how often each occurs."""
    pairs = None
    if int(pair.max()) >= (1 << 62) // n_texts:
        pairs, pair = np.unique(pair, return_inverse=True)
    key, n = np.unique(pair * n_texts + place, return_counts=True)
    found, place = np.divmod(key, n_texts)
    return (found if pairs is None else pairs[found]), place.astype(np.int32), n.astype(np.int32)


def _each_batch(batches):
    """Batches of texts, and their names."""
    from pyspark import TaskContext

    name, batch = TaskContext.get().partitionId() << 32, _Batch()
    for record in slices(batches, "content"):
        held, ids = record.column("held_out").to_pylist(), record.column("doc_id").to_pylist()
        for i in range(record.num_rows):
            batch.add(held[i], ids[i], text_bytes(record.column("content")[i]))
            if batch.full():
                yield name, batch
                name, batch = name + 1, _Batch()
    if batch.texts:
        yield name, batch


def _requests(parts: int, hot: dict[int, tuple[int, int]], apart: bool):
    def run(batches):
        kinds = [pa.int32(), pa.int64(), *[pa.int32()] * 2, pa.int64(), pa.int32(), *[pa.binary()] * 9]
        for name, batch in _each_batch(batches):
            columns = list(zip(*batch.requests(name, parts, hot, apart), strict=True))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, _names(_REQUEST))

    return run


def _hot_words(rows: DataFrame, size: int, parts: int) -> dict[int, tuple[int, int]]:
    """First part and number of slices of each word with more than a part's share of the tokens."""
    every = max(1, math.ceil(size / SAMPLE_BYTES))
    long = F.octet_length("content") > LONG_TEXT
    chosen = rows.where(long | (F.pmod(F.xxhash64("doc_id", "content"), F.lit(every)) == 0))

    def run(batches):
        count = Counter()
        for batch in slices(batches, "content"):
            for value in batch.column("content"):
                text = text_bytes(value)
                weight = 1 if len(text) > LONG_TEXT else every
                for word, n in Counter(text.lower().split()).items():
                    count[word] += n * weight
                count[b""] += weight
        hashes = np.array([_hash(w) for w in count], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(count.values()), pa.int64())], ["word", "n"])

    counts = materialize(chosen.select("content").mapInArrow(run, "word long, n long"), "lm-often")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") * parts > total).collect()
    found, first = {}, parts
    for row in sorted(often):
        count = math.ceil(row["n"] * parts / total)
        found[row["word"] % (1 << 64)] = (first, count)
        first += count
    return found


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """One part: its pairs, how often they occur in training texts, and where they are asked for.

    Or what a batch keeps, as it came.
    """
    if frame["part"].iloc[0] < 0:
        return _kept(frame)
    rows = list(frame.sort_values(["batch", "n_texts"]).itertuples(index=False))
    owned, rows = [r for r in rows if r.n_texts < 0], [r for r in rows if r.n_texts >= 0]
    none = np.zeros(0, "<u8")
    words = np.unique(np.concatenate([none, *[np.frombuffer(r.words, "<u8") for r in rows + owned]]))
    guests = np.unique(np.concatenate([none, *[np.frombuffer(r.guests, "<u8") for r in rows]]))
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in rows:
        word = np.repeat(np.searchsorted(words, np.frombuffer(row.words, "<u8")), _numbers(row.spread))
        keys.append((word << 32) | np.searchsorted(guests, np.frombuffer(row.guests, "<u8")))
        counts.append(_numbers(row.train))
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    requests, at = [], 0
    for row, own in zip(rows, keys[1:], strict=True):
        kept = {k: getattr(row, k) for k in ("batch", "n_texts", "uses", "place", "n", "ids", "tokens")}
        requests.append({"pairs": _packed(np.diff(which[at : at + len(own)], prepend=0)), **kept})
        at += len(own)
    places = [int(np.searchsorted(words, np.frombuffer(r.words, "<u8"))[0]) for r in owned]
    routes = {p: r.n for p, r in zip(places, owned, strict=True)}
    one = rows[0] if rows else owned[0]
    made = {
        "part": one.part,
        "home": one.home,
        "first": one.first,
        "n_words": len(words),
        "spread": _packed(np.bincount(key >> 32, minlength=len(words))),
        "pairs": _packed(key & 0xFFFFFFFF),
        "customers": _packed(np.bincount(which, np.concatenate(counts), len(key))),
        "guests": guests.astype("<u8").tobytes(),
        "hot_places": _packed(sorted(routes)),
        "hot_routes": _packed([x for p in sorted(routes) for x in _numbers(routes[p])]),
        "hot": None if one.home < 0 else int(one.hot),
        "requests": requests,
        "kept": [],
    }
    return pd.DataFrame([made])


def _kept(frame: pd.DataFrame) -> pd.DataFrame:
    names = ["batch", "n_texts", "spread", "uses", "place", "n", "ids", "tokens"]
    kept = [{k: getattr(r, k) for k in names} | {"parts": r.words} for r in frame.itertuples(index=False)]
    made = dict.fromkeys(_names(_PART.partition(", requests")[0]), None)
    made |= {"part": frame["part"].iloc[0], "requests": [], "kept": kept}
    return pd.DataFrame([made])


@dataclass
class Totals:
    """Customers and tables of every restaurant, by level: all tokens, parents, endings."""

    customers: tuple[np.ndarray, np.ndarray, np.ndarray]
    tables: tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Model:
    """What all parts share: sizes, discounts and the totals after each sweep.

    ``held`` has the customers of words' restaurants for each part, ``stored`` the letters after
    each sweep; both stay in Spark.
    """

    books: int
    tokens: int = 0
    known_words: int = 0
    discount: tuple[float, ...] = (0.5,) * 4
    totals: list[Totals] = field(default_factory=list)
    held: DataFrame | None = None
    stored: list[DataFrame] = field(default_factory=list)

    def shared(self):
        """A broadcast of what tasks need."""
        context = self.held.sparkSession.sparkContext
        return context.broadcast(replace(self, held=None, stored=[]))


def seat(customers: np.ndarray, weight, parent: np.ndarray, rest, discount: float, rng):
    """Tables after all customers of each dish have left and sat down again.

    ``weight + discount * tables`` of the whole restaurant times ``parent``
    stands for a new table; ``rest`` is the tables of the other dishes.
    """
    order = np.argsort(-customers, kind="stable")
    count = customers[order]
    parent = parent[order]
    base = weight + discount * rest[order]
    tables = np.minimum(count, 1).astype(np.int64)
    active = int(np.searchsorted(-count, -1, "left"))  # more than one customer
    seated = 1
    while active:
        group = 1 if seated < ONE_BY_ONE else seated // 16
        new = (base[:active] + discount * tables[:active]) * parent[:active]
        chance = new / (new + seated - discount * tables[:active])
        if group == 1:
            tables[:active] += rng.random(active) < chance
        else:
            tables[:active] += rng.binomial(np.minimum(group, count[:active] - seated), chance)
        seated += group
        active = int(np.searchsorted(-count, -seated, "left"))
    out = np.empty_like(tables)
    out[order] = tables
    return out


class Seats:
    """The tables of one part's words on all levels.

    In a slice there is one word; its upper levels are as its own part has told.
    """

    def __init__(self, row) -> None:
        self.part, self.home, self.first = int(row.part), int(row.home), int(row.first)
        self.is_slice, self.n_words = self.home >= 0, int(row.n_words)
        self.word = np.repeat(np.arange(self.n_words), _numbers(row.spread))
        self.guests, self.guest = np.frombuffer(row.guests, "<u8"), _numbers(row.pairs)
        self.ending = (self.guests >> np.uint64(_HASH_BITS)).astype(np.int64)[self.guest]
        self.pair_customers = _numbers(row.customers)
        self.pair_tables = np.minimum(self.pair_customers, 1)
        self.told = np.zeros((2, len(self.guests)))  # customers and tables of the words' restaurants
        self.counts = np.bincount(self.word, self.pair_customers, self.n_words)
        self.hot_places, routes = _numbers(row.hot_places), _numbers(row.hot_routes).reshape(-1, 2)
        self.routes = {int(first): (i, int(count)) for i, (first, count) in enumerate(routes)}
        hot = self.hot_places if not self.is_slice else np.zeros(1, np.int64)
        dense = (hot[:, None] * CONTEXTS + np.arange(CONTEXTS)).ravel()
        key = self.word * CONTEXTS + self.ending  # sorted, as names start with the ending
        # Hot words have no pairs here but a cell for each ending, a slice has just these.
        cells = dense if self.is_slice else np.sort(np.concatenate([key[_cuts(key)], dense]))
        self.pair_cell = np.searchsorted(cells, key)
        self.hot_cells = np.searchsorted(cells, dense)
        self.hot_customers = np.zeros(len(dense), np.int64)
        self.context = cells % CONTEXTS
        parent = cells // _CHILDREN  # of a word: sorted as well
        self.parents = parent[_cuts(parent)]
        self.cell = np.searchsorted(self.parents, parent)
        self._first_tables()

    def _first_tables(self) -> None:
        self.customers = self._sent_up()
        self.tables = np.minimum(self.customers, 1)
        self._upwards(None, None)

    def _sent_up(self) -> np.ndarray:
        """Tables of words' restaurants as customers of endings."""
        if self.is_slice:
            return np.zeros(CONTEXTS, np.int64)
        found = np.bincount(self.pair_cell, self.pair_tables, len(self.context)).astype(np.int64)
        found[self.hot_cells] = self.hot_customers
        return found

    def _upwards(self, seat_parents, seat_all) -> None:
        """Tables become customers one level up; without a seating rule each dish has one table."""
        self.parent_customers = np.bincount(self.cell, self.tables, len(self.parents)).astype(np.int64)
        known = np.minimum(self.parent_customers, 1)
        self.parent_tables = known if seat_parents is None else seat_parents(self.parent_customers)
        sums = np.bincount(self.parents // PARENTS, self.parent_tables, self.n_words)
        self.word_customers = sums.astype(np.int64)
        known = np.minimum(self.word_customers, 1)
        self.word_tables = known if seat_all is None else seat_all(self.word_customers)

    def take(self, *boxes) -> Seats:
        """Continue with the letters written after a sweep, and those on customers."""
        seats = None
        for letter in (x for box in boxes if box is not None for x in box):
            kind, key = letter["kind"], letter["key"]
            if kind in ("held", "told"):  # customers, tables
                self.told[int(kind == "told"), self._book(key)] = _numbers(letter["payload"])
                continue
            if kind == "seats":
                seats = letter["payload"]
                continue
            found = _numbers(letter["payload"])
            if kind == "slice":
                at = self.routes[key][0]
                self.hot_customers[at * CONTEXTS : (at + 1) * CONTEXTS] += found[:-1]
                self.counts[self.hot_places[at]] += found[-1]
            elif kind == "upper":
                cuts = np.cumsum([1, 1, 1, PARENTS, PARENTS, CONTEXTS])
                upper = np.split(found, cuts)
                self.counts = upper[0].astype(float)
                self.word_customers, self.word_tables = upper[1:3]
                self.parent_customers, self.parent_tables, self.customers, self.tables = upper[3:]
        if seats is None:
            if not self.is_slice:
                self._first_tables()
            return self
        self._seat_again(_each(seats))
        return self

    def _written(self) -> bytes:
        """Tables of all dishes with two customers or more; others follow from the customers."""
        levels = [(self.pair_tables, self.pair_customers)]
        if not self.is_slice:
            levels += [(self.tables, self.customers), (self.parent_tables, self.parent_customers)]
            levels += [(self.word_tables, self.word_customers)]
        hot = [] if self.is_slice else [self.customers[self.hot_cells]]
        return _all([*hot, *[tables[customers > 1] for tables, customers in levels]])

    def _seat_again(self, written: list[np.ndarray]) -> None:
        def seated(tables):
            def again(customers):
                out = np.minimum(customers, 1)
                out[customers > 1] = tables
                return out

            return again

        hot = written.pop(0) if not self.is_slice else None
        self.pair_tables = seated(written[0])(self.pair_customers)
        if not self.is_slice:
            self.customers = np.bincount(self.pair_cell, self.pair_tables, len(self.context)).astype(np.int64)
            self.customers[self.hot_cells] = hot
            self.tables = seated(written[1])(self.customers)
            self._upwards(seated(written[2]), seated(written[3]))

    def _book(self, number: int) -> np.ndarray:
        """The part's words in a book, in the order of their letters."""
        return self._books[1][self._books[0][number] : self._books[0][number + 1]]

    def by_book(self, count: int) -> Seats:
        self._books = _books(self.guests, count)
        return self

    def sweep(self, model: Model, number: int) -> None:
        """Sweep ``number`` uses the totals after the one before."""
        rng = np.random.default_rng([SEED, self.part, number])
        totals, d = model.totals[number - 1], model.discount
        flat = 1 / (model.known_words + 1)
        of_word = self.of_words(model, totals)
        of_cell = self.of_parents(model, totals, of_word)[self.cell]
        of_ending = self.of_endings(model, totals, of_cell)

        def by_word(many):
            rest = self.told[1][self.guest[many]] - self.pair_tables[many]
            return of_ending[self.pair_cell[many]], rest

        def by_ending(many):
            return of_cell[many], totals.tables[2][self.context[many]] - self.tables[many]

        def by_parent(many):
            word, group = np.divmod(self.parents[many], PARENTS)
            return of_word[word], totals.tables[1][group] - old_parents[many]

        def by_all(many):
            return np.full(len(many), flat), totals.tables[0][0] - old_all[many]

        self.pair_tables = _seated(self.pair_customers, STRENGTH[3], by_word, d[3], rng)
        if self.is_slice:
            return
        self.customers, old_parents, old_all = self._sent_up(), self.parent_tables, self.word_tables
        self.tables = _seated(self.customers, STRENGTH[2], by_ending, d[2], rng)
        self._upwards(
            lambda customers: _seated(customers, STRENGTH[1], by_parent, d[1], rng),
            lambda customers: _seated(customers, STRENGTH[0], by_all, d[0], rng),
        )

    def of_words(self, model: Model, totals: Totals) -> np.ndarray:
        """Probabilities in the restaurant of all tokens."""
        d, c, t = model.discount[0], totals.customers[0][0], totals.tables[0][0]
        own = self.word_customers - d * self.word_tables
        return (own + (STRENGTH[0] + d * t) / (model.known_words + 1)) / (STRENGTH[0] + c)

    def of_parents(self, model: Model, totals: Totals, of_word: np.ndarray) -> np.ndarray:
        """Probabilities in the parents that have the words."""
        word, group = np.divmod(self.parents, PARENTS)
        d, c, t = model.discount[1], totals.customers[1][group], totals.tables[1][group]
        own = self.parent_customers - d * self.parent_tables
        return (own + (STRENGTH[1] + d * t) * of_word[word]) / (STRENGTH[1] + c)

    def word_parents(self, model: Model, totals: Totals) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities in the restaurant of all tokens, and in every parent."""
        d, c, t = model.discount[1], totals.customers[1], totals.tables[1]
        of_word = self.of_words(model, totals)
        found = np.outer(of_word, (STRENGTH[1] + d * t) / (STRENGTH[1] + c))
        found.ravel()[self.parents] = self.of_parents(model, totals, of_word)
        return of_word, found

    def of_endings(self, model: Model, totals: Totals, parent: np.ndarray | None = None) -> np.ndarray:
        """Probabilities in the endings' restaurants, for each cell; ``parent`` has their parents'."""
        d, c, t = model.discount[2], totals.customers[2][self.context], totals.tables[2][self.context]
        if parent is None:
            parent = self.of_parents(model, totals, self.of_words(model, totals))[self.cell]
        return (self.customers - d * self.tables + (STRENGTH[2] + d * t) * parent) / (STRENGTH[2] + c)

    def of_pairs(self, model: Model, totals: Totals) -> np.ndarray:
        """Probabilities of the pairs' words behind the words before them."""
        d, (c, t) = model.discount[3], self.told[:, self.guest]
        parent = self.of_endings(model, totals)[self.pair_cell]
        own = self.pair_customers - d * self.pair_tables
        return (own + (STRENGTH[3] + d * t) * parent) / (STRENGTH[3] + c)

    def letters(self, first: bool) -> list[tuple]:
        """What other parts, and this one in the next sweep, have to know; ``_LETTER`` rows."""
        found = [(self.part, "seats", 0, self._written()), (-1, "total", 0, _packed(self.totals()))]
        if self.is_slice:
            found.append(self.from_slice())
        for start, (at, count) in self.routes.items():
            payload = _packed(np.concatenate(self._upper(at)))
            found += [(start + i, "upper", 0, payload) for i in range(count)]
        for kind, values in (("customers", self.pair_customers), ("tables", self.pair_tables)):
            if kind == "tables" or first:
                sums = np.bincount(self.guest, values, len(self.guests))
                own = [(i, self._book(i)) for i in range(len(self._books[0]) - 1)]
                found += [(self.part, kind, i, _packed(sums[x])) for i, x in own if len(x)]
        return found

    def _upper(self, at: int) -> list[np.ndarray]:
        place = int(self.hot_places[at])
        cells = self.hot_cells[at * CONTEXTS : (at + 1) * CONTEXTS]
        parents = slice(self.cell[cells[0]], self.cell[cells[0]] + PARENTS)
        one = np.array([self.counts[place], self.word_customers[place], self.word_tables[place]])
        return [one, self.parent_customers[parents], self.parent_tables[parents], self.customers[cells], self.tables[cells]]

    def from_slice(self) -> tuple:
        """A slice's tables by ending and number of tokens, for its word's own part."""
        up = np.bincount(self.ending, self.pair_tables, CONTEXTS)
        return (self.home, "slice", self.first, _packed(np.append(up, self.pair_customers.sum())))

    def totals(self) -> np.ndarray:
        """Customers, then tables, of endings, parents and all tokens; behind each, sizes.

        These are known words and tokens, then the numbers of dishes with one and with two
        customers on each level.
        """
        levels = (self.word_customers, self.parent_customers, self.customers, self.pair_customers)
        known = int((self.word_customers > 0).sum())
        if self.is_slice:
            levels, known = (np.zeros(0),) * 3 + (self.pair_customers,), 0
        found = []
        for size, of_all, of_parents, of_endings in (
            (1, self.word_customers, self.parent_customers, self.customers),
            (2, self.word_tables, self.parent_tables, self.tables),
        ):
            sums = np.zeros(CONTEXTS + PARENTS + 1)
            if not self.is_slice:
                sums[:CONTEXTS] = np.bincount(self.context, of_endings, CONTEXTS)
                sums[CONTEXTS:-1] = np.bincount(self.parents % PARENTS, of_parents, PARENTS)
                sums[-1] = of_all.sum()
            more = [known if size == 1 else self.pair_customers.sum(), *[(x == size).sum() for x in levels]]
            found += [sums, more]
        return np.concatenate(found).astype(np.int64)


def _seated(customers: np.ndarray, strength: float, above, discount: float, rng):
    """Tables of all dishes; only those with two customers or more are left to chance.

    ``above`` has their parents' probabilities and the restaurants' other tables.
    """
    tables = np.minimum(customers, 1)
    many = np.flatnonzero(customers > 1)
    parent, rest = above(many)
    tables[many] = seat(customers[many], strength, parent, np.maximum(rest, 0), discount, rng)
    return tables


def _books(guests: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each book's words start, and their order."""
    book = (guests % np.uint64(count)).astype(np.int64)
    order = np.argsort(book, kind="stable")
    return np.searchsorted(book[order], np.arange(count + 1)), order


def _bucketed(df: DataFrame, label: str, count: int, key: str) -> DataFrame:
    """``df`` stored in buckets, so that a join by ``key`` leaves it where it is."""
    spark, name = df.sparkSession, f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    rows = df.write.bucketBy(count, key).option("compression", "zstd")
    rows.option("path", shared_dir(spark, label)).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return found


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _book_index(frame: pd.DataFrame) -> pd.DataFrame:
    """Which restaurant each entry of the parts' letters to a book is about."""
    frame = frame.sort_values("part")
    names = [np.frombuffer(x, "<u8") for x in frame["names"]]
    found, index = np.unique(np.concatenate(names), return_inverse=True)
    sizes = [len(x) for x in names]
    made = (int(frame["book"].iloc[0]), len(found), _packed(frame["part"]), _packed(sizes), _packed(index))
    return pd.DataFrame([made], columns=["book", "n", "parts", "sizes", "entries"])


def _guests(parts: DataFrame, count: int) -> DataFrame:
    """A row for each book: who has which of its words."""

    def run(frames):
        for frame in frames:
            for part, value in frame.itertuples(index=False):
                guests = np.frombuffer(value, "<u8")
                starts, order = _books(guests, count)
                rows = [(b, part, guests[order[starts[b] : starts[b + 1]]].tobytes()) for b in range(count)]
                yield pd.DataFrame(rows, columns=["book", "part", "names"])

    rows = parts.select("part", "guests").mapInPandas(run, "book int, part int, names binary")
    rows = rows.where(F.octet_length("names") > 0).repartition(count, "book")
    index = rows.groupBy("book").applyInPandas(
        _book_index, "book int, n long, parts binary, sizes binary, entries binary"
    )
    return _bucketed(index, "lm-books", count, "book")


def _tell(guests: DataFrame, letters: DataFrame, kind: str, answer: str) -> DataFrame:
    """Sums of every word's restaurant, to all parts that have the word."""

    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                sent = {m["part"]: m["payload"] for m in row.sent}
                parts, entries = _numbers(row.parts).tolist(), _numbers(row.entries)
                values = np.concatenate([_numbers(sent[p]) for p in parts])
                sums = np.bincount(entries, values, row.n).astype(np.int64)[entries]
                ends = np.cumsum(_numbers(row.sizes))
                own = zip(parts, np.append(0, ends[:-1]), ends, strict=True)
                rows = [(p, answer, row.book, _packed(sums[a:b])) for p, a, b in own]
                yield pd.DataFrame(rows, columns=_names(_LETTER))

    sent = letters.where(F.col("kind") == kind).groupBy(F.col("key").cast("int").alias("book"))
    sent = sent.agg(F.collect_list(F.struct("part", "payload")).alias("sent"))
    return guests.join(sent.hint("shuffle_hash"), "book").mapInPandas(run, _LETTER)


_TO_PARTS = "kind NOT IN ('total', 'customers', 'tables')"


def _with_letters(parts: DataFrame, *letters: DataFrame) -> DataFrame:
    """Parts with the letters to them after one or several sweeps."""
    found = None
    for number, rows in enumerate(letters):
        rows = rows.where(_TO_PARTS).select("part", F.lit(number).alias("sweep"), "kind", "key", "payload")
        found = rows if found is None else found.unionByName(rows)
    inbox = found.groupBy("part").agg(F.collect_list(F.struct("sweep", "kind", "key", "payload")).alias("inbox"))
    return parts.join(inbox.hint("shuffle_hash"), "part", "left")


def _summed(letters: DataFrame, parts: int) -> tuple[Totals, np.ndarray, np.ndarray]:
    """Totals and sizes over all parts; the driver gets a row of fixed size for many parts."""

    def run(frames):
        total = None
        for frame in frames:
            for payload in frame["payload"]:
                found = _numbers(payload)
                total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"payload": [_packed(total)]})

    rows = letters.where("kind = 'total'").select("payload")
    rows = rows.repartition(math.ceil(parts / PARTS_A_SUM) or 1).mapInPandas(run, "payload binary").collect()
    size = CONTEXTS + PARENTS + 1
    line = np.zeros((2, size + 5))
    for row in rows:
        line += _numbers(row["payload"]).reshape(2, -1)
    levels = (line[:, size - 1 : size], line[:, CONTEXTS : size - 1], line[:, :CONTEXTS])
    totals = Totals(tuple(x[0] for x in levels), tuple(x[1] for x in levels))
    return totals, line[0, size:].astype(np.int64), line[1, size:].astype(np.int64)


def fit(parts: DataFrame, sweeps: int = SWEEPS, keep_from: int = 0) -> Model:
    """Seat all training tokens; ``parts`` is what ``prepared`` returns.

    What is stored after sweeps before ``keep_from`` is removed.
    """
    count = parts.count()
    books = max(1, math.ceil(count / PARTS_A_BOOK))
    model, static = Model(books, held=parts), parts.select(*_names(_STATIC))
    guests = _guests(parts, books)

    def slices_first(frames):
        for frame in frames:
            rows = [Seats(row).from_slice() for row in frame.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=_names(_LETTER))

    letters, paths = static.where("home >= 0").mapInPandas(slices_first, _LETTER), []
    for number in range(sweeps + 1):
        shared = model.shared()

        def step(frames, shared=shared, number=number):
            model = shared.value
            for frame in frames:
                for row in frame.itertuples(index=False):
                    seats = Seats(row).by_book(model.books).take(row.held if number else None, row.inbox)
                    if number:
                        seats.sweep(model, number)
                    yield pd.DataFrame(seats.letters(not number), columns=_names(_LETTER))

        after, path = _stored(_with_letters(static, letters).mapInPandas(step, _LETTER), "lm-letters")
        told, also = _stored(_tell(guests, after, "tables", "told"), "lm-told")
        totals, ones, twos = _summed(after, count)
        model.totals.append(totals)
        if not number:
            model.known_words, model.tokens = int(ones[0]), int(twos[0])
            pairs = zip(ones[1:].tolist(), twos[1:].tolist(), strict=True)
            model.discount = tuple(
                min(max(a / (a + 2 * b), 0.1), 0.95) if a + b else 0.5 for a, b in pairs
            )
            held = _tell(guests, after, "customers", "held").groupBy("part")
            held = held.agg(F.collect_list(F.struct("kind", "key", "payload")).alias("held"))
            model.held = _bucketed(held, "lm-held", max(1, count), "part")
            static = static.join(model.held.hint("shuffle_hash"), "part", "left")
        if 0 < number <= keep_from:
            for old in paths.pop():
                remove(parts.sparkSession, old)
        letters = after.where(_TO_PARTS).unionByName(told)
        model.stored.append(letters)
        paths.append((path, also))
    return model


def _after(row, model: Model, number: int) -> Seats:
    """The seats of a part after a sweep."""
    own = F.col("part") == int(row.part)
    held = [m for r in model.held.where(own).collect() for m in r["held"]]
    return Seats(row).by_book(model.books).take(held, model.stored[number].where(own).where(_TO_PARTS).collect())


class Answers:
    """Sums by text of what a task's parts know, for each batch that asks."""

    def __init__(self) -> None:
        self.names: dict[int, tuple[bytes, bytes]] = {}
        self.sums: dict[int, np.ndarray] = {}
        self.size = 0

    def add(self, request, known, base, chance) -> None:
        size, batch = request["n_texts"], request["batch"]
        if request["tokens"]:
            self.names[batch] = (request["ids"], request["tokens"])
        if batch not in self.sums:
            self.sums[batch] = np.zeros((3, size))
            self.size += 24 * size
        place, n = np.frombuffer(request["place"], "<u2"), _numbers(request["n"])
        sums = self.sums[batch]
        for i, values in enumerate((known, base, np.log10(chance))):
            sums[i] += np.bincount(place, n * values, size)

    def taken(self) -> pd.DataFrame:
        """What has been added, after which nothing is held."""
        rows = [
            {
                "batch": batch,
                "ids": self.names.get(batch, (b"", b""))[0],
                "tokens": self.names.get(batch, (b"", b""))[1],
                "known": sums[0].astype("<i4").tobytes(),
                "base": sums[1].astype("<f8").tobytes(),
                "score": sums[2].astype("<f8").tobytes(),
            }
            for batch, sums in self.sums.items()
        ]
        self.__init__()
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _PARTIAL.split(", ")])


def _answered(frames, model: Model, numbers: list[int]):
    """Answers of a task's parts that have the places; sums beyond ``HELD_BYTES`` and one batch are not held."""
    answers = Answers()
    for frame in frames:
        for row in frame.itertuples(index=False):
            for _ in _answer(row, model, numbers, answers):
                if answers.size > HELD_BYTES:
                    yield answers.taken()
    yield answers.taken()


def _of_part(row, model: Model, numbers: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a part's pairs, how often each word occurs, and the pairs' mean probabilities."""
    mean = 0.0
    for i, number in enumerate(numbers):
        inbox = [m for m in row.inbox if m["sweep"] == i]
        seats = Seats(row).by_book(model.books).take(row.held, inbox)
        mean = mean + seats.of_pairs(model, model.totals[number]) / len(numbers)
        word, counts = seats.word, seats.counts
        del seats, inbox
    return word, counts, mean


def _base(counts: np.ndarray, model: Model) -> np.ndarray:
    return np.log10((counts + 1) / (model.tokens + model.known_words + 1))


def _answer(row, model: Model, numbers: list[int], answers: Answers):
    """Log probabilities of everything a part is asked for, summed by text; a step for each batch."""
    word, counts, mean = _of_part(row, model, numbers)
    known, base = (counts > 0)[word], _base(counts, model)[word]
    for request in row.requests:
        pair = np.repeat(np.cumsum(_numbers(request["pairs"])), _numbers(request["uses"]))
        answers.add(request, known[pair], base[pair], mean[pair])
        yield


def _answers(row, model: Model, numbers: list[int]) -> pd.DataFrame:
    """For each batch, how often the words it asks a part for occur, and the pairs' log probabilities."""
    word, counts, mean = _of_part(row, model, numbers)
    steps, rows = np.rint(-np.log10(mean) * LOG_STEPS).astype(np.int64), []
    for request in row.requests:
        pairs = np.cumsum(_numbers(request["pairs"]))
        words = word[pairs]
        batch, often = request["batch"], counts[words[_cuts(words)]]
        rows.append((_home(batch), batch, row.part, _packed(often), _packed(steps[pairs])))
    return pd.DataFrame(rows, columns=_names(_ANSWER))


def _texts(row, model: Model) -> pd.DataFrame:
    """Sum the parts' answers for the texts of one batch."""
    sent = {m["source"]: m for m in row.sent if m["batch"] == row.batch}
    sent = [sent[p] for p in _numbers(row.parts).tolist()]  # in the order of the batch's places
    counts = np.concatenate([_numbers(m["counts"]) for m in sent])
    chances = np.concatenate([_numbers(m["chances"]) for m in sent]) / -LOG_STEPS
    spread, uses = _numbers(row.spread), _numbers(row.uses)
    place, n = np.frombuffer(row.place, "<u2"), _numbers(row.n)
    total = {}
    for name, values in (("known", counts > 0), ("base", _base(counts, model)), ("score", chances)):
        of_pairs = values if name == "score" else np.repeat(values, spread)
        total[name] = np.bincount(place, n * np.repeat(of_pairs, uses), row.n_texts)
    tokens = np.frombuffer(row.tokens, "<i8")
    ids = np.frombuffer(row.ids[: 8 * len(tokens)], "<i8")
    nulls = np.frombuffer(row.ids[8 * len(tokens) :], "u1").astype(bool)
    return pd.DataFrame(
        {
            "doc_id": pd.array(ids, dtype="Int64").copy() if not nulls.any() else _nullable(ids, nulls),
            "n_tokens": tokens,
            "n_known": total["known"].astype(np.int64),
            "base_score": total["base"],
            "score": total["score"],
        }
    )


def _nullable(ids: np.ndarray, nulls: np.ndarray):
    return pd.arrays.IntegerArray(ids.astype("int64"), nulls)


def prepared(df: DataFrame, held_out, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each part of the vocabulary: counts of training texts, places of all texts."""
    return _parts(df, held_out, text, doc_id, False)[0]


def _parts(df: DataFrame, held_out, text: str, doc_id: str, apart: bool) -> tuple[DataFrame, DataFrame, int]:
    """Rows for the parts and, ``apart``, for the places that batches keep; the number of buckets of both."""
    value = clean_text(f"`{text}`")
    rows = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        F.encode(value, "UTF-8").alias("content"),
    )
    size = df.agg(F.sum(F.octet_length(value))).first()[0] or 0
    count = max(1, math.ceil(size / PART_BYTES))
    hot = _hot_words(rows, size, count)
    # A hot word's own part has to know of its slices.
    told = [
        (h % count, None, -1, -1, -1, -1, h.to_bytes(8, "little"), *[b""] * 5, _packed(route), b"", b"")
        for h, route in hot.items()
    ]
    asked = rows.mapInArrow(_requests(count, hot, apart), _REQUEST)
    asked = asked.unionByName(df.sparkSession.createDataFrame(told, _REQUEST)) if told else asked
    total = count + sum(n for _, n in hot.values())
    merged = asked.repartition(total, "part").groupBy("part").applyInPandas(_merged, _PART)
    stored = _bucketed(merged, "lm-parts", total, "part")
    kept = stored.where("part < 0").select("part", F.inline("kept"))
    return stored.where("part >= 0").drop("kept"), kept, total


def held_out_rows(doc_id: str = "doc_id", folds: int = 7, fold: int = 2):
    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    return F.crc32(F.encode(name, "UTF-8")) % folds == fold


def score(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    sweeps: int = SWEEPS,
    burn_in: int = BURN_IN,
) -> DataFrame:
    """Score every text by a model of those that are not held out.

    ``perplexity`` is that of the text's tokens under the model.
    """
    parts, kept, count = _parts(df, held_out_rows(doc_id), text, doc_id, True)
    model = fit(parts, sweeps, burn_in + 1)
    shared = model.shared()
    numbers = list(range(burn_in + 1, sweeps + 1))

    def answering(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield _answers(row, shared.value, numbers)

    def adding(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield _texts(row, shared.value)

    asked = parts.where(F.size("requests") > 0).drop("hot").join(model.held.hint("shuffle_hash"), "part", "left")
    told = _with_letters(asked, *[model.stored[i] for i in numbers])
    sent = told.mapInPandas(answering, _ANSWER).repartition(count, "part").groupBy("part")
    sent = sent.agg(F.collect_list(F.struct("batch", "source", "counts", "chances")).alias("sent"))
    texts = kept.join(sent.hint("shuffle_hash"), "part").mapInPandas(
        adding, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return texts.select(
        "doc_id",
        held_out_rows().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
