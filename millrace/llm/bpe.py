"""Byte-level BPE encoding and decoding on whole texts of any length.

A text of at most ``LEAF_CHARS`` characters is encoded where it is. A longer one
is a tree: it is halved until the leaves are short, leaves are encoded by
different tasks, and neighbours are joined pair by pair. A cut may fall inside a
word, so a join encodes a window around it anew and lets it grow until the
window's first tokens are those of the left side and its last tokens those of
the right side; with windows as large as both sides the result is exact anyway.

Inside a leaf the text falls apart where white space follows other characters:
the vocabulary's splitting pattern never matches across such a place. Those
pieces repeat, so each is encoded once and then looked up. Where the vocabulary
numbers its merges in their order, pieces are encoded by ranks, which gives the
same ids in less time; pieces with a special token's name always by the library.

NULL counts as the empty text and has no ids. Repeated rows are encoded each.
Columns named as the added ones are replaced.
"""

from __future__ import annotations

import array
import functools
import json
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import appended, clean_text

LEAF_CHARS = 32 * 1024
CACHED_PIECES = 200_000  # pieces a task remembers before it starts afresh
AGREE = 4  # tokens that must agree on each side of a join
FIRST_WINDOW = 16

_PIECE = re.compile(r"\s*\S+|\s+")
# White space for Python's \s but not for the vocabulary's pattern.
_ODD_SPACE = re.compile("[\x1c-\x1f]")

# Fixed value: how byte-level vocabularies split texts before merging.
_SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

IDS = T.StructField("ids", T.BinaryType())
COUNT = T.StructField("n_tokens", T.LongType())
DECODED = T.StructField("decoded", T.StringType())


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies spell printable bytes as themselves, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """One vocabulary: ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        byte = _byte_of_character()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes_of: dict[int, bytes] = {}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            known = all(c in byte for c in token)
            self.bytes_of[i] = bytes(byte[c] for c in token) if known else token.encode()
        self.pieces: dict[str, bytes] = {}
        self.by_rank = self._ranked(path)

    def _ranked(self, path: str):
        """Encoder by ranks, if ids follow the order of merges and nothing else is set up."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            setup = json.load(file)
        model, before = setup["model"], setup["pre_tokenizer"] or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
        plain = (
            model.get("type") == "BPE"
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not setup["normalizer"]
            and not model.get("dropout")
            and all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        )
        if not plain:
            return None
        ranks = {self.bytes_of[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding(path, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, piece: str) -> bytes:
        if self.by_rank is None or any(s in piece for s in self.special):
            return self._library([piece])[0]
        return array.array("I", self.by_rank.encode_ordinary(piece)).tobytes()

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def encode(self, text: str) -> bytes:
        """Ids of a text, as the library gives them for the whole text."""
        if _ODD_SPACE.search(text):
            return self._library([text])[0]
        pieces, known = _PIECE.findall(text), self.pieces
        new = set(pieces).difference(known)
        if len(known) + len(new) > CACHED_PIECES:
            known.clear()
            new = set(pieces)
        for piece in new:
            known[piece] = self._piece(piece)
        return b"".join(map(known.__getitem__, pieces))

    def decode_bytes(self, ids) -> bytes:
        try:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        except KeyError:  # ids the vocabulary lacks
            return b"".join([self.bytes_of.get(i, b"") for i in ids])

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(np.frombuffer(ids, "<u4").tolist()).decode("utf-8", "replace")

    def columns(self, ids: list[bytes], count: int) -> list[list]:
        """Ids, their number and, if three columns are wanted, the text they spell."""
        made = [ids, [len(x) // 4 for x in ids]]
        return made if count == 2 else [*made, [self.decode(x) for x in ids]]

    def join(self, left: bytes, right: bytes) -> bytes:
        """Ids of the joined text from the ids of its two sides."""
        a, b = np.frombuffer(left, "<u4"), np.frombuffer(right, "<u4")
        wide = FIRST_WINDOW
        while True:
            i, j = max(len(a) - wide, 0), min(wide, len(b))
            while i > 0 and self._inside_character(a[i]):
                i -= 1
            while j < len(b) and self._inside_character(b[j]):
                j += 1
            window = self.decode_bytes([*a[i:].tolist(), *b[:j].tolist()]).decode()
            new = np.frombuffer(self._library([window])[0], "<u4")
            if self._agree(new, a[i:], i == 0) and self._agree(new[::-1], b[:j][::-1], j == len(b)):
                return np.concatenate([a[:i], new, b[j:]]).tobytes()
            wide *= 2

    def _inside_character(self, token: int) -> bool:
        head = self.bytes_of.get(int(token), b"")[:1]
        return bool(head) and 0x80 <= head[0] < 0xC0

    @staticmethod
    def _agree(new: np.ndarray, side: np.ndarray, whole: bool) -> bool:
        """The side is in the window as a whole, or they begin with the same tokens."""
        if whole:
            return True
        same = min(len(new), len(side), AGREE)
        return same == AGREE and bool((new[:same] == side[:same]).all())

    def join_all(self, leaves: list[bytes]) -> bytes:
        """Join neighbours pair by pair, level by level."""
        while len(leaves) > 1:
            pairs = [self.join(*leaves[i : i + 2]) for i in range(0, len(leaves) - 1, 2)]
            leaves = pairs + leaves[len(leaves) - len(leaves) % 2 :]
        return leaves[0] if leaves else b""


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def leaves(text: str, size: int) -> list[str]:
    """Halve a text until no part is longer than ``size``."""
    if len(text) <= size:
        return [text]
    middle = len(text) // 2
    return leaves(text[:middle], size) + leaves(text[middle:], size)


def encode(
    df: DataFrame, vocabulary: str, column: str = "text", leaf_chars: int = LEAF_CHARS
) -> DataFrame:
    """Add ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens``."""
    return _coded(df, vocabulary, column, leaf_chars, [IDS, COUNT])


def round_trip(
    df: DataFrame, vocabulary: str, column: str = "text", leaf_chars: int = LEAF_CHARS
) -> DataFrame:
    """``ids``, ``n_tokens`` and ``decoded`` in place of the text; one Python process does both."""
    return _coded(df, vocabulary, column, leaf_chars, [IDS, COUNT, DECODED], without=(column,))


def _coded(df, vocabulary, column, leaf_chars, added, without=()) -> DataFrame:
    df = df.drop(*[f.name for f in added if f.name.lower() != column.lower()])
    length = F.length(clean_text(f"`{column}`"))

    def plain():
        tool = codec(vocabulary)
        return lambda texts: tool.columns([tool.encode(t.decode()) for t in texts], len(added))

    short = appended(df.where(length <= leaf_chars), column, added, plain, without)
    long = _long(df.where(length > leaf_chars), vocabulary, column, leaf_chars, added, without)
    return short.unionByName(long)


def _long(df, vocabulary, column, leaf_chars, added, without) -> DataFrame:
    """Leaves of each different text go to different tasks; one task joins their ids."""
    gone = {f.name.lower() for f in added} | {c.lower() for c in without}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]

    def cut(frames):
        for frame in frames:
            for name, text in zip(frame["__name"], frame["__text"], strict=True):
                parts = leaves(text, leaf_chars)
                yield pd.DataFrame({"__name": name, "__leaf": range(len(parts)), "__part": parts})

    def encoded(frames):
        tool = codec(vocabulary)
        for frame in frames:
            frame["__part"] = [tool.encode(t) for t in frame["__part"]]
            yield frame

    def joined(frame):
        tool = codec(vocabulary)
        ids = tool.join_all(frame.sort_values("__leaf")["__part"].tolist())
        made = zip([f.name for f in added], tool.columns([ids], len(added)), strict=True)
        return pd.DataFrame({"__name": frame["__name"].iloc[:1], **dict(made)})

    text = clean_text(f"`{column}`")
    named = df.withColumn("__name", F.sha2(F.encode(text, "UTF-8"), 256))
    parts = (
        named.select("__name", text.alias("__text"))
        .mapInPandas(cut, "__name string, __leaf long, __part string")
        .groupBy("__name", "__leaf")
        .agg(F.first("__part").alias("__part"))
        .mapInPandas(encoded, "__name string, __leaf long, __part binary")
    )
    schema = T.StructType([T.StructField("__name", T.StringType()), *added])
    ids = parts.groupBy("__name").applyInPandas(joined, schema)
    return named.select(*kept, "__name").join(ids, "__name").drop("__name")


def decode(df: DataFrame, vocabulary: str, column: str = "ids") -> DataFrame:
    """Replace the ids by ``decoded``, the text they spell; broken characters become U+FFFD.

    Ids the vocabulary lacks spell nothing; NULL ids give the empty text.
    """
    field = DECODED

    def work():
        tool = codec(vocabulary)

        def act(values):
            return ([tool.decode(v) for v in values],)

        return act

    return _from_binary(df, column, field, work)


def _from_binary(df: DataFrame, column: str, field: T.StructField, work) -> DataFrame:
    import pyarrow as pa

    from millrace.llm.common import slices, text_bytes

    kept = [f for f in df.schema.fields if f.name.lower() != field.name]

    def run(batches):
        act = work()
        for batch in slices(batches, column):
            made = act([text_bytes(v) for v in batch.column(column)])[0]
            arrays = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(made, pa.string())], [f.name for f in kept] + [field.name]
            )

    return df.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, T.StructType([*kept, field]))


def digests(coded: DataFrame) -> DataFrame:
    """Digests of the ids and of the decoded text."""
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
