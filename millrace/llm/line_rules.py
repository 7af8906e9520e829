"""Quality rules, line first: lines that break a rule go, then documents that lose too much.

Lines are split at line feeds; lines without a word are neither tested nor lost. A
line fails by

* punctuation: it is shorter than ``SENTENCE`` words and has no end mark, or it has
  more than one sign (``SIGNS``) for two words;
* navigation: at least two of its words, and a fifth of them, are separators;
* boilerplate: it has one of ``PHRASES``, or equals an earlier line of the text.

The cleaned text is the lines that are left, as they were. A document is rejected when
it fails a base rule (fewer than ``LEAST_WORDS`` words, or over half of its words in
windows of ``WINDOW`` words that occur again), or when failed lines hold more than
``MOST_LOST`` percent of its characters in words.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. NULL counts as empty; empty texts fail. Repeated rows are judged each;
an empty table gives an empty result; columns that carry an added name are replaced.
A text is measured as a whole, in memory in proportion to its length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import appended

LEAST_WORDS = 50
WINDOW = 3
MOST_REPEATED = 50  # percent of the words
MOST_LOST = 50  # percent of the characters in words
SENTENCE = 10

# Marks, separators and phrases the line rules look for.
SYMBOLS = b"#*$%&|<>"
SIGNS = b"#*$%&|<>!"
ENDS = (".", "!", "?", ":", ";", "\"", "'", ")", "…", "”", "’", "»", "。", "！", "？")
SEPARATORS = ("|", ">", "»", "›", "•", "·", "::", "/", "<", "«", "→")
PHRASES = (
    "all rights reserved",
    "back to top",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "sign in",
    "sign up",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "uses cookies",
)

_SPACES = b"\t\n\x0b\x0c\r "
_LATER_BYTES = bytes(range(0x80, 0xC0))  # of a character of several bytes
_ENDS = tuple(e.encode() for e in ENDS)
_SEPARATORS = frozenset(s.encode() for s in SEPARATORS)
_PHRASES = tuple(p.encode() for p in PHRASES)


def characters(text: bytes) -> int:
    """Characters in words."""
    return len(text.translate(None, _SPACES + _LATER_BYTES))


def _count(text: bytes, among: bytes) -> int:
    return len(text) - len(text.translate(None, among))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window which occurs twice or more."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    runs = ids
    for size in range(2, window + 1):
        runs = runs[:-1] * len(number) + ids[size - 1 :]
        # Numbers below the count of windows, so that the next product stays small.
        _, runs, counts = np.unique(runs, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[runs] > 1)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    covered[again] += 1
    covered[again + window] -= 1
    return int(np.count_nonzero(np.cumsum(covered)))


def broken_rule(line: bytes, seen: set[bytes]) -> str | None:
    """The rule that a line with a word breaks; ``seen`` holds the lines before it."""
    words = line.split()
    signs = _count(line, SIGNS)
    if (len(words) < SENTENCE and not words[-1].endswith(_ENDS)) or 2 * signs > len(words):
        return "punctuation"
    separators = sum(w in _SEPARATORS for w in words) if signs or not line.isascii() or b"/" in line or b"::" in line else 0
    if separators >= 2 and 5 * separators >= len(words):
        return "navigation"
    if line in seen:
        return "boilerplate"
    lower = line.lower()
    return "boilerplate" if any(p in lower for p in _PHRASES) else None


def measure(text: bytes) -> tuple:
    """Base counts, the verdict, lines, failed lines, characters lost, and the cleaned text."""
    words = text.split()
    n_words, chars = len(words), characters(text)
    repeats = repeated_words(words)
    seen: set[bytes] = set()
    left, lines, failed, doubled, lost = [], 0, 0, 0, 0
    for line in text.split(b"\n"):
        if not line.strip():
            left.append(line)
            continue
        lines += 1
        doubled += line in seen
        if broken_rule(line, seen):
            failed += 1
            lost += characters(line)
        else:
            left.append(line)
        seen.add(line)
    base_failed = n_words < LEAST_WORDS or 100 * repeats > MOST_REPEATED * n_words
    kept = not base_failed and 100 * lost <= MOST_LOST * chars
    symbols = _count(text, SYMBOLS)
    return n_words, chars, symbols, doubled, repeats, base_failed, kept, lines, failed, lost, b"\n".join(left)


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_failed_lines long, lost_chars long"
)


def judged(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its measures and verdict, and ``clean_text`` in place of the text."""
    added = T.StructType.fromDDL(MEASURES + ", clean_text string").fields

    def act(texts):
        made = [measure(t) for t in texts]
        columns = [list(c) for c in zip(*made, strict=True)] if made else [[] for _ in added]
        columns[-1] = [t.decode("utf-8", "replace") for t in columns[-1]]
        return columns

    return appended(df, text, added, lambda: act, without=[text])


def verdicts(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, the measures and the verdict; the cleaned texts stay in the tasks."""
    added = T.StructType.fromDDL(MEASURES).fields

    def act(texts):
        made = [measure(t)[:-1] for t in texts]
        return [list(c) for c in zip(*made, strict=True)] if made else [[] for _ in added]

    rows = df.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text")
    return appended(rows, "text", added, lambda: act, without=["text"])


def cleaned(df: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their columns and the cleaned text."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    found = judged(df.select(F.col(f"`{text}`").alias("text"), row)).where("kept")
    return found.select(
        *[(F.col("clean_text") if c.lower() == text.lower() else F.col(f"row.`{c}`")).alias(c) for c in df.columns]
    )
