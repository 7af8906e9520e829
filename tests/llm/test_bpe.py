"""Encoding against the library, whole and in pieces."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "é", "漢", "😀", " ", "  ", "\n", "\t", "'", "'s", "'re", "12", "!", "...", "<|endoftext|>", "\x1c", " ", "The"]


def library(text):
    ids = bpe.codec(PATH).tokenizer.encode(text, add_special_tokens=False).ids
    return np.asarray(ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=120), st.integers(1, 40))
def test_tree_and_pieces_equal_the_library(parts, size):
    text, codec = "".join(parts), bpe.codec(PATH)
    assert codec.encode(text) == library(text)
    assert codec.join_all([codec.encode(t) for t in bpe.leaves(text, size)]) == library(text)


@pytest.mark.parametrize(
    "text",
    ["x" * 9000, " " * 5000 + "y", "abcdefghij" * 900, "漢字" * 3000, "ab<|endoftext|>" * 400, "'" * 3000 + "s"],
)
def test_unsplit_runs(text):
    codec = bpe.codec(PATH)
    assert codec.join_all([codec.encode(t) for t in bpe.leaves(text, 200)]) == library(text)


def test_round_trip_of_a_table(spark):
    texts = [
        (1, "Hello  world's <|endoftext|> end", "x"),
        (2, None, None),
        (3, "", "x"),
        (4, "unsplit" * 700, "x"),
        (4, "unsplit" * 700, "x"),
        (None, "word and 漢字 " * 300, "x"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string, ids string").repartition(2)
    coded = bpe.decode(bpe.encode(docs, PATH, leaf_chars=500), PATH)
    at_once = bpe.round_trip(docs, PATH, leaf_chars=500)
    assert sorted(map(repr, bpe.digests(at_once).collect())) == sorted(map(repr, bpe.digests(coded).collect()))
    found = sorted((tuple(r) for r in bpe.digests(coded).collect()), key=repr)
    wanted = [
        (
            i,
            len(library(t or "")) // 4,
            hashlib.sha256(library(t or "")).hexdigest(),
            hashlib.sha256((t or "").encode()).hexdigest(),
        )
        for i, t, _ in texts
    ]
    assert found == sorted(wanted, key=repr)


def test_empty_table_and_unknown_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(docs, PATH).count() == 0
    ids = np.array([15496, 4_000_000_000], "<u4").tobytes()
    frame = spark.createDataFrame([(1, bytearray(ids)), (2, None)], "doc_id long, ids binary")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(frame, PATH).collect()}
    assert found == {1: "Hello", 2: ""}
