"""Licence notices over several lines, and the words a paragraph must have."""

import itertools
import re

from millrace.llm import licenses
from test_native import FILLER, licence_rows


WRAPPED = {
    500: (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell""",
    ),
    501: (
        "GPL-3.0",
        """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.""",
    ),
    502: (
        "BSD",
        """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:""",
    ),
}


def test_wrapped_notices(spark):
    rows, wanted = licence_rows()
    rows += [(i, f"{FILLER}\n\n{text}\n\n{FILLER}") for i, (_, text) in WRAPPED.items()]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"]: r["licences"] for r in got if r["licences"]}
    assert found == wanted | {i: [family] for i, (family, _) in WRAPPED.items()}
    assert all(sum(f["confirmed"] for f in r["findings"]) == 1 for r in got if r["doc_id"] in (500, 501, 502))


def test_gate_covers_templates_of_common_words():
    pairs = ["released under", "under the", "the mit", "mit license"]
    counts = {"released": 50, "under": 90, "the": 99, "mit": 40, "license": 60}
    assert licenses.gate(counts, 10, [pairs]) == ["mit"]
    assert licenses.gate(counts, 45, [pairs]) == ["mit"]
    assert licenses.gate(dict.fromkeys(counts, 0), 10, [pairs]) == sorted(counts)


def test_notices_behind_long_lines_and_over_many_lines(spark):
    grant = WRAPPED[500][1]
    words = " ".join(f"{FILLER} {n}" for n in range(8))  # over 400 characters
    shapes = {
        600: f"{words} {grant}",  # wrapped, behind other words of its first line
        601: f"{FILLER}\n{words * 4} {grant.replace(chr(10), ' ')} {words}",
        602: grant.replace(" ", "\n"),  # a word a line
        603: f"{grant} {words * 4}",
        604: f"{FILLER}\n" + " ".join([words] * 30) + f" {grant}",
    }
    rows, wanted = licence_rows()
    rows += list(shapes.items())
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"]: r["licences"] for r in got if r["licences"]}
    assert found == wanted | dict.fromkeys(shapes, ["MIT"])
    confirmed = {r["doc_id"]: [f for f in r["findings"] if f["confirmed"]] for r in got}
    assert all(len(confirmed[i]) == 1 for i in (600, 602, 603, 604))


def test_all_paragraphs_are_learned_from(spark, monkeypatch):
    """Also those of more documents than ``SAMPLE``, and the words behind the first 400 of a line."""
    seen = {}
    gate = licenses.gate
    monkeypatch.setattr(licenses, "gate", lambda counts, most, known: seen.update(counts, most=most) or gate(counts, most, known))
    rows = [(i, f"{FILLER} {i}\nanother line {i} of it") for i in range(300)]
    rows += [(i, " ".join([f"word{i}"] * 500) + " sublicense apache") for i in range(300, 310)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = licenses.fit(docs, sample_size=20)
    assert seen["apache"] == 10 and seen["most"] == licenses.RARE * 610
    # Templates weigh as much beside 310 documents as beside 20.
    text = "Released under the MIT License."
    found = licenses.classified(docs.limit(1).selectExpr("doc_id", f"'{text}' AS text"), model)
    assert [r["family"] for r in found.where("NOT wrapped").collect()] == ["MIT"]


def test_words_sharing_beginnings_are_found_alone():
    words = ["apache", "mit", "mpl", "license", "licensed", "licenses", "2.0", "2.1", "cc-by", "cc"]
    every = re.compile(rf"(?<!\w){licenses._trie(words)}(?!\w)")
    parts = ["apache", "mit", "mp", "mpl", "licens", "license", "licensed", "2.0", "2x0", "cc-by", "cc", "c"]
    for text in (f"{a}{sign}{b}" for a, b in itertools.permutations(parts, 2) for sign in (" ", "-", "")):
        plain = re.search(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)", text)
        assert bool(every.search(text)) == bool(plain)
