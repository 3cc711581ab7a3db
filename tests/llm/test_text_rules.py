"""Quality rules, licences and text arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, shingles, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.llm import licenses, quality_rules, text_arrays

PROSE = "The cat sat on the mat and looked at a bird that was in the tree for an hour or so, as it is with cats. "


def plain_measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    repeated = {x for x in windows if windows.count(x) > 1}
    covered = {i + k for i, x in enumerate(windows) if x in repeated for k in range(8)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \t\x0b\n\r ",
    "one",
    PROSE,
    PROSE * 3,
    (PROSE + "\n") * 4 + "tail #*$% <b>",
    "a b c d e f g h a b c d e f g h i",
    "é ß 😀 word\x85x\xa0y " * 9,
    "THE!! CAT!! SAT!! " * 10,
    "w " * 5000,
]


def test_measures_equal_a_plain_count(spark):
    got = quality_rules.apply_rules(documents(spark, TEXTS)).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[n] for n in names) for r in got] == [plain_measures(t) for t in TEXTS]
    for row in got:
        base = row["n_words"] < 20 or 100 * row["n_repeat_words"] > 30 * row["n_words"]
        assert row["base_failed"] == base
        assert row["kept"] == (not base and not row["failed_rules"])


def test_prose_is_kept_and_junk_is_not(spark):
    texts = [PROSE, PROSE.upper().replace(" ", "!! "), PROSE.replace(" ", " | "), PROSE.replace(" ", "%%% ")]
    got = quality_rules.apply_rules(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["kept"] for r in got] == [True, False, False, False]


def test_rules_carry_columns_and_take_empty_tables(spark):
    docs = documents(spark, [PROSE]).withColumn("n_words", F.lit("x")).withColumn("_x.y", F.lit(2))
    got = quality_rules.apply_rules(docs)
    assert {"_x.y", "kept"} <= set(got.columns) and got.columns.count("n_words") == 1
    assert got.first()["n_words"] == 26
    assert quality_rules.apply_rules(documents(spark, [])).count() == 0
    twice = quality_rules.apply_rules(docs.union(docs)).drop("text").distinct()
    assert twice.count() == 1


def test_rules_need_no_user_function_and_no_shuffle(spark):
    plan = quality_rules.apply_rules(documents(spark, [PROSE]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


MIT = (
    "Copyright (c) 2024 Somebody\nPermission is hereby granted, free of charge, to any person obtaining a copy of "
    'this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial "
    'portions of the Software.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, ""),
        ("", ""),
        (PROSE, ""),
        ("Some words. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("All rights reserved.\nReleased under the MIT License.", "MIT,All rights reserved"),
        (MIT, "MIT"),
        (PROSE * 2000 + "\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("this is not licensed under the mit license maybe", ""),
        ("Released under the MIT License. Released under the MIT License.", "MIT"),
    ],
)
def test_licences(spark, text, expected):
    row = licenses.scan_licenses(documents(spark, [text])).first()
    assert row["licenses"] == expected
    assert row["n_licenses"] == len([x for x in expected.split(",") if x])


def test_licence_scan_of_an_empty_table_and_of_extra_columns(spark):
    docs = documents(spark, []).withColumn("licenses", F.lit("x")).withColumn("a.b", F.lit(1))
    got = licenses.scan_licenses(docs)
    assert got.count() == 0 and got.columns.count("licenses") == 1 and "a.b" in got.columns


def plain_shingle_counts(texts):
    return [len(shingles(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAb é\n\t1.", max_size=40)), max_size=8))
def test_shingles_of_arrow_buffers(texts):
    counts = np.zeros(len(texts), int)
    for chunk in text_arrays.chunks(pa.array(texts, pa.string()), limit=50):
        first, behind, row = text_arrays.words(chunk)
        data = bytes(chunk.data)
        found = [[] for _ in chunk.starts]
        for f, b, r in zip(first, behind, row, strict=True):
            found[r].append(data[f:b].decode())
        n = len(chunk.starts)
        assert found == [words(t) for t in texts[chunk.first : chunk.first + n]]
        hashes = text_arrays.word_hashes(chunk, first, behind)
        values, rows = text_arrays.shingle_hashes(hashes, row, n, 5)
        for r in range(n):
            counts[chunk.first + r] = len(set(values[rows == r].tolist()))
    assert counts.tolist() == plain_shingle_counts(texts)
