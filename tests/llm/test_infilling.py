from __future__ import annotations

import hashlib
import random

import pytest
from helpers import documents
from pyspark.sql import functions as F

from earshot.llm import infilling


def plainly(doc_id, text, seed=1, cut=90, spm=20):
    """The transformation by slices: form, cuts and output."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in infilling.SENTINELS) or h3 % 100 >= cut:
        return "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_rotation_exchanges_blocks(monkeypatch):
    draw = random.Random(2)
    monkeypatch.setattr(infilling, "BLOCK", 7)
    for _ in range(500):
        raw = bytes(draw.randrange(256) for _ in range(draw.randint(0, 60)))
        a, b, c = sorted(draw.randint(0, len(raw)) for _ in range(3))
        buffer = bytearray(raw)
        infilling.rotate(buffer, a, b, c)
        assert buffer == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


def test_offsets_are_those_of_code_points(monkeypatch):
    draw = random.Random(4)
    for block in (3, 8, 1 << 16):
        monkeypatch.setattr(infilling, "BLOCK", block)
        for _ in range(200):
            text = "".join(draw.choices("aéあ😀", k=draw.randint(0, 20)))
            counts = sorted(draw.randint(0, len(text)) for _ in range(2))
            found = infilling.byte_offsets(text.encode(), *counts)
            assert found == [len(text[:k].encode()) for k in counts]


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_texts_come_back_exactly(form):
    draw = random.Random(6)
    for _ in range(500):
        # Parts of sentinels may end up beside sentinels.
        text = "".join(draw.choices(["<", ">", "P", "S", "M", "é", "<S", "M>", "<P", "😀"], k=draw.randint(1, 12)))
        if any(mark in text for mark in infilling.SENTINELS):
            continue
        a, b = sorted(draw.randint(0, len(text)) for _ in range(2))
        out = infilling.interleave(text.encode(), form, a, b)
        p, m, s = text[:a], text[a:b], text[b:]
        assert out.decode() == (f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}")
        assert infilling.restore(out, form).decode() == text


def test_sentinels_that_may_overlap_are_refused():
    for marks in (("<<", "<S>", "<M>"), ("<P", "P>", "<M>"), ("<P>", "<P>x", "<M>")):
        with pytest.raises(ValueError, match="sentinel"):
            infilling.check_sentinels(marks)
    infilling.check_sentinels(("<fim_prefix>", "<fim_suffix>", "<fim_middle>"))


def test_documents_of_all_kinds(spark):
    draw = random.Random(8)
    texts = [None, "", "a", "has <P> mark", "has <M>", "é😀" * 300_000]
    texts += ["".join(draw.choices("ab é<>PSM\n😀", k=draw.randint(1, 60))) for _ in range(200)]
    docs = documents(spark, texts).withColumn("form", F.lit("x")).withColumn("N", F.lit(0))
    rows = {r["doc_id"]: r for r in infilling.restored(infilling.transform(docs)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        form, prefix, middle, output = plainly(i, text or "")
        row = rows[i]
        assert (row["n"], row["form"]) == (len(text or ""), form)
        assert (row["prefix_chars"], row["middle_chars"]) == (prefix, middle)
        assert row["output"] == output and row["restored"] == (text or "")
    assert {r["form"] for r in rows.values()} == {"plain", "psm", "spm"}


def test_parameters_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("x", "some text"), (None, "some text"), ("x", "some text")], "k string, t string")
    marks = ("<pre>", "<suf>", "<mid>")
    out = infilling.transform(docs, seed=7, cut_percent=100, spm_percent=100, sentinels=marks, doc_id="k", text="t")
    rows = infilling.restored(out, marks).collect()
    assert len(rows) == 3 and {r["form"] for r in rows} == {"spm"} and {r["restored"] for r in rows} == {"some text"}
    assert rows[0]["output"].startswith("<suf>") and len({r["output"] for r in rows}) == 2
    none = infilling.digest(infilling.restored(infilling.transform(documents(spark, []))))
    assert none.count() == 0 and len(none.columns) == 7
