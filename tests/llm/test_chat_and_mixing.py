from __future__ import annotations

import hashlib
import math

import pytest
from helpers import documents
from pyspark.sql import functions as F

from earshot.llm import chat_format, mixing

SCHEMA = "conv_id long, turn long, role string, text string"
TURNS = [
    (1, 0, "user", "hi"),
    (1, 2, "assistant", "second"),
    (1, 1, "assistant", "first"),
    (1, 3, "user", None),
    (2, 0, "assistant", "\\### Assistant: </turn> ok"),
    (2, 1, "us>er<end>\n", "<and>\\s\\l<end>\n<role:user>"),
    (3, None, None, "no turn"),
    (3, 0, "user", ""),
    (3, 0, "user", ""),
    (None, 0, "assistant", "lost"),
    (4, 0, "assistant", "x" * 100_000),
]


def plain(turns):
    key = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    turns = [(t[2] or "", t[3] or "") for t in sorted(turns, key=key)]
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(said), len(loss), sha(loss)


def test_formatted_conversations_read_back(spark):
    turns = spark.createDataFrame(TURNS, SCHEMA).withColumn("turns", F.lit(0))
    formatted = chat_format.format_conversations(turns)
    got = {r["conv_id"]: r for r in chat_format.digest(formatted).collect()}
    assert set(got) == {t[0] for t in TURNS}
    for conv, row in got.items():
        expected = plain([t for t in TURNS if t[0] == conv])
        assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"]) == expected
    text = formatted.where("conv_id = 1").first()["formatted"]
    assert text == "<role:user>hi<end>\n<role:assistant>first<and>second<end>\n<role:user><end>\n"


def test_many_turns_and_no_turns(spark):
    many = spark.range(3000).select(
        F.lit(5).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), "id").alias("text"),
    )
    row = chat_format.digest(chat_format.format_conversations(many)).first()
    turns = [(5, i, "user" if i % 3 == 0 else "assistant", f"t{i}") for i in range(3000)]
    assert (row["n_turns"], row["turns_sha256"]) == plain(turns)[:2]
    assert chat_format.format_conversations(many.limit(0)).count() == 0


@pytest.mark.parametrize("make", ["chat", "mix"])
def test_main_path_is_native(spark, make):
    if make == "chat":
        df = chat_format.digest(chat_format.format_conversations(spark.createDataFrame(TURNS, SCHEMA)))
    else:
        df = mixing.mix_sources(documents(spark, ["x"] * 9), {"src0": 1.0, "src1": 1.0})
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def plain_copies(doc, mean, seed=42):
    parts = max(1, math.ceil(mean / mixing.LARGEST_MEAN))
    total = 0
    for j in range(parts):
        digest = hashlib.md5(f"{seed}:{doc}:{j}".encode()).hexdigest()
        u = int(digest[:13], 16) / 2**52
        p = c = math.exp(-mean / parts)
        k = 0
        while c <= u and k < mixing.LAST_COUNT:
            k += 1
            p *= mean / parts / k
            c += p
        total += k
    return total


def test_copies_follow_the_inverted_distribution(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.lit("t").alias("text"),
        F.when(F.col("id") % 100 == 0, "rare").otherwise("common").alias("source"),
    )
    mixed = mixing.mix_sources(docs, {"rare": 3.0, "common": 1.0})
    got = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    means = {True: 0.75 * 400 / 4, False: 0.25 * 400 / 396}
    expected = {d: plain_copies(d, means[d % 100 == 0]) for d in range(400)}
    assert got == {d: n for d, n in expected.items() if n}
    numbers = mixed.where("doc_id = 0").select("copy_no").orderBy("copy_no").collect()
    assert [r[0] for r in numbers] == list(range(expected[0]))


def test_mixture_meets_its_weights(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("source"),
    )
    mixed = mixing.mix_sources(docs, {"hot": 1.0, "cold": 1.0}, target_rows=12_000)
    counts = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(counts["hot"] - 6000) < 300 and abs(counts["cold"] - 6000) < 500


def test_mixing_of_awkward_rows(spark):
    rows = [(None, None, None, None, None), (1, "a", "en", None, 1), (1, "a", "en", "s", 1), (1, "a", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("draws", F.lit(1)).withColumn("copy_no", F.lit("old"))
    mixed = mixing.mix_sources(docs, {"s": 1.0}, other_weight=1.0, target_rows=400)
    counts = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert counts["s"] > 100 and counts[None] > 100
    assert mixing.mix_sources(docs.limit(0), {"s": 1.0}).count() == 0
    assert mixing.mix_sources(docs, {"s": 1.0}).where("source IS NULL").count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {})
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"s": -1.0})
