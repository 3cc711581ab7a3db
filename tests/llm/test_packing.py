from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from earshot.llm import packing
from earshot.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(vocabulary_path())


def encoded(encoder, texts):
    out = []
    for _, ids, at in encoder.encode(pa.array(texts, pa.string()), 1):
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]
    return out


def test_ids_are_those_of_the_tokeniser(encoder):
    draw = random.Random(3)
    texts = ["".join(draw.choices("ab  \n\t ,.'1é\xa0²ßsあ\x85\x1c😀", k=draw.randint(0, 14))) for _ in range(3000)]
    texts += [None, "", " ", " <|endoftext|> x", "they'll it's", "word " * 3000, "x" * 50_000]
    assert encoded(encoder, texts) == [encoder.whole(t or "").tolist() + [1] for t in texts]


def test_special_strings_are_the_ids_that_the_library_gives(encoder):
    library = Tokenizer.from_file(vocabulary_path())
    texts = ["<|endoftext|>", "a b <|endoftext|> c<|endoftext|>", "<|endof", "text|> x", "a <|endoftext |>", "b c"]
    expected = [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert encoded(encoder, texts) == expected
    assert [50256 in ids for ids in expected] == [True, True, False, False, False, False]


def test_ids_of_an_empty_column(encoder):
    assert encoded(encoder, []) == []


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 5000, 4096])
def test_lengths_are_binary(n):
    found = packing.lengths(n)
    assert sum(found) == n and all(x & (x - 1) == 0 and x <= 2048 for x in found)
    assert found == sorted(found, reverse=True)


def test_each_id_lies_in_exactly_one_piece(spark, encoder):
    texts = ["a word or two " * k for k in (1, 7, 300, 2000)] + [None, ""]
    docs = documents(spark, texts)
    rows = packing.pack_documents(docs.union(docs.where("doc_id = 0")), vocabulary_path()).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert all(r["offset"] == 0 and r["length"] == 1 << r["bucket"] for r in rows)
    for doc, text in enumerate(texts):
        ids = np.append(encoder.whole(text or ""), 1).astype("<u4").tobytes()
        pieces = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: (r["start"], r["sequence_id"]))
        times = 2 if doc == 0 else 1
        assert b"".join(bytes(p["ids"]) for p in pieces[::times]) == ids
        assert {p["doc_tokens"] for p in pieces} == {len(ids) // 4}


def test_buckets_hold_sequences_of_one_length(spark, tmp_path):
    docs = documents(spark, ["a word or two " * k for k in (1, 7, 300, 2000)])
    packing.write_buckets(packing.pack_documents(docs, vocabulary_path()), str(tmp_path / "b"))
    whole = spark.read.parquet(str(tmp_path / "b"))
    assert whole.where("length <> shiftleft(1, bucket)").count() == 0 and whole.count() > 10


def test_digest_and_empty_table(spark):
    docs = documents(spark, ["some text"]).withColumn("length", F.lit("x"))
    packed = packing.pack_documents(docs, vocabulary_path())
    for piece, row in zip(packed.collect(), packing.digest(packed).collect(), strict=True):
        assert row["ids_crc32"] == zlib.crc32(bytes(piece["ids"]))
    assert packing.pack_documents(documents(spark, []), vocabulary_path()).count() == 0
