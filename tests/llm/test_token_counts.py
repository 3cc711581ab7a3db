from __future__ import annotations

import random

import pytest
from conftest import SMALL
from helpers import documents
from pyspark.sql import functions as F

from earshot.llm import token_counts
from earshot.llm.common import table
from earshot.llm.queries import COUNTED_VOCABULARY, op11_token_counts, vocabulary_path

PATH = vocabulary_path(COUNTED_VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(PATH, token_counts.prove(PATH))


def by_tokenizer(text):
    return len(token_counts.tokenizer(PATH).encode(text or "", add_special_tokens=False).ids)


def test_proven_strings_are_one_token_and_others_are_not(counter):
    coder = token_counts.tokenizer(PATH)
    proven = set(token_counts.prove(PATH))
    assert len(proven) > 30_000
    whole = {letters: coder.model.tokenize(letters) for letters in proven}
    assert all(len(found) == 1 and found[0].value == letters + "</w>" for letters, found in whole.items())
    left = {t.removesuffix("</w>") for t in coder.get_vocab() if t.endswith("</w>")} - proven - {""}
    assert all(len(coder.model.tokenize(letters)) != 1 for letters in left)


def test_counts_are_those_of_the_tokeniser(counter):
    draw = random.Random(11)
    alphabets = (
        "ab Zé\t\n\x0b\x1c\x1f\x85\xa0²½ªº 's't'RE 1,.‘’“”–… ​ñ İıŉſΣσςßẞÄ̈áあ한글가😀̸<>=|\x00\x7fK",
        "ab Zé\t\n's'T'LL1,’…–ŉſßÄ<|>\x00\x7f\x1c",
        "the house and'd 12 ... of",
    )
    for i in range(6000):
        text = "".join(draw.choices(alphabets[i % 3], k=draw.randint(0, 30)))
        if i % 40 == 0:
            text = text[:5] + "<|endoftext|>" + text[5:] + "<|startoftext|>"
        assert counter.count(text) == by_tokenizer(text), repr(text)


def test_plain_characters_are_cut_alike(counter):
    for code in range(0x2030):
        text = f"a{chr(code)}b{chr(code) * 2}1 {chr(code)}"
        if not token_counts._UNUSUAL.search(text):
            assert counter.count(text) == by_tokenizer(text), code


def test_slabs_do_not_change_counts(counter, monkeypatch):
    text = "Straße 12, l'été's … é " * 200 + "x" * 5000 + " 한글 á" * 300
    whole = counter.count(text)
    assert whole == by_tokenizer(text)
    monkeypatch.setattr(token_counts.slabs, "__defaults__", (7,))
    assert "".join(token_counts.slabs(text)) == text and len(list(token_counts.slabs(text))) > 200
    assert counter.count(text) == whole


def test_memory_of_counts_is_bounded(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    counts = token_counts.PieceCounts({"a": 1}, len)
    assert [counts["b" * (i + 1)] for i in range(64)] == list(range(1, 65))
    assert counts["x" * 100] == 100 and len(counts) <= 52 and counts["a"] == 1


def test_documents_of_all_kinds(spark):
    texts = [None, "", " \n ", "a b c", "a b c", "<|endoftext|>", "Wort " * 2049, "x" * 200_000, "é" * 3]
    docs = documents(spark, texts).withColumn("n_tokens", F.lit("x")).withColumn("N_BYTES", F.lit(0))
    rows = {r["doc_id"]: r for r in token_counts.count_tokens(docs, PATH).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        n = by_tokenizer(text)
        assert rows[i][1:] == (len((text or "").encode()), n, n > 2048)
    assert rows[6]["over_limit"] and not rows[3]["over_limit"]
    empty = token_counts.count_tokens(documents(spark, []), PATH)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    twice = token_counts.count_tokens(docs.union(docs), PATH)
    assert twice.count() == 2 * len(texts) and twice.distinct().count() == len(texts)


def test_query_equals_the_tokeniser_on_all_documents(spark):
    whole = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    rows = op11_token_counts(spark, SMALL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: by_tokenizer(t) for i, t in whole.items()}
