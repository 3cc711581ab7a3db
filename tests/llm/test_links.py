"""Connected components, the n-gram join and embedding links against plain versions."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest
from helpers import components, documents, shingles, similar_pairs
from pyspark.sql import functions as F

from earshot.llm import embedding_links, ngram_join
from earshot.llm.components import connected_components
from earshot.session import SHUFFLE_CLEANUP


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_connected_components(spark, shape):
    draw = random.Random(5)
    links = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(100, i) for i in range(50)],
        "random": [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(170)],
        "none": [],
    }[shape]
    table = spark.createDataFrame(links + [(7, 7), (None, 3)], "a long, b long")
    got = {r["id"]: r["component_id"] for r in connected_components(table).collect()}
    ids = {x for link in links for x in link if link[0] != link[1]}
    assert got == components(ids, links)


def near_copies(draw, base, n, changes):
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randint(0, changes)):
            copy[draw.randrange(len(copy))] = f"x{draw.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    passage = prose(60)
    texts = [None, "", "  \n", "one two", "One TWO", "one two three four five", "É a b c d", "é a b c d"]
    for length, changes in ((40, 2), (80, 4), (200, 9), (25, 1), (120, 8)):
        texts += near_copies(draw, prose(length), 25, changes)
    texts += [" ".join(prose(draw.randint(5, 90)) + passage) for _ in range(60)]
    texts += [" ".join(passage[: draw.randint(30, 60)]) for _ in range(25)]
    texts += [" ".join(prose(30))] * 40
    texts += [" ".join(prose(4000))]
    return texts


@pytest.mark.parametrize(("seed", "least"), [(1, 64), (2, 5)])
def test_ngram_join_equals_all_pairs(spark, monkeypatch, seed, least):
    monkeypatch.setattr(ngram_join, "LEAST_COMMON", least)
    texts = corpus(seed)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    expected = components(range(len(texts)), similar_pairs(sets))
    rows = ngram_join.near_duplicates(documents(spark, texts).repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(s) for i, s in sets.items()}
    assert len(rows) == len(texts)


def test_threshold_is_exact(spark):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base)]
    for cut in range(1, 40):
        texts.append(" ".join(base[cut:]))
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    expected = components(range(len(texts)), similar_pairs(sets))
    pair = [documents(spark, [texts[0], texts[k]]) for k in (19, 20)]
    linked = [len({r["component_id"] for r in ngram_join.near_duplicates(p).collect()}) == 1 for p in pair]
    assert linked == [bool(similar_pairs({0: sets[0], k: sets[k]})) for k in (19, 20)]
    got = ngram_join.near_duplicates(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected


def test_ngram_join_of_awkward_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (None, text), (3, text), (3, text), (5, text), (3, "other words all along the way"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit(1))
    got = sorted(
        ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()),
        key=repr,
    )
    assert got == sorted(
        [(None, 4, None), (None, 4, None), (3, 4, 3), (3, 4, 3), (5, 4, 3), (3, 2, 3), (6, 0, 6)], key=repr
    )
    kept = ngram_join.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 3, 6]
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def shuffles_on_disk(spark):
    """Numbers of the shuffles that have files in the session's local folders."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {int(n) for n in re.findall(r"shuffle_(\d+)_", manager.getAllFiles().mkString("\n"))}


def test_ngram_join_leaves_no_shuffle_files(spark):
    keys = "spark.sql.execution.arrow.maxRecordsPerBatch", SHUFFLE_CLEANUP
    settings = [spark.conf.get(key, None) for key in keys]
    docs = documents(spark, corpus(3)).repartition(3)
    before = shuffles_on_disk(spark)
    found = ngram_join.near_duplicates(docs)
    until = time.time() + 20
    while (left := shuffles_on_disk(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert [spark.conf.get(key, None) for key in keys] == settings
    # A result that is read twice is the same both times, though its files went in between.
    assert sorted(found.collect()) == sorted(found.collect())


def test_packed_numbers_come_back():
    values = np.sort(np.random.default_rng(0).integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2))
    assert (ngram_join.unpack_sorted(ngram_join.pack_sorted(values)) == values).all()
    small = np.arange(7, dtype=np.uint32)
    assert (ngram_join.unpack_plain(ngram_join.pack_plain(small), np.uint32, 7) == small).all()


def vectors(seed, n, dims=16):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(n // 4, dims))
    out = [base]
    for noise in (0.1, 0.25, 0.5):
        out.append(base + noise * draw.normal(size=base.shape) * np.linalg.norm(base, axis=1, keepdims=True) / dims**0.5)
    crowd = draw.normal(size=dims)
    out.append(crowd + 0.05 * draw.normal(size=(n // 4, dims)))
    return np.vstack(out).astype(np.float32)


@pytest.mark.parametrize("block", [2000, 40])
def test_embedding_links_against_all_pairs(spark, block):
    found = vectors(3, 400)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(found)]
    rows += [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [float("nan")] * 16, 0), (1003, rows[0][1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {
        r["vec_id"]: r
        for r in embedding_links.link_vectors(table, leaf_rows=60, block=block).collect()
    }
    exact = np.vstack([found, found[:1]]).astype(np.float64)
    ids = [*range(len(found)), 1003]
    norms = np.linalg.norm(exact, axis=1)
    close = exact @ exact.T / norms[:, None] / norms >= 0.9
    np.fill_diagonal(close, False)
    degree = close.sum(1)
    links = np.array([got[i]["n_links"] for i in ids])
    assert (links <= degree).all() and links.sum() >= 0.97 * degree.sum()
    if links.sum() == degree.sum():
        pairs = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(close), strict=True)]
        assert {i: got[i]["component_id"] for i in ids} == components(ids, pairs)
    for i in (1000, 1001, 1002):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_embeddings_without_vectors(spark):
    table = spark.createDataFrame([(1, None), (None, [None, 1.0]), (2, [])], "vec_id long, embedding array<double>")
    got = embedding_links.link_vectors(table)
    assert sorted((r["vec_id"] or 0, r["n_links"], r["kept"]) for r in got.collect()) == [
        (0, 0, True),
        (1, 0, True),
        (2, 0, True),
    ]
    assert embedding_links.link_vectors(table.limit(0)).count() == 0
    copies = spark.createDataFrame([(4, [1.0, 0.0])] * 3 + [(9, [2.0, 0.0])], "vec_id long, embedding array<double>")
    rows = embedding_links.link_vectors(copies).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in rows} == {(4, 3, 4), (9, 3, 4)}


@pytest.mark.parametrize("nearest", [None, 2])
def test_pairs_that_meet_in_lists_are_counted_whole(spark, monkeypatch, nearest):
    """Blocks and parts of any size count the same pairs as a plain loop over the lists."""
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(ngram_join, "PAIRS_AT_ONCE", 7)
    draw = random.Random(12)
    members = [(i, i % 2, draw.choice([18, 20, 22, 40]), draw.choice([0, 0, 0, 5, 6])) for i in range(40)]
    rows = [
        (shingle, size, draw.randint(1, 5), i, mark, label)
        for shingle in range(30)
        for i, mark, size, label in draw.sample(members, draw.randint(2, 25))
    ]
    lists = spark.createDataFrame(rows, "shingle long, size int, place int, id long, mark long, label long")
    labelled = lists.select("id", "mark", "size", "label").distinct()
    expected = {}
    for shingle, size, place, i, mark, label in rows:
        for other, size2, place2, j, mark2, label2 in rows:
            if other != shingle or label >= label2 or not 0.8 <= size / size2 <= 1.25:
                continue
            reach = min(size - place, size2 - place2) + 1
            key = (i, mark, size, j, mark2, size2)
            shared, first = expected.get(key, (0, False))
            need = ngram_join.least_overlap(size, size2)
            expected[key] = (shared + 1, first or reach >= need)

    def judge(shared, first, x_size, y_size):
        return first & (shared > 1)

    found = ngram_join._met(lists, labelled, judge, nearest).collect()
    got = {tuple(r)[:6]: r["shared"] for r in found}
    assert len(got) == len(found)
    whole = {k: n for k, (n, first) in expected.items() if first and n > 1}
    if nearest is None:
        assert got == whole and len(whole) > 50
    else:
        assert got.items() <= whole.items() and len(got) < len(whole)
        # Each member keeps the pair that shares most.
        for side in (0, 3):
            for key in {k[side] for k in whole}:
                best = max(n for k, n in whole.items() if k[side] == key)
                assert best in [n for k, n in got.items() if k[side] == key]
