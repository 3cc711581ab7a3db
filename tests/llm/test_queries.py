"""Registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL
from helpers import DOC_SCHEMA, components, shingles, similar_pairs
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from earshot.llm import classifier, packing, secrets
from earshot.llm.common import table
from earshot.llm.oracle import oracle_sql
from earshot.llm.queries import MIX_WEIGHTS, automata, queries
from tools.compare import TABLES, normalised


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_all_are_registered():
    found = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in found) == 1 for k in range(1, 14))
    assert "pipeline" in found and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    mine = queries()[name](spark, SMALL).toPandas()
    theirs = duck.execute(oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert normalised(mine) == normalised(theirs)


@pytest.mark.parametrize("name", [n for n in queries() if n not in oracle_sql()])
def test_query_has_whole_results(spark, name):
    source = "pages" if name.startswith("op6") else "documents"
    key = "page_id" if source == "pages" else "doc_id"
    rows = queries()[name](spark, SMALL)
    assert rows.select(key).distinct().count() == table(spark, SMALL, source).count()


def test_pipeline_stages(spark):
    docs = table(spark, SMALL, "documents")
    whole = {r["doc_id"]: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"

    good = stages["quality classifier"](spark, docs, SMALL)
    assert good.columns == docs.columns
    kept = {r["doc_id"]: r for r in good.collect()}
    model = classifier.fit(docs, table(spark, SMALL, "labels"))
    scores = {r["doc_id"]: r["score"] for r in classifier.score_documents(docs, model).collect()}
    assert set(kept) == {i for i, s in scores.items() if s >= classifier.GOOD}
    assert all(kept[i] == whole[i] for i in kept) and 0 < len(kept) < len(whole)

    single = stages["n-gram Jaccard join"](spark, good, SMALL)
    sets = {i: shingles(r["text"]) for i, r in kept.items()}
    roots = components(sets, similar_pairs(sets))
    rows = {r["doc_id"]: r for r in single.collect()}
    assert set(rows) == set(roots.values()) and len(rows) < len(kept)

    planted = (10**6, 'my token = "0123456789abcdef0123456789abcdef01234567" here', "en", "src0", 58)
    single = single.unionByName(spark.createDataFrame([planted], DOC_SCHEMA))
    rows = {r["doc_id"]: r for r in single.collect()}
    clean = stages["secret scans"](spark, single, SMALL)
    known = automata()
    for row in clean.collect():
        spans = secrets.scan_text(rows[row["doc_id"]]["text"], known)[1]
        text = rows[row["doc_id"]]["text"]
        assert row["text"] == (secrets.redact(text, spans) if spans else text)
        assert not spans or row["n_chars"] == len(row["text"])
    assert clean.count() == len(rows)
    assert clean.where("doc_id = 1000000").first()["text"] == 'my [SECRET]" here'

    mixed = stages["mixing sources to target weights"](spark, clean, SMALL)
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.select("doc_id").collect()} <= set(rows)
    assert abs(mixed.count() - len(rows)) < 5 * len(rows) ** 0.5
    assert {r["source"] for r in mixed.select("source").distinct().collect()} <= set(MIX_WEIGHTS)

    packed = stages["packing"](spark, mixed, SMALL)
    total = packed.agg(F.sum("length")).first()[0]
    encoder = packing.encoder(corpus_pipeline.vocabulary_path())
    assert total == sum(len(encoder.whole(r["text"])) + 1 for r in mixed.collect())


def test_pipeline_runs_through(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 100 and "ids_crc32" in rows.columns


def test_stages_take_empty_tables_and_further_columns(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA).withColumn("score", F.lit(1)).withColumn("id", F.lit(2))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs
