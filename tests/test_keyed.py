from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.sinks import files, writers
from earshot.sinks.keyed import CommitConflict, KeyedTable


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), ["k"], file_rows=100)


def numbered(spark, first, last, value):
    return spark.range(first, last).select(F.col("id").alias("k"), F.lit(value).alias("v"))


def test_first_commit_and_upserts(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read(0)
    assert table.upsert(numbered(spark, 0, 1000, "a")) == 1
    assert table.upsert(numbered(spark, 950, 1050, "b")) == 2
    assert rows(table.read().groupBy("v").count()) == [("a", 950), ("b", 100)]
    assert rows(table.read(1).groupBy("v").count()) == [("a", 1000)]
    assert table.replace(numbered(spark, 0, 3, "c")) == 3 and table.read().count() == 3


def test_only_files_in_range_are_rewritten(spark, table):
    table.upsert(numbered(spark, 0, 1000, "a"))
    before = {r["file"]: r for r in table.manifest(1).collect()}
    assert len(before) >= 10 and sum(r["n_rows"] for r in before.values()) == 1000
    table.upsert(numbered(spark, 205, 207, "b"))
    after = {r["file"] for r in table.manifest(2).collect()}
    replaced = set(before) - after
    assert replaced == {f for f, r in before.items() if r["low"] <= 206 and r["high"] >= 205}
    assert len(replaced) <= 2 and table.read().count() == 1000
    # New keys far from all others rewrite nothing.
    table.upsert(numbered(spark, 5000, 5010, "c"))
    assert after <= {r["file"] for r in table.manifest(3).collect()}
    assert table.read().count() == 1010


def test_update_columns_and_several_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["name", "n"], file_rows=5)
    old = spark.createDataFrame([(c, i, "old", 1) for c in "abcd" for i in range(6)], "name string, n int, v string, w int")
    table.upsert(old)
    news = spark.createDataFrame([("b", 2, "new", 9), ("z", 1, "new", 9)], old.schema)
    table.upsert(news, ["v"])
    found = {(r["name"], r["n"]): (r["v"], r["w"]) for r in table.read().collect()}
    assert len(found) == 25 and found["b", 2] == ("new", 1) and found["z", 1][0] == "new"
    assert sum(v == ("old", 1) for v in found.values()) == 23


def test_of_two_writers_one_tries_again(spark, table, monkeypatch):
    table.upsert(numbered(spark, 0, 100, "a"))
    other = KeyedTable(spark, table.path, ["k"])
    commit, calls = table.commit, []

    def overtaken(manifest, base):
        calls.append(base)
        if len(calls) == 1:
            other.upsert(numbered(spark, 0, 50, "other"))
        return commit(manifest, base)

    monkeypatch.setattr(table, "commit", overtaken)
    assert table.upsert(numbered(spark, 40, 60, "mine")) == 3
    assert calls == [1, 2]
    assert rows(table.read().groupBy("v").count()) == [("a", 40), ("mine", 20), ("other", 40)]


def test_a_writer_that_may_not_try_again_fails(spark, table, monkeypatch):
    table.upsert(numbered(spark, 0, 10, "a"))
    manifest = table._manifest_name(1)
    assert files.create_new(spark, f"{table.path}/versions/{2:010d}", manifest)
    assert not files.create_new(spark, f"{table.path}/versions/{2:010d}", "other")
    with pytest.raises(CommitConflict):
        table.commit("other", 1)
    monkeypatch.setattr(table, "version", lambda: 1)
    with pytest.raises(CommitConflict):
        table.upsert(numbered(spark, 0, 10, "b"), tries=2)


def test_a_job_broken_off_before_the_commit_leaves_the_old_version(spark, table, monkeypatch):
    table.upsert(numbered(spark, 0, 100, "a"))
    with monkeypatch.context() as patch:
        patch.setattr(table, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            table.upsert(numbered(spark, 0, 100, "b"))
    assert table.version() == 1 and rows(table.read().select("v").distinct()) == [("a",)]
    assert len(files.names(spark, f"{table.path}/data")) == 2
    table.expire(1)
    assert len(files.names(spark, f"{table.path}/data")) == 2  # might still be written
    table.expire(1, orphan_hours=0)
    assert len(files.names(spark, f"{table.path}/data")) == 1 and table.read().count() == 100


def test_old_versions_are_removed_with_what_only_they_use(spark, table):
    table.upsert(numbered(spark, 0, 1000, "a"))
    for k in range(3):
        table.upsert(numbered(spark, 100 * k, 100 * k + 5, str(k)))
    table.expire(2, orphan_hours=0)
    assert table.versions() == [3, 4]
    assert table.read(3).count() == table.read().count() == 1000
    stored = set()
    for folder in files.names(spark, f"{table.path}/data"):
        stored |= {f"data/{folder}/{n}" for n in files.names(spark, f"{table.path}/data/{folder}") if n.startswith("part-")}
    assert stored == {r["file"] for n in (3, 4) for r in table.manifest(n).collect()}


def test_inserts_read_and_rewrite_nothing_else(spark, table):
    twice = numbered(spark, 0, 500, "a").union(numbered(spark, 0, 500, "b"))
    assert table.insert_new(twice, F.col("v")) == 1
    before = {r["file"] for r in table.manifest(1).collect()}
    table.insert_new(numbered(spark, 480, 520, "c").union(numbered(spark, 510, 520, "d")), F.col("v"))
    after = {r["file"] for r in table.manifest(2).collect()}
    assert before < after
    assert rows(table.read().groupBy("v").count()) == [("a", 500), ("c", 20)]
    table.insert_new(numbered(spark, 0, 520, "e"))
    assert table.read().count() == 520


def test_empty_updates_null_keys_and_an_emptied_table(spark, table):
    table.upsert(numbered(spark, 0, 10, "a"))
    table.upsert(numbered(spark, 0, 0, "b"))
    assert table.read().count() == 10
    table.upsert(spark.createDataFrame([(None, "n")], "k long, v string"))
    table.upsert(spark.createDataFrame([(None, "n"), (3, "x")], "k long, v string"))
    assert rows(table.read().groupBy("v").count()) == [("a", 9), ("n", 2), ("x", 1)]
    table.replace(numbered(spark, 0, 0, "b"))
    assert table.read().count() == 0 and table.read().columns == ["k", "v"]
    table.upsert(numbered(spark, 0, 2, "c"))
    assert table.read().count() == 2


def test_staged_days_are_loaded_together(spark, tmp_path):
    base = str(tmp_path)
    staged = spark.range(6).select("id", F.expr("DATE '2024-01-01' + CAST(id % 3 AS INT)").alias("date"))
    writers.write_partitioned(staged, f"{base}/staged", ["date"])
    for _ in range(2):
        writers.load_staged_days(f"{base}/staged", f"{base}/final")
    loaded = spark.read.parquet(f"{base}/final")
    assert loaded.count() == 6 and loaded.where("process_date <> date").count() == 0
    assert not [n for n in files.names(spark, f"{base}/staged") if n.startswith("date=")]
