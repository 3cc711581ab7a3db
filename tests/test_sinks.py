from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot import schemas
from earshot.operators import changes
from earshot.plans import daily, extracts
from earshot.session import scratch_path, shared_dir
from earshot.sinks import writers
from earshot.sources import readers

D = dt.date


def daily_rows(spark, data):
    return spark.createDataFrame(data, "user_id string, date date, n long, created_at string, updated_at string")


def test_partitioned_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(
        daily_rows(spark, [("a", D(2024, 1, 1), 1, "x", "x"), ("a", D(2024, 1, 2), 1, "x", "x")]), path, ["date"]
    )
    writers.write_partitioned(daily_rows(spark, [("b", D(2024, 1, 2), 2, "x", "x")]), path, ["date"])
    assert rows(spark.read.parquet(path), "user_id", "date") == [
        ("a", D(2024, 1, 1)),
        ("b", D(2024, 1, 2)),
    ]


def test_zero_padded_folders(spark, canonical, tmp_path):
    path = str(tmp_path / "t")
    enriched = daily.enrich_history(canonical.plays).drop("year", "month", "day")
    writers.write_partitioned(
        writers.zero_padded_day(enriched, "timestamp"), path, ["year", "month", "day"]
    )
    assert os.path.isdir(f"{path}/year=2024/month=01/day=05")
    assert spark.read.parquet(path).count() == canonical.plays.count()


def test_upsert_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("a", D(2024, 1, 1), 1, "old", "old"), ("a", D(2024, 1, 2), 1, "old", "old"), ("b", D(2024, 1, 2), 5, "old", "old")]
    writers.upsert_partitions(path, daily_rows(spark, first), ["user_id", "date"])
    untouched = os.listdir(f"{path}/date=2024-01-01")
    updates = daily_rows(spark, [("a", D(2024, 1, 2), 9, "new", "new"), ("c", D(2024, 1, 3), 7, "new", "new")])
    writers.upsert_partitions(path, updates, ["user_id", "date"])
    got = rows(spark.read.parquet(path), "user_id", "date", "n", "created_at", "updated_at")
    assert got == [
        ("a", D(2024, 1, 1), 1, "old", "old"),
        ("a", D(2024, 1, 2), 9, "old", "new"),
        ("b", D(2024, 1, 2), 5, "old", "old"),
        ("c", D(2024, 1, 3), 7, "new", "new"),
    ]
    assert os.listdir(f"{path}/date=2024-01-01") == untouched


def test_upsert_table_switches_versions(spark, tmp_path):
    base = str(tmp_path / "users")
    start = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(FileNotFoundError):
        writers.current_version(spark, base)
    writers.upsert_table(spark, base, start, ["k"], view="users_now")
    before = spark.table("users_now")
    changed = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    writers.upsert_table(spark, base, changed, ["k"], view="users_now")
    assert rows(spark.table("users_now")) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(before) == [(1, "a"), (2, "b")]
    # Another session finds the current version without the view.
    assert rows(writers.current_version(spark.newSession(), base)) == [(1, "a"), (2, "c"), (3, "d")]


def test_append_new_twice(spark, tmp_path):
    path = str(tmp_path / "staged")
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "event_id int, v string")
    writers.append_new(path, batch, ["event_id"])
    writers.append_new(path, batch, ["event_id"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b")]


def test_staging_to_final(spark, tmp_path):
    staging, final = str(tmp_path / "staging"), str(tmp_path / "final")
    data = daily_rows(spark, [("a", D(2024, 1, 1), 1, "x", "x"), ("b", D(2024, 1, 2), 2, "x", "x")])
    writers.write_partitioned(data, staging, ["date"])
    for _ in range(2):
        writers.load_staged(staging, final, "2024-01-01")
    assert rows(spark.read.parquet(final), "user_id", "process_date") == [("a", D(2024, 1, 1))]
    assert rows(spark.read.parquet(staging), "user_id") == [("b",)]
    for _ in range(2):
        writers.load_staged(staging, final, "2024-01-02")
    assert rows(spark.read.parquet(final), "user_id") == [("a",), ("b",)]
    left = changes.clear_staged(data, F.lit("2024-01-01").cast("date"))
    assert rows(left, "user_id") == [("b",)]


def test_materialize_buckets_avoid_a_shuffle(spark, canonical, capsys):
    spark.sql("CREATE DATABASE IF NOT EXISTS analytics")
    plays = canonical.plays.withColumn("date", F.to_date("played_at"))
    writers.materialize(plays, "analytics.history", ["date"], ["user_id", "track_id"])
    spark.table("analytics.history").groupBy("user_id", "track_id").count().explain()
    assert "Exchange" not in capsys.readouterr().out
    counts = rows(readers.table_counts(spark, ["analytics", "missing"]))
    assert counts == [("analytics.history", plays.count())]
    assert readers.source(spark, "analytics", "history").count() == plays.count()


def test_logs(spark, canonical):
    staged = extracts.incremental_extract(
        canonical.plays, canonical.plays.select("event_id").limit(0), "2024-01-29"
    )
    etl = writers.etl_log(
        staged, "extract_streaming_history", "streaming_history", "2024-01-29", "2024-01-29 02:05:00"
    ).first()
    assert etl.records_processed == staged.count() > 0
    assert etl.log_message == "Extracted streaming history for 2024-01-28"
    assert etl.start_datetime == dt.datetime(2024, 1, 29, 2, 0)
    run = writers.run_log(
        staged, "daily", "test", "2024-01-29 02:00:00", "2024-01-29 02:10:00", "2024-01-29"
    ).first()
    assert (run.duration_seconds, run.records_processed) == (600, staged.count())


def test_files_keep_malformed_rows(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"id": 1, "v": "a"}\n{oops\n')
    got = readers.read_files(spark, str(tmp_path / "in.json"), "json", "id int, v string")
    assert rows(got) == [(1, "a", None), (None, None, "{oops")]
    (tmp_path / "in.csv").write_text("id,v\n1,a\nx,b\n")
    csv = readers.read_files(spark, str(tmp_path / "in.csv"), "csv", "id int, v string")
    assert rows(csv)[0] == (1, "a", None) and rows(csv)[1][2] == "x,b"
    with pytest.raises(ValueError):
        readers.read_files(spark, str(tmp_path), "json")


def test_sample_dim_and_schema_projection(spark, canonical):
    assert rows(readers.sample_dim(canonical.tracks, ["track_id", "name"], 3), "track_id") == [
        (0,),
        (1,),
        (2,),
    ]
    projected = schemas.project_schema(canonical.tracks, schemas.TRACKS)
    assert projected.schema == schemas.struct_of(schemas.TRACKS)
    assert projected.where("danceability IS NOT NULL").count() == 0
    renamed = schemas.rename(spark.range(1).toDF("song_id"), schemas.SONG_TO_TRACK)
    assert renamed.columns == ["track_id"]


def test_write_json(spark, tmp_path):
    writers.write_json(spark.createDataFrame([(1, "a")], "k int, v string"), str(tmp_path / "j"))
    assert rows(spark.read.schema("k int, v string").json(str(tmp_path / "j"))) == [(1, "a")]


def test_shared_dir_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
