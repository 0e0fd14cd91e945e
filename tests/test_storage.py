"""Lake, versioned tables, watermarks, text files and the file stream."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import as_rows
from pyspark.sql import functions as F

from tenura.operators import clean, versioned
from tenura.operators.watermarks import BEFORE_START, Watermarks
from tenura.schemas import TABLES
from tenura.sources import csv as csv_source
from tenura.sources import lake
from tenura.streaming import current_stream, ingest_stream

USAGE = TABLES["feature_usage"]
COLUMNS = "usage_id string, subscription_id string, usage_date date, usage_count int"


def _usage(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def test_days_are_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_days(_usage(spark, ("U1", "S", date(2024, 1, 1), 1), ("U2", "S", date(2024, 1, 2), 2)), path, "usage_date")
    lake.write_days(_usage(spark, ("U3", "S", date(2024, 1, 2), 3)), path, "usage_date")
    rows = lake.read_days(spark, path, USAGE.lake_schema, date(2023, 12, 31), date(2024, 1, 2))
    assert {r["usage_id"] for r in rows.collect()} == {"U1", "U3"}
    assert (tmp_path / "lake" / "year=2024" / "month=01" / "day=02").is_dir()
    after = lake.read_days(spark, path, USAGE.lake_schema, date(2024, 1, 1), date(2024, 1, 2))
    assert {r["usage_id"] for r in after.collect()} == {"U3"}
    assert lake.read_days(spark, path, USAGE.lake_schema, date(2024, 2, 1), date(2024, 3, 2)) is None
    assert lake.read_days(spark, path, USAGE.lake_schema, date(2024, 1, 2), date(2024, 1, 2)) is None
    assert lake.read_days(spark, str(tmp_path / "none"), USAGE.lake_schema, date(2024, 1, 1), date(2024, 1, 2)) is None


def test_day_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [(f"U{i}", "S", date(2024, 1, 1 + i), i) for i in range(20)]
    lake.write_days(_usage(spark, *rows), path, "usage_date")
    got = lake.read_days(spark, path, USAGE.lake_schema, date(2024, 1, 5), date(2024, 1, 7))
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [(" in plan
    scanned = got.select(F.input_file_name().alias("f")).distinct().count()
    assert scanned == 2


def test_foreign_folders_are_left_out(spark, tmp_path):
    path = tmp_path / "lake"
    lake.write_days(_usage(spark, ("U1", "S", date(2024, 1, 1), 1)), str(path), "usage_date")
    lake.write_days(_usage(spark, ("U9", "S", date(2024, 1, 1), 1)), str(path / "notes"), "usage_date")
    spark.range(3).write.parquet(str(path / "year=abc" / "month=01" / "day=01"))
    _usage(spark, ("U8", "S", date(2024, 1, 1), 1)).write.parquet(str(path / "year=2024" / "month=02" / "day=31"))
    rows = lake.read_days(spark, str(path), USAGE.lake_schema, date(2023, 12, 31), date(2024, 3, 2))
    assert [r["usage_id"] for r in rows.collect()] == ["U1"]


def test_columns_missing_in_old_days_read_as_null(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_days(_usage(spark, ("U1", "S", date(2024, 1, 1), 1)).drop("usage_count"), path, "usage_date")
    lake.write_days(_usage(spark, ("U2", "S", date(2024, 1, 2), 2)), path, "usage_date")
    rows = lake.read_days(spark, path, USAGE.lake_schema, date(2023, 12, 31), date(2024, 1, 2))
    assert {r["usage_id"]: r["usage_count"] for r in rows.collect()} == {"U1": None, "U2": 2}


def test_watermarks(spark, tmp_path):
    state = Watermarks(spark, str(tmp_path / "wm"))
    assert state.get("ingestion_accounts") == BEFORE_START == date(2023, 12, 31)
    state.set("ingestion_accounts", date(2024, 3, 1))
    state.set("ingestion_accounts", date(2024, 2, 1))
    assert state.get("ingestion_accounts") == date(2024, 3, 1)
    state.reset("ingestion_accounts")
    assert state.get("ingestion_accounts") == BEFORE_START and state.all() == {}
    state.set("ingestion_accounts", date(2024, 1, 5))
    assert state.all() == {"ingestion_accounts": date(2024, 1, 5)}


def test_reset_modes_and_the_first_day(spark, tmp_path):
    rows = _usage(spark, ("U1", "S", date(2024, 1, 1), 1), ("U2", "S", date(2024, 1, 2), 1))
    for mode, kept in (("reference", {"U2"}), ("corrected", {"U1", "U2"})):
        state = Watermarks(spark, str(tmp_path / mode))
        state.set("ingestion_feature_usage", date(2025, 1, 1))
        state.reset_all(mode)
        wm = state.get("ingestion_feature_usage")
        got = clean.newer_than(rows, "usage_date", wm, date(2024, 1, 31))
        assert {r["usage_id"] for r in got.collect()} == kept
    assert len(Watermarks(spark, str(tmp_path / "reference")).all()) == 15


def test_versioned_table(spark, tmp_path):
    table = versioned.VersionedTable(spark, str(tmp_path / "mart"))
    assert table.read() is None
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert table.publish(one) == 1
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert table.publish(versioned.delete_insert(table.read(), new, ["k"])) == 2
    assert as_rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_unlisted_version_is_not_read(spark, tmp_path):
    table = versioned.VersionedTable(spark, str(tmp_path / "mart"))
    table.publish(spark.range(3))
    spark.range(9).write.parquet(str(tmp_path / "mart" / "data" / "version=2"))
    assert table.read().count() == 3
    table.publish(spark.range(4))
    assert table.read().count() == 4


def test_schema_modes(spark):
    target = spark.createDataFrame([(1, "old", 5)], "k int, gone string, n int")
    new = spark.createDataFrame([(2, 1.5, 7)], "k int, fresh double, n int")
    sync = versioned.delete_insert(target, new, ["k"])
    assert sync.columns == ["k", "fresh", "n"]
    appended = versioned.delete_insert(target, new, ["k"], "append")
    assert sorted(appended.columns) == ["fresh", "gone", "k", "n"]
    assert {r["k"]: r["gone"] for r in appended.collect()} == {1: "old", 2: None}


def test_text_files_with_bom_quotes_and_gaps(spark, tmp_path):
    text = (
        "﻿Churn_Event_ID , ACCOUNT_ID,churn_date,reason_code,refund_amount_usd,"
        "preceding_upgrade_flag,preceding_downgrade_flag,is_reactivation,feedback_text\n"
        'C1,\t A1 ,2024-03-04 05:06:07,bugs,12.5,True,False,true,"said ""no"", twice"\n'
        "C2,A2,soon,NA,nan,,False,,\n"
    )
    (tmp_path / "churn_events.csv").write_text(text, encoding="utf-8")
    table = TABLES["churn_events"]
    raw = csv_source.read_raw(spark, str(tmp_path), table)
    assert csv_source.head(raw, 1).count() == 1
    rows = {r["churn_event_id"]: r for r in clean.standardise(raw, table).collect()}
    assert rows["C1"]["account_id"] == "A1" and rows["C1"]["churn_date"] == date(2024, 3, 4)
    assert rows["C1"]["feedback_text"] == 'said "no", twice'
    assert rows["C2"]["churn_date"] is None and rows["C2"]["reason_code"] is None
    assert rows["C2"]["refund_amount_usd"] is None and rows["C2"]["is_reactivation"] is None
    assert csv_source.read_raw(spark, str(tmp_path), TABLES["accounts"]) is None


def _write_usage(spark, folder, *rows):
    df = spark.createDataFrame(list(rows), COLUMNS)
    filled = clean.align(df, USAGE.raw_schema)
    filled.coalesce(1).write.mode("append").options(header="true").csv(folder)


def test_stream_reads_every_file_once(spark, tmp_path):
    raw, out, ckpt = (str(tmp_path / n) for n in ("raw", "lake", "ckpt"))
    _write_usage(spark, raw, ("U1", "S", date(2024, 1, 1), 1), ("U2", "S", date(2024, 1, 2), 2))
    assert ingest_stream.ingest_available(spark, raw, out, ckpt, USAGE) == 2
    _write_usage(spark, raw, ("U2", "S", date(2024, 1, 2), 5), ("U3", "S", date(2024, 1, 2), 3))
    assert ingest_stream.ingest_available(spark, raw, out, ckpt, USAGE) == 2
    assert ingest_stream.ingest_available(spark, raw, out, ckpt, USAGE) == 0
    rows = ingest_stream.current_stream_rows(spark, out, USAGE)
    assert {r["usage_id"]: r["usage_count"] for r in rows.collect()} == {"U1": 1, "U2": 5, "U3": 3}


def test_stream_keeps_the_last_of_a_key_and_sets_late_rows_aside(spark, tmp_path):
    raw, out, ckpt = (str(tmp_path / n) for n in ("raw", "lake", "ckpt"))
    run = lambda: ingest_stream.ingest_available(spark, raw, out, ckpt, USAGE, lateness="2 days")
    _write_usage(spark, raw, ("U1", "S", date(2024, 1, 10), 1))
    assert run() == 1
    _write_usage(spark, raw, ("U1", "S", date(2024, 1, 10), 7), ("U2", "S", date(2024, 1, 1), 2), ("U3", "S", date(2024, 1, 9), 3))
    assert run() == 3
    rows = ingest_stream.current_stream_rows(spark, out, USAGE)
    assert {r["usage_id"]: r["usage_count"] for r in rows.collect()} == {"U1": 7, "U3": 3}
    late = spark.read.parquet(ingest_stream.late_path(out)).collect()
    assert [(r["usage_id"], r["usage_count"]) for r in late] == [("U2", 2)]


def test_stream_and_batch_read_columns_by_name(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "lake"), str(tmp_path / "ckpt")
    raw.mkdir()
    (raw / "a.csv").write_text(
        "\ufeffsubscription_id, Usage_ID ,usage_date,usage_count,note\nS1,U1,2024-01-02,4,\"a, b\"\n", encoding="utf-8"
    )
    (raw / "b.csv").write_text("usage_id,usage_date,feature_name\nU2,2024-01-03,api\n\n")
    assert ingest_stream.ingest_available(spark, str(raw), out, ckpt, USAGE) == 2
    got = {r["usage_id"]: r.asDict() for r in ingest_stream.current_stream_rows(spark, out, USAGE).collect()}
    assert (got["U1"]["subscription_id"], got["U1"]["usage_count"]) == ("S1", 4)
    assert (got["U2"]["subscription_id"], got["U2"]["feature_name"]) == (None, "api")
    one = spark.read.options(**csv_source.READ_OPTIONS).csv(str(raw / "a.csv"))
    batch = clean.standardise(one, USAGE).collect()[0].asDict()
    assert all(got["U1"][n] == batch[n] for n in ("usage_id", "subscription_id", "usage_date", "usage_count"))


def test_stream_refuses_a_file_without_header(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("U1,S1,2024-01-02\n")
    with pytest.raises(Exception, match="no header of feature_usage"):
        ingest_stream.ingest_available(spark, str(raw), str(tmp_path / "lake"), str(tmp_path / "ckpt"), USAGE)


def test_stream_header_with_quoted_comma_and_rows_like_the_header(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "lake"), str(tmp_path / "ckpt")
    raw.mkdir()
    (raw / "a.csv").write_text(
        '\nusage_id,"note, of the day",usage_date,feature_name\nU1,"a, b",2024-01-02,api\n'
        'usage_id,"note, of the day",2024-01-03,feature_name\n'
    )
    assert ingest_stream.ingest_available(spark, str(raw), out, ckpt, USAGE) == 2
    got = {r["usage_id"]: r["feature_name"] for r in ingest_stream.current_stream_rows(spark, out, USAGE).collect()}
    assert got == {"U1": "api", "usage_id": "feature_name"}


def test_stream_lines_are_not_shuffled(spark, tmp_path):
    lines = spark.createDataFrame(
        [("usage_id,usage_date", "f", 0), ("U1,2024-01-02", "f", 0)], "value string, _file string, _start long"
    )
    rows = ingest_stream.rows_by_name(lines.coalesce(1), USAGE)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert [r["usage_id"] for r in rows.collect()] == ["U1"]


def test_upsert_stream_equals_the_batch_rule(spark, tmp_path):
    """A late row, a repeated key with a newer day, the same row again, and an older row within the lateness."""
    raw, out, current = (str(tmp_path / n) for n in ("raw", "lake", "current"))

    def arrive(*rows):
        _write_usage(spark, raw, *rows)
        ingest_stream.ingest_available(spark, raw, out, str(tmp_path / "c1"), USAGE)
        return current_stream.upsert_available(spark, out, current, str(tmp_path / "c2"), USAGE, "5 days")

    assert arrive(("U1", "S", date(2024, 1, 10), 1), ("U2", "S", date(2024, 1, 9), 2)) == 2
    assert arrive(
        ("U1", "S", date(2024, 1, 12), 7), ("U2", "S", date(2024, 1, 9), 2), ("U3", "S", date(2024, 1, 1), 3),
        ("U4", "S", date(2024, 1, 6), 4), ("U1", "S", date(2024, 1, 11), 9),
    ) == 2  # U2 is known, U3 too late
    table = current_stream.current_table(spark, current, USAGE)
    rows = table.read().collect()
    assert {r["usage_id"]: r["usage_count"] for r in rows} == {"U1": 7, "U2": 2, "U4": 4} and len(rows) == 3
    version = table.current_version()
    assert current_stream.upsert_available(spark, out, current, str(tmp_path / "c2"), USAGE, "5 days") == 0
    assert table.current_version() == version


def test_state_of_the_upsert_stream_is_on_disk_and_knows_rows_by_content(spark, tmp_path):
    """Stores of RocksDB whose keys are 32 bytes, and none that is a map on the heap; they outlive the call."""
    raw, out, current, state = (str(tmp_path / n) for n in ("raw", "lake", "current", "c2"))

    def arrive(*rows):
        _write_usage(spark, raw, *rows)
        ingest_stream.ingest_available(spark, raw, out, str(tmp_path / "c1"), USAGE)
        return current_stream.upsert_available(spark, out, current, state, USAGE, "5 days")

    row = ("U1", "S", date(2024, 1, 10), 1)
    assert arrive(row, row, (None, "S", date(2024, 1, 10), 1)) == 2
    assert arrive(row, ("U1", "S", date(2024, 1, 10), 2)) == 1
    assert arrive(row, (None, "S", date(2024, 1, 10), 1)) == 0
    rows = current_stream.current_table(spark, current, USAGE).read().collect()
    assert {(r["usage_id"], r["usage_count"]) for r in rows} == {("U1", 2), (None, 1)} and len(rows) == 2
    files = [p.name for p in (tmp_path / "c2" / "state").rglob("*")]
    assert any(n.endswith(".zip") for n in files) and not any(n.endswith((".delta", ".snapshot")) for n in files)
    keys = spark.read.format("statestore").load(state).select("key.*")
    assert [f.dataType.typeName() for f in keys.schema.fields] == ["binary"]
    assert {r[0] and len(r[0]) for r in keys.collect()} == {32}


def test_records_with_line_breaks_are_cut_in_parts(spark, tmp_path):
    """Equal to the reader that cannot split a file, with several tasks for one file."""
    table = TABLES["churn_events"]
    head = "churn_event_id,account_id,churn_date,reason_code,feedback_text"
    texts = ['plain', '"two\nlines"', '"said ""no"",\n\nthen left\n"', "", '"a, b"', '"\n"']
    body = "".join(f"C{i},A{i % 7},2024-03-{1 + i % 28:02d},bugs,{texts[i % len(texts)]}\n" for i in range(4000))
    (tmp_path / "churn_events.csv").write_text(head + "\n" + body)
    whole = csv_source.read_raw(spark, str(tmp_path), table, multi_line=True)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        assert spark.read.text(str(tmp_path / "churn_events.csv")).rdd.getNumPartitions() > 5
        parts = csv_source.read_raw_in_parts(spark, str(tmp_path), table)
        assert parts.columns == whole.columns
        got = sorted(map(str, parts.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(got) == 4000 and got == sorted(map(str, whole.collect()))


def test_event_window_bounds_on_timestamps(spark):
    rows = [(i, datetime(2024, 1, d, h)) for i, (d, h) in enumerate([(1, 23), (2, 0), (3, 23), (4, 0)])]
    df = spark.createDataFrame(rows, "i int, submitted_at timestamp")
    got = clean.event_window(df, "submitted_at", date(2024, 1, 1), date(2024, 1, 3))
    assert {r["i"] for r in got.collect()} == {1, 2}


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    from tenura import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.shared_root(Session())
