"""Values that outgrow what the small tables hold: long ids, large counts, many micro-batches."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tenura.catalog import dirty, oracles
from tenura.operators import clean, derive, enrich, profile
from tenura.operators.watermarks import Watermarks
from tenura.schemas import TABLES
from tenura.sources import testdata as td
from tenura.streaming import ingest_stream

USAGE = TABLES["feature_usage"]


def test_all_digits_of_an_id_are_read(spark):
    ids = spark.createDataFrame([("S1234567890",), ("S000000012",), ("U1234567890-3",)], "key string")
    assert [r[0] for r in ids.select(dirty.number_of("key")).collect()] == [1234567890, 12, 1234567890]


def test_long_numbers_make_whole_ids_in_both_engines(spark, data_dir):
    import duckdb

    wanted = ["S1234567890", "S1234567891", "S000000001"]
    keys = spark.createDataFrame([(1234567890,), (1234567891,), (1,)], "k bigint")
    assert [r[0] for r in keys.selectExpr(td._id("S", "k")).collect()] == wanted
    twin = f"SELECT {oracles._id('S', 'k')} FROM (VALUES (1234567890), (1234567891), (1)) t(k)"
    assert [r[0] for r in duckdb.sql(twin).fetchall()] == wanted


def test_churn_event_ids_keep_the_whole_subscription_id(spark):
    tail = "7" * 80
    rows = [(f"S{tail}{x}", "A", datetime(2024, 1, 1), datetime(2024, 2, 1), 10.0, True, False, False, False) for x in "ab"]
    names = "subscription_id string, account_id string, start_date timestamp, end_date timestamp, mrr_amount double, "
    flags = "churn_flag boolean, upgrade_flag boolean, downgrade_flag boolean, is_reactivation boolean"
    found = derive.churn_events_from(spark.createDataFrame(rows, names + flags))
    assert {r["churn_event_id"] for r in found.collect()} == {f"C{tail}a", f"C{tail}b"}


def test_large_counts_are_kept(spark):
    names = USAGE.raw_schema.names
    cells = {"usage_id": "U1", "subscription_id": "S1", "usage_date": "2024-01-02", "feature_name": "api"}
    cells |= {"usage_count": "3000000000", "usage_duration_secs": "3000000000.0", "error_count": "-4"}
    raw = spark.createDataFrame([tuple(cells.get(n, "true") for n in names)], ", ".join(f"{n} string" for n in names))
    row = enrich.enrich_feature_usage(clean.standardise(raw, USAGE)).first()
    assert (row["usage_count"], row["usage_duration_secs"], row["error_count"]) == (3_000_000_000, 3_000_000_000, 0)


def test_stream_counts_more_batches_than_the_progress_list_keeps(spark, tmp_path):
    raw, out, ckpt = (str(tmp_path / n) for n in ("raw", "lake", "ckpt"))
    day = date(2024, 1, 2)
    for i in range(4):
        cells = {"usage_id": f"U{i}", "subscription_id": "S", "usage_date": str(day), "usage_count": "1"}
        row = tuple(cells.get(n, "0") for n in USAGE.raw_schema.names)
        frame = spark.createDataFrame([row], ", ".join(f"{n} string" for n in USAGE.raw_schema.names))
        frame.coalesce(1).write.mode("append").option("header", True).csv(raw)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        assert ingest_stream.ingest_available(spark, raw, out, ckpt, USAGE, files_per_batch=1) == 4
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert spark.read.parquet(out).count() == 4


def test_every_order_is_a_subscription_and_suppliers_have_none(spark, data_dir):
    subs, accounts = td.subscriptions(spark, data_dir), td.accounts(spark, data_dir)
    assert subs.count() == td.table(spark, data_dir, "orders").count()
    idle = accounts.join(subs.select("account_id").distinct(), "account_id", "left_anti")
    suppliers = td.table(spark, data_dir, "supplier").count()
    assert idle.where(F.col("account_id").startswith("V")).count() == suppliers > 0


def test_stable_sample_keeps_the_smallest_hashes(spark):
    rows = spark.range(2000).repartition(5)
    hashes = rows.select("id", F.md5(F.col("id").cast("string")).alias("h")).collect()
    wanted = {r["id"] for r in sorted(hashes, key=lambda r: r["h"])[:25]}
    assert {r["id"] for r in profile.stable_sample(rows, "id", 25).collect()} == wanted


def test_watermark_order_comes_from_the_log(spark, tmp_path):
    log = Watermarks(spark, str(tmp_path / "marks"))
    log.set("a", date(2024, 5, 1))
    log.reset("a")
    log.set("a", date(2024, 3, 1))
    assert log.get("a") == date(2024, 3, 1)
    assert sorted(r["seq"] for r in log.log().collect()) == [1, 2, 3]
