"""One small frame per semantic trap."""

from __future__ import annotations

from datetime import date, datetime

from conftest import as_rows
from pyspark.sql import functions as F

from tenura.operators import clean, derive, enrich, versioned
from tenura.plans import marts
from tenura.schemas import TABLES

SUB = "subscription_id string, account_id string, start_date date, end_date timestamp, plan_tier string, seats int, mrr_amount double"


def _subs(spark, *rows):
    full = [(i, a, s, e, "Pro", 2, 50.0) for i, a, s, e in rows]
    return spark.createDataFrame(full, SUB)


def _churn(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "churn_event_id string, account_id string, churn_date date, reason_code string, "
        "refund_amount_usd double, is_reactivation boolean",
    )


def _flags(df, name):
    return {r["subscription_id"]: r[name] for r in df.collect()}


def test_gap_is_floored_elapsed_days(spark):
    subs = _subs(
        spark,
        ("S1", "A", date(2024, 1, 1), datetime(2024, 1, 31, 10)),
        ("S2", "A", date(2024, 4, 1), datetime(2024, 4, 30)),
        ("S3", "B", date(2024, 1, 1), datetime(2024, 1, 31, 10)),
        ("S4", "B", date(2024, 4, 2), datetime(2024, 4, 30)),
        ("S5", "C", date(2024, 1, 1), datetime(2024, 1, 31, 10)),
        ("S6", "C", date(2024, 1, 31), datetime(2024, 4, 30)),
    )
    out = enrich.enrich_subscriptions(subs)
    assert _flags(out, "churn_flag") == {
        "S1": False, "S2": True, "S3": True, "S4": True, "S5": False, "S6": True,
    }
    assert _flags(out, "reactivation_flag") == {
        "S1": False, "S2": False, "S3": False, "S4": True, "S5": False, "S6": False,
    }


def test_last_subscription_and_tail_modes(spark):
    subs = _subs(
        spark,
        ("S1", "A", date(2024, 1, 1), datetime(2024, 2, 1)),
        ("S2", "B", date(2024, 1, 1), datetime(2024, 6, 1)),
    )
    assert set(_flags(enrich.enrich_subscriptions(subs), "churn_flag").values()) == {True}
    as_of = enrich.enrich_subscriptions(subs, tail="as_of", as_of=date(2024, 6, 30))
    assert _flags(as_of, "churn_flag") == {"S1": True, "S2": False}


def test_missing_end_counts_as_churned_in_reference(spark):
    subs = _subs(
        spark, ("S1", "A", date(2024, 1, 1), None), ("S2", "A", date(2024, 2, 1), datetime(2024, 3, 1))
    )
    out = enrich.enrich_subscriptions(subs)
    assert _flags(out, "churn_flag")["S1"] is True
    assert _flags(out, "days_active")["S1"] == 0


def test_month_overlap_modes(spark):
    subs = enrich.enrich_subscriptions(
        _subs(spark, ("S1", "A", date(2024, 11, 15), datetime(2025, 2, 10)))
    )

    def months(overlap):
        rows = marts.active_months(subs, marts.month_spine(date(2025, 6, 1), "calendar"), overlap)
        return sorted((r["year"], r["month"]) for r in rows.collect())

    assert months("reference") == [(2024, 11), (2024, 12)]
    assert months("calendar") == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]


def test_end_before_start_is_never_active(spark):
    subs = enrich.enrich_subscriptions(
        _subs(spark, ("S1", "A", date(2024, 5, 15), datetime(2024, 3, 1)))
    )
    spine = marts.month_spine(date(2025, 6, 1), "calendar")
    assert marts.active_months(subs, spine, "calendar").count() == 0


def test_new_and_churned_accounts_reach_every_tier_of_the_account(spark):
    rows = [
        ("S1", "A", date(2024, 3, 1), datetime(2024, 3, 20), "Free", 1, 0.0),
        ("S2", "A", date(2024, 3, 20), datetime(2024, 5, 20), "Pro", 2, 50.0),
        ("S3", "B", date(2024, 3, 5), datetime(2024, 5, 20), "Pro", 3, 75.0),
        ("S4", "B", date(2024, 3, 6), datetime(2024, 3, 8), "Pro", 1, 25.0),
    ]
    subs = enrich.enrich_subscriptions(spark.createDataFrame(rows, SUB))
    churn = _churn(spark, ("C1", "A", date(2024, 3, 20), "bugs", 0.0, True),
                   ("C2", "A", date(2024, 3, 21), "bugs", 0.0, True),
                   ("C3", "Z", date(2024, 3, 21), "bugs", 0.0, True))
    mart = marts.mrr_monthly(subs, churn, date(2024, 3, 31), overlap="calendar", spine="calendar")
    got = {r["plan_tier"]: r.asDict() for r in mart.where("month = 3").collect()}
    assert got["Free"]["new_accounts"] == 1 and got["Free"]["churned_accounts"] == 1
    assert got["Pro"]["active_accounts"] == 2 and got["Pro"]["new_accounts"] == 2
    assert got["Pro"]["churned_accounts"] == 1
    assert got["Pro"]["avg_mrr_per_account"] == 50.0 and got["Pro"]["total_seats"] == 6


def test_refreshed_month_equals_full_build_unless_starts_are_prefiltered(spark, data_dir):
    from tenura.sources import testdata as td

    subs = enrich.enrich_subscriptions(td.subscriptions(spark, data_dir))
    churn, as_of = td.churn_events(spark, data_dir), date(2026, 6, 30)
    modes = {"overlap": "calendar", "spine": "calendar"}
    full = marts.mrr_monthly(subs, churn, as_of, **modes).where("year * 100 + month >= 202604")
    part = marts.mrr_monthly(subs, churn, as_of, refresh_from=202604, **modes)
    cut = marts.mrr_monthly(subs, churn, as_of, refresh_from=202604, prefilter_starts=True, **modes)
    assert as_rows(part) == as_rows(full)
    assert as_rows(cut) != as_rows(full)


def _health(spark, unmatched):
    accounts = spark.createDataFrame(
        [("A1", "one", "Pro", "X", "Y"), ("A2", "two", "Pro", "X", "Y"), ("A3", "three", "Pro", "X", "Y")],
        "account_id string, account_name string, plan_tier string, country string, industry string",
    )
    subs = enrich.enrich_subscriptions(
        _subs(spark, ("S1", "A2", date(2024, 5, 1), datetime(2024, 8, 1))),
        tail="as_of", as_of=date(2024, 6, 1),
    )
    usage = spark.createDataFrame(
        [("U1", "S1", date(2024, 5, 20), 4)],
        "usage_id string, subscription_id string, usage_date date, usage_count int",
    )
    tickets = spark.createDataFrame(
        [("T1", "A1", datetime(2024, 5, 1), None, "high", 2.0)],
        "ticket_id string, account_id string, submitted_at timestamp, closed_at timestamp, "
        "priority string, satisfaction_score double",
    )
    mart = marts.health_score(
        accounts, subs, usage, _churn(spark), tickets, date(2024, 6, 1), unmatched=unmatched
    )
    return {r["account_id"]: r.asDict() for r in mart.collect()}


def test_account_without_subscription(spark):
    got = _health(spark, "reference")
    assert set(got) == {"A1", "A2"}
    assert got["A1"]["plan_tier"] == "" and got["A1"]["days_since_last_activity"] > 19_000
    assert got["A1"]["health_score"] == 50 + 15 - 10 - 10
    got = _health(spark, "nulls")
    assert got["A1"]["plan_tier"] == "Pro" and got["A1"]["days_since_last_activity"] is None
    assert got["A1"]["health_score"] == 50 - 10
    assert got["A2"]["health_score"] == 50 + 15 + 10 + 10 and got["A2"]["churn_risk"] == "low"
    assert got["A1"]["churn_risk"] == "high"


def test_columns_go_by_name(spark):
    table = TABLES["feature_usage"]
    rows = clean.with_lineage(
        spark.createDataFrame([("U1", "S1")], "usage_id string, subscription_id string"),
        "application_logs", "batch", "time",
    ).select("_batch_id", "usage_id", "_source_system", "subscription_id", "_ingestion_time")
    out = clean.align(rows, table.warehouse_schema).first()
    assert out["_source_system"] == "application_logs" and out["_ingestion_time"] == "time"
    assert out["_updated_at"] is None and out["usage_count"] is None


def test_sort_key_and_primary_key_versions(spark):
    rows = [
        ("S1", "A", date(2024, 1, 1), 1), ("S1", "A", date(2024, 1, 1), 3),
        ("S1", "A", date(2024, 1, 1), 2), ("S1", "A", date(2024, 1, 2), 4),
    ]
    df = spark.createDataFrame(rows, "subscription_id string, account_id string, start_date date, _updated_at bigint")
    table = TABLES["subscriptions"]
    by_sort = versioned.current_rows(df, table)
    assert sorted(r["_updated_at"] for r in by_sort.collect()) == [3, 4]
    assert [r["_updated_at"] for r in versioned.current_rows(df, table, "pk").collect()] == [4]


def test_latest_version_ignores_row_order(spark):
    rows = [("S1", i % 7, i) for i in range(50)]
    one = spark.createDataFrame(rows, "k string, v int, _updated_at bigint")
    two = spark.createDataFrame(rows[::-1], "k string, v int, _updated_at bigint").repartition(7)
    assert as_rows(versioned.latest_version(one, ["k"])) == as_rows(versioned.latest_version(two, ["k"]))


def test_keep_last_takes_the_later_row(spark):
    rows = [("U1", date(2024, 1, 1), 5), ("U1", date(2024, 1, 3), 1), ("U1", date(2024, 1, 2), 9)]
    df = spark.createDataFrame(rows, "usage_id string, usage_date date, n int")
    assert [r["n"] for r in clean.keep_last(df, ["usage_id"], ["usage_date"]).collect()] == [1]


def test_churn_flag_and_churn_events_are_apart(spark):
    """The gap rule on subscriptions and the events table are two definitions."""
    subs = _subs(spark, ("S1", "A", date(2024, 1, 1), datetime(2024, 2, 1))).withColumn(
        "churn_flag", F.lit(True)
    )
    assert derive.with_reactivation(subs).first()["is_reactivation"] is False
    accounts = spark.createDataFrame([("A",), ("B",)], "account_id string")
    flagged = derive.with_ever_churned(accounts, _churn(spark, ("C", "B", date(2024, 1, 1), "bugs", 0.0, False)))
    assert {r["account_id"]: r["churn_flag"] for r in flagged.collect()} == {"A": False, "B": True}


def test_denominators_differ(spark):
    subs = _subs(
        spark,
        ("S1", "A", date(2024, 1, 1), datetime(2024, 6, 1)),
        ("S2", "B", date(2024, 3, 1), datetime(2024, 6, 1)),
    )
    churn = _churn(spark, ("C1", "A", date(2024, 3, 5), "bugs", 1.5, True),
                   ("C2", "A", date(2023, 3, 5), "bugs", 1.5, True))
    starting = marts.churn_summary(churn, subs).orderBy("year").collect()
    assert [r["churn_rate_pct"] for r in starting] == [0.0, 100.0]
    active = marts.churn_summary(churn, subs, denominator="active").orderBy("year").collect()
    assert [r["churn_rate_pct"] for r in active] == [0.0, 50.0]
    assert marts.churn_one_month(churn, subs, 2024, 3).first()["churn_rate_pct"] == 50.0


def test_refund_rule(spark):
    rows = [
        ("S1", "A", date(2024, 1, 1), datetime(2024, 1, 1, 12), "Pro", 2, 100.0),
        ("S2", "A", date(2024, 2, 1), datetime(2024, 2, 11), "Pro", 2, 100.0),
        ("S3", "A", date(2024, 3, 1), datetime(2024, 3, 31), "Pro", 2, 100.0),
    ]
    subs = spark.createDataFrame(rows, SUB).withColumn("churn_flag", F.lit(True))
    events = derive.churn_events_from(derive.with_reactivation(derive.with_plan_moves(subs)))
    assert {r["churn_event_id"]: r["refund_amount_usd"] for r in events.collect()} == {
        "C1": 5.0, "C2": 25.0, "C3": 0.0,
    }


def test_report_order(spark):
    rows = [(2024, 2, "a", 1), (2024, 1, "a", 1), (2024, 1, "b", 7)]
    mart = spark.createDataFrame(rows, "year int, month int, reason_code string, churn_count int")
    got = [tuple(r) for r in marts.report_order(mart, "churn_summary").collect()]
    assert got == [(2024, 1, "b", 7), (2024, 1, "a", 1), (2024, 2, "a", 1)]
