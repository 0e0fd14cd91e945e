from __future__ import annotations

from datetime import date, datetime

import pytest

from tenura.operators import profile, quality
from tenura.schemas import TABLES


def _results(df, name):
    return {r["check_name"]: (r["status"], r["detail"]) for r in quality.check_table(df, TABLES[name]).collect()}


SUBS = "subscription_id string, account_id string, start_date string, end_date string, plan_tier string, mrr_amount string"


def test_checks_on_text_columns(spark):
    rows = [
        ("S1", "A", "2024-01-02", "2024-02-01", "Pro", "12"),
        ("S1", "A", "2024-01-03", "2024-01-01", None, "-3"),
        (None, "A", "2030-01-01", None, "Pro", "n/a"),
        (None, None, "never", "2024-01-01", "Pro", None),
    ]
    got = _results(spark.createDataFrame(rows, SUBS), "subscriptions")
    assert got["non_empty_batch"] == ("PASS", "4 rows")
    assert got["no_null_pk"] == ("FAIL", "2 nulls in 'subscription_id'")
    assert got["no_duplicate_pk"] == ("WARNING", "2 duplicates in 'subscription_id'")
    assert got["no_negative_revenue"] == ("FAIL", "mrr_amount: 1 negative")
    assert got["date_order"] == ("FAIL", "1 rows where end < start")
    assert got["date_bounds"] == ("WARNING", "1 rows outside [2024-01-01, 2026-12-31]")
    assert got["no_null_critical_cols"] == ("FAIL", "account_id: 1 nulls, plan_tier: 1 nulls, end_date: 1 nulls")


def test_missing_columns(spark):
    got = _results(spark.createDataFrame([("A",)], "account_id string"), "subscriptions")
    assert got["no_null_pk"][0] == "FAIL" and got["no_duplicate_pk"] == ("WARNING", "-1 duplicates in 'subscription_id'")
    assert got["date_order"][0] == "SKIP" and got["date_bounds"][0] == "SKIP"
    assert got["no_negative_revenue"] == ("PASS", "all >= 0")


def test_empty_batch_skips_all(spark):
    got = _results(spark.createDataFrame([], SUBS), "subscriptions")
    assert len(got) == 7 and {s for s, _ in got.values()} == {"SKIP"}


def test_gate(spark):
    good = spark.createDataFrame(
        [("T1", "A", datetime(2024, 1, 2), None, "high")],
        "ticket_id string, account_id string, submitted_at timestamp, closed_at timestamp, priority string",
    )
    results = quality.check_tables({"support_tickets": good}, TABLES)
    assert len(quality.enforce(results)) == 7
    assert quality.gate_status(results).first()["gate"] == "go"
    bad = good.withColumn("priority", good["closed_at"].cast("string"))
    results = quality.check_tables({"support_tickets": bad}, TABLES)
    assert quality.gate_status(results).first()["gate"] == "stop"
    with pytest.raises(quality.DataQualityError, match="priority: 1 nulls"):
        quality.enforce(results)


def test_declared_tests(spark):
    frame = spark.createDataFrame(
        [("a", 10, "low"), ("a", 101, "odd"), (None, -1, "odd"), (None, None, None)],
        "account_id string, health_score int, churn_risk string",
    )
    tests = [t for t in quality.fv.DECLARED_TESTS if t[0] == "customer_health_score" and t[1] != "mrr_last_month"]
    got = {
        (r["column_name"], r["test"]): r["failures"]
        for r in quality.declared_tests({"customer_health_score": frame}, tests).collect()
    }
    assert got == {
        ("account_id", "unique"): 1,
        ("account_id", "not_null"): 2,
        ("health_score", "not_null"): 1,
        ("health_score", "expression_is_true >= 0"): 1,
        ("health_score", "expression_is_true <= 100"): 1,
        ("churn_risk", "accepted_values low,medium,high"): 1,
    }


def test_all_declared_tests_are_listed():
    kinds = [t[2] for t in quality.fv.DECLARED_TESTS]
    assert len(kinds) == 45
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 24, "unique": 7, "expression_is_true": 13, "accepted_values": 1,
    }


def test_profile_lists_few_values_and_samples_many(spark):
    rows = [(i, "x" if i % 2 else "y", None, date(2024, 1, 1)) for i in range(9)]
    df = spark.createDataFrame(rows, "n int, s string, empty string, d date")
    got = {r["column_name"]: r for r in profile.profile_columns(df, "t").collect()}
    assert got["n"]["n_unique"] == 9 and got["n"]["sample_values"] == "0|1|2|3"
    assert got["s"]["sample_values"] == "x|y" and got["s"]["non_null"] == 9
    assert got["empty"]["n_unique"] == 0 and got["empty"]["sample_values"] == ""
    assert got["d"]["dtype"] == "date"


def test_sample_is_stable(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as k")
    one = {r["k"] for r in profile.stable_sample(df, "k", 20).collect()}
    two = {r["k"] for r in profile.stable_sample(df.repartition(9), "k", 20).collect()}
    assert one == two and len(one) == 20
