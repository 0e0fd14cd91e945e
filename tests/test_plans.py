"""Physical plans: what is pushed down, and joins that must not appear."""

from __future__ import annotations

from datetime import date

import pytest

import __spark_entry__ as entry_points
from tenura.catalog.queries import QUERIES
from tenura.operators import clean
from tenura.plans import marts
from tenura.sources import testdata as td

# The plan of these is the scan of what they have written; their steps are looked at below.
WRITES = {
    "lake_roundtrip", "csv_roundtrip", "csv_records_in_parts", "ingest_stream_usage", "stream_upsert_usage", "daily_run_mrr",
    "month_replace", "mrr_month_refresh", "churn_month_refresh", "usage_month_refresh", "health_window_refresh",
    *[n for n in QUERIES if n.startswith(("daily_run_incremental_", "daily_run_corrected_steps_"))],
}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES])
def test_no_cross_or_nested_loop_join(spark, data_dir, name):
    plan = _plan(entry_points.queries()[name](spark, data_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan


def test_steps_of_runs_have_no_python_or_nested_loop(spark, data_dir, tmp_path, monkeypatch):
    """The plans of every frame that a run writes, from ingest to the marts."""
    from tenura.operators import versioned
    from tenura.plans import daily_run
    from tenura.sources import lake

    plans = []

    def seen(module, name):
        whole = getattr(module, name)

        def write(df, *args, **kw):
            plans.append(_plan(df))
            return whole(df, *args, **kw)

        monkeypatch.setattr(module, name, write)

    for module, name in ((daily_run, "append_months"), (daily_run, "write_days"), (daily_run, "cut"), (lake, "write_days")):
        seen(module, name)
    publish = versioned.VersionedTable._write
    monkeypatch.setattr(versioned.VersionedTable, "_write", lambda self, df, v: plans.append(_plan(df)) or publish(self, df, v))
    store = daily_run.Store(root=str(tmp_path / "run"), raw_dir=str(tmp_path / "raw"))
    sources = {n: f(spark, data_dir) for n, f in td.SOURCES.items()}
    daily_run.run_day(spark, store, date(2026, 6, 30), modes=daily_run.CORRECTED, sources=sources)
    assert len(plans) >= 20
    for plan in plans:
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "Python" not in plan


def test_column_pruning(spark, data_dir):
    plan = _plan(marts.feature_usage_summary(td.feature_usage(spark, data_dir)))
    scan = plan[plan.index("ReadSchema"):]
    assert "l_extendedprice" not in scan and "l_tax" not in scan


def test_first_row_per_key_is_cut_before_the_shuffle(spark, data_dir):
    plan = _plan(clean.keep_last(td.feature_usage(spark, data_dir), ["usage_id"], ["usage_date"]))
    assert plan.count("WindowGroupLimit") == 2


def test_large_account_is_added_up_before_the_shuffle(spark, data_dir):
    from tenura.operators.enrich import enrich_subscriptions

    subs = enrich_subscriptions(td.subscriptions(spark, data_dir))
    plan = _plan(marts.mrr_monthly(subs, td.churn_events(spark, data_dir), date(2026, 6, 30)))
    below = plan[plan.index("Window"):]
    assert "partial_sum(mrr_amount" in below and "Expand" not in plan


def test_collapsed_versions_read_only_needed_columns(spark, tmp_path):
    from tenura.operators import versioned
    from tenura.schemas import TABLES

    table, path = TABLES["feature_usage"], str(tmp_path / "fact")
    spark.createDataFrame([], table.warehouse_schema).write.parquet(path)
    rows = versioned.current_rows(spark.read.parquet(path), table)
    plan = _plan(rows.where("usage_date >= date'2025-01-01'").select("usage_count"))
    assert "feature_name" not in plan and "_source_system" not in plan
    assert "GreaterThanOrEqual(usage_date,2025-01-01)" in plan
