"""Whole runs over small raw files."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

import pytest
from conftest import as_rows

from tenura.operators.quality import DataQualityError
from tenura.operators.versioned import VersionedTable
from tenura.operators.watermarks import Watermarks
from tenura.plans import daily_run
from tenura.plans.daily_run import CORRECTED, Store
from tenura.schemas import TABLES

FIRST = date(2024, 1, 1)
LAST = date(2024, 6, 30)


def _csv(folder, name, header, rows):
    lines = [header, *(",".join("" if c is None else str(c) for c in r) for r in rows)]
    (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8-sig")


def _raw(folder, bad_mrr=False):
    folder.mkdir(parents=True, exist_ok=True)
    accounts, subs, churn, usage, tickets = [], [], [], [], []
    for a in range(5):
        day = FIRST + timedelta(days=a)
        accounts.append((f"A{a}", f"Company {a}", "Finance", "Laos", f"{day} 10:00:00", "ads", "Pro", 3, "True", "False"))
        start = day
        for k in range(3):
            end = start + timedelta(days=20 + 10 * k)
            sid = f"S{a}{k}"
            subs.append((sid, f"A{a}", f"{start} 09:00:00", f"{end} 15:00:00", ["Free", "Pro"][k % 2], 2 + k,
                         10.0, 0.0, 25.5 * k, 0, "False", "False", "False", "False", "monthly", "True", None, None))
            for repeat in range(2):
                usage.append((f"U{a}{k}", sid, f"{start + timedelta(days=1)}", ["api", "export"][k % 2], 4 + k + repeat, 60, k, "False"))
            if k == 1:
                churn.append((f"C{a}", f"A{a}", f"{end} 15:00:00", "bugs", 1.5, "False", "False", "False", None))
            start = end + timedelta(days=5 + 40 * (a % 3))
        tickets.append((f"T{a}", f"A{a}", f"{day} 11:00:00", f"{day} 19:00:00" if a % 2 else None, 8.0, "high", 9, 4.5, "False"))
    if bad_mrr:
        tickets.append(("T99", "A1", "2024-06-20 11:00:00", "2024-06-19 11:00:00", 8.0, "high", 9, 4.5, "False"))
    _csv(folder, "accounts", "account_id,account_name,industry,country,signup_date,referral_source,plan_tier,seats,is_trial,churn_flag", accounts)
    _csv(folder, "subscriptions", "subscription_id,account_id,start_date,end_date,plan_tier,seats,price,discount_value,mrr_amount,arr_amount,is_trial,upgrade_flag,downgrade_flag,churn_flag,billing_frequency,auto_renew_flag,next_start,is_reactivation", subs)
    _csv(folder, "churn_events", "churn_event_id,account_id,churn_date,reason_code,refund_amount_usd,preceding_upgrade_flag,preceding_downgrade_flag,is_reactivation,feedback_text", churn)
    _csv(folder, "feature_usage", "usage_id,subscription_id,usage_date,feature_name,usage_count,usage_duration_secs,error_count,is_beta_feature", usage)
    _csv(folder, "support_tickets", "ticket_id,account_id,submitted_at,closed_at,resolution_time_hours,priority,first_response_time_minutes,satisfaction_score,escalation_flag", tickets)


def _store(tmp_path, name, **kw):
    raw = tmp_path / f"raw-{name}"
    _raw(raw, **kw)
    return Store(root=str(tmp_path / name), raw_dir=str(raw))


def _content(spark, store, collapse):
    out = {}
    for name in ("dim_accounts", "fact_subscriptions", "fact_churn_events", "fact_feature_usage", "fact_support_tickets"):
        rows = daily_run.warehouse(spark, store, name, collapse)
        out[name] = as_rows(rows.drop("_updated_at", "_ingestion_time", "_batch_id"))
    for name in ("mrr_monthly", "churn_summary", "feature_usage_summary"):
        out[name] = as_rows(VersionedTable(spark, store.mart(name)).read().drop("_refreshed_at"))
    return out


def test_steps_and_one_wide_run_agree(spark, tmp_path):
    """With history scope, months not pre-filtered and collapse on the primary key."""
    modes = replace(CORRECTED, tail="reference")
    wide, steps = _store(tmp_path, "wide"), _store(tmp_path, "steps")
    daily_run.run_day(spark, wide, LAST, modes=modes)
    results = daily_run.backfill(spark, steps, FIRST, LAST, step_days=91, modes=modes)
    assert len(results) == 2
    one, two = _content(spark, wide, "pk"), _content(spark, steps, "pk")
    assert one["fact_subscriptions"] and one == two


def test_second_run_adds_nothing_and_reset_replays(spark, tmp_path):
    store = _store(tmp_path, "again")
    first = daily_run.run_day(spark, store, LAST)
    assert first["ingest"]["subscriptions"]["rows"] > 12
    before = _content(spark, store, "sort_key")
    second = daily_run.run_day(spark, store, LAST)
    assert {r["rows"] for step in ("ingest", "transform", "load") for r in second[step].values()} == {0}
    for key in ("ingestion_subscriptions", "transform_subscriptions", "warehouse_fact_subscriptions"):
        Watermarks(spark, store.watermarks).reset(key)
    third = daily_run.run_day(spark, store, LAST)
    assert third["load"]["subscriptions"]["rows"] == first["load"]["subscriptions"]["rows"]
    assert daily_run.staged(spark, store, TABLES["subscriptions"]).count() == 2 * third["load"]["subscriptions"]["rows"]
    assert _content(spark, store, "sort_key") == before


def test_failed_check_stops_before_the_warehouse(spark, tmp_path):
    store = _store(tmp_path, "bad", bad_mrr=True)
    with pytest.raises(DataQualityError, match="date_order"):
        daily_run.run_day(spark, store, LAST)
    assert daily_run.warehouse(spark, store, "fact_support_tickets").isEmpty()


def test_missing_file_is_skipped_and_failures_are_named(spark, tmp_path):
    store = _store(tmp_path, "part")
    (tmp_path / "raw-part" / "churn_events.csv").unlink()
    (tmp_path / "raw-part" / "feature_usage.csv").write_text("usage_id,other\nU1,2\n")
    with pytest.raises(daily_run.RunError, match=r"ingest failed for tables: \['feature_usage'\]"):
        daily_run.run_day(spark, store, LAST)
    state = Watermarks(spark, store.watermarks).all()
    assert state["ingestion_accounts"] == LAST
    assert "ingestion_churn_events" not in state and "ingestion_feature_usage" not in state


def test_command_line(spark, tmp_path, capsys):
    import json

    from tenura.__main__ import main

    store = _store(tmp_path, "cli", bad_mrr=True)
    where = ["--root", store.root, "--raw", store.raw_dir]
    assert main(["ingest", *where, "--date", "2024-06-30"]) == 0
    assert json.loads(capsys.readouterr().out)["support_tickets"] == {"status": "ok", "rows": 6}
    assert main(["transform", *where, "--date", "2024-06-30"]) == 0
    assert main(["check", *where, "--date", "2024-06-30"]) == 1
    assert "date_order" in capsys.readouterr().err
    assert main(["reset", *where, "--key", "ingestion_accounts"]) == 0
    left = json.loads(capsys.readouterr().out)
    assert "ingestion_accounts" not in left and left["transform_accounts"] == "2024-06-30"


def test_single_modes_can_be_chosen():
    from tenura.__main__ import chosen, parse

    args = ["run", "--root", "r", "--modes", "corrected", "--set", "denominator=active", "--set", "usage_upto_as_of=false"]
    assert chosen(parse(args)) == replace(CORRECTED, denominator="active", usage_upto_as_of=False)
    with pytest.raises(SystemExit, match="unknown mode"):
        chosen(parse(["run", "--root", "r", "--set", "other=1"]))
