"""Change-driven refresh, commits, bucketed tables, the key index, mergeable state, the sweep."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import as_rows
from pyspark.sql import functions as F
from test_daily_run import FIRST, _content, _store

from tenura.operators import versioned
from tenura.operators.versioned import numbers_of_folders
from tenura.operators.distinct_state import DistinctState, IdDictionary
from tenura.operators.enrich import enrich_subscriptions
from tenura.operators.watermarks import Commit, Watermarks
from tenura.plans import daily_run, marts, sweep, usage_state
from tenura.plans.daily_run import CORRECTED
from tenura.schemas import TABLES
from tenura.sources import testdata as td
from tenura.sources.key_index import KeyIndex
from tenura.sources.lake import append_months, read_months

HEALTH = "customer_health_score"


def _scores(spark, store):
    return as_rows(daily_run.mart_table(spark, store, HEALTH).read().drop("_refreshed_at"))


def test_steps_of_any_length_leave_the_same_scores(spark, tmp_path):
    """All corrected modes unchanged: daily, weekly and one wide run."""
    upto = FIRST + timedelta(days=40)
    wide, weeks, days = (_store(tmp_path, n) for n in ("wide", "weeks", "days"))
    daily_run.run_day(spark, wide, upto, modes=CORRECTED)
    daily_run.backfill(spark, weeks, upto - timedelta(days=13), upto, step_days=7, modes=CORRECTED)
    daily_run.run_day(spark, days, upto - timedelta(days=2), modes=CORRECTED)
    daily_run.backfill(spark, days, upto - timedelta(days=1), upto, modes=CORRECTED)
    expected = _scores(spark, wide)
    assert expected and _scores(spark, weeks) == expected and _scores(spark, days) == expected
    assert _content(spark, weeks, "pk") == _content(spark, wide, "pk") == _content(spark, days, "pk")


def test_broken_off_step_leaves_no_second_copy(spark, tmp_path, monkeypatch):
    """The rows are written and the control row is not: the next run writes them again, and one copy is read."""
    store, upto = _store(tmp_path, "broken"), date(2024, 6, 30)
    daily_run.ingest_all(spark, store, upto)
    whole = Watermarks.set

    def broken(self, key, day, commit=None, months=None):
        if key == "transform_feature_usage":
            raise OSError("lost")
        whole(self, key, day, commit, months)

    monkeypatch.setattr(Watermarks, "set", broken)
    with pytest.raises(daily_run.RunError, match="feature_usage"):
        daily_run.transform_all(spark, store, upto)
    usage = TABLES["feature_usage"]
    assert len(list(Path(store.staging("feature_usage")).glob("commit=*"))) == 1
    assert daily_run.staged(spark, store, usage).isEmpty()
    monkeypatch.setattr(Watermarks, "set", whole)
    written = daily_run.transform_all(spark, store, upto)
    assert written["feature_usage"]["rows"] == daily_run.staged(spark, store, usage).count() > 0
    assert written["accounts"]["rows"] == 0
    assert len(list(Path(store.staging("feature_usage")).glob("commit=*"))) == 2


def test_upsert_writes_only_the_buckets_that_changed(spark, tmp_path):
    table = versioned.VersionedTable(spark, str(tmp_path / "mart"), F.expr("k % 8"))
    rows = spark.range(8000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table.publish(rows)
    new = spark.createDataFrame([(11, "new"), (8003, "more")], "k bigint, v string")
    merge = lambda old, fresh: versioned.delete_insert(old, fresh, ["k"])
    assert table.upsert(new, merge, {"load": 7}) == 2 and table.marks() == {"load": 7}

    def size(version):
        return sum(f.stat().st_size for f in (tmp_path / "mart" / "data" / f"version={version}").rglob("*.parquet"))

    assert size(2) < size(1) / 6  # bucket 3 of 8
    assert numbers_of_folders(spark, str(tmp_path / "mart/data/version=2"), "_bucket") == [3]
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(got) == 8001 and got[11] == "new" and got[8003] == "more" and len(got[12]) == 64


def test_upsert_empties_buckets_and_follows_changed_columns(spark, tmp_path):
    table = versioned.VersionedTable(spark, str(tmp_path / "mart"), F.col("month"))
    table.publish(spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "month int, v string"))
    without = lambda old, fresh: old.where("month <> 2").unionByName(fresh)
    table.upsert(spark.createDataFrame([], "month int, v string"), without, also=(2,))
    assert as_rows(table.read()) == [(1, "a"), (None, "c")]
    table.upsert(spark.createDataFrame([(1, "x", 5)], "month int, v string, n int"),
                 lambda old, fresh: versioned.delete_insert(old, fresh, ["month"]))
    assert as_rows(table.read()) == [(1, 5, "x"), (None, None, "c")]


def test_key_index_names_the_months_of_keys(spark, tmp_path):
    table, path = TABLES["feature_usage"], str(tmp_path)
    columns = "usage_id string, subscription_id string, usage_date date"
    loads = [
        [("U1", "S1", date(2024, 1, 5)), ("U2", "S2", date(2024, 2, 5)), ("U3", "S3", date(2024, 3, 5))],
        [("U1", "S1", date(2024, 5, 5)), ("U4", "S4", date(2024, 5, 6)), ("U5", "S2", date(2024, 6, 6))],
    ]
    commits = []
    for number, rows in enumerate(loads, 1):
        folder = f"{path}/rows/commit=c{number}"
        append_months(spark.createDataFrame(rows, columns), folder, "usage_date", ("usage_id",))
        KeyIndex(spark, f"{path}/index", table, commits).add(spark.createDataFrame(rows, columns), f"c{number}")
        commits.append(Commit(f"c{number}", number, tuple(numbers_of_folders(spark, folder, "_month"))))
    index = KeyIndex(spark, f"{path}/index", table, commits)
    assert index.from_month(date(2024, 6, 1)) == [202406]
    assert index.from_month(date(2024, 5, 1)) == [202401, 202405, 202406]  # U1 moved from January
    assert index.of(spark.createDataFrame([("S2",)], "subscription_id string"), "subscription_id") == [202402, 202406]
    assert index.of(spark.createDataFrame([("U1",)], "usage_id string"), "usage_id") == [202401, 202405]
    schema = spark.createDataFrame([], columns).schema
    rows = read_months(spark, f"{path}/rows", schema, commits=commits, months=[202401, 202405])
    read = rows.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("_month=")[1][:6] for r in read} == {"202401", "202405"}
    assert read_months(spark, f"{path}/rows", schema, commits=commits, months=[]).isEmpty()


def test_distinct_counts_from_state(spark, tmp_path):
    rng = random.Random(1)
    rows = [(2024, rng.randint(1, 3), rng.choice("ab"), f"S{rng.randrange(300)}" if rng.random() < 0.95 else None) for _ in range(3000)]
    loads = [rows[:1000], rows[500:2200], rows[2200:]]
    columns = "year int, month int, feature string, id string"
    state = DistinctState(spark, str(tmp_path / "state"), ("year", "month", "feature"), "id")
    for number, load in enumerate(loads, 1):
        frame = spark.createDataFrame(load, columns)
        state.add(frame, number)
        state.add(frame, number)  # a load that is added again counts once
    direct = spark.createDataFrame(rows, columns).groupBy("year", "month", "feature").agg(F.count_distinct("id").alias("n"))
    assert as_rows(state.counts("n")) == as_rows(direct)
    codes = [r["code"] for r in state.ids.codes().collect()]
    assert sorted(codes) == list(range(300))


def test_dictionary_keeps_its_codes(spark, tmp_path):
    ids = IdDictionary(spark, str(tmp_path / "ids"))
    for some in (["a", "b", None], ["b", "c"], ["a"]):
        before = {r["id"]: r["code"] for r in ids.codes().collect()}
        ids.extend(spark.createDataFrame([(i,) for i in some], "id string"))
        after = {r["id"]: r["code"] for r in ids.codes().collect()}
        assert before.items() <= after.items()
    assert set(after) == {"a", "b", "c"} and sorted(after.values()) == [0, 1, 2]


def test_usage_state_skips_a_load_that_it_has(spark, tmp_path, data_dir):
    usage = td.feature_usage(spark, data_dir)
    state = usage_state.UsageState(spark, str(tmp_path / "usage"))
    state.add(usage, 1)
    state.add(usage, 1)
    assert as_rows(state.mart()) == as_rows(marts.feature_usage_summary(usage))


def test_sweep_equals_listed_months(spark, data_dir):
    """Overlapping, nested, equal and open spans, nulls, one very large account, starts before and ends after the months."""
    rng, subs, churn = random.Random(2), [], []
    for i in range(600):
        start = datetime(2023, 1, 1) + timedelta(days=rng.randrange(1400))
        end = start + timedelta(days=rng.randrange(-20, 900))
        account = "A0" if i % 3 == 0 else rng.choice([f"A{k}" for k in range(40)] + [None])
        price = rng.choice([None, 0.0, 10.0, 33.0])  # whole: sums of doubles are then exact like the sweep's decimals
        subs.append((f"S{i}", account, start, None if i % 50 == 0 else end, rng.choice(["Free", "Pro", None]), rng.choice([None, 3]),
                     price, None if price is None else 12 * price))
        churn.append((account, (start + timedelta(days=40)).date()))
    columns = ("subscription_id string, account_id string, start_date timestamp, end_date timestamp, plan_tier string, "
               "seats int, mrr_amount double, arr_amount double")
    rows = enrich_subscriptions(spark.createDataFrame(subs, columns))
    events = spark.createDataFrame(churn, "account_id string, churn_date date")
    as_of = date(2026, 3, 15)
    listed = marts.mrr_monthly(rows, events, as_of, overlap="calendar", spine="calendar")

    def known(df):  # a missing amount counts as zero in both
        return as_rows(df.na.fill(0))

    got = sweep.mrr_monthly_sweep(rows, events, as_of)
    assert got.dtypes == listed.dtypes
    assert known(got) == known(listed)


def test_sweep_makes_two_rows_of_a_long_subscription(spark):
    rows = enrich_subscriptions(spark.createDataFrame(
        [("S1", "A1", datetime(2024, 1, 1), datetime(2026, 12, 1), "Pro", 1, 5.0)],
        "subscription_id string, account_id string, start_date timestamp, end_date timestamp, plan_tier string, seats int, mrr_amount double",
    ))
    spanning = sweep.spans(rows, 2024 * 12, 2026 * 12 + 11)
    assert sweep._events(spanning, {"rows": F.lit(1)}).count() == 2
    assert marts.active_months(rows, [date(2024 + m // 12, m % 12 + 1, 1) for m in range(36)], "calendar").count() == 36


def test_scores_need_no_facts_of_untouched_accounts(spark, tmp_path):
    store, day = _store(tmp_path, "touched"), date(2024, 6, 30)
    daily_run.run_day(spark, store, day, modes=CORRECTED)
    before = daily_run.state_table(spark, store)
    version = before.current_version()
    daily_run.refresh_account_state(spark, store, day, replace(CORRECTED))
    assert before.current_version() == version + 1
    written = list((Path(store.mart("account_state")) / "data" / f"version={version + 1}").rglob("*.parquet"))
    assert written == []


def test_keys_that_do_not_repeat_are_not_shuffled_whole(spark):
    """Few, many or no repeated keys and null keys: the rows of keep_last; without repeats no window is left."""
    from tenura.operators import clean

    rng = random.Random(4)
    rows = [(f"k{rng.randrange(300)}" if rng.random() < 0.95 else None, rng.randrange(5), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, day int, n int")
    expected = as_rows(clean.keep_last(df, ["k"], ["day"]))
    assert as_rows(clean.keep_last_of_few(df, ["k"], ["day"])) == expected
    assert as_rows(clean.keep_last_of_few(df, ["k"], ["day"], few=3)) == expected
    once = clean.keep_last_of_few(clean.keep_last(df, ["k"], ["day"]).select("k", "n"), ["n"])
    assert as_rows(once) == as_rows(clean.keep_last(df, ["k"], ["day"]).select("k", "n"))
    plain = spark.range(50)
    plan = clean.keep_last_of_few(plain, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_rows_of_one_load_are_read_without_a_shuffle(spark, tmp_path):
    """No key repeats in the first load: its readers collapse nothing; later loads are collapsed as ever."""
    store, upto = _store(tmp_path, "narrow"), FIRST + timedelta(days=40)
    daily_run.run_day(spark, store, upto, modes=CORRECTED)

    def plan(first=None):
        rows = daily_run.warehouse(spark, store, "fact_feature_usage", "pk", first)
        return rows._jdf.queryExecution().optimizedPlan().toString()

    assert "Window" not in plan() and "Window" not in plan(FIRST + timedelta(days=31))
    usage = TABLES["feature_usage"]
    index = daily_run.key_index(spark, store, usage)
    assert index.repeated().isEmpty() and index.newer_than_month(FIRST) == []


def test_index_lists_repeated_keys_and_the_loads_that_can_replace(spark, tmp_path):
    table, path = TABLES["feature_usage"], str(tmp_path)
    columns = "usage_id string, subscription_id string, usage_date date"
    loads = [
        [("U1", "S1", date(2024, 1, 5)), ("U2", "S2", date(2024, 5, 5))],
        [("U1", "S1", date(2024, 1, 6)), ("U3", "S3", date(2024, 3, 5)), ("U3", "S3", date(2024, 3, 6))],
        [("U2", "S2", date(2024, 2, 5))],
    ]
    commits = []
    for number, rows in enumerate(loads, 1):
        KeyIndex(spark, f"{path}/index", table, commits).add(spark.createDataFrame(rows, columns), f"c{number}")
        months = tuple(sorted({d.year * 100 + d.month for _, _, d in rows}))
        commits.append(Commit(f"c{number}", number, months))
    index = KeyIndex(spark, f"{path}/index", table, commits)
    ids = spark.createDataFrame([("U1",), ("U2",), ("U3",)], "id string").select(F.xxhash64("id").alias("key"), "id")
    assert sorted(r["id"] for r in index.repeated().join(ids, "key").collect()) == ["U1", "U2", "U3"]
    assert [c.name for c in index.newer_than_month(date(2024, 5, 1))] == ["c2", "c3"]
    assert [c.name for c in index.newer_than_month(date(2024, 3, 1))] == ["c2", "c3"]
    assert index.from_month(date(2024, 5, 1)) == [202402, 202405]


def test_revenue_lists_months_after_accounts_are_dealt_out(spark):
    """Nulls, markers outside of the months, and several tiers: sums by hand; months are never shuffled by account."""
    from tenura.functions.dates import month_number

    rng, spine = random.Random(9), [date(2024, m, 1) for m in range(1, 13)]
    rows = []
    for i in range(300):
        start = None if rng.random() < 0.05 else date(2023, 10, 1) + timedelta(days=rng.randrange(500))
        end = None if start is None or rng.random() < 0.05 else start + timedelta(days=rng.randrange(-20, 200))
        account = None if rng.random() < 0.1 else f"A{rng.randrange(20)}"
        mrr = None if rng.random() < 0.2 else float(rng.randrange(50))
        rows.append((account, rng.choice(["Pro", "Free", None]), start, end, mrr, mrr and mrr * 12, rng.randrange(9)))
    subs = spark.createDataFrame(
        rows, "account_id string, plan_tier string, start_date date, end_date date, mrr_amount double, arr_amount double, seats int"
    )
    churn = spark.createDataFrame([(f"A{i % 25}", date(2023, 12, 1) + timedelta(days=9 * i)) for i in range(60)] + [(None, None)], "account_id string, churn_date date")
    number = lambda d: d.year * 12 + d.month - 1
    for overlap in ("reference", "calendar"):
        first = subs.where("seats = 1")
        mart = marts._mrr(subs, churn, spine, overlap, first)
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.split("hashpartitioning(")[1:] if x.startswith("year") and "account_id" in x.split(")")[0]]
        new = {(r[0], number(r[2])) for r in rows if r[6] == 1 and r[2]}
        gone = {(r["account_id"], number(r["churn_date"])) for r in churn.collect() if r["churn_date"]}
        want = {}
        for account, tier, start, end, mrr, _, seats in rows:
            if start is None or end is None:
                continue
            for m in spine:
                if number(start) <= number(m) <= number(end) and (overlap == "calendar" or start.month <= m.month):
                    g = want.setdefault((m.year, m.month, tier), [set(), 0.0, 0, 0])
                    g[0].add((account, number(m)))
                    g[1] += mrr or 0.0
                    g[2] += mrr is not None
                    g[3] += seats
        got = {(r["year"], r["month"], r["plan_tier"]): r for r in mart.collect()}
        assert set(got) == set(want)
        for key, (accounts, mrr, priced, seats) in want.items():
            named, r = {a for a in accounts if a[0] is not None}, got[key]
            assert (r["active_accounts"], r["new_accounts"], r["churned_accounts"]) == (len(named), len(named & new), len(named & gone))
            assert (r["total_mrr"] or 0.0, r["total_seats"]) == (mrr, seats)
            assert not priced or abs(r["avg_mrr_per_account"] - mrr / priced) <= 0.0051


def test_rows_of_one_ingest_are_not_counted_by_key_again(spark, tmp_path, monkeypatch):
    """The lake rows of one ingest hold each key once; rows of two ingests are collapsed as ever."""
    store, usage, counted = _store(tmp_path, "once"), TABLES["feature_usage"], []
    plain = daily_run.keep_last_of_few
    monkeypatch.setattr(daily_run, "keep_last_of_few", lambda *a: counted.append(a) or plain(*a))
    columns = "usage_id string, subscription_id string, usage_date date, feature_name string, usage_count int, usage_duration_secs int, error_count int, is_beta_feature boolean"
    raw = spark.createDataFrame([(f"U{i % 9}", "S1", FIRST + timedelta(days=i), "api", i, 1, 0, False) for i in range(12)], columns)
    daily_run.ingest_table(spark, store, usage, FIRST + timedelta(days=20), raw)
    assert daily_run.transform_table(spark, store, usage, FIRST + timedelta(days=20)) == 9 and not counted
    for last in (30, 40):
        more = spark.createDataFrame([("U0", "S1", FIRST + timedelta(days=last), "api", last, 1, 0, False)], columns)
        daily_run.ingest_table(spark, store, usage, FIRST + timedelta(days=last), more)
    assert daily_run.transform_table(spark, store, usage, FIRST + timedelta(days=40)) == 1 and len(counted) == 1


def test_large_days_go_to_staging_in_their_tasks(spark, tmp_path, monkeypatch):
    """Rows of large day files are not shuffled by month, and the staged rows are the same."""
    from tenura.sources import lake

    found = {}
    for name, least in (("small", 1 << 30), ("large", 1)):
        monkeypatch.setattr(lake, "LARGE_FILE", least)
        store, ways = _store(tmp_path, name), []
        daily_run.ingest_all(spark, store, FIRST + timedelta(days=60))
        plain = lake.append_months
        monkeypatch.setattr(daily_run, "append_months", lambda *a, by_month=False: ways.append(by_month) or plain(*a, by_month=by_month))
        daily_run.transform_all(spark, store, FIRST + timedelta(days=60), CORRECTED)
        found[name] = {n: as_rows(daily_run.staged(spark, store, t).drop("_ingestion_time", "_batch_id")) for n, t in TABLES.items()}
        assert any(ways) == (name == "large")
    assert found["small"] == found["large"]
