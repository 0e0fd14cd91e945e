"""Registered queries: name -> (spark, folder of the supplied tables) -> frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import fixed_values as fv
from tenura.catalog import dirty
from tenura.functions.dates import month_key
from tenura.operators import clean, derive, dims, enrich, profile, quality, versioned
from tenura.operators.watermarks import BEFORE_START, Watermarks, current_watermarks
from tenura.plans import daily_run, health_state, marts, sweep, usage_state
from tenura.schemas import TABLES
from tenura.session import configure, cut, scratch_path
from tenura.sources import csv as csv_source
from tenura.sources import lake
from tenura.sources import testdata as td
from tenura.streaming import current_stream, ingest_stream

AS_OF = date(2026, 6, 30)
ONE_MONTH = (2025, 3)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register a query under its function name."""

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        return function(configure(spark), data_dir)

    QUERIES[function.__name__] = run
    return run


def facts(spark, d, **modes) -> DataFrame:
    return enrich.enrich_subscriptions(td.subscriptions(spark, d), **modes)


def _lifecycle(rows: DataFrame) -> DataFrame:
    return rows.select(
        "subscription_id", "account_id", "start_date", "end_date", "subscription_sequence",
        "days_active", "churn_flag", "reactivation_flag", "mrr_amount", "arr_amount",
    )


# --- marts ----------------------------------------------------------------------------


@query
def feature_usage_summary(spark, d):
    return marts.feature_usage_summary(td.feature_usage(spark, d))


@query
def feature_usage_one_month(spark, d):
    return marts.feature_usage_one_month(td.feature_usage(spark, d), *ONE_MONTH)


@query
def churn_summary(spark, d):
    return marts.churn_summary(td.churn_events(spark, d), td.subscriptions(spark, d))


@query
def churn_summary_active_base(spark, d):
    return marts.churn_summary(
        td.churn_events(spark, d), td.subscriptions(spark, d), denominator="active"
    )


@query
def churn_one_month(spark, d):
    return marts.churn_one_month(td.churn_events(spark, d), td.subscriptions(spark, d), *ONE_MONTH)


@query
def mrr_monthly_reference(spark, d):
    return marts.mrr_monthly(facts(spark, d), td.churn_events(spark, d), AS_OF)


@query
def mrr_monthly_sweep(spark, d):
    """The same as ``mrr_monthly_calendar``, from two rows a subscription instead of one a month."""
    return sweep.mrr_monthly_sweep(facts(spark, d), td.churn_events(spark, d), AS_OF)


@query
def feature_usage_from_state(spark, d):
    """Usage in three loads, the last with late rows of one feature, each added to the stored state."""
    usage, state = td.feature_usage(spark, d), usage_state.UsageState(spark, scratch_path(spark, "usage-state"))
    late = F.col("feature_name") == "api"
    early = F.col("usage_date") <= F.lit(date(2025, 6, 30))
    for load, rows in enumerate((usage.where(early & ~late), usage.where(~early), usage.where(early & late)), 1):
        state.add(rows, load)
    return state.mart()


@query
def mrr_monthly_calendar(spark, d):
    return marts.mrr_monthly(
        facts(spark, d), td.churn_events(spark, d), AS_OF, overlap="calendar", spine="calendar"
    )


@query
def mrr_monthly_refresh_reference(spark, d):
    return marts.mrr_monthly(
        facts(spark, d), td.churn_events(spark, d), AS_OF, refresh_from=202601, prefilter_starts=True
    )


@query
def mrr_monthly_refresh_corrected(spark, d):
    return marts.mrr_monthly(
        facts(spark, d), td.churn_events(spark, d), AS_OF,
        overlap="calendar", spine="calendar", refresh_from=202601,
    )


@query
def mrr_one_month(spark, d):
    return marts.mrr_one_month(facts(spark, d), td.churn_events(spark, d), *ONE_MONTH)


def _health(spark, d, subs, **modes) -> DataFrame:
    return marts.health_score(
        td.accounts(spark, d), subs, td.feature_usage(spark, d), td.churn_events(spark, d),
        td.support_tickets(spark, d), AS_OF, **modes,
    )


@query
def health_score_reference(spark, d):
    return _health(spark, d, facts(spark, d))


@query
def health_score_corrected(spark, d):
    subs = facts(spark, d, tail="as_of", as_of=AS_OF)
    return _health(spark, d, subs, unmatched="nulls", usage_upto_as_of=True)


@query
def health_affected_window(spark, d):
    subs = facts(spark, d)
    touched = marts.affected_accounts(
        subs, td.churn_events(spark, d), td.support_tickets(spark, d),
        date(2026, 5, 31), date(2026, 6, 30),
    )
    return _health(spark, d, subs, affected=touched)


# --- subscription lifecycle and source derivations ------------------------------------


@query
def subscription_lifecycle(spark, d):
    return _lifecycle(facts(spark, d))


@query
def subscription_lifecycle_split(spark, d):
    """As subscription_lifecycle, with accounts above 16 rows cut into slices."""
    return _lifecycle(facts(spark, d, hot_rows=16))


@query
def subscription_lifecycle_asof(spark, d):
    return _lifecycle(facts(spark, d, tail="as_of", as_of=AS_OF))


@query
def subscription_lifecycle_batch_scope(spark, d):
    batches = td.subscriptions(spark, d).withColumn("batch_month", month_key("start_date"))
    rows = enrich.enrich_subscriptions(batches, scope=["batch_month"])
    return _lifecycle(rows).withColumn("batch_month", month_key("start_date"))


@query
def plan_revenue(spark, d):
    rows = derive.with_plan_revenue(td.subscriptions(spark, d), dims.dim_plans(spark))
    return rows.select(
        "subscription_id", "plan_tier", "seats", "price", "gross_revenue", "discount_value",
        "mrr_amount", "arr_amount",
    )


@query
def plan_moves(spark, d):
    rows = derive.with_plan_moves(td.subscriptions(spark, d))
    return rows.select("subscription_id", "account_id", "plan_tier", "upgrade_flag", "downgrade_flag")


@query
def plan_moves_split(spark, d):
    """As plan_moves, with accounts above 16 rows cut into slices."""
    rows = derive.with_plan_moves(td.subscriptions(spark, d), hot_rows=16)
    return rows.select("subscription_id", "account_id", "plan_tier", "upgrade_flag", "downgrade_flag")


@query
def trial_flags(spark, d):
    rows = derive.with_trial_flag(td.subscriptions(spark, d))
    return rows.select("subscription_id", "account_id", "plan_tier", "is_trial")


def _churned_subs(spark, d) -> DataFrame:
    """Subscriptions with the churn flag their source system sets."""
    n = dirty.number_of("subscription_id")
    return td.subscriptions(spark, d).withColumn("churn_flag", n % 10 < 3)


@query
def reactivations(spark, d):
    rows = derive.with_reactivation(_churned_subs(spark, d))
    return rows.select("subscription_id", "account_id", "churn_flag", "is_reactivation")


@query
def churn_refunds(spark, d):
    subs = _churned_subs(spark, d).withColumn(
        "end_date", F.when(F.col("seats") % 3 == 0, F.col("start_date") + F.expr("interval 500 hours"))
        .otherwise(F.col("end_date"))
    )
    return derive.churn_events_from(derive.with_reactivation(derive.with_plan_moves(subs)))


@query
def account_churn_flag(spark, d):
    rows = derive.with_ever_churned(td.accounts(spark, d), td.churn_events(spark, d))
    return rows.select("account_id", "churn_flag")


@query
def ticket_satisfaction(spark, d):
    hours = (2 + dirty.number_of("ticket_id") % 700 / 10).alias("h")
    tickets = td.support_tickets(spark, d).withColumn("resolution_time_hours", hours)
    rows = derive.with_ticket_outcome(tickets)
    return rows.select(
        "ticket_id", "submitted_at", "closed_at", "escalation_flag", "satisfaction_score"
    )


# --- cleaning ---------------------------------------------------------------------------


def _cleaned(name: str, raw: DataFrame, columns: list[str]) -> DataFrame:
    typed = clean.standardise(raw, TABLES[name])
    return enrich.ENRICHERS[name](typed).select(*columns)


@query
def accounts_clean(spark, d):
    return _cleaned(
        "accounts", dirty.accounts(td.accounts(spark, d)),
        ["account_id", "account_name", "industry", "country", "signup_date", "referral_source",
         "plan_tier", "seats", "is_trial", "churn_flag"],
    )


@query
def churn_clean(spark, d):
    return _cleaned(
        "churn_events", dirty.churn_events(td.churn_events(spark, d)),
        ["churn_event_id", "account_id", "churn_date", "reason_code", "refund_amount_usd",
         "is_reactivation"],
    )


@query
def usage_clean(spark, d):
    return _cleaned(
        "feature_usage", dirty.feature_usage(td.feature_usage(spark, d)),
        ["usage_id", "subscription_id", "usage_date", "feature_name", "usage_count",
         "usage_duration_secs", "error_count", "is_beta_feature"],
    )


@query
def tickets_clean(spark, d):
    return _cleaned(
        "support_tickets", dirty.support_tickets(td.support_tickets(spark, d)),
        ["ticket_id", "account_id", "submitted_at", "closed_at", "resolution_time_hours",
         "priority", "first_response_time_minutes", "satisfaction_score", "escalation_flag"],
    )


@query
def usage_dedup_keep_last(spark, d):
    return clean.keep_last(td.feature_usage(spark, d), ["usage_id"], ["usage_date"])


@query
def ingest_window(spark, d):
    """Rows a run for 2025-06-30 would take after a watermark of 2025-03-31."""
    parts = [
        clean.newer_than(f(spark, d), TABLES[n].event_date, date(2025, 3, 31), date(2025, 6, 30))
        .groupBy(month_key(F.to_date(TABLES[n].event_date)).alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(n).alias("table_name"), "month", "rows")
        for n, f in td.SOURCES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def rolling_window(spark, d):
    """Rows per day in the 31 days checked for two batch dates."""
    parts = [
        clean.rolling_window(f(spark, d), TABLES[n].event_date, batch)
        .groupBy(F.to_date(TABLES[n].event_date).alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(n).alias("table_name"), F.lit(batch).alias("batch_date"), "day", "rows")
        for n, f in td.SOURCES.items()
        for batch in (date(2024, 1, 20), AS_OF)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def staging_align(spark, d):
    rows = clean.with_lineage(
        facts(spark, d), "transactional_system", "batch-1", "2026-07-01T00:00:00"
    ).withColumn("not_in_staging", F.lit("x"))
    return clean.flags_as_numbers(clean.align(rows, TABLES["subscriptions"].staging_schema))


@query
def schema_drift(spark, d):
    parts = [
        clean.drift_report(
            f(spark, d).withColumn("not_in_staging", F.col(TABLES[n].key)),
            TABLES[n].staging_schema, n,
        )
        for n, f in td.SOURCES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- dimensions ---------------------------------------------------------------------------


@query
def dim_date_starts(spark, d):
    """Every day of the date dimension with the subscriptions that start on it."""
    starts = (
        td.subscriptions(spark, d)
        .groupBy(F.col("start_date").alias("date_key"))
        .agg(F.count(F.lit(1)).alias("starts"))
    )
    return (
        dims.dim_date(spark)
        .join(starts, "date_key", "left")
        .withColumn("starts", F.coalesce("starts", F.lit(0)))
    )


@query
def dim_plans_subscriptions(spark, d):
    """Every plan with its subscriptions, seats and list revenue."""
    by_tier = (
        td.subscriptions(spark, d)
        .groupBy("plan_tier")
        .agg(F.count(F.lit(1)).alias("subscriptions"), F.sum("seats").alias("seats"))
    )
    return (
        dims.dim_plans(spark)
        .join(by_tier, "plan_tier", "left")
        .select(
            "plan_tier", "price_per_seat_usd", "billing_type", "description",
            F.coalesce("subscriptions", F.lit(0)).alias("subscriptions"),
            F.coalesce("seats", F.lit(0)).alias("seats"),
            (F.col("price_per_seat_usd") * F.coalesce("seats", F.lit(0))).alias("list_revenue"),
        )
    )


@query
def account_fact_counts(spark, d):
    """Rows of every fact per account; usage reaches its account over the subscription."""
    def per_account(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("account_id").agg(F.count(F.lit(1)).alias(name))

    subs = td.subscriptions(spark, d)
    used = (
        td.feature_usage(spark, d)
        .groupBy("subscription_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(subs.select("subscription_id", "account_id"), "subscription_id")
        .groupBy("account_id")
        .agg(F.sum("n").alias("usage_rows"))
    )
    counts = [
        per_account(subs, "subscriptions"),
        per_account(td.churn_events(spark, d), "churn_events"),
        per_account(td.support_tickets(spark, d), "tickets"),
        used,
    ]
    rows = td.accounts(spark, d).select("account_id", "plan_tier")
    rows = reduce(lambda left, right: left.join(right, "account_id", "left"), counts, rows)
    return rows.fillna(0, ["subscriptions", "churn_events", "tickets", "usage_rows"])


# --- versions, refreshes, incremental runs ---------------------------------------------------


def _versions(spark, d) -> DataFrame:
    """Up to three versions per subscription; the third may move the start date."""
    n = dirty.number_of("subscription_id")
    base = td.subscriptions(spark, d).select(
        "subscription_id", "account_id", "start_date", "plan_tier", "seats"
    )
    second = base.where(n % 3 == 0).withColumn("seats", F.col("seats") + 1)
    third = base.where(n % 5 == 0).withColumn(
        "start_date",
        F.when(n % 10 == 0, F.date_add("start_date", 1)).otherwise(F.col("start_date")),
    )
    return (
        versioned.with_version(third, 3000)
        .unionByName(versioned.with_version(base, 1000))
        .unionByName(versioned.with_version(second, 2000))
    )


@query
def latest_version(spark, d):
    return versioned.current_rows(_versions(spark, d), TABLES["subscriptions"])


@query
def latest_version_by_pk(spark, d):
    return versioned.current_rows(_versions(spark, d), TABLES["subscriptions"], "pk")


@query
def delete_insert(spark, d):
    """Target up to June 2025; new result from March 2025 on that lacks one feature."""
    usage = td.feature_usage(spark, d)
    target = marts.feature_usage_summary(usage.where("usage_date < date'2025-07-01'"))
    new = marts.feature_usage_summary(
        usage.where("feature_name <> 'export' and error_count < 3"), refresh_from=202503
    )
    return versioned.delete_insert(target, new, fv.MART_KEYS["feature_usage_summary"])


@query
def schema_evolution(spark, d):
    """Refresh of a mart that lacks one column and has one that was dropped since."""
    usage = td.feature_usage(spark, d)
    new = marts.feature_usage_summary(usage, refresh_from=202503)
    old = marts.feature_usage_summary(usage.where("usage_date < date'2025-07-01'"))
    old = old.drop("beta_usage_count").withColumn("grade", F.upper("feature_name"))
    return versioned.delete_insert(
        old, new, fv.MART_KEYS["feature_usage_summary"], on_schema_change="append"
    )


@query
def month_replace(spark, d):
    """Months written without one feature, then two of them replaced by full ones."""
    usage, path = td.feature_usage(spark, d), scratch_path(spark, "month-replace")
    versioned.replace_months(marts.feature_usage_summary(usage.where("feature_name <> 'api'")), path)
    for month in (ONE_MONTH, (2026, 2)):
        versioned.replace_months(marts.feature_usage_one_month(usage, *month), path)
    return spark.read.parquet(path)


@query
def month_highwater_refresh(spark, d):
    """A mart built in mid-June, refreshed later from its latest month on."""
    usage = td.feature_usage(spark, d)
    target = marts.feature_usage_summary(usage.where("usage_date <= date'2025-06-15'"))
    new = marts.feature_usage_summary(usage, refresh_from=marts.high_water_month(target))
    return versioned.delete_insert(target, new, fv.MART_KEYS["feature_usage_summary"])


@query
def late_rows_dropped(spark, d):
    """Rows a run after 2025-06-30 takes, leaves as late, or leaves for later."""
    usage, watermark, batch = td.feature_usage(spark, d), date(2025, 6, 30), date(2025, 12, 31)
    windows = {
        "taken": (watermark, batch), "late": (BEFORE_START, watermark), "not_yet": (batch, date(9999, 12, 30)),
    }
    parts = [
        clean.newer_than(usage, "usage_date", *window).select("feature_name", F.lit(name).alias("window"))
        for name, window in windows.items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("feature_name").agg(
        *[F.count_if(F.col("window") == name).alias(name) for name in windows]
    )


@query
def backfill_union(spark, d):
    """Half-year windows deduplicated one by one, then collapsed to the newest per id."""
    cuts = [date(2023, 12, 31), date(2024, 6, 30), date(2024, 12, 31), date(2025, 6, 30),
            date(2025, 12, 31), date(2026, 6, 30), date(2026, 12, 31)]
    usage = td.feature_usage(spark, d)
    windows = [
        versioned.with_version(
            clean.keep_last(clean.newer_than(usage, "usage_date", a, b), ["usage_id"], ["usage_date"]),
            number,
        )
        for number, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]
    union = reduce(DataFrame.unionByName, windows)
    return versioned.current_rows(union, TABLES["feature_usage"], "pk").drop("_updated_at")


@query
def watermark_state(spark, d):
    """Control rows of daily runs: one per table and day, and two kinds of reset."""
    days = reduce(
        DataFrame.unionByName,
        [
            f(spark, d)
            .select(F.lit(f"ingestion_{n}").alias("key"), F.to_date(TABLES[n].event_date).alias("day"))
            .distinct()
            for n, f in td.SOURCES.items()
        ],
    )
    log = days.select(
        "key", "day", F.lit(False).alias("reset"),
        F.datediff("day", F.lit(fv.FIRST_DAY)).cast("bigint").alias("seq"),
    )
    resets = (
        log.groupBy("key").agg(F.max("seq").alias("top"))
        .where(F.col("key").isin("ingestion_accounts", "ingestion_subscriptions"))
        .select(
            "key",
            F.when(F.col("key") == "ingestion_subscriptions", F.lit(fv.FIRST_DAY)).alias("day"),
            F.lit(True).alias("reset"),
            F.when(F.col("key") == "ingestion_subscriptions", F.col("top") + 1)
            .otherwise(F.col("top") - 10).alias("seq"),
        )
    )
    return current_watermarks(log.unionByName(resets))


@query
def warehouse_load(spark, d):
    """Staged usage of a window under a version, columns by name, summed per month."""
    table = TABLES["feature_usage"]
    staged = clean.align(
        clean.with_lineage(
            enrich.enrich_feature_usage(td.feature_usage(spark, d)), table.source_system, "b", "t"
        ),
        table.staging_schema,
    )
    rows = clean.event_window(staged, table.event_date, date(2024, 12, 31), date(2025, 12, 31))
    loaded = clean.align(versioned.with_version(rows, 1751328000000), table.warehouse_schema)
    return loaded.groupBy(
        month_key("usage_date").alias("month"), "_source_system", "_ingestion_time", "_updated_at"
    ).agg(F.count(F.lit(1)).alias("rows"), F.sum("usage_count").alias("uses"))


@query
def lake_roundtrip(spark, d):
    """Usage written to the day-partitioned lake and a range of days read back."""
    table, path = TABLES["feature_usage"], scratch_path(spark, "lake")
    lake.write_days(td.feature_usage(spark, d), path, table.event_date)
    rows = lake.read_days(spark, path, table.lake_schema, date(2025, 1, 31), date(2025, 7, 31))
    return rows.groupBy("usage_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("usage_count").alias("uses"),
        F.count("_batch_id").alias("with_batch_id"),
    )


@query
def csv_roundtrip(spark, d):
    """Accounts written as text with a header and read back through the cleaning step."""
    table, folder = TABLES["accounts"], scratch_path(spark, "csv")
    csv_source.write_csv(td.accounts(spark, d), f"{folder}/{table.file_name}")
    return clean.standardise(csv_source.read_raw(spark, folder, table), table)


@query
def ingest_stream_usage(spark, d):
    """Usage as text files in two arrivals, the second with all columns the other way round.

    The first arrival holds every id with a count of its own; the last row of an id counts.
    """
    table, folder = TABLES["feature_usage"], scratch_path(spark, "stream")
    usage = td.feature_usage(spark, d)
    arrivals = (usage.withColumn("usage_count", F.lit(1)), usage.select(*reversed(usage.columns)))
    for number, rows in enumerate(arrivals):
        csv_source.write_csv(rows, f"{folder}/raw/arrival={number}")
        ingest_stream.ingest_available(
            spark, f"{folder}/raw/arrival=*", f"{folder}/lake", f"{folder}/checkpoint", table
        )
    rows = ingest_stream.current_stream_rows(spark, f"{folder}/lake", table)
    return rows.groupBy(month_key("usage_date").alias("month"), "feature_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("usage_count").alias("uses")
    )


@query
def stream_upsert_usage(spark, d):
    """Usage in two arrivals, merged by key with a watermark of 30 days: the second repeats the first
    arrival's keys with other counts, and holds rows that are too late by then."""
    table, folder = TABLES["feature_usage"], scratch_path(spark, "upsert")
    usage = td.feature_usage(spark, d)
    first = usage.where(F.col("usage_date") <= F.lit(date(2025, 12, 31))).withColumn("usage_count", F.lit(1))
    for number, rows in enumerate((first, usage)):
        csv_source.write_csv(rows, f"{folder}/raw/arrival={number}")
        ingest_stream.ingest_available(spark, f"{folder}/raw/arrival=*", f"{folder}/lake", f"{folder}/checkpoint", table)
        current_stream.upsert_available(
            spark, f"{folder}/lake", f"{folder}/current", f"{folder}/checkpoint-current", table, "30 days"
        )
    rows = current_stream.current_table(spark, f"{folder}/current", table).read()
    return rows.groupBy(month_key("usage_date").alias("month"), "feature_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("usage_count").alias("uses")
    )


@query
def csv_records_in_parts(spark, d):
    """Churn events with line breaks and quotes in their feedback, read in parts of a file."""
    table, folder = TABLES["churn_events"], scratch_path(spark, "records")
    events = td.churn_events(spark, d)
    text = F.concat_ws("", "reason_code", F.lit(' said "no",\n'), "churn_event_id", F.lit("\n\nand left"))
    short = F.substring("churn_event_id", -1, 1) < "3"
    events = events.withColumn("feedback_text", F.when(short, text).otherwise(F.col("reason_code")))
    csv_source.write_csv(events, f"{folder}/{table.file_name}")
    rows = csv_source.read_raw_in_parts(spark, folder, table)
    return rows.select("churn_event_id", "account_id", F.to_date("churn_date").alias("churn_date"), "feedback_text")


@query
def daily_run_mrr(spark, d):
    """One wide run of every step; the revenue mart it leaves behind."""
    folder = scratch_path(spark, "daily-run")
    store = daily_run.Store(root=folder, raw_dir=f"{folder}/raw")
    sources = {n: f(spark, d) for n, f in td.SOURCES.items()}
    daily_run.run_day(spark, store, AS_OF, sources=sources)
    mart = versioned.VersionedTable(spark, store.mart("mrr_monthly")).read()
    return mart.drop("_refreshed_at")


# Runs in two steps, up to the end of May and of June 2026.  Several queries read what one run
# leaves behind, so each kind of run is made once per Spark application and folder of tables.
FIRST_STEP = date(2026, 5, 31)
_RUNS: dict[tuple, daily_run.Store] = {}


def _identity(spark, d) -> tuple:
    """Names, sizes and times of the tables, so that changed files are never answered by an old run."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{d}/*.parquet*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return tuple((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found)


def _new_store(spark, label: str) -> daily_run.Store:
    folder = scratch_path(spark, label)
    return daily_run.Store(root=folder, raw_dir=f"{folder}/raw")


def _once(kind: str, build):
    def store(spark, d) -> daily_run.Store:
        key = (spark.sparkContext.applicationId, d, _identity(spark, d), kind)
        if key not in _RUNS:
            _RUNS[key] = build(spark, d)
        return _RUNS[key]

    return store


def _stepwise(modes: daily_run.Modes):
    def build(spark, d) -> daily_run.Store:
        store = _new_store(spark, "steps")
        sources = {n: f(spark, d) for n, f in td.SOURCES.items()}
        daily_run.backfill(spark, store, date(2026, 5, 2), AS_OF, step_days=30, modes=modes, sources=sources)
        return store

    return build


def _by_month(spark, d) -> daily_run.Store:
    """All steps up to May; June is loaded, then refreshed by month and by touched accounts."""
    store = _new_store(spark, "month")
    sources = {n: f(spark, d) for n, f in td.SOURCES.items()}
    daily_run.run_day(spark, store, FIRST_STEP, sources=sources)
    daily_run.ingest_all(spark, store, AS_OF, sources)
    daily_run.transform_all(spark, store, AS_OF)
    daily_run.load_all(spark, store, AS_OF)
    daily_run.refresh_month(spark, store, AS_OF.year, AS_OF.month)
    daily_run.refresh_health(spark, store, FIRST_STEP, AS_OF)
    return store


# In history scope the last subscription of an untouched account keeps the tail of its own run,
# so the corrected steps take the tail that does not depend on the day of the run.
STEPS = {
    "reference": _once("reference", _stepwise(daily_run.Modes())),
    "corrected": _once("corrected", _stepwise(replace(daily_run.CORRECTED, tail="reference", health="window"))),
}
UNCHANGED_STEPS = _once("unchanged", _stepwise(daily_run.CORRECTED))
MONTH_STEPS = _once("month", _by_month)


def _mart_query(name: str, mart: str, store, text: str) -> None:
    def read(spark, d):
        return versioned.VersionedTable(spark, store(spark, d).mart(mart)).read().drop("_refreshed_at")

    read.__name__, read.__doc__ = name, text
    query(read)


for _mode, _store in STEPS.items():
    for _mart in fv.MART_KEYS:
        _mart_query(
            f"daily_run_incremental_{_mart}_{_mode}", _mart, _store,
            "The mart after two steps of a backfill: built in the first, refreshed in the second.",
        )
for _name, _mart in (
    ("mrr_month_refresh", "mrr_monthly"),
    ("churn_month_refresh", "churn_summary"),
    ("usage_month_refresh", "feature_usage_summary"),
    ("health_window_refresh", "customer_health_score"),
):
    _mart_query(_name, _mart, MONTH_STEPS, "The stored mart after a refresh of June alone.")


for _mart in fv.MART_KEYS:
    _mart_query(
        f"daily_run_corrected_steps_{_mart}", _mart, UNCHANGED_STEPS,
        "The mart after two steps with all corrected modes; the same as after one wide run.",
    )


@query
def changed_accounts_feed(spark, d):
    """Accounts whose facts stand in the loads of the second step, which the state is refreshed for."""
    store = UNCHANGED_STEPS(spark, d)
    new = {n: daily_run.loads(spark, store, n)[1:] for n in daily_run.STATE_SOURCES}
    return daily_run.changed_accounts(spark, store, new, daily_run.CORRECTED)


@query
def pk_rows_from_month(spark, d):
    """Current rows by primary key from June on, read from the months that the index of keys names."""
    store, first = UNCHANGED_STEPS(spark, d), date(2026, 6, 1)
    parts = [
        daily_run.warehouse(spark, store, t.warehouse_name, "pk", first)
        .groupBy(month_key(t.event_date).alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(t.name).alias("table_name"), "month", "rows")
        for t in TABLES.values()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def account_scores_later(spark, d):
    """Scores read from the state for a day 45 days after it was last refreshed."""
    store = UNCHANGED_STEPS(spark, d)
    state = daily_run.state_table(spark, store).read()
    return health_state.scores_on(state, AS_OF + timedelta(days=45))


@query
def backfill_run(spark, d):
    """Rows per month of every warehouse table that a backfill in two steps leaves behind."""
    store = STEPS["reference"](spark, d)
    parts = [
        daily_run.warehouse(spark, store, t.warehouse_name)
        .groupBy(month_key(t.event_date).alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(t.name).alias("table_name"), "month", "rows")
        for t in TABLES.values()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def late_data_run(spark, d):
    """Usage of one feature arrives after the watermark has passed it: what the lake then holds."""
    table, store, usage = TABLES["feature_usage"], _new_store(spark, "late"), td.feature_usage(spark, d)
    daily_run.ingest_table(spark, store, table, date(2025, 6, 30), usage.where("feature_name <> 'api'"))
    daily_run.ingest_table(spark, store, table, date(2025, 12, 31), usage)
    rows = lake.read_days(spark, store.lake(table.name), table.lake_schema, BEFORE_START, date(2025, 12, 31))
    return rows.groupBy("feature_name", month_key("usage_date").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("usage_count").alias("uses")
    )


@query
def watermark_replay(spark, d):
    """Rows taken by runs around a reset of one watermark and of all of them."""
    table, store, churn = TABLES["churn_events"], _new_store(spark, "replay"), td.churn_events(spark, d)
    state, key, rows = Watermarks(spark, store.watermarks), f"ingestion_{table.name}", []

    def run(step: str, upto: date) -> None:
        taken = daily_run.ingest_table(spark, store, table, upto, churn)
        rows.append((step, taken, state.all()[key]))

    run("first", date(2024, 6, 30))
    run("next", date(2024, 12, 31))
    run("earlier date", date(2024, 9, 30))
    state.reset(key)
    run("after reset", date(2024, 9, 30))
    state.reset_all()
    run("after reset of all", date(2024, 3, 31))
    return spark.createDataFrame(rows, "step string, taken bigint, watermark date")


# --- checks and profiles ------------------------------------------------------------------------


def _staged(spark, d) -> dict[str, DataFrame]:
    return {
        "accounts": td.accounts(spark, d),
        "subscriptions": dirty.faulty_subscriptions(facts(spark, d)),
        "churn_events": dirty.faulty_churn_events(td.churn_events(spark, d)),
        "feature_usage": td.feature_usage(spark, d),
        "support_tickets": dirty.faulty_tickets(td.support_tickets(spark, d)),
    }


@query
def dq_results(spark, d):
    return quality.check_tables(_staged(spark, d), TABLES)


@query
def dq_gate_status(spark, d):
    return quality.gate_status(quality.check_tables(_staged(spark, d), TABLES))


@query
def declarative_checks(spark, d):
    subs = cut(facts(spark, d))  # read by its own tests and by three marts
    accounts, churn = td.accounts(spark, d), td.churn_events(spark, d)
    usage, tickets = td.feature_usage(spark, d), td.support_tickets(spark, d)
    frames = {
        "dim_accounts": accounts,
        "dim_plans": dims.dim_plans(spark),
        "fact_subscriptions": dirty.faulty_subscriptions(subs),
        "fact_churn_events": dirty.faulty_churn_events(churn),
        "fact_feature_usage": usage,
        "fact_support_tickets": tickets,
        # Marts with row tests only are read once; the last one is read by its value tests too.
        "mrr_monthly": marts.mrr_monthly(subs, churn, AS_OF),
        "churn_summary": marts.churn_summary(churn, subs),
        "feature_usage_summary": marts.feature_usage_summary(usage),
        "customer_health_score": cut(
            marts.health_score(accounts, subs, usage, churn, tickets, AS_OF)
        ),
    }
    return quality.declared_tests(frames)


@query
def profile_columns(spark, d):
    return profile.profile_tables({n: f(spark, d) for n, f in td.SOURCES.items()})


CATEGORIES = {
    "accounts": ["industry", "plan_tier", "is_trial", "churn_flag", "referral_source", "country"],
    "subscriptions": ["plan_tier", "billing_frequency"],
    "churn_events": ["reason_code", "is_reactivation"],
    "feature_usage": ["feature_name", "is_beta_feature"],
    "support_tickets": ["priority", "escalation_flag"],
}


@query
def value_sets(spark, d):
    parts = [
        profile.value_sets(f(spark, d), CATEGORIES[n], n) for n, f in td.SOURCES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def event_ranges(spark, d):
    parts = [profile.date_range(f(spark, d), TABLES[n].event_date, n) for n, f in td.SOURCES.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def adhoc_filters(spark, d):
    """Row counts of the looks an analyst takes at the raw tables."""
    subs = derive.with_plan_moves(_churned_subs(spark, d)).agg(
        F.count_if("churn_flag").alias("churned"),
        F.count_if(F.col("account_id") == "A000000179").alias("one_account"),
        F.count_if(F.col("upgrade_flag") & (F.col("upgrade_flag") == F.col("downgrade_flag"))).alias("both_moves"),
        F.count_if(F.col("churn_flag") & F.col("upgrade_flag")).alias("churned_after_upgrade"),
    )
    churn = td.churn_events(spark, d).agg(
        F.count_if("is_reactivation").alias("reactivated"),
        F.count_if(F.col("refund_amount_usd") > 0).alias("refunded"),
    )
    return subs.unpivot([], subs.columns, "look", "rows").unionByName(
        churn.unpivot([], churn.columns, "look", "rows")
    )


@query
def stable_sample(spark, d):
    return profile.stable_sample(td.subscriptions(spark, d), "subscription_id", 200).select(
        "subscription_id", "account_id", "plan_tier", "seats"
    )
