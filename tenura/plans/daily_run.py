"""Daily run: raw files -> lake -> staging -> checks -> warehouse -> marts."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tenura import fixed_values as fv
from tenura.operators import quality
from tenura.operators.clean import (
    FEW_KEYS, align, event_window, keep_last, keep_last_of_few, newer_than, rolling_window,
    split_by_key, standardise, with_lineage,
)
from tenura.operators.dims import dim_plans
from tenura.operators.enrich import ENRICHERS
from tenura.operators.versioned import (
    VersionedTable, delete_insert, latest_version, numbers_of_folders, path_exists, with_version,
)
from tenura.operators.watermarks import BEFORE_START, Commit, Watermarks
from tenura.plans import health_state, marts
from tenura.schemas import TABLES, WAREHOUSE, SourceTable
from tenura.session import cut
from tenura.sources.csv import read_raw
from tenura.sources.key_index import KeyIndex
from tenura.sources.lake import append_months, large_days, read_days, read_months, write_days

log = logging.getLogger(__name__)


class RunError(Exception):
    """Names the tables that failed; the others of the step were still processed."""


@dataclass(frozen=True)
class Store:
    """Where the layers live.  Any file system Spark can reach."""

    root: str
    raw_dir: str

    def lake(self, table: str) -> str:
        return f"{self.root}/lake/{table}"

    def staging(self, table: str) -> str:
        return f"{self.root}/staging/{table}"

    def warehouse(self, table: str) -> str:
        return f"{self.root}/warehouse/{table}"

    def key_index(self, table: str) -> str:
        return f"{self.root}/index/{table}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    @property
    def watermarks(self) -> str:
        return f"{self.root}/state/watermarks"


@dataclass(frozen=True)
class Modes:
    """Semantic choices of a run; the defaults follow the reference as written."""

    scope: str = "batch"
    tail: str = "reference"
    overlap: str = "reference"
    spine: str = "reference"
    unmatched: str = "reference"
    prefilter_starts: bool = True
    collapse: str = "sort_key"
    denominator: str = "starting"
    usage_upto_as_of: bool = False
    health: str = "window"


CORRECTED = Modes(
    scope="history", tail="as_of", overlap="calendar", spine="calendar",
    unmatched="nulls", prefilter_starts=False, collapse="pk", usage_upto_as_of=True,
    health="changes",
)


def _now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()


def observed(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Write, and count ``rows`` and take further metrics in the same pass.

    When adaptive execution finds the input empty it drops the rest of the plan, the
    counter with it, and the finished write reports no count; any other failure is raised.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]))
    try:
        return seen.get
    except Py4JJavaError:
        if df.isEmpty():
            return {"rows": 0} | dict.fromkeys(metrics)
        raise


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    return observed(df, write)["rows"]


def ingest_table(
    spark: SparkSession, store: Store, table: SourceTable, batch_date: date,
    raw: DataFrame | None = None,
) -> int:
    """New rows of a raw table into the lake; the watermark moves only if there were any."""
    state, key = Watermarks(spark, store.watermarks), f"ingestion_{table.name}"
    watermark = state.get(key)
    raw = read_raw(spark, store.raw_dir, table) if raw is None else raw
    if raw is None:
        log.warning("%s: no raw file, skipped", table.name)
        return 0
    new = newer_than(standardise(raw, table), table.event_date, watermark, batch_date)
    unique = keep_last(new, [table.key], [table.event_date])
    batch, at = str(uuid.uuid4()), _now()

    def stamped(df: DataFrame) -> DataFrame:
        return with_lineage(df, table.source_system, batch, at)

    written = _counted(unique, lambda df: write_days(df, store.lake(table.name), table.event_date, stamped))
    if written:
        state.set(key, batch_date)
    return written


def _append(
    df: DataFrame, folder: str, table: SourceTable, state: Watermarks, key: str, day: date,
    *, even_if_empty: bool = False, also: Callable[[DataFrame, str], None] | None = None,
    by_month: bool = False,
) -> int:
    """Rows into a folder of their own, then watermark and folder into the control table at once.

    ``also`` writes what goes with the rows, from the rows as written, before they become visible.
    """
    spark, commit = df.sparkSession, uuid.uuid4().hex
    path = f"{folder}/commit={commit}"
    written = _counted(df, lambda rows: append_months(rows, path, table.event_date, table.sort_key, by_month=by_month))
    if not written:
        if even_if_empty:
            state.set(key, day)
        return 0
    if also is not None:
        also(read_months(spark, path, df.schema), commit)
    state.set(key, day, commit, numbers_of_folders(spark, path, "_month"))
    return written


def transform_table(
    spark: SparkSession, store: Store, table: SourceTable, batch_date: date, modes: Modes = Modes()
) -> int:
    """New lake days into staging; the watermark moves only if there were any rows.

    With scope ``history`` the subscriptions of every account in the new days are worked
    out again over all their days, so that daily runs and one wide run agree.
    """
    state, key = Watermarks(spark, store.watermarks), f"transform_{table.name}"
    watermark = state.get(key)
    lake = store.lake(table.name)
    new = read_days(spark, lake, table.lake_schema, watermark, batch_date)
    if new is None:
        return 0
    order = [table.event_date, "_ingestion_time"]
    extra, history = {}, False
    once = _one_batch(new, lake)
    if table.name == "subscriptions":
        extra = {"tail": modes.tail, "as_of": batch_date, "interval": True}
        history = modes.scope == "history"
        if history and watermark <= BEFORE_START:  # the new days are all days
            new = new.where("account_id is not null").withColumn("_ingestion_time", F.lit(_now()))
        elif history:
            touched = new.select("account_id").distinct()
            everything = read_days(spark, lake, table.lake_schema, BEFORE_START, batch_date)
            once = False
            new = everything.join(touched, "account_id", "left_semi").withColumn(
                "_ingestion_time", F.lit(_now())
            )
    unique = new if once else keep_last_of_few(new, [table.key], order)
    rows = align(ENRICHERS[table.name](unique, **extra), table.kept_schema)
    as_read = once and table.name != "subscriptions" and large_days(new)
    return _append(rows, store.staging(table.name), table, state, key, batch_date, by_month=as_read)


def _one_batch(rows: DataFrame, lake: str) -> bool:
    """Whether all lake rows come from one ingest, which writes each key once.

    A file stream does not: its rows stand below the number of their micro-batch.
    """
    if path_exists(rows.sparkSession, f"{lake}/year=*/month=*/day=*/_*=*"):
        return False
    batches = rows.select("_batch_id").distinct().limit(2).collect()
    return len(batches) == 1 and batches[0][0] is not None


def staged(spark: SparkSession, store: Store, table: SourceTable, first=None, last=None) -> DataFrame:
    commits = Watermarks(spark, store.watermarks).commits(f"transform_{table.name}")
    return read_months(spark, store.staging(table.name), table.kept_schema, first, last, commits)


def check_batch(spark: SparkSession, store: Store, batch_date: date) -> DataFrame:
    """Results of all checks on the 31 days up to the batch date, as one frame."""
    first = max(batch_date - timedelta(days=fv.CHECK_WINDOW_DAYS), fv.FIRST_DAY)
    frames = {
        t.name: rolling_window(staged(spark, store, t, first, batch_date), t.event_date, batch_date)
        for t in TABLES.values()
    }
    return quality.check_tables(frames, TABLES)


def load_table(
    spark: SparkSession, store: Store, table: SourceTable, load_date: date, modes: Modes = Modes()
) -> int:
    """New staging rows into the warehouse table under a new version, columns by name.

    Staging may hold a row twice after a reset; one load writes each key once, so that a
    version of a key is one row.
    """
    state, key = Watermarks(spark, store.watermarks), f"warehouse_{table.warehouse_name}"
    watermark = state.get(key)
    rows = event_window(
        staged(spark, store, table, watermark, load_date), table.event_date, watermark, load_date
    )
    history = table.name == "subscriptions" and modes.scope == "history"
    commits = Watermarks(spark, store.watermarks).commits(f"transform_{table.name}")
    # A transform writes each primary key once, so rows of a single commit hold no key twice.
    single = len(commits) <= 1
    if history and single and watermark <= BEFORE_START:  # the window holds all rows of the only commit
        rows, history = rows.where("account_id is not null"), False
    elif history:
        touched = rows.select("account_id").distinct()
        known = staged(spark, store, table, None, load_date)
        known = known.where(F.col(table.event_date) <= F.lit(load_date))
        rows = known.join(touched, "account_id", "left_semi")
    unique = rows if single else keep_last(rows, _collapse_key(table, modes.collapse), ["_ingestion_time"])
    versioned = align(with_version(unique, time.time_ns() // 1_000_000), table.stored_schema)
    index = key_index(spark, store, table)
    return _append(
        versioned, store.warehouse(table.warehouse_name), table, state, key, load_date,
        even_if_empty=True, also=lambda written, commit: index.add(written, commit, unique=single),
        by_month=single and not history,
    )


def loads(spark: SparkSession, store: Store, name: str) -> list[Commit]:
    """Commits of a warehouse table, oldest first."""
    return Watermarks(spark, store.watermarks).commits(f"warehouse_{name}")


def key_index(spark: SparkSession, store: Store, table: SourceTable) -> KeyIndex:
    name = table.warehouse_name
    return KeyIndex(spark, store.key_index(name), table, loads(spark, store, name))


def _collapse_key(table: SourceTable, collapse: str) -> tuple[str, ...]:
    return table.sort_key if collapse == "sort_key" else (table.key,)


def warehouse(
    spark: SparkSession,
    store: Store,
    name: str,
    collapse: str = "sort_key",
    first: date | None = None,
    accounts: DataFrame | None = None,
    subscriptions: DataFrame | None = None,
) -> DataFrame:
    """Current rows of a warehouse table, from the month of ``first`` on, of some accounts or subscriptions.

    Months and accounts are left out before versions are collapsed, which is exact where
    the event date or the account is part of the collapse key: all versions of a row then
    agree in it.  For other keys the index of keys names the months that hold any version of the rows
    asked for; only those are read, and rows that turn out to lie outside are left out afterwards.
    Of months before ``first`` only loads are read that are newer than the oldest load of later months, since
    others hold no newer version; and only keys that the index lists as repeated are collapsed, unless they are many.
    """
    if name == "dim_plans":
        return dim_plans(spark)
    table = WAREHOUSE[name]
    key = _collapse_key(table, collapse)
    commits = loads(spark, store, name)
    wanted = {"account_id": accounts, "subscription_id": subscriptions}
    wanted = {c: df for c, df in wanted.items() if df is not None and c in table.sort_key}
    dated, months = table.event_date in key, None
    index = KeyIndex(spark, store.key_index(name), table, commits)
    if not dated:
        named = [index.of(df, c) for c, df in wanted.items()]
        named += [index.from_month(first)] if first is not None else []
        months = sorted(set.intersection(*map(set, named))) if named else None

    def stored(first: date | None, commits: list[Commit], months: list[int] | None) -> DataFrame:
        return read_months(spark, store.warehouse(name), table.stored_schema, first, None, commits, months)

    if dated or first is None:
        rows = stored(first if dated else None, commits, months)
    else:
        least = first.year * 100 + first.month
        rows = stored(None, commits, [m for m in months if m >= least]).unionByName(
            stored(None, index.newer_than_month(first), [m for m in months if m < least])
        )
    for column, df in wanted.items():
        if column in key:
            rows = rows.join(df, column, "left_semi")
    current = _collapsed(rows, key, table, index.repeated())
    for column, df in wanted.items():
        if column not in key:
            current = current.join(df, column, "left_semi")
    if first is not None and not dated:
        current = current.where(F.col(table.event_date) >= F.lit(first.replace(day=1)))
    return current


def _collapsed(
    rows: DataFrame, key: tuple[str, ...], table: SourceTable, repeated: DataFrame | None
) -> DataFrame:
    """``latest_version``, with only the rows of repeated primary keys shuffled if these are few."""
    found = None if repeated is None else repeated.count()
    if found is None or found > FEW_KEYS:
        return latest_version(rows, key)
    if not found:
        return rows
    single, several = split_by_key(rows, [table.key], repeated)
    return single.unionByName(latest_version(several, key))


def _first_day(month: int | None) -> date | None:
    return None if month is None else date(month // 100, month % 100, 1)


def refresh_marts(
    spark: SparkSession, store: Store, as_of: date, modes: Modes = Modes()
) -> dict[str, int]:
    """Recompute what is new in each mart, replace rows with the same key, keep the rest.

    An absent or empty mart is built in full.
    """
    def fact(name: str, first: date | None = None, accounts: DataFrame | None = None) -> DataFrame:
        return warehouse(spark, store, name, modes.collapse, first, accounts)

    tables = {name: mart_table(spark, store, name) for name in fv.MART_KEYS}
    targets = {name: t.read() for name, t in tables.items()}
    mrr_from, churn_from, usage_from = (
        marts.high_water_month(targets[name])
        for name in ("mrr_monthly", "churn_summary", "feature_usage_summary")
    )
    subs = fact("fact_subscriptions")
    health = "customer_health_score"
    if modes.health == "window":
        scores, affected = targets[health], None
        if scores is not None and not scores.isEmpty():
            affected = _affected(fact, as_of - timedelta(days=2))
    fresh = {
        "mrr_monthly": marts.mrr_monthly(
            subs, fact("fact_churn_events", _first_day(mrr_from)), as_of,
            overlap=modes.overlap, spine=modes.spine, refresh_from=mrr_from,
            prefilter_starts=modes.prefilter_starts and mrr_from is not None,
        ),
        "churn_summary": marts.churn_summary(
            fact("fact_churn_events", _first_day(churn_from)),
            fact("fact_subscriptions", _first_day(churn_from)) if modes.denominator == "starting" else subs,
            refresh_from=churn_from, denominator=modes.denominator, as_of=as_of,
        ),
        "feature_usage_summary": marts.feature_usage_summary(
            fact("fact_feature_usage", _first_day(usage_from)), refresh_from=usage_from
        ),
    }
    if modes.health == "window":
        fresh[health] = _scores(fact, as_of, modes, affected)
    published = {
        name: _publish(
            tables[name], new, lambda old, new, name=name: delete_insert(old, new, fv.MART_KEYS[name])
        )
        for name, new in fresh.items()
    }
    if modes.health == "changes":  # every score can change with the day: the mart is written whole
        refresh_account_state(spark, store, as_of, modes)
        scores = health_state.scores_on(state_table(spark, store).read(), as_of, modes.unmatched)
        published[health] = tables[health].publish(marts.with_refresh_time(scores))
    return published


def mart_table(spark: SparkSession, store: Store, name: str) -> VersionedTable:
    """A stored mart: monthly ones by month, scores by a hash of the account."""
    monthly = "month" in fv.MART_KEYS[name]
    bucket = F.expr("year * 100 + month") if monthly else health_state.state_bucket()
    return VersionedTable(spark, store.mart(name), bucket)


def state_table(spark: SparkSession, store: Store) -> VersionedTable:
    return VersionedTable(spark, store.mart("account_state"), health_state.state_bucket())


STATE_SOURCES = ("dim_accounts", "fact_subscriptions", "fact_churn_events", "fact_support_tickets", "fact_feature_usage")


def changed_accounts(
    spark: SparkSession, store: Store, new: dict[str, list[Commit]], modes: Modes
) -> DataFrame:
    """Accounts with a row in these loads; usage counts for the account of its subscription."""
    def fed(name: str) -> DataFrame:
        table = WAREHOUSE[name]
        return read_months(spark, store.warehouse(name), table.stored_schema, commits=new[name])

    direct = [fed(n).select("account_id") for n in STATE_SOURCES if n != "fact_feature_usage"]
    used = cut(fed("fact_feature_usage").select("subscription_id").distinct())
    owners = warehouse(spark, store, "fact_subscriptions", modes.collapse, subscriptions=used)
    every = [*direct, owners.select("account_id")]
    return cut(reduce(DataFrame.unionByName, every).where("account_id is not null").distinct())


def refresh_account_state(
    spark: SparkSession, store: Store, as_of: date, modes: Modes = Modes()
) -> int:
    """Bring the state of the accounts up to the loads; returns the state's version."""
    table = state_table(spark, store)
    commits = {name: loads(spark, store, name) for name in STATE_SOURCES}
    seen = table.marks()
    new = {name: [c for c in listed if c.seq > seen.get(name, 0)] for name, listed in commits.items()}
    upto = {name: listed[-1].seq for name, listed in commits.items() if listed}
    affected = changed_accounts(spark, store, new, modes) if table.current_version() else None

    def fact(name: str, first: date | None = None) -> DataFrame:
        return warehouse(spark, store, name, modes.collapse, first, affected)

    state = health_state.account_state(
        fact("dim_accounts"), fact("fact_subscriptions"),
        fact("fact_feature_usage", as_of - timedelta(days=fv.USAGE_WINDOW_DAYS)),
        fact("fact_churn_events"), fact("fact_support_tickets"), as_of, affected,
    )
    return table.upsert(cut(state), lambda old, rows: delete_insert(old, rows, ["account_id"]), upto)


def _affected(fact: Callable[..., DataFrame], after: date, upto: date | None = None) -> DataFrame:
    names = ("fact_subscriptions", "fact_churn_events", "fact_support_tickets")
    return cut(marts.affected_accounts(*[fact(n, after) for n in names], after, upto))


def _scores(
    fact: Callable[..., DataFrame], as_of: date, modes: Modes, affected: DataFrame | None
) -> DataFrame:
    return marts.health_score(
        fact("dim_accounts", accounts=affected),
        fact("fact_subscriptions", accounts=affected),
        fact("fact_feature_usage", as_of - timedelta(days=fv.USAGE_WINDOW_DAYS)),
        fact("fact_churn_events"),
        fact("fact_support_tickets", accounts=affected),
        as_of, unmatched=modes.unmatched, usage_upto_as_of=modes.usage_upto_as_of, affected=affected,
    )


def _publish(
    table: VersionedTable, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
    also: tuple[int, ...] = (),
) -> int:
    """New rows merged into the stored ones; only buckets that hold some of them are written."""
    return table.upsert(cut(marts.with_refresh_time(new)), merge, also=also)


def refresh_month(
    spark: SparkSession, store: Store, year: int, month: int, modes: Modes = Modes()
) -> dict[str, int]:
    """Replace one month of the monthly marts by what the warehouse holds; other months stay."""
    day = date(year, month, 1)

    def fact(name: str, first: date | None = None) -> DataFrame:
        return warehouse(spark, store, name, modes.collapse, first)

    def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
        others = old.where((F.col("year") != year) | (F.col("month") != month))
        return others.unionByName(new, allowMissingColumns=True)

    subs, churn = fact("fact_subscriptions"), fact("fact_churn_events", day)
    fresh = {
        "mrr_monthly": marts.mrr_one_month(subs, churn, year, month, modes.overlap),
        "churn_summary": marts.churn_one_month(churn, subs, year, month),
        "feature_usage_summary": marts.feature_usage_one_month(
            fact("fact_feature_usage", day), year, month
        ),
    }
    return {
        name: _publish(mart_table(spark, store, name), new, replaced, also=(year * 100 + month,))
        for name, new in fresh.items()
    }


def refresh_health(
    spark: SparkSession, store: Store, after: date, upto: date, modes: Modes = Modes()
) -> dict[str, int]:
    """Score the accounts with an event after one day and not after another; as of the latter."""
    def fact(name: str, first: date | None = None, accounts: DataFrame | None = None) -> DataFrame:
        return warehouse(spark, store, name, modes.collapse, first, accounts)

    name = "customer_health_score"
    new = _scores(fact, upto, modes, _affected(fact, after, upto))
    merge = lambda old, new: delete_insert(old, new, fv.MART_KEYS[name])
    return {name: _publish(mart_table(spark, store, name), new, merge)}


def _each(step: str, tables: Iterable[SourceTable], work: Callable[[SourceTable], int]) -> dict:
    """Run a step for all tables side by side; they share no files.

    One failure does not stop the others but is raised at the end.
    """
    def one(table: SourceTable) -> dict:
        try:
            return {"status": "ok", "rows": work(table)}
        except Exception as exc:  # noqa: BLE001 - reported below with the table's name
            log.exception("%s failed for %s", step, table.name)
            return {"status": "error", "error": str(exc)}

    tables = list(tables)
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        summary = dict(zip((t.name for t in tables), pool.map(one, tables)))
    failed = [name for name, result in summary.items() if result["status"] == "error"]
    if failed:
        raise RunError(f"{step} failed for tables: {failed}")
    return summary


Sources = dict[str, DataFrame]


def ingest_all(
    spark: SparkSession, store: Store, batch_date: date, sources: Sources | None = None
) -> dict:
    """Raw rows into the lake, from files or from given frames of raw rows."""
    given = sources or {}
    return _each(
        "ingest", TABLES.values(),
        lambda t: ingest_table(spark, store, t, batch_date, given.get(t.name)),
    )


def transform_all(
    spark: SparkSession, store: Store, batch_date: date, modes: Modes = Modes()
) -> dict:
    return _each(
        "transform", TABLES.values(), lambda t: transform_table(spark, store, t, batch_date, modes)
    )


def load_all(spark: SparkSession, store: Store, load_date: date, modes: Modes = Modes()) -> dict:
    return _each("load", TABLES.values(), lambda t: load_table(spark, store, t, load_date, modes))


def run_day(
    spark: SparkSession, store: Store, batch_date: date, *,
    as_of: date | None = None, modes: Modes = Modes(), sources: Sources | None = None,
) -> dict:
    """All steps for one date; a failed check stops the run before the warehouse."""
    return {
        "ingest": ingest_all(spark, store, batch_date, sources),
        "transform": transform_all(spark, store, batch_date, modes),
        "checks": quality.enforce(check_batch(spark, store, batch_date)),
        "load": load_all(spark, store, batch_date, modes),
        "marts": refresh_marts(spark, store, as_of or batch_date, modes),
    }


def backfill(
    spark: SparkSession, store: Store, first: date, last: date, *,
    step_days: int = 1, modes: Modes = Modes(), sources: Sources | None = None,
) -> list[dict]:
    """Replay a range of dates in steps; one step over the whole range is one wide run."""
    results, day = [], first
    while day <= last:
        upto = min(day + timedelta(days=step_days - 1), last)
        results.append(run_day(spark, store, upto, modes=modes, sources=sources))
        day = upto + timedelta(days=1)
    return results
