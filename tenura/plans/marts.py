"""The four marts and their single-month and affected-account forms.

Each function takes frames that hold one current row per key and returns the mart.  A
``refresh_from`` month key limits the result to that month and later ones.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura import fixed_values as fv
from tenura.functions.dates import month_number, month_spine
from tenura.functions.values import money, percent_or_zero, ratio
from tenura.operators.clean import event_window
from tenura.session import cut


def _from_month(df: DataFrame, column: str, refresh_from: int | None) -> DataFrame:
    """Rows of the month and later; a plain date bound, so that it reaches the file scan."""
    if refresh_from is None:
        return df
    return df.where(F.col(column) >= F.lit(date(refresh_from // 100, refresh_from % 100, 1)))


def _year_month(column: str) -> dict[str, Column]:
    return {"year": F.year(column), "month": F.month(column)}


# --- monthly recurring revenue ---------------------------------------------------


def active_months(subs: DataFrame, months: list[date], overlap: str = "reference") -> DataFrame:
    """One row per subscription and month it spans, with columns year and month.

    Every subscription lists its own months, so no join of ranges is needed.  The list is
    cut to the spine first: it never has more entries than the spine.

    ``calendar`` takes every month from start to end.  ``reference`` also asks that the
    month number is not below that of the start, so a term that starts in November is not
    active in the next January.
    """
    return _months_of_spans(_with_span(subs), months, overlap).drop("_first", "_last")


def _with_span(subs: DataFrame) -> DataFrame:
    """Rows with both dates, and the numbers of the months they start and end in."""
    dated = subs.where("start_date is not null and end_date is not null")
    return dated.withColumns({"_first": month_number(F.col("start_date")), "_last": month_number(F.col("end_date"))})


def _months_of_spans(spans: DataFrame, months: list[date], overlap: str) -> DataFrame:
    """One row per span (``_first`` and ``_last`` month) and month of it."""
    numbers = sorted(m.year * 12 + m.month - 1 for m in months)
    if not numbers:
        return spans.limit(0).withColumns({"year": F.lit(0), "month": F.lit(0)})
    first = F.greatest(F.col("_first"), F.lit(numbers[0]))
    last = F.least(F.col("_last"), F.lit(numbers[-1]))
    listed = (
        spans.where(first <= last)
        .withColumn("_month", F.explode(F.sequence(first, last)))
        .withColumns(
            {
                "year": F.floor(F.col("_month") / 12).cast("int"),
                "month": F.col("_month") % 12 + 1,
            }
        )
    )
    if len(numbers) != numbers[-1] - numbers[0] + 1:
        listed = listed.where(F.col("_month").isin(numbers))
    if overlap == "reference":
        listed = listed.where(F.col("_first") % 12 + 1 <= F.col("month"))
    return listed.drop("_month")


def _within(spans: DataFrame, months: list[date]) -> DataFrame:
    """Spans that touch the months, so that others are not shuffled."""
    numbers = [m.year * 12 + m.month - 1 for m in months]
    if not numbers:
        return spans.limit(0)
    return spans.where((F.col("_first") <= max(numbers)) & (F.col("_last") >= min(numbers)))


def _mrr(subs: DataFrame, churn: DataFrame, months: list[date], overlap: str,
         first_subs: DataFrame) -> DataFrame:
    """Revenue per month and tier over the given months.

    Subscriptions are first added up per account, tier, first and last month, with map-side combining, so a
    very large account is a bounded number of spans before anything is dealt by account.  Spans list
    their months only then: months, markers of new and churned accounts and the window that
    spreads a marker over the tiers of the account stay in the account's task.
    """
    keys, sums = ["year", "month", "account_id"], ["rows", "mrr", "priced", "arr", "seats"]
    spans = (
        _within(_with_span(subs), months)
        .groupBy("account_id", "plan_tier", "_first", "_last")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("mrr_amount").alias("mrr"),
            F.count("mrr_amount").alias("priced"),
            F.sum("arr_amount").alias("arr"),
            F.sum("seats").alias("seats"),
            F.lit(False).alias("is_new"),
            F.lit(False).alias("is_churned"),
        )
    )

    def markers(df: DataFrame, column: str, new: bool) -> DataFrame:
        marked = df.where(F.col(column).isNotNull()).select("account_id", month_number(F.col(column)).alias("_first")).distinct()
        none = {f.name: f.dataType for f in spans.schema.fields if f.name in ["plan_tier", *sums[1:]]}
        return marked.select(
            "account_id", "_first", F.col("_first").alias("_last"), F.lit(0).cast("bigint").alias("rows"),
            *[F.lit(None).cast(t).alias(n) for n, t in none.items()],
            F.lit(new).alias("is_new"), F.lit(not new).alias("is_churned"),
        )

    every = spans.unionByName(markers(first_subs, "start_date", True)).unionByName(markers(churn, "churn_date", False))
    per_account = (
        _months_of_spans(every.repartition("account_id"), months, overlap)
        .groupBy(*keys, "plan_tier")
        .agg(
            *[F.sum(n).alias(n) for n in sums],
            F.max("is_new").alias("is_new"),
            F.max("is_churned").alias("is_churned"),
        )
    )
    whole_account = Window.partitionBy(*keys)
    return (
        per_account.withColumns(
            {
                "is_new": F.max("is_new").over(whole_account),
                "is_churned": F.max("is_churned").over(whole_account),
            }
        )
        .where("rows > 0")
        .groupBy("year", "month", "plan_tier")
        .agg(
            F.count("account_id").alias("active_accounts"),
            F.count(F.when(F.col("is_new"), F.col("account_id"))).alias("new_accounts"),
            F.count(F.when(F.col("is_churned"), F.col("account_id"))).alias("churned_accounts"),
            money(F.sum("mrr")).alias("total_mrr"),
            money(F.sum("arr")).alias("total_arr"),
            money(ratio(F.sum("mrr"), F.sum("priced"))).alias("avg_mrr_per_account"),
            F.sum("seats").alias("total_seats"),
        )
    )


def mrr_monthly(
    subs: DataFrame,
    churn: DataFrame,
    as_of: date,
    *,
    overlap: str = "reference",
    spine: str = "reference",
    refresh_from: int | None = None,
    prefilter_starts: bool = False,
) -> DataFrame:
    """Active, new and churned accounts and revenue per year, month and plan tier.

    The average is per subscription row.  New and churned accounts count when they are
    also active in that month.  ``prefilter_starts`` drops subscriptions that began before
    the refreshed months, as an incremental run of the reference does; left off, a
    refreshed month equals the same month of a full build.
    """
    months = [m for m in month_spine(as_of, spine) if m.year * 100 + m.month >= (refresh_from or 0)]
    first_subs = _from_month(subs.where("subscription_sequence = 1"), "start_date", refresh_from)
    counted = _from_month(subs, "start_date", refresh_from) if prefilter_starts else subs
    return _mrr(counted, _from_month(churn, "churn_date", refresh_from), months, overlap, first_subs)


def mrr_one_month(
    subs: DataFrame, churn: DataFrame, year: int, month: int, overlap: str = "reference"
) -> DataFrame:
    this = date(year, month, 1)
    first_subs = in_month(subs.where("subscription_sequence = 1"), "start_date", year, month)
    return _mrr(subs, in_month(churn, "churn_date", year, month), [this], overlap, first_subs)


def in_month(df: DataFrame, column: str, year: int, month: int) -> DataFrame:
    first = date(year, month, 1)
    following = date(year + month // 12, month % 12 + 1, 1)
    return df.where((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(following)))


# --- churn --------------------------------------------------------------------------


def _churn_by(churn: DataFrame, *keys: str) -> DataFrame:
    return churn.groupBy(*keys, "reason_code").agg(
        F.count(F.lit(1)).alias("churn_count"),
        money(F.sum("refund_amount_usd")).alias("total_refund_usd"),
        F.count_if("is_reactivation").alias("reactivation_count"),
    )


def churn_summary(
    churn: DataFrame,
    subs: DataFrame,
    *,
    refresh_from: int | None = None,
    denominator: str = "starting",
    as_of: date | None = None,
) -> DataFrame:
    """Churn events, refunds, reactivations and churn rate per year, month and reason.

    ``starting`` divides by the accounts with a subscription that starts in the month;
    ``active`` divides by the accounts with a subscription that spans it.
    """
    events = _churn_by(
        _from_month(churn, "churn_date", refresh_from).withColumns(_year_month("churn_date")),
        "year", "month",
    )
    if denominator == "starting":
        base = _from_month(subs, "start_date", refresh_from).withColumns(_year_month("start_date"))
    else:
        months = month_spine(as_of or fv.LAST_DAY, "calendar")
        spans = _within(_with_span(subs), months).select("account_id", "_first", "_last").distinct()
        base = _months_of_spans(spans.repartition("account_id"), months, "calendar")
    accounts = base.groupBy("year", "month").agg(F.count_distinct("account_id").alias("accounts"))
    rate = percent_or_zero(F.col("churn_count"), F.col("accounts"))
    return events.join(accounts, ["year", "month"], "left").select(
        "year", "month", "reason_code", "churn_count", "total_refund_usd", "reactivation_count",
        money(rate).alias("churn_rate_pct"),
    )


def churn_one_month(
    churn: DataFrame, subs: DataFrame, year: int, month: int, overlap: str = "reference"
) -> DataFrame:
    """Churn of one month over the accounts whose subscription spans that month."""
    events = _churn_by(in_month(churn, "churn_date", year, month))
    spanning = active_months(subs, [date(year, month, 1)], overlap)
    accounts = spanning.agg(F.count_distinct("account_id")).scalar()
    return events.select(
        F.lit(year).alias("year"), F.lit(month).alias("month"),
        "reason_code", "churn_count", "total_refund_usd", "reactivation_count",
        money(percent_or_zero(F.col("churn_count"), accounts)).alias("churn_rate_pct"),
    )


# --- feature usage --------------------------------------------------------------------


def _usage_by(usage: DataFrame, *keys: str) -> DataFrame:
    total, subscriptions = F.sum("usage_count"), F.count_distinct("subscription_id")
    return usage.groupBy(*keys, "feature_name").agg(
        total.alias("total_usage_count"),
        F.sum("usage_duration_secs").alias("total_duration_secs"),
        F.sum("error_count").alias("total_error_count"),
        subscriptions.alias("unique_subscriptions"),
        money(ratio(total, subscriptions)).alias("avg_usage_per_sub"),
        F.count_if("is_beta_feature").alias("beta_usage_count"),
    )


def feature_usage_summary(usage: DataFrame, *, refresh_from: int | None = None) -> DataFrame:
    """Usage, time, errors and distinct subscriptions per year, month and feature.

    The beta column counts rows, not uses.
    """
    dated = _from_month(usage, "usage_date", refresh_from).withColumns(_year_month("usage_date"))
    return _usage_by(dated, "year", "month")


def feature_usage_one_month(usage: DataFrame, year: int, month: int) -> DataFrame:
    summary = _usage_by(in_month(usage, "usage_date", year, month))
    return summary.select(F.lit(year).alias("year"), F.lit(month).alias("month"), "*")


# --- customer health --------------------------------------------------------------------


def affected_accounts(
    subs: DataFrame, churn: DataFrame, tickets: DataFrame, after: date, upto: date | None = None
) -> DataFrame:
    """Distinct accounts with a subscription start, churn event or ticket after a day."""
    upto = upto or date(9999, 12, 30)
    parts = [
        event_window(df, column, after, upto).select("account_id")
        for df, column in ((subs, "start_date"), (churn, "churn_date"), (tickets, "submitted_at"))
    ]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


def _only(df: DataFrame, accounts: DataFrame | None) -> DataFrame:
    return df if accounts is None else df.join(accounts, "account_id", "left_semi")


def health_score(
    accounts: DataFrame,
    subs: DataFrame,
    usage: DataFrame,
    churn: DataFrame,
    tickets: DataFrame,
    as_of: date,
    *,
    unmatched: str = "reference",
    usage_upto_as_of: bool = False,
    affected: DataFrame | None = None,
) -> DataFrame:
    """Score, risk and recent activity per account.

    Every fact is added up per account before it is joined, with map-side combining, and
    usage per subscription before it meets the subscriptions, so no join sees the rows of
    a large account.  All sums are partitioned by account, as the joins need them.

    ``affected`` limits the result to those accounts, by semi joins on the facts; Spark, which
    knows the bytes, decides whether the keys are broadcast.

    Accounts without a subscription: ``reference`` reads the missing columns as 0, '' and
    1970-01-01, so the account counts as active, with an empty tier, idle since 1970.
    ``nulls`` leaves them unknown: tier of the account, no points for or against.
    """
    keys = None if affected is None else cut(affected)

    latest = (
        _only(subs, keys)
        .groupBy("account_id")
        .agg(
            F.max(
                F.struct("start_date", "subscription_id", "plan_tier", "mrr_amount", "churn_flag")
            ).alias("s")
        )
        .select(
            "account_id",
            F.col("s.plan_tier").alias("sub_tier"),
            F.col("s.mrr_amount").alias("mrr"),
            F.col("s.churn_flag").alias("churned"),
            F.col("s.start_date").alias("last_start"),
            F.lit(True).alias("has_sub"),
        )
    )
    recent = usage.where(F.col("usage_date") >= F.lit(as_of - timedelta(days=fv.USAGE_WINDOW_DAYS)))
    if usage_upto_as_of:
        recent = recent.where(F.col("usage_date") <= F.lit(as_of))
    used = (
        recent.groupBy("subscription_id")
        .agg(F.sum("usage_count").alias("uses"))
        .join(_only(subs, keys).select("subscription_id", "account_id"), "subscription_id")
        .groupBy("account_id")
        .agg(F.sum("uses").alias("uses"))
    )
    support = (
        _only(tickets, keys)
        .groupBy("account_id")
        .agg(
            F.avg("satisfaction_score").alias("satisfaction"),
            F.count_if((F.col("priority") == "high") & F.col("closed_at").isNull()).alias("open_high"),
            F.lit(True).alias("has_ticket"),
        )
    )
    base = accounts.select("account_id", "account_name", "plan_tier", "country", "industry")
    if affected is None:
        left = churn.select("account_id").distinct().withColumn("has_churn", F.lit(True))
        base = base.join(left, "account_id", "left")
    else:
        base = _only(base, keys)
    joined = (
        base.join(latest, "account_id", "left")
        .join(used, "account_id", "left")
        .join(support, "account_id", "left")
    )
    if affected is None:
        joined = joined.where("has_sub or has_ticket or has_churn")
    return scored(joined, as_of, unmatched)


def scored(joined: DataFrame, as_of: date, unmatched: str) -> DataFrame:
    """Score, risk and idle days from one row per account."""
    defaults = unmatched == "reference"

    def filled(name: str, value) -> Column:
        return F.coalesce(name, F.lit(value)) if defaults else F.col(name)

    tier = F.coalesce(filled("sub_tier", ""), F.col("plan_tier"))
    churned, mrr = filled("churned", False), filled("mrr", 0.0)
    idle = F.datediff(F.lit(as_of), filled("last_start", date(1970, 1, 1)))
    uses, open_high = F.coalesce("uses", F.lit(0)), F.coalesce("open_high", F.lit(0))
    satisfaction = F.col("satisfaction")

    def points(condition: Column, value: int) -> Column:
        return F.when(condition, F.lit(value)).otherwise(F.lit(0))

    score = (
        F.lit(fv.HEALTH_BASE)
        + points(~churned, fv.HEALTH_ACTIVE)
        + points(mrr > 0, fv.HEALTH_PAYING)
        + points(satisfaction >= fv.SATISFIED_FROM, fv.HEALTH_SATISFIED)
        + points(uses > 0, fv.HEALTH_USING)
        + points(churned, fv.HEALTH_CHURNED)
        + points(open_high > 0, fv.HEALTH_OPEN_HIGH)
        + points(idle > fv.IDLE_DAYS, fv.HEALTH_IDLE)
    )
    risk = (
        F.when(churned, "high")
        .when(uses == 0, "high")
        .when(idle > fv.IDLE_DAYS, "medium")
        .when(F.coalesce(satisfaction, F.lit(fv.SATISFACTION_WHEN_UNKNOWN)) < fv.UNSATISFIED_BELOW, "medium")
        .otherwise("low")
    )
    return joined.select(
        "account_id",
        "account_name",
        tier.alias("plan_tier"),
        "country",
        "industry",
        F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("bigint").alias("health_score"),
        money(F.coalesce(mrr, F.lit(0.0))).alias("mrr_last_month"),
        money(satisfaction).alias("avg_satisfaction"),
        uses.cast("bigint").alias("total_usage_30d"),
        open_high.cast("bigint").alias("open_high_tickets"),
        risk.alias("churn_risk"),
        idle.cast("bigint").alias("days_since_last_activity"),
    )


def with_refresh_time(mart: DataFrame) -> DataFrame:
    return mart.withColumn("_refreshed_at", F.current_timestamp())


def report_order(mart: DataFrame, name: str) -> DataFrame:
    """Sort a mart as its report shows it: months up, the largest group first."""
    largest = {
        "mrr_monthly": "total_mrr",
        "churn_summary": "churn_count",
        "feature_usage_summary": "total_usage_count",
    }[name]
    return mart.orderBy("year", "month", F.desc(largest))


def high_water_month(target: DataFrame | None) -> int | None:
    """Latest month of a mart as a month key; None asks for a full build."""
    if target is None:
        return None
    top = target.agg(F.max(F.col("year") * 100 + F.col("month"))).first()[0]
    return None if top is None else max(top, fv.FIRST_MONTH_KEY)
