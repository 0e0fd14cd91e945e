"""Columns of the source systems that follow from others: prices, moves, refunds, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura import fixed_values as fv
from tenura.functions.dates import whole_days
from tenura.functions.values import at_least, money
from tenura.operators.neighbours import HOT_ROWS, with_neighbours

SUBSCRIPTION_ORDER = ("start_date", "subscription_id")


def _by_tier(values: dict) -> Column:
    tier = F.col("plan_tier")
    chain = None
    for name, value in values.items():
        chain = (F if chain is None else chain).when(tier == name, F.lit(value))
    return chain


def with_plan_revenue(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """List revenue, discount by tier, net monthly and yearly revenue.

    A tier holds a large part of all rows, so the plans go to the rows and not the rows
    to the plans.
    """
    prices = plans.select("plan_tier", "price_per_seat_usd")
    gross = F.col("seats") * F.col("price_per_seat_usd")
    discount = money(F.col("gross_revenue") * _by_tier(fv.DISCOUNT_RATES))
    return (
        subs.join(prices, "plan_tier", "left")
        .withColumn("gross_revenue", money(gross))
        .withColumn("price", money(F.col("gross_revenue") / F.nullif(F.col("seats"), F.lit(0))))
        .withColumn("discount_value", discount)
        .withColumn("mrr_amount", money(F.col("gross_revenue") - F.col("discount_value")))
        .withColumn("arr_amount", money(F.col("mrr_amount") * 12))
        .drop("price_per_seat_usd")
    )


def with_plan_moves(subs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Upgrade / downgrade against the previous subscription; both false on the first."""
    rank = _by_tier({tier: i for i, tier in enumerate(fv.PLAN_TIERS)})
    placed = with_neighbours(
        subs.withColumn("_tier_rank", rank),
        ["account_id"],
        SUBSCRIPTION_ORDER,
        previous_of={"_previous_rank": "_tier_rank"},
        hot_rows=hot_rows,
    )
    now, before = F.col("_tier_rank"), F.col("_previous_rank")
    return placed.withColumns(
        {
            "upgrade_flag": F.coalesce(now > before, F.lit(False)),
            "downgrade_flag": F.coalesce(now < before, F.lit(False)),
        }
    ).drop("_tier_rank", "_previous_rank")


def _marked(subs: DataFrame, ids: DataFrame, flag: str) -> DataFrame:
    """Flag the subscriptions named by ids; the join key is unique, so it cannot be skewed."""
    return subs.join(ids.withColumn(flag, F.lit(True)), "subscription_id", "left").withColumn(
        flag, F.coalesce(flag, F.lit(False))
    )


def with_trial_flag(subs: DataFrame) -> DataFrame:
    """True for the first subscription of an account on each plan (so also for its first)."""
    earliest = (
        subs.groupBy("account_id", "plan_tier")
        .agg(F.min(F.struct(*SUBSCRIPTION_ORDER)).alias("_first"))
        .select("_first.subscription_id")
    )
    return _marked(subs, earliest, "is_trial")


def with_reactivation(subs: DataFrame) -> DataFrame:
    """Churned, but a later subscription of the account exists."""
    latest = (
        subs.groupBy("account_id")
        .agg(F.max(F.struct(*SUBSCRIPTION_ORDER)).alias("_last"))
        .select("_last.subscription_id")
    )
    return (
        _marked(subs, latest, "_is_last")
        .withColumn("is_reactivation", F.col("churn_flag") & ~F.col("_is_last"))
        .drop("_is_last")
    )


def churn_events_from(subs: DataFrame) -> DataFrame:
    """One churn event per churned subscription; short terms get part of the fee back."""
    days = whole_days(F.col("end_date"), F.col("start_date"))
    months = at_least(days / fv.REFUND_MONTH_DAYS, fv.REFUND_MIN_MONTHS)
    refund = money(F.col("mrr_amount") * months * fv.REFUND_SHARE)
    return subs.where("churn_flag").select(
        F.concat(F.lit("C"), F.expr("substring(subscription_id, 2)")).alias("churn_event_id"),
        "account_id",
        F.to_date("end_date").alias("churn_date"),
        F.when(days < fv.REFUND_TERM_DAYS, refund).otherwise(F.lit(0.0)).alias("refund_amount_usd"),
        F.col("upgrade_flag").alias("preceding_upgrade_flag"),
        F.col("downgrade_flag").alias("preceding_downgrade_flag"),
        "is_reactivation",
    )


def with_ever_churned(accounts: DataFrame, churn_events: DataFrame) -> DataFrame:
    """Account flag: at least one churn event exists."""
    churned = churn_events.select("account_id").distinct().withColumn("_churned", F.lit(True))
    return (
        accounts.drop("churn_flag")
        .join(churned, "account_id", "left")
        .withColumn("churn_flag", F.coalesce("_churned", F.lit(False)))
        .drop("_churned")
    )


def with_ticket_outcome(tickets: DataFrame) -> DataFrame:
    """Close time from the hours taken, and the score those hours and an escalation earn."""
    hours = F.col("resolution_time_hours")
    penalty = F.when(F.col("escalation_flag"), F.lit(fv.ESCALATION_PENALTY)).otherwise(F.lit(0))
    lowest = fv.SATISFACTION_RANGE[0]
    score = money(at_least(F.lit(fv.SATISFACTION_TOP) - hours / 24 - penalty, lowest))
    taken = F.make_dt_interval(secs=hours * 3600)
    return tickets.withColumns(
        {"closed_at": F.col("submitted_at") + taken, "satisfaction_score": score}
    )
