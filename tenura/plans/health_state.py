"""Health scores from a small stored state per account, refreshed by what the loads have changed.

The state of an account is what its facts say without a reading day: the last subscription with
its bounds of validity, sums of satisfaction, open tickets, and its usage by day.  A refresh finds the accounts
whose facts stand in loads that the state has not seen, works their state out again, and replaces it; how
far the loads have been seen becomes visible with the state.  Scores are then read from the state
for any day, for all accounts, without the facts: idle days, the 30 days of usage and the churn of a last
subscription are decided by the day of reading.  So steps of any length leave the scores of one wide run.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura import fixed_values as fv
from tenura.operators.enrich import churned_on
from tenura.plans.marts import scored

BUCKETS = 64


def state_bucket() -> Column:
    return F.pmod(F.xxhash64("account_id"), F.lit(BUCKETS))


def only(df: DataFrame, accounts: DataFrame | None) -> DataFrame:
    return df if accounts is None else df.join(accounts, "account_id", "left_semi")


def account_state(
    accounts: DataFrame,
    subs: DataFrame,
    usage: DataFrame,
    churn: DataFrame,
    tickets: DataFrame,
    as_of: date,
    affected: DataFrame | None = None,
) -> DataFrame:
    """One row per account, of the affected ones if given; facts are added up before they are joined.

    Usage is kept by day for the 30 days before ``as_of``: later readings look back less far.
    """
    last = (
        only(subs, affected)
        .groupBy("account_id")
        .agg(
            F.max(
                F.struct(
                    "start_date", "subscription_id", "plan_tier", "mrr_amount", "next_start_at", "ended_at"
                )
            ).alias("s")
        )
        .select(
            "account_id",
            F.col("s.plan_tier").alias("sub_tier"),
            F.col("s.mrr_amount").alias("mrr"),
            F.col("s.start_date").alias("last_start"),
            F.col("s.next_start_at").alias("next_start_at"),
            F.col("s.ended_at").alias("ended_at"),
            F.lit(True).alias("has_sub"),
        )
    )
    support = (
        only(tickets, affected)
        .groupBy("account_id")
        .agg(
            F.sum("satisfaction_score").alias("satisfaction_sum"),
            F.count("satisfaction_score").alias("satisfaction_rows"),
            F.count_if((F.col("priority") == "high") & F.col("closed_at").isNull()).alias("open_high"),
            F.lit(True).alias("has_ticket"),
        )
    )
    window = F.col("usage_date").between(F.lit(as_of - timedelta(days=fv.USAGE_WINDOW_DAYS)), F.lit(as_of))
    used = (
        usage.where(window)
        .groupBy("subscription_id", "usage_date")
        .agg(F.sum("usage_count").alias("uses"))
        .join(only(subs, affected).select("subscription_id", "account_id"), "subscription_id")
        .groupBy("account_id", "usage_date")
        .agg(F.sum("uses").alias("uses"))
        .groupBy("account_id")
        .agg(F.array_sort(F.collect_list(F.struct("usage_date", "uses"))).alias("usage_by_day"))
    )
    left = only(churn, affected).select("account_id").distinct().withColumn("has_churn", F.lit(True))
    base = only(accounts, affected).select("account_id", "account_name", "plan_tier", "country", "industry")
    return (
        base.join(last, "account_id", "left")
        .join(used, "account_id", "left")
        .join(support, "account_id", "left")
        .join(left, "account_id", "left")
    )


def uses_on(as_of: date) -> Column:
    """Usage of the 30 days before a day, from the sums by day."""
    first = as_of - timedelta(days=fv.USAGE_WINDOW_DAYS)
    recent = F.filter("usage_by_day", lambda d: d["usage_date"].between(F.lit(first), F.lit(as_of)))
    return F.aggregate(recent, F.lit(0).cast("bigint"), lambda total, d: total + d["uses"])


def scores_on(state: DataFrame, as_of: date, unmatched: str = "nulls") -> DataFrame:
    """The mart as of a day, of every account with a subscription, ticket or churn event."""
    seen = state.where("has_sub or has_ticket or has_churn").withColumns(
        {
            "churned": F.when(F.col("has_sub"), churned_on(as_of)),
            "uses": uses_on(as_of),
            "satisfaction": F.col("satisfaction_sum") / F.nullif("satisfaction_rows", F.lit(0)),
        }
    )
    return scored(seen, as_of, unmatched)
