"""Business rules per source table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura import fixed_values as fv
from tenura.functions.dates import parse_day, parse_timestamp, whole_days
from tenura.functions.values import money, non_negative, truthy, within
from tenura.operators.neighbours import HOT_ROWS, with_neighbours


def _day(df: DataFrame, name: str):
    c = F.col(name)
    return parse_day(c) if dict(df.dtypes)[name] == "string" else F.to_date(c)


def _instant(df: DataFrame, name: str):
    c = F.col(name)
    return parse_timestamp(c) if dict(df.dtypes)[name] == "string" else c.cast("timestamp")


def enrich_accounts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "signup_date": _day(df, "signup_date"),
            "churn_flag": truthy(F.col("churn_flag")),
            "is_trial": truthy(F.col("is_trial")),
        }
    )


def enrich_subscriptions(
    df: DataFrame,
    *,
    tail: str = "reference",
    as_of: date | None = None,
    scope: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    interval: bool = False,
) -> DataFrame:
    """Sequence, gaps, churn, reactivation, days active and revenue per subscription.

    ``tail`` decides what the last subscription of an account is: ``reference`` always
    calls it churned, ``as_of`` only once it has been over for more than the gap at that
    date.  ``scope`` adds columns that the sequence restarts on, e.g. an ingest batch.

    ``interval`` keeps the next start and the end with its time of day, so that ``churned_on`` can
    judge a last subscription again on any later day.

    Ends keep their time of day until the gaps are taken, since gaps are whole elapsed
    days, not calendar days.
    """
    typed = df.withColumns(
        {"start_date": _instant(df, "start_date"), "end_date": _instant(df, "end_date")}
    )
    kept = {"next_start_at": F.col("_next_start"), "ended_at": F.col("end_date")} if interval else {}
    placed = with_neighbours(
        typed,
        ["account_id", *scope],
        ["start_date", "subscription_id"],
        next_of={"_next_start": "start_date"},
        previous_of={"_prev_end": "end_date"},
        sequence="subscription_sequence",
        hot_rows=hot_rows,
    )
    gap_to_next = whole_days(F.col("_next_start"), F.col("end_date"))
    gap_from_prev = whole_days(F.col("start_date"), F.col("_prev_end"))
    if tail == "as_of":
        since_end = whole_days(F.lit(as_of), F.col("end_date"))
        churned = truthy(F.coalesce(gap_to_next, since_end) > fv.CHURN_GAP_DAYS)
    else:
        churned = gap_to_next.isNull() | (gap_to_next > fv.CHURN_GAP_DAYS)
    monthly = money(non_negative(F.col("mrr_amount")))
    return placed.withColumns(
        kept
        | {
            "churn_flag": churned,
            "reactivation_flag": truthy(gap_from_prev > fv.REACTIVATION_GAP_DAYS),
            "days_active": non_negative(whole_days(F.col("end_date"), F.col("start_date"))).cast("int"),
            "mrr_amount": monthly,
            "arr_amount": money(monthly * 12),
            "start_date": F.to_date("start_date"),
            "end_date": F.to_date("end_date"),
        }
    ).drop("_next_start", "_prev_end")


def churned_on(day: date) -> Column:
    """Whether a subscription was followed by too long a gap, seen on a day: valid-time bounds
    (``next_start_at``, ``ended_at``) decide, not the day on which the row was written."""
    gap = F.coalesce(
        whole_days(F.col("next_start_at"), F.col("ended_at")), whole_days(F.lit(day), F.col("ended_at"))
    )
    return truthy(gap > fv.CHURN_GAP_DAYS)


def enrich_churn_events(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "churn_date": _day(df, "churn_date"),
            "refund_amount_usd": money(non_negative(F.col("refund_amount_usd"))),
            "reason_code": F.coalesce("reason_code", F.lit(fv.UNKNOWN_REASON)),
        }
    )


def enrich_feature_usage(df: DataFrame) -> DataFrame:
    counts = ("usage_count", "usage_duration_secs", "error_count")
    return df.withColumns(
        {"usage_date": _day(df, "usage_date")}
        | {c: non_negative(F.col(c)).cast("bigint") for c in counts}
        | {"is_beta_feature": truthy(F.col("is_beta_feature"))}
    )


def enrich_support_tickets(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "submitted_at": _instant(df, "submitted_at"),
            "closed_at": _instant(df, "closed_at"),
            "resolution_time_hours": non_negative(F.col("resolution_time_hours")).cast("double"),
            "first_response_time_minutes": non_negative(F.col("first_response_time_minutes")),
            "satisfaction_score": within(F.col("satisfaction_score"), *fv.SATISFACTION_RANGE),
            "escalation_flag": truthy(F.col("escalation_flag")),
        }
    )


ENRICHERS: dict[str, Callable[..., DataFrame]] = {
    "accounts": enrich_accounts,
    "subscriptions": enrich_subscriptions,
    "churn_events": enrich_churn_events,
    "feature_usage": enrich_feature_usage,
    "support_tickets": enrich_support_tickets,
}
