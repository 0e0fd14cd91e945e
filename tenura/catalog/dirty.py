"""The mapped tables written as untidy raw text, to exercise the cleaning operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number_of(key: str) -> Column:
    """The number inside an id such as A000000123, all its digits."""
    return F.regexp_extract(key, "^.([0-9]+)", 1).cast("bigint")


def _every(n: Column, step: int, text: str, otherwise: Column) -> Column:
    return F.when(n % step == 0, F.lit(text)).otherwise(otherwise)


def _flag(c: str) -> Column:
    return F.initcap(F.col(c).cast("string"))


def _untidy_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"  {c.upper()}\t" for c in df.columns])


def accounts(df: DataFrame) -> DataFrame:
    n = number_of("account_id")
    return _untidy_headers(
        df.select(
            F.concat(F.lit(" "), "account_id", F.lit("\t")).alias("account_id"),
            F.concat(F.lit("\t "), "account_name", F.lit("  ")).alias("account_name"),
            _every(n, 11, "NA", F.col("industry")).alias("industry"),
            "country",
            _every(n, 13, "not a date", F.concat(F.col("signup_date").cast("string"), F.lit(" 10:30:00"))).alias("signup_date"),
            _every(n, 7, "None", F.col("referral_source")).alias("referral_source"),
            "plan_tier",
            _every(n, 19, "NaN", F.concat(F.col("seats").cast("string"), F.lit(".0"))).alias("seats"),
            _every(n, 17, "", _flag("is_trial")).alias("is_trial"),
            _every(n, 23, "null", _flag("churn_flag")).alias("churn_flag"),
        )
    )


def churn_events(df: DataFrame) -> DataFrame:
    n = number_of("churn_event_id")
    refund = F.col("refund_amount_usd").cast("string")
    return _untidy_headers(
        df.select(
            "churn_event_id",
            F.concat(F.lit("  "), "account_id").alias("account_id"),
            _every(n, 13, "31/31/2025", F.col("churn_date").cast("string")).alias("churn_date"),
            _every(n, 11, "#N/A", F.concat("reason_code", F.lit("\t"))).alias("reason_code"),
            _every(n, 5, "-12.5", _every(n, 7, "n/a", refund)).alias("refund_amount_usd"),
            _flag("is_reactivation").alias("is_reactivation"),
        )
    )


def feature_usage(df: DataFrame) -> DataFrame:
    n = number_of("usage_id")
    return _untidy_headers(
        df.select(
            "usage_id",
            "subscription_id",
            _every(n, 13, "yesterday", F.col("usage_date").cast("string")).alias("usage_date"),
            F.concat(F.lit(" "), "feature_name").alias("feature_name"),
            _every(n, 6, "-3", F.concat(F.col("usage_count").cast("string"), F.lit(".0"))).alias("usage_count"),
            _every(n, 10, "nan", F.col("usage_duration_secs").cast("string")).alias("usage_duration_secs"),
            _every(n, 15, "<NA>", F.col("error_count").cast("string")).alias("error_count"),
            _every(n, 9, "", _flag("is_beta_feature")).alias("is_beta_feature"),
        )
    )


def support_tickets(df: DataFrame) -> DataFrame:
    n = number_of("ticket_id")
    score = F.col("satisfaction_score").cast("string")
    return _untidy_headers(
        df.select(
            "ticket_id",
            "account_id",
            F.col("submitted_at").cast("string").alias("submitted_at"),
            _every(n, 13, "open", F.col("closed_at").cast("string")).alias("closed_at"),
            _every(n, 6, "-4.5", F.col("resolution_time_hours").cast("string")).alias("resolution_time_hours"),
            F.concat("priority", F.lit("  ")).alias("priority"),
            _every(n, 8, "NULL", F.col("first_response_time_minutes").cast("string")).alias("first_response_time_minutes"),
            _every(n, 4, "7.5", _every(n, 9, "0.2", score)).alias("satisfaction_score"),
            _every(n, 14, "", _flag("escalation_flag")).alias("escalation_flag"),
        )
    )


# Rows that break the batch checks.



def faulty_subscriptions(df: DataFrame) -> DataFrame:
    n = number_of("subscription_id")
    return df.withColumns(
        {
            "mrr_amount": F.when(n % 101 == 0, F.lit(-5.0)).otherwise(F.col("mrr_amount")),
            "arr_amount": F.when(n % 103 == 0, F.lit(-60.0)).otherwise(F.col("arr_amount")),
            "end_date": F.when(n % 211 == 0, F.date_sub("start_date", 1)).otherwise(F.col("end_date")),
            "plan_tier": F.when(n % 307 != 0, F.col("plan_tier")),
            "subscription_id": F.when(n % 997 != 0, F.col("subscription_id")),
        }
    )


def faulty_churn_events(df: DataFrame) -> DataFrame:
    n = number_of("churn_event_id")
    return df.withColumns(
        {
            "refund_amount_usd": F.when(n % 89 == 0, F.lit(-1.0)).otherwise(F.col("refund_amount_usd")),
            "account_id": F.when(n % 401 != 0, F.col("account_id")),
        }
    )


def faulty_tickets(df: DataFrame) -> DataFrame:
    n = number_of("ticket_id")
    early = F.col("submitted_at") - F.expr("interval 1 hour")
    return df.withColumn("closed_at", F.when(n % 503 == 0, early).otherwise(F.col("closed_at")))
