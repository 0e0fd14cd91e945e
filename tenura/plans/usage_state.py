"""Feature usage by month from stored, mergeable state: sums and exact distinct subscriptions.

Each load adds its sums and bitmaps to those of the months that it touches, late rows included; no older fact
is read.  Every part carries the number of the last load that it has taken in and skips a load that
it has, so a load that broke off between the parts can simply be added again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions.values import money, ratio
from tenura.operators.distinct_state import DistinctState
from tenura.operators.versioned import VersionedTable
from tenura.session import cut

KEYS = ("year", "month", "feature_name")
SUMS = ("total_usage_count", "total_duration_secs", "total_error_count", "beta_usage_count")


class UsageState:
    """State below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.sums = VersionedTable(spark, f"{path}/sums", F.expr("year * 100 + month"))
        self.subscriptions = DistinctState(spark, f"{path}/subscriptions", KEYS, "subscription_id")

    def add(self, usage: DataFrame, load: int) -> None:
        """Take in the rows of load number ``load``; loads are numbered upwards from 1."""
        dated = usage.withColumns({"year": F.year("usage_date"), "month": F.month("usage_date")})
        if self.sums.marks().get("load", 0) < load:
            new = dated.groupBy(*KEYS).agg(
                F.sum("usage_count").alias("total_usage_count"),
                F.sum("usage_duration_secs").alias("total_duration_secs"),
                F.sum("error_count").alias("total_error_count"),
                F.count_if("is_beta_feature").alias("beta_usage_count"),
            )
            self.sums.upsert(cut(new), _added, {"load": load})
        self.subscriptions.add(dated, load)

    def mart(self) -> DataFrame:
        """The feature usage summary of all loads so far."""
        counts = self.subscriptions.counts("unique_subscriptions").withColumnsRenamed({k: f"_{k}" for k in KEYS})
        sums = self.sums.read()
        same = [sums[k].eqNullSafe(counts[f"_{k}"]) for k in KEYS]
        distinct = F.coalesce("unique_subscriptions", F.lit(0)).cast("bigint")
        return sums.join(counts, same, "left").select(
            *KEYS, *SUMS[:3], distinct.alias("unique_subscriptions"),
            money(ratio(F.col("total_usage_count"), distinct)).alias("avg_usage_per_sub"), "beta_usage_count",
        )


def _added(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
