"""Monthly revenue by a sweep over months, two rows a subscription however long it runs.

Every subscription adds its amounts in its first month and takes them off in the month after its last (a difference
array); sums per month and tier are added up over the months.  Accounts are counted in the same way from
the months that an account newly covers in a tier: spans of one account and tier are first reduced to
the latest end per first month, so at most one row per month is left of the largest account, and each then
counts only from beyond the ends before it.  Equal to listing each subscription's months (``marts.mrr_monthly`` with
``overlap="calendar"``), whose rows grow with the length of the spans.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.functions.dates import month_number, month_spine
from tenura.functions.values import money, ratio

AMOUNT = "decimal(38,6)"  # exact, so that what is added and taken off leaves nothing behind
SUMS = ("rows", "mrr", "priced", "arr", "priced_arr", "seats", "seated", "active", "new", "churned")


def spans(subs: DataFrame, first: int, last: int) -> DataFrame:
    """Subscriptions with the numbers of their first and last month, cut to the given ones."""
    bounded = subs.where("start_date is not null and end_date is not null").withColumns(
        {
            "_from": F.greatest(month_number(F.col("start_date")), F.lit(first)),
            "_to": F.least(month_number(F.col("end_date")), F.lit(last)),
        }
    )
    return bounded.where("_from <= _to")


def covered(spanning: DataFrame) -> DataFrame:
    """Disjoint spans of months (account_id, plan_tier, _from, _to) that an account covers in a tier."""
    longest = (
        spanning.where("account_id is not null")
        .groupBy("account_id", "plan_tier", "_from")
        .agg(F.max("_to").alias("_to"))
    )
    before = Window.partitionBy("account_id", "plan_tier").orderBy("_from")
    reached = F.max("_to").over(before.rowsBetween(Window.unboundedPreceding, -1))
    return longest.withColumn("_from", F.greatest("_from", F.coalesce(reached + 1, "_from"))).where("_from <= _to")


def _events(rows: DataFrame, amounts: dict[str, Column]) -> DataFrame:
    """Each row's amounts added in its first month and taken off after its last."""
    values = rows.select("plan_tier", "_from", "_to", *[c.alias(n) for n, c in amounts.items()])
    ends = F.array(
        F.struct(F.col("_from").alias("at"), F.lit(1).alias("sign")),
        F.struct((F.col("_to") + 1).alias("at"), F.lit(-1).alias("sign")),
    )
    return values.withColumn("_end", F.explode(ends)).select(
        "plan_tier", F.col("_end.at").alias("at"), *[(F.col(n) * F.col("_end.sign")).alias(n) for n in amounts]
    )


def _points(segments: DataFrame, markers: DataFrame, name: str) -> DataFrame:
    """Tiers in which an account is active in the month of its marker; each counts in that month only."""
    marked = markers.where("account_id is not null and at is not null").distinct()
    met = segments.join(marked, "account_id").where("at >= _from and at <= _to")
    once = met.select("plan_tier", F.col("at").alias("_from"), F.col("at").alias("_to"))
    return _events(once, {name: F.lit(1).cast("bigint")})


def mrr_monthly_sweep(subs: DataFrame, churn: DataFrame, as_of: date) -> DataFrame:
    """Active, new and churned accounts and revenue per year, month and plan tier, by calendar."""
    months = month_spine(as_of, "calendar")
    first, last = (m.year * 12 + m.month - 1 for m in (months[0], months[-1]))
    spanning = spans(subs, first, last)
    segments = covered(spanning)

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast(AMOUNT)

    def known(name: str) -> Column:
        return F.col(name).isNotNull().cast("bigint")

    starts = subs.where("subscription_sequence = 1").select("account_id", month_number(F.col("start_date")).alias("at"))
    ends = churn.select("account_id", month_number(F.col("churn_date")).alias("at"))
    parts = [
        _events(
            spanning,
            {
                "rows": F.lit(1).cast("bigint"), "mrr": filled("mrr_amount"), "priced": known("mrr_amount"),
                "arr": filled("arr_amount"), "priced_arr": known("arr_amount"),
                "seats": F.coalesce("seats", F.lit(0)).cast("bigint"), "seated": known("seats"),
            },
        ),
        _events(segments, {"active": F.lit(1).cast("bigint")}),
        _points(segments, starts, "new"),
        _points(segments, ends, "churned"),
    ]
    events = parts[0]
    for part in parts[1:]:
        events = events.unionByName(part, allowMissingColumns=True)
    changes = events.groupBy("plan_tier", "at").agg(*[F.sum(n).alias(n) for n in SUMS])
    every = changes.select("plan_tier").distinct().withColumn("at", F.explode(F.sequence(F.lit(first), F.lit(last))))
    changes = changes.unionByName(every, allowMissingColumns=True).groupBy("plan_tier", "at").agg(*[F.sum(n).alias(n) for n in SUMS])
    upto = Window.partitionBy("plan_tier").orderBy("at")  # at most one row per month of a tier
    summed = changes.withColumns({n: F.sum(F.coalesce(F.col(n), F.lit(0))).over(upto) for n in SUMS})
    return summed.where((F.col("at") <= last) & (F.col("rows") > 0)).select(
        F.floor(F.col("at") / 12).cast("int").alias("year"),
        (F.col("at") % 12 + 1).cast("int").alias("month"),
        "plan_tier",
        F.col("active").alias("active_accounts"),
        F.col("new").alias("new_accounts"),
        F.col("churned").alias("churned_accounts"),
        F.when(F.col("priced") > 0, money(F.col("mrr"))).alias("total_mrr"),
        F.when(F.col("priced_arr") > 0, money(F.col("arr"))).alias("total_arr"),
        money(ratio(F.col("mrr").cast("double"), F.col("priced"))).alias("avg_mrr_per_account"),
        F.when(F.col("seated") > 0, F.col("seats")).alias("total_seats"),
    )
