"""Static dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura import fixed_values as fv
from tenura.functions.dates import week_from_sunday, weekday_from_monday
from tenura.operators.clean import align


def dim_plans(spark: SparkSession) -> DataFrame:
    schema = T.StructType.fromDDL(fv.PLAN_SEED_COLUMNS)
    rows = ", ".join(str(row) for row in fv.PLAN_SEED)
    return align(spark.sql(f"SELECT * FROM VALUES {rows} AS seed({', '.join(schema.names)})"), schema)


def dim_date(
    spark: SparkSession, first: date = fv.FIRST_DAY, last: date = fv.LAST_DAY
) -> DataFrame:
    """One row per day with its calendar attributes."""
    d = F.col("date_key")
    weekday = weekday_from_monday(d)
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_key")
    )
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        week_from_sunday(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
    )
