"""Column profiles, value sets, samples and ad-hoc looks at a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ALL_VALUES_UPTO = 5
SAMPLES_BEYOND = 4


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, rows) of every value, NULL included, in one shuffle for all columns."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.explode(cells).alias("_cell"))
        .select("_cell.*")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """Type, number of distinct values and a few values of each column.

    Up to five values are all listed; of more, the first four in text order, so that the
    profile of the same data is always the same.  Counts and first values ask for the same cells, counted
    in the same way, so that Spark shuffles them once for both.
    """
    values = distinct_values(df, df.columns)
    counted = values.groupBy("column_name").agg(
        F.count("value").alias("n_unique"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("rows")).otherwise(0)).alias("non_null"),
    )
    in_order = Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_last(), "rows")
    first_few = (
        values.withColumn("_rank", F.row_number().over(in_order))
        .where(F.col("_rank") <= ALL_VALUES_UPTO)
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list("value")).alias("_few"))  # which leaves NULL out
    )
    types = F.create_map(*[F.lit(x) for name_type in df.dtypes for x in name_type])
    shown = F.when(F.col("n_unique") <= ALL_VALUES_UPTO, F.col("_few")).otherwise(
        F.slice("_few", 1, SAMPLES_BEYOND)
    )
    return counted.join(first_few, "column_name", "left").select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.element_at(types, F.col("column_name")).alias("dtype"),
        "n_unique",
        "non_null",
        F.coalesce(F.array_join(shown, "|"), F.lit("")).alias("sample_values"),
    )


def profile_tables(frames: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [profile_columns(df, name) for name, df in frames.items()]
    )


def value_sets(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Every distinct value of the given category columns, with its number of rows."""
    return distinct_values(df, columns).where(F.col("value").isNotNull()).select(
        F.lit(table).alias("table_name"), "column_name", "value", "rows"
    )


def date_range(df: DataFrame, column: str, table: str) -> DataFrame:
    return df.agg(
        F.min(F.to_date(column)).alias("first_day"),
        F.max(F.to_date(column)).alias("last_day"),
        F.count(F.lit(1)).alias("rows"),
        F.count(column).alias("dated_rows"),
    ).select(F.lit(table).alias("table_name"), "first_day", "last_day", "rows", "dated_rows")


def stable_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The same rows on every run: smallest hashes of the key.

    The smallest of each of 256 buckets of hashes are kept first, so the task that makes the
    final choice reads at most 256 times ``rows`` rows, however large the input.
    """
    digest = F.md5(F.col(key).cast("string"))
    bucket = Window.partitionBy(F.substring(digest, 1, 2)).orderBy(digest, key)
    first = df.withColumn("_rank", F.row_number().over(bucket)).where(F.col("_rank") <= rows).drop("_rank")
    return first.orderBy(digest, key).limit(rows)
