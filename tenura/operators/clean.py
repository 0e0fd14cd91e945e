"""Cleaning, windows of dates, lineage and alignment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tenura import fixed_values as fv
from tenura.functions.dates import parse_day, parse_timestamp
from tenura.functions.values import missing_to_null, strip
from tenura.schemas import SourceTable
from tenura.session import cut


def standardise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower() for name in df.columns])


def strip_text(df: DataFrame) -> DataFrame:
    """Strip every text cell; missing-value tokens become NULL first."""
    return df.select(
        *[
            strip(missing_to_null(F.col(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _coerced(c: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return c
    if isinstance(source, T.StringType):
        if isinstance(target, T.TimestampType):
            return parse_timestamp(c)
        if isinstance(target, T.DateType):
            return parse_day(c)
        if isinstance(target, T.IntegerType):
            # "12.0" is how a whole number is written once its column holds gaps
            return c.try_cast("double").try_cast("int")
        if isinstance(target, T.LongType):
            return c.try_cast("decimal(38, 6)").try_cast("bigint")
        return c.try_cast(target)
    return c.cast(target)


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give known columns their type; cells that do not parse become NULL."""
    wanted = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[
            _coerced(F.col(f.name), f.dataType, wanted[f.name]).alias(f.name)
            if f.name in wanted
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def standardise(df: DataFrame, table: SourceTable) -> DataFrame:
    """Raw text rows to typed rows whose event date is a day."""
    typed = coerce(strip_text(standardise_headers(df)), table.raw_schema)
    return typed.withColumn(table.event_date, F.to_date(table.event_date))


def newer_than(df: DataFrame, column: str, watermark: date, upto: date) -> DataFrame:
    """Rows dated after the watermark and not after the batch date."""
    day = F.to_date(column)
    return df.where((day > F.lit(watermark)) & (day <= F.lit(upto)))


def event_window(df: DataFrame, column: str, after: date, upto: date) -> DataFrame:
    """Same window as newer_than, on the raw column so that it reaches the file scan."""
    if isinstance(df.schema[column].dataType, T.DateType):
        return newer_than(df, column, after, upto)
    start = datetime.combine(after + timedelta(days=1), datetime.min.time())
    end = datetime.combine(upto + timedelta(days=1), datetime.min.time())
    c = F.col(column)
    return df.where((c >= F.lit(start)) & (c < F.lit(end)))


def rolling_bounds(batch_date: date) -> tuple[date, date]:
    """First and last day checked for a batch: 31 days, not before the start date."""
    start = batch_date - timedelta(days=fv.CHECK_WINDOW_DAYS)
    return max(start, fv.FIRST_DAY), batch_date


def rolling_window(df: DataFrame, column: str, batch_date: date) -> DataFrame:
    first, last = rolling_bounds(batch_date)
    return event_window(df, column, first - timedelta(days=1), last)


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by the order columns, ties by all other columns.

    Spark keeps only the first row per key in every map task before it shuffles, so a
    key with very many rows costs one row per task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    newest = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in [*order, *rest]])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


FEW_KEYS = 1_000_000


def split_by_key(df: DataFrame, key: Sequence[str], hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not among the hashes (one column, ``key``), and the others; the hashes go to the rows."""
    marked, few = df.withColumn("_key", F.xxhash64(*key)), F.broadcast(hashes.select(F.col("key").alias("_key")))
    return marked.join(few, "_key", "left_anti").drop("_key"), marked.join(few, "_key", "left_semi").drop("_key")


def keep_last_of_few(df: DataFrame, key: Sequence[str], order: Sequence[str] = (), few: int = FEW_KEYS) -> DataFrame:
    """As ``keep_last``, for rows whose keys seldom repeat; ``df`` must repeat itself.

    Hashes of the keys are counted first, so that only rows of a hash that repeats are shuffled whole.
    More such hashes than ``few`` are not sent to the tasks; all rows are shuffled then.
    """
    hashes = df.groupBy(F.xxhash64(*key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    repeated = cut(hashes.where("n > 1").select("key"))
    found = repeated.count()
    if not found:
        return df
    if found > few:
        return keep_last(df, key, order)
    single, several = split_by_key(df, key, repeated)
    return single.unionByName(keep_last(several, key, order))


def with_lineage(df: DataFrame, source_system: str, batch_id: str, ingested_at: str) -> DataFrame:
    """Lineage columns; one batch id and one time for the whole run of a table."""
    return df.withColumns(
        {
            "_ingestion_time": F.lit(ingested_at),
            "_source_system": F.lit(source_system),
            "_batch_id": F.lit(batch_id),
        }
    )


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema, in order: extra ones dropped, missing ones NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def flags_as_numbers(df: DataFrame) -> DataFrame:
    """Booleans as 0/1, for readers that have no boolean type."""
    return df.select(
        *[
            F.col(f.name).cast("int").alias(f.name)
            if isinstance(f.dataType, T.BooleanType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def schema_drift(df: DataFrame, target: T.StructType) -> tuple[list[str], list[str]]:
    """Columns only in the frame, and columns only in the target (lineage ignored)."""
    only_source = [c for c in df.columns if c not in target.names]
    only_target = [c for c in target.names if c not in df.columns and not c.startswith("_")]
    return only_source, only_target


def drift_report(df: DataFrame, target: T.StructType, table: str) -> DataFrame:
    """One row per drifted column with the number of values an alignment would drop."""
    only_source, only_target = schema_drift(df, target)
    drifted = [(c, "only_in_source") for c in only_source]
    drifted += [(c, "only_in_target") for c in only_target]
    filled = df.agg(
        *[F.count(F.col(c)).alias(c) for c in only_source],
        *[F.lit(0).cast("bigint").alias(c) for c in only_target],
    )
    cells = ", ".join(f"'{c}', '{side}', `{c}`" for c, side in drifted)
    if not drifted:
        return filled.limit(0).selectExpr(
            "'' as table_name", "'' as column_name", "'' as side", "0L as filled_values"
        )
    return filled.selectExpr(
        f"'{table}' as table_name",
        f"stack({len(drifted)}, {cells}) as (column_name, side, filled_values)",
    )
