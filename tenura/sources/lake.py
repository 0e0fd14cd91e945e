"""Date-partitioned Parquet lake: table/year=YYYY/month=MM/day=DD."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.functions.dates import calendar_months, month_key
from tenura.operators.versioned import path_exists
from tenura.operators.watermarks import Commit

PARTITIONS = ("year", "month", "day")
LARGE_FILE = 1 << 16


def write_days(
    df: DataFrame, path: str, event_date: str, stamped: Callable[[DataFrame], DataFrame] = lambda df: df
) -> None:
    """Replace the days present in df and leave all others alone, so a re-run is harmless.

    Rows of a day are brought together before the write.  The rebalance step splits a day
    that is too large for one task and packs small days, by actual size.  ``stamped`` adds what is the same
    in all rows; it is applied after that step, as are the names of the folders, so neither is shuffled.
    """
    d = F.col(event_date)
    (
        stamped(df.withColumn("_day", F.to_date(d)).hint("rebalance", "_day").drop("_day"))
        .withColumns(
            {
                "year": F.date_format(d, "yyyy"),
                "month": F.date_format(d, "MM"),
                "day": F.date_format(d, "dd"),
            }
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def _days_between(after: date, upto: date) -> Column:
    """Partition predicate for after < day <= upto; no date at all, no match."""
    day = F.expr("try_to_date(format_string('%04d-%02d-%02d', year, month, day))")
    return (day > F.lit(after)) & (day <= F.lit(upto))


def _day_folders(path: str, after: date, upto: date) -> str:
    """Pattern for the day folders of the months that the range touches."""
    months = calendar_months(after + timedelta(days=1), upto)
    names = ",".join(m.strftime("year=%Y/month=%m") for m in months)
    return f"{path}/{{{names}}}/day=[0-9][0-9]"


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, after: date, upto: date
) -> DataFrame | None:
    """Rows of the days in (after, upto]; None when no day was written in its months.

    Only folders of those months are listed, only days in the range are given to tasks, and
    folders that do not follow the layout are left alone.  The schema is stated, so no file
    has to be opened to find it, and a column that some days lack reads as NULL.
    """
    folders = _day_folders(path, after, upto)
    if upto <= after or not path_exists(spark, folders):
        return None
    dated = T.StructType(
        [f for f in schema.fields if f.name not in PARTITIONS]
        + [T.StructField(p, T.IntegerType()) for p in PARTITIONS]
    )
    rows = spark.read.schema(dated).option("basePath", path).parquet(folders)
    return rows.where(_days_between(after, upto)).drop(*PARTITIONS)


def large_days(rows: DataFrame) -> bool:
    """Whether the files of a read lake are so large that their rows need not be brought together by month."""
    files = rows.inputFiles()
    if not files:
        return False
    jvm = rows.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(files[len(files) // 2]))
    middle = path.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).getFileStatus(path)
    return middle.getLen() >= LARGE_FILE


def append_months(
    df: DataFrame, path: str, event_date: str, sort_key: tuple[str, ...], *, by_month: bool = False
) -> None:
    """Append to a month-partitioned table, sorted inside each file by the table's key.

    ``by_month`` says that the rows come straight from files that hold one month each, or one day: they stay
    in their tasks then, and no more files are written than were read.
    """
    dated = df.withColumn("_month", month_key(F.to_date(event_date)))
    (
        (dated if by_month else dated.hint("rebalance", "_month"))
        .sortWithinPartitions("_month", *sort_key)
        .write.mode("append")
        .option("compression", "zstd")
        .partitionBy("_month")
        .parquet(path)
    )


def read_months(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: date | None = None,
    last: date | None = None,
    commits: Sequence[Commit] | None = None,
    months: Sequence[int] | None = None,
) -> DataFrame:
    """Rows of a month-partitioned table; an empty frame when it does not exist yet.

    The bounds, or a list of months, prune months; rows inside a month are not cut.  With
    ``commits`` only their folders are read, and of those only folders that hold such months.
    """
    month = T.StructField("_month", T.IntegerType())
    if commits is None:
        if not path_exists(spark, path):
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(T.StructType([*schema.fields, month])).parquet(path)
    else:
        def wanted(m: int) -> bool:
            return (
                (first is None or m >= first.year * 100 + first.month)
                and (last is None or m <= last.year * 100 + last.month)
                and (months is None or m in months)
            )

        bounded = any(x is not None for x in (first, last, months))
        folders = [f"{path}/commit={c.name}" for c in commits if not bounded or any(map(wanted, c.months))]
        if not folders:
            return spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("commit", T.StringType()), month])
        rows = spark.read.schema(stored).option("basePath", path).parquet(*folders).drop("commit")
    if first is not None:
        rows = rows.where(F.col("_month") >= first.year * 100 + first.month)
    if last is not None:
        rows = rows.where(F.col("_month") <= last.year * 100 + last.month)
    if months is not None:
        rows = rows.where(F.col("_month").isin(*months) if months else F.lit(False))
    return rows.drop("_month")
