"""Text sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tenura.operators.versioned import path_exists
from tenura.schemas import SourceTable
from tenura.session import cut

READ_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "escape": '"',
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_raw(
    spark: SparkSession, raw_dir: str, table: SourceTable, multi_line: bool = False
) -> DataFrame | None:
    """All cells as text; None when the file is missing.

    Typing comes later and never fails a batch.  ``multi_line`` allows line breaks in
    quoted cells, but such a file cannot be split over tasks.
    """
    path = f"{raw_dir.rstrip('/')}/{table.file_name}"
    if not path_exists(spark, path):
        return None
    return (
        spark.read.options(**READ_OPTIONS)
        .option("multiLine", str(multi_line).lower())
        .csv(path)
    )


def _sums_before(lines: DataFrame, column: Column, name: str) -> DataFrame:
    """For each part of a file the sum of a column over the parts before it; one row a part."""
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    parts = lines.groupBy("_file", "_start").agg(F.sum(column).alias("sum"))
    return parts.select("_file", "_start", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias(name))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of text files whose quoted cells may hold line breaks: ``value`` and its place (file, part, line).

    Files are read in parts, and each part counts its quotes.  A line begins outside of quotes
    if the number of quotes before it in its file is even: the sums of the parts before, which are one row a part,
    and the running sum inside the part.  Lines that begin inside of quotes go on the record before
    them.  A record of one line, by far most of them, passes as it is; only lines of longer
    records are brought together, and only parts are ever put in order, never a file.
    Quotes must stand around cells only, as writers of such files leave them (a quote inside is doubled).
    """
    place = ["_file", "_start", "_at"]
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    lines = cut(lines.withColumn("_quotes", F.length(F.regexp_replace("value", '[^"]', ""))))
    inside_part = Window.partitionBy("_file", "_start").orderBy("_at")
    running = F.sum("_quotes").over(inside_part.rowsBetween(Window.unboundedPreceding, -1))
    placed = lines.join(_sums_before(lines, F.col("_quotes"), "_before"), ["_file", "_start"]).withColumn(
        "_inside", (F.col("_before") + F.coalesce(running, F.lit(0))) % 2 == 1
    )
    alone = ~F.col("_inside") & (F.col("_quotes") % 2 == 0)
    whole = placed.where(alone).select("value", *place)
    broken = cut(placed.where(~alone).select("value", *place, (~F.col("_inside")).cast("int").alias("_begins")))
    upto = F.sum("_begins").over(inside_part.rowsBetween(Window.unboundedPreceding, 0))
    joined = (
        broken.withColumn("_upto", upto)
        .join(_sums_before(broken, F.col("_begins"), "_before"), ["_file", "_start"])
        .groupBy("_file", (F.col("_before") + F.col("_upto")).alias("_record"))
        .agg(F.array_sort(F.collect_list(F.struct("_start", "_at", "value"))).alias("lines"))
        .select(
            F.array_join(F.col("lines.value"), "\n").alias("value"),
            "_file", F.col("lines")[0]["_start"].alias("_start"), F.col("lines")[0]["_at"].alias("_at"),
        )
    )
    return whole.unionByName(joined).withColumn("value", F.regexp_replace("value", "\r$", ""))


def read_raw_in_parts(spark: SparkSession, raw_dir: str, table: SourceTable) -> DataFrame | None:
    """As ``read_raw`` with ``multi_line``, but a file is read by as many tasks as it has parts.

    A folder may hold several files; each begins with the same header.
    """
    path = f"{raw_dir.rstrip('/')}/{table.file_name}"
    if not path_exists(spark, path):
        return None
    records = read_records(spark, path).where(F.trim("value") != "")
    records = records.withColumn("_place", F.struct("_start", "_at"))
    first = cut(
        records.where(F.col("_start") == 0).groupBy("_file").agg(F.min(F.struct("_place", "value")).alias("first"))
        .select("_file", F.col("first._place").alias("_first"), F.col("first.value").alias("header"))
    )
    header = first.agg(F.min("header")).first()[0]
    if header is None:
        return spark.createDataFrame([], T.StructType())
    width = header.count(",") + 1
    generic = ", ".join(f"c{i} string" for i in range(width))
    options = {k: v for k, v in READ_OPTIONS.items() if k not in ("header", "encoding")} | {"multiLine": "true"}
    one = first.limit(1).select(F.from_csv(F.regexp_replace("header", "\ufeff", ""), generic, options).alias("h")).first()["h"]
    names = [n for n in one if n is not None]
    rows = records.join(first.select("_file", "_first"), "_file").where(F.col("_place") != F.col("_first"))
    cells = rows.select(F.from_csv("value", generic, options).alias("row")).select("row.*")
    return cells.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def head(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows, to look at the columns."""
    return df.limit(rows)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header="true", escape='"').csv(path)
