"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.session import cut

# White space between words, as every contract of these operators states it.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch: bounds the memory of a Python worker when texts are long.
BATCH_ROWS = 512

# Copies of the small side of a join whose large side may hold one key in a third of its rows.
SALTS = 16


def ready(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches and let executors import this package.

    The package is sent as an archive through Spark's own file distribution, once per
    Spark context, so that no folder has to be shared for code.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if not getattr(context, "_tenura_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="tenura-code-"), "tenura_code.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for at, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(at, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)
        context._tenura_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(names: list[str]) -> list[Column]:
    """Columns by name, whatever signs the names hold."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in names]


def salted(rows: DataFrame, small: DataFrame, key: str, spread: Column, how: str = "left") -> DataFrame:
    """Join ``small`` (one row per key) to ``rows`` so that no key lands in one task.

    ``spread`` is any column that varies within a key.  Both sides are shuffled by key and
    salt; the small side is repeated SALTS times.
    """
    left = rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [key, "__salt"], how).drop("__salt")


# Name of the column that addresses a row.
ROW = "__tenura_row"


def addressed(docs: DataFrame) -> DataFrame:
    """``docs`` with an address of each row that every later scan repeats: hash of the file, row in it.

    So decisions can be made on narrow columns and joined to the documents afterwards, without
    writing texts again.  A frame that is not read from Parquet files is written first.
    """
    def with_row(df: DataFrame) -> DataFrame:
        row = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        return df.select("*", row.alias(ROW))

    try:
        return with_row(docs)
    except AnalysisException:
        return with_row(cut(docs))
