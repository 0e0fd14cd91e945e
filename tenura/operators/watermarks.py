"""Watermarks as an append-only control table (key, day, reset, seq, commit, months).

A watermark is the greatest day written since the last reset of its key, so it never
moves back and needs no rewrite of stored state.

A step that appends rows writes them to a folder of their own and then one control row, which
names the folder (the commit) together with the watermark.  Readers read the folders that are
named, so rows and watermark become visible at once: a step that broke off in between has
left a folder that nobody reads, and its next run repeats it without a second copy.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import fixed_values as fv
from tenura.operators.versioned import path_exists

LOG_SCHEMA = "day date, reset boolean, seq bigint, commit string, months array<int>, key string"
BEFORE_START = fv.FIRST_DAY - timedelta(days=1)


@dataclass(frozen=True)
class Commit:
    """A folder of appended rows, its place in the order of commits, and the months that it holds."""

    name: str
    seq: int
    months: tuple[int, ...]


def current_watermarks(log: DataFrame) -> DataFrame:
    """Key and watermark of every key that has one."""
    resets = log.where("reset").groupBy("key").agg(F.max("seq").alias("reset_seq"))
    return (
        log.join(resets, "key", "left")
        .where(F.col("reset_seq").isNull() | (F.col("seq") >= F.col("reset_seq")))
        .groupBy("key")
        .agg(F.max("day").alias("watermark"))
        .where(F.col("watermark").isNotNull())
    )


class Watermarks:
    """Control table at a path, one folder per key, so that tables can run side by side."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _read(self, path: str) -> DataFrame:
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).option("basePath", self.path).parquet(path)

    def log(self) -> DataFrame:
        return self._read(self.path)

    def _append(
        self, rows: Iterable[tuple[str, date | None, bool]],
        commit: str | None = None, months: Sequence[int] | None = None,
    ) -> None:
        # From the log, not from a clock, so that hosts whose clocks differ agree on the order.
        seq = 1 + (self.log().agg(F.max("seq")).first()[0] or 0)
        for key, day, reset in rows:
            row = self.spark.range(1).select(
                F.lit(day).cast("date").alias("day"),
                F.lit(reset).alias("reset"),
                F.lit(seq).cast("bigint").alias("seq"),
                F.lit(commit).cast("string").alias("commit"),
                (F.lit(None) if months is None else F.array(*map(F.lit, months))).cast("array<int>").alias("months"),
            )
            row.coalesce(1).write.mode("append").parquet(f"{self.path}/key={key}")

    def get(self, key: str) -> date:
        """Last processed day; the day before the start when there is none."""
        folder = f"{self.path}/key={key}"
        if not path_exists(self.spark, folder):
            return BEFORE_START
        row = current_watermarks(self._read(folder)).first()
        return row["watermark"] if row else BEFORE_START

    def all(self) -> dict[str, date]:
        return {r["key"]: r["watermark"] for r in current_watermarks(self.log()).toLocalIterator()}

    def set(
        self, key: str, day: date, commit: str | None = None, months: Sequence[int] | None = None
    ) -> None:
        """Move the watermark and make a commit visible, in one write."""
        self._append([(key, day, False)], commit, months)

    def commits(self, key: str) -> list[Commit]:
        """Folders written for a key, oldest first; a reset does not take them back."""
        folder = f"{self.path}/key={key}"
        if not path_exists(self.spark, folder):
            return []
        listed = self._read(folder).where("commit is not null").orderBy("seq").collect()
        return [Commit(r["commit"], r["seq"], tuple(r["months"] or ())) for r in listed]

    def reset(self, key: str) -> None:
        """Forget the key: the next run starts from the first day."""
        self._append([(key, None, True)])

    def reset_all(self, mode: str = "reference") -> None:
        """Reset every key.

        ``reference`` sets them to the first day, whose rows a later run then leaves out;
        ``corrected`` forgets them, so that the first day is read again.
        """
        day = fv.FIRST_DAY if mode == "reference" else None
        self._append([(key, day, True) for key in fv.WATERMARK_KEYS])
