"""Which months hold which keys, kept beside a month-partitioned table.

Every load adds (key, owner, month) of its rows, keys as 64-bit hashes, those of its keys that the table then holds more
than once, and the pairs of months that such a key is in.  So a reader that collapses versions by primary key need not read the whole table: rows from a month
on need that month, later ones, and those that share a key with one of them; rows of some owners or
keys need the months that the index names for them.  A collision of hashes only adds a month.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions.dates import month_key
from tenura.operators.versioned import path_exists
from tenura.operators.watermarks import Commit
from tenura.schemas import SourceTable
from tenura.session import cut

ENTRIES = "key bigint, owner bigint, month int"
PAIRS = "month int, other int"
REPEATS = "key bigint, inside boolean"


def owner_of(table: SourceTable) -> str:
    """The column by which rows are asked for: the account, or what stands for it."""
    return table.sort_key[0]


class KeyIndex:
    """Index of one table at a path; its folders are listed by the table's own commits."""

    def __init__(self, spark: SparkSession, path: str, table: SourceTable, commits: Sequence[Commit]):
        self.spark, self.path, self.table = spark, path.rstrip("/"), table
        self.commits = list(commits)

    def _read(self, part: str, schema: str) -> DataFrame:
        folders = [f"{self.path}/{part}/commit={c.name}" for c in self.commits]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def add(self, rows: DataFrame, commit: str, unique: bool = False) -> None:
        """Entries of new rows (a written table) and the pairs of months that they link.

        ``unique`` says that the rows hold no key twice: then the first load has nothing to count.
        """
        entries = rows.select(
            F.xxhash64(self.table.key).alias("key"),
            F.xxhash64(owner_of(self.table)).alias("owner"),
            month_key(F.to_date(self.table.event_date)).alias("month"),
        )
        folder = f"{self.path}/entries/commit={commit}"
        entries.write.parquet(folder)
        if unique and not self.commits:
            for part, schema in (("repeats", REPEATS), ("links", PAIRS)):
                none = self.spark.createDataFrame([], schema)
                none.coalesce(1).write.parquet(f"{self.path}/{part}/commit={commit}")
            return
        fresh = self.spark.read.schema(ENTRIES).parquet(folder).select("key", "month")
        known = self._read("entries", ENTRIES).select("key", "month")
        every = known.withColumn("new", F.lit(0)).unionByName(fresh.withColumn("new", F.lit(1)))
        again = cut(
            every.groupBy("key")
            .agg(
                F.count(F.lit(1)).alias("n"), F.sum("new").alias("new"),
                (F.min("month") < F.max("month")).alias("spread"),
            )
            .where("n > 1 and new > 0")
            .select("key", (F.col("new") > 1).alias("inside"), "spread")
        )
        again.select("key", "inside").write.parquet(f"{self.path}/repeats/commit={commit}")
        spread = again.where("spread").select("key")
        links = fresh.join(spread, "key").join(
            every.join(spread, "key").select("key", F.col("month").alias("other")), "key"
        )
        links = links.where("month <> other").select("month", "other").distinct()
        links.coalesce(1).write.parquet(f"{self.path}/links/commit={commit}")

    def repeated(self) -> DataFrame | None:
        """Hashes of all keys that the table holds more than once; None for an index that does not list them."""
        oldest = min(self.commits, key=lambda c: c.seq, default=None)
        if oldest is not None and not path_exists(self.spark, f"{self.path}/repeats/commit={oldest.name}"):
            return None  # its first loads were listed without them
        return self._read("repeats", REPEATS).select("key").distinct()

    def _repeats_inside(self, commit: Commit) -> bool:
        """Whether the commit by itself may hold a key more than once."""
        folder = f"{self.path}/repeats/commit={commit.name}"
        if not path_exists(self.spark, folder):
            return True
        return not self.spark.read.schema(REPEATS).parquet(folder).where("inside").isEmpty()

    def newer_than_month(self, first: date) -> list[Commit]:
        """Commits whose rows of earlier months can be newer versions of rows from ``first`` on."""
        least = first.year * 100 + first.month
        holding = [c for c in self.commits if any(m >= least for m in c.months)]
        if not holding:
            return []
        oldest = min(holding, key=lambda c: c.seq)
        return [c for c in self.commits if c.seq > oldest.seq or (c is oldest and self._repeats_inside(c))]

    def _with_linked(self, months: set[int]) -> list[int]:
        """With the months in which a key of these months has another version."""
        pairs = [(r["month"], r["other"]) for r in self._read("links", PAIRS).distinct().collect()]
        linked = {b for a, b in pairs if a in months} | {a for a, b in pairs if b in months}
        return sorted(months | linked)

    def from_month(self, first: date) -> list[int]:
        """Months to read for the current rows of a month and later ones."""
        least = first.year * 100 + first.month
        return self._with_linked({m for c in self.commits for m in c.months if m >= least})

    def of(self, wanted: DataFrame, column: str) -> list[int]:
        """Months to read for the current rows of some owners (or primary keys) of a frame."""
        side = "key" if column == self.table.key else "owner"
        hashed = wanted.select(F.xxhash64(column).alias(side)).distinct()
        found = self._read("entries", ENTRIES).join(hashed, side, "left_semi").select("month").distinct()
        return self._with_linked({r["month"] for r in found.where("month is not null").collect()})
