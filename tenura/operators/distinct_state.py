"""Exact distinct counts that can be merged: dictionary codes and bitmaps, stored and combined on refresh.

Ids get dense codes from an append-only dictionary.  A group's distinct ids are bitmaps of 32 768
codes each; bitmaps of several loads are combined by OR, so a refresh adds the new rows' bitmaps to
the stored ones and reads no old facts.  A group has at most (ids / 32 768) bitmaps of 4 KB, however many
rows it has.  What has been added cannot be taken off: a month whose rows were corrected is built again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.versioned import VersionedTable
from tenura.session import cut

DICTIONARY_BUCKETS = 64


class IdDictionary:
    """Ids and their codes at a path; a code never changes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path, F.pmod(F.xxhash64("id"), F.lit(DICTIONARY_BUCKETS)))

    def codes(self) -> DataFrame:
        known = self.table.read()
        return self.spark.createDataFrame([], "id string, code bigint") if known is None else known

    def extend(self, ids: DataFrame) -> None:
        """Give codes to the ids (one column ``id``) that have none; NULL gets none.

        New ids are numbered within the parts of a written table, and the parts by sums of their
        counts, so no task sees all of them.
        """
        known, used = self.codes(), self.table.marks().get("used", 0)
        new = ids.where("id is not null").distinct().join(known, "id", "left_anti")
        new = cut(new.withColumn("_at", F.monotonically_increasing_id()))
        part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
        sizes = new.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size")).orderBy("part").collect()
        if not sizes:
            return
        starts, total = [], used
        for row in sizes:
            starts.append((row["part"], total))
            total += row["size"]
        offsets = self.spark.createDataFrame(starts, "part bigint, start bigint")
        numbered = new.withColumn("part", part).join(offsets, "part").select("id", (F.col("start") + place).alias("code"))
        self.table.upsert(cut(numbered), lambda old, rows: old.unionByName(rows), {"used": total})


def bitmaps(rows: DataFrame, keys: Sequence[str], code: str = "code") -> DataFrame:
    """keys, block, bitmap of the distinct codes of each group."""
    at = F.col(code) + 1  # block numbers of positive codes start at 1
    return (
        rows.where(F.col(code).isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(at).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
    )


def merged(*states: DataFrame) -> DataFrame:
    """Bitmaps of several states as one: the union of their ids."""
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    keys = [c for c in every.columns if c != "bitmap"]
    return every.groupBy(*keys).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(state: DataFrame, name: str) -> DataFrame:
    """Distinct ids per group."""
    keys = [c for c in state.columns if c not in ("block", "bitmap")]
    return state.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


class DistinctState:
    """Bitmaps of groups at a path, written by month."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], id_column: str):
        self.spark, self.keys, self.id_column = spark, list(keys), id_column
        self.ids = IdDictionary(spark, f"{path}/ids")
        self.table = VersionedTable(spark, f"{path}/bitmaps", F.expr("year * 100 + month"))

    def add(self, rows: DataFrame, load: int) -> None:
        """Take in the rows of load number ``load``, unless they are there already; only the months
        that they belong to are written."""
        if self.table.marks().get("load", 0) >= load:
            return
        narrow = cut(rows.select(*self.keys, F.col(self.id_column).alias("id")).distinct())
        self.ids.extend(narrow.select("id"))
        coded = narrow.join(self.ids.codes(), "id")
        self.table.upsert(cut(bitmaps(coded, self.keys)), merged, {"load": load})

    def counts(self, name: str) -> DataFrame:
        return counted(self.table.read(), name)
