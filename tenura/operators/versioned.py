"""Append-and-collapse tables, delete+insert refreshes and month replacement."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tenura.schemas import SourceTable

VERSION = "_updated_at"


def with_version(df: DataFrame, version: int) -> DataFrame:
    return df.withColumn(VERSION, F.lit(version).cast("bigint"))


def latest_version(df: DataFrame, keys: Sequence[str], version: str = VERSION) -> DataFrame:
    """Newest row per key by version, whatever order the rows were written in.

    A key has one row per version, as a load writes it, so the version alone decides and a
    reader that needs two columns reads those, the key and the version.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(version).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def current_rows(df: DataFrame, table: SourceTable, keys: str = "sort_key") -> DataFrame:
    """Latest rows of a warehouse table.

    ``sort_key`` collapses on the sort key, so a subscription whose start date changed
    keeps both rows; ``pk`` collapses on the primary key.
    """
    return latest_version(df, table.sort_key if keys == "sort_key" else (table.key,))


def sync_columns(target: DataFrame, schema: T.StructType, mode: str = "sync_all") -> DataFrame:
    """Bring stored rows to a changed schema.

    ``sync_all`` takes the new schema as it is; ``append`` keeps dropped columns too.
    """
    new = {f.name: f.dataType for f in schema.fields}
    kept = [f for f in target.schema.fields if f.name not in new] if mode == "append" else []
    have = set(target.columns)
    return target.select(
        *[
            (F.col(n) if n in have else F.lit(None)).cast(t).alias(n)
            for n, t in new.items()
        ],
        *[F.col(f.name) for f in kept],
    )


def delete_insert(
    target: DataFrame, new: DataFrame, keys: Sequence[str], on_schema_change: str = "sync_all"
) -> DataFrame:
    """Target rows whose key is not in the new result, plus the new result.

    Keys that vanished from the result stay.
    """
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    return sync_columns(kept, new.schema, on_schema_change).unionByName(
        new, allowMissingColumns=True
    )


def replace_months(df: DataFrame, path: str) -> None:
    """Write the (year, month) partitions present in df; other months stay as they are."""
    (
        df.hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


BUCKET = "_bucket"
LISTING = "version bigint, buckets array<int>, filled array<int>, columns string, marks map<string,bigint>"


class VersionedTable:
    """A table whose every publication has its own folder, and an append-only list that names
    what to read.  A publication is listed only after its folder is complete, so readers see the
    old rows or the new ones, never a mixture.

    ``bucket`` gives each row a whole number (its month, a hash of its key).  Then ``upsert``
    rewrites the buckets that hold changed rows, and the list says for each bucket which
    publication holds it, so what is written follows the change and not the table.  ``marks`` are
    numbers that become visible with the rows, such as how far a source has been read.
    """

    def __init__(self, spark: SparkSession, path: str, bucket: Column | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.bucket = None if bucket is None else F.coalesce(bucket.cast("int"), F.lit(-1))

    def _listed(self) -> list:
        listing = f"{self.path}/versions"
        if not path_exists(self.spark, listing):
            return []
        return self.spark.read.schema(LISTING).parquet(listing).orderBy("version").collect()

    def current_version(self) -> int:
        listed = self._listed()
        return listed[-1]["version"] if listed else 0

    def marks(self) -> dict[str, int]:
        listed = self._listed()
        return dict(listed[-1]["marks"] or {}) if listed else {}

    def _folders(self, listed: list, only: Collection[int] | None = None) -> list[str]:
        places: dict[int | None, int] = {}
        for row in listed:
            if row["buckets"] is None:
                places = {}
            for gone in row["buckets"] or ():
                places.pop(gone, None)
            held = [None] if row["filled"] is None else row["filled"]
            places |= {b: row["version"] for b in held}
        data = f"{self.path}/data"
        return [
            f"{data}/version={v}" if b is None else f"{data}/version={v}/{BUCKET}={b}"
            for b, v in places.items()
            if b is None or only is None or b in only
        ]

    def _rows(self, listed: list, only: Collection[int] | None = None) -> DataFrame:
        folders = self._folders(listed, only)
        schema = T.StructType.fromDDL(listed[-1]["columns"]) if listed[-1]["columns"] else None
        if not folders:
            return self.spark.createDataFrame([], schema)
        if schema is None:
            return self.spark.read.parquet(*folders)
        places = T.StructType.fromDDL(f"version bigint, {BUCKET} int").fields
        reader = self.spark.read.schema(T.StructType([*schema.fields, *places]))
        return reader.option("basePath", f"{self.path}/data").parquet(*folders).drop("version", BUCKET)

    def read(self) -> DataFrame | None:
        listed = self._listed()
        return self._rows(listed) if listed else None

    def _write(self, df: DataFrame, version: int) -> list[int] | None:
        folder = f"{self.path}/data/version={version}"
        if self.bucket is None:
            df.write.mode("overwrite").parquet(folder)
            return None
        bucketed = df.withColumn(BUCKET, self.bucket).hint("rebalance", BUCKET)
        bucketed.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        return numbers_of_folders(self.spark, folder, BUCKET)

    def _list(
        self, version: int, buckets: Collection[int] | None, filled: Collection[int] | None,
        schema: T.StructType, marks: Mapping[str, int] | None,
    ) -> int:
        numbers = "cast(array({}) as array<int>)".format
        self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"),
            *[
                F.expr("cast(null as array<int>)" if held is None else numbers(",".join(map(str, sorted(held))))).alias(name)
                for name, held in (("buckets", buckets), ("filled", filled))
            ],
            F.lit(_ddl(schema)).alias("columns"),
            F.create_map(*[F.lit(x) for k, v in (marks or {}).items() for x in (k, v)]).cast("map<string,bigint>").alias("marks"),
        ).coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return version

    def publish(self, df: DataFrame, marks: Mapping[str, int] | None = None) -> int:
        """All rows, as the next version."""
        version = self.current_version() + 1
        return self._list(version, None, self._write(df, version), df.schema, marks)

    def upsert(
        self, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
        marks: Mapping[str, int] | None = None, also: Collection[int] = (),
    ) -> int:
        """``merge(stored, new)`` in the buckets of the new rows, and in those of ``also``; other
        buckets stay where they are.  ``new`` must repeat itself; a changed set of columns, or a
        table that was written without buckets, is written as a whole.
        """
        listed = self._listed()
        if not listed:
            return self.publish(new, marks)
        stored, last = self._rows(listed), listed[-1]
        whole = self.bucket is None or any(r["filled"] is None for r in listed)
        if whole or _ddl(stored.schema) != _ddl(new.schema):
            return self.publish(merge(stored, new), marks)
        rows = new.select(self.bucket.alias(BUCKET)).distinct().collect()
        touched = {r[BUCKET] for r in rows} | set(also)
        version = last["version"] + 1
        merged = merge(self._rows(listed, touched), new)
        filled = self._write(merged, version) if touched else []
        return self._list(version, touched, filled, new.schema, marks)


def _ddl(schema: T.StructType) -> str:
    """Columns and types as text, whatever else the schema says."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a path or pattern, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def numbers_of_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the partition folders ``name=number`` directly below a path."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    numbers = [s.getPath().getName().split("=", 1)[1] for s in found]
    return sorted(int(n) for n in numbers if n.lstrip("-").isdigit())
