"""Previous row, next row and position within a key, also when one key is very large.

A window over a key sorts all rows of that key in one task.  That is right for keys
of usual size.  Keys above ``hot_rows`` rows take another way to the same answer: their
rows are range-partitioned by (key, order) and cut into slices of at most ``hot_rows`` rows, so
that one key spans many slices, the window runs inside each slice, and the slices are joined at
their edges.  There are at most (hot keys + slices) edges, both bounded by rows / hot_rows and the partitions.
Slices are numbers of rows, not tasks: partitions follow the session's setting, however low the limit is.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.session import cut

HOT_ROWS = 4_000_000
PLACES = (1 << 33) - 1


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names]
    )


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than hot_rows rows, or None; counted with map-side combining."""
    counts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
    )
    return None if counts.isEmpty() else cut(counts)


def _in_one_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    next_of: Mapping[str, str],
    previous_of: Mapping[str, str],
    sequence: str | None,
) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    added = {name: F.lead(c).over(w) for name, c in next_of.items()}
    added |= {name: F.lag(c).over(w) for name, c in previous_of.items()}
    if sequence:
        added[sequence] = F.row_number().over(w).cast("bigint")
    return df.withColumns(added)


def _in_slices(
    df: DataFrame,
    partitions: int,
    slice_rows: int,
    keys: Sequence[str],
    order: Sequence[str],
    next_of: Mapping[str, str],
    previous_of: Mapping[str, str],
    sequence: str | None,
) -> DataFrame:
    # The slice numbers are written down: both uses below must see the same ones.
    # The row number holds the partition above bit 33 and the place in it below.
    sorted_rows = df.repartitionByRange(partitions, *keys, *order).sortWithinPartitions(*keys, *order)
    sliced = cut(
        sorted_rows.withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_slice", F.expr(f"(_at & ~{PLACES}L) | ((_at & {PLACES}L) div {slice_rows}L)"))
        .drop("_at")
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    position = F.struct(*order)
    first_row = F.struct(*[F.col(c).alias(name) for name, c in next_of.items()], F.lit(1).alias("_"))
    last_row = F.struct(*[F.col(c).alias(name) for name, c in previous_of.items()], F.lit(1).alias("_"))

    across = Window.partitionBy(*keys).orderBy("_slice")
    edges = (
        sliced.groupBy(*keys, "_slice")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min_by(first_row, position).alias("_first"),
            F.max_by(last_row, position).alias("_last"),
        )
        .select(
            *keys,
            "_slice",
            F.lead("_first").over(across).alias("_after"),
            F.lag("_last").over(across).alias("_before"),
            F.coalesce(
                F.sum("_rows").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
        )
    )

    place = F.row_number().over(inside)
    rows = sliced.withColumns(
        {"_place": place, "_is_last": F.lead(F.lit(1)).over(inside).isNull()}
        | {f"_n_{name}": F.lead(c).over(inside) for name, c in next_of.items()}
        | {f"_p_{name}": F.lag(c).over(inside) for name, c in previous_of.items()}
    )
    joined = rows.alias("r").join(
        edges.alias("e"),
        reduce(
            lambda a, b: a & b,
            [F.col(f"r.{n}").eqNullSafe(F.col(f"e.{n}")) for n in [*keys, "_slice"]],
        ),
    )
    added = [
        F.when(F.col("_is_last"), F.col(f"_after.{name}")).otherwise(F.col(f"_n_{name}")).alias(name)
        for name in next_of
    ]
    added += [
        F.when(F.col("_place") == 1, F.col(f"_before.{name}"))
        .otherwise(F.col(f"_p_{name}"))
        .alias(name)
        for name in previous_of
    ]
    if sequence:
        added.append((F.col("_offset") + F.col("_place")).alias(sequence))
    return joined.select(*[F.col(f"r.{c}").alias(c) for c in df.columns], *added)


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    next_of: Mapping[str, str] | None = None,
    previous_of: Mapping[str, str] | None = None,
    sequence: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add columns of the next and previous row of the same key, and a 1-based position.

    ``order`` must put the rows of a key in a total order.
    """
    next_of, previous_of = dict(next_of or {}), dict(previous_of or {})
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return _in_one_window(df, keys, order, next_of, previous_of, sequence)
    size = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    usual = df.join(hot, _same(df, hot, keys), "left_anti")
    large = df.join(hot, _same(df, hot, keys), "left_semi")
    most = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size["rows"] / HOT_ROWS) + 1)
    partitions = min(math.ceil(size["rows"] / hot_rows) + 1, most)
    return _in_one_window(usual, keys, order, next_of, previous_of, sequence).unionByName(
        _in_slices(large, partitions, hot_rows, keys, order, next_of, previous_of, sequence)
    )
