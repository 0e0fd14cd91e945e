"""Exact deduplication: two passes over a Bloom filter, built from DataFrame functions only.

Two texts are equal when they are identical after every white-space character is deleted.
Pass 1 counts, for two filter cells per hash, how many rows fall on them; cells met at least
twice become the bits of a filter.  Pass 2 probes it: a row with a cell that was met once has
a text of its own and passes straight through, without a shuffle.  Only the other rows are
grouped by their SHA-256, which decides; a false alarm of the filter costs a shuffled row and
never changes the answer.

The filter has 16 cells a row, at least 2^15 and at most ``max_bits``: at the default of
2^27 it is broadcast as 16 MB of bitmaps, whatever the input.  Past some 8 million rows more
false alarms shuffle, with the same result.

Defined results: a null text counts as empty, so null, empty and blank texts form one group.
Of equal texts the row with the most code points stays, then the smallest id (null ids come
last), then one of the identical rows; ``kept`` is true for exactly one row of a group.  An
empty table gives an empty result.  Input columns are carried in a struct, so their names
cannot clash with those of the operator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ROW, SPACES, addressed, quoted, salted
from tenura.session import cut

MAX_BITS = 1 << 27
BITMAP = 32768  # bits of one bitmap of bitmap_construct_agg


def stripped(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), SPACES, F.coalesce(text, F.lit("")))


def with_hash(rows: DataFrame, carried: list[str]) -> DataFrame:
    """doc (struct of the carried columns), id, n (code points), sha and row of addressed documents."""
    return rows.select(
        F.struct(*quoted(carried)).alias("doc"),
        F.col("doc_id").alias("id"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n"),
        F.sha2(stripped(F.col("text")).cast("binary"), 256).alias("sha"),
        F.col(ROW).alias("row"),
    )


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    bits = BITMAP
    while bits < 16 * rows and bits < max_bits:
        bits *= 2
    return min(bits, max_bits)


def _cell(sha: Column, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), sha), F.lit(bits))


def repeated_cells(hashed: DataFrame, bits: int) -> DataFrame:
    """Pass 1: bitmaps (bucket, bitmap) of the cells that at least two rows fall on."""
    cells = hashed.select(F.explode(F.array(_cell(F.col("sha"), 1, bits), _cell(F.col("sha"), 2, bits))).alias("cell"))
    twice = cells.groupBy("cell").count().where("count > 1").select((F.col("cell") + 1).alias("cell"))
    return twice.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap")
    )


def probed(hashed: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Pass 2: the rows with ``maybe``, false only if the text occurs once."""
    small = F.broadcast(bitmaps)  # bits / 8 bytes at most, see MAX_BITS
    out = hashed
    for seed in (1, 2):
        at = F.pmod(F.xxhash64(F.lit(seed), F.col("sha")), F.lit(bits)).alias("at")
        out = out.withColumn(f"at{seed}", at).withColumn(f"bucket{seed}", F.expr(f"at{seed} div {BITMAP} + 1"))
        named = small.select(F.col("bucket").alias(f"bucket{seed}"), F.col("bitmap").alias(f"bitmap{seed}"))
        out = out.join(named, f"bucket{seed}", "left").withColumn(
            f"hit{seed}",
            F.expr(
                f"coalesce(getbit(cast(conv(hex(substring(bitmap{seed}, cast(at{seed} % {BITMAP} div 8 + 1 AS int), 1)), "
                f"16, 10) AS bigint), cast(at{seed} % 8 AS int)), 0) = 1"
            ),
        ).drop(f"bitmap{seed}")
    return out.withColumn("maybe", F.col("hit1") & F.col("hit2")).select(*hashed.columns, "maybe")


def judged_groups(again: DataFrame) -> DataFrame:
    """Rows that may be repeated, with keep_id, group_size and kept."""
    order = F.struct(
        (-F.col("n")).alias("n"), F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row")
    )
    groups = (
        again.groupBy("sha")
        .agg(F.count("*").alias("size"), F.min(order).alias("first"))
        .where("size > 1")
        .select("sha", "size", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row"))
    )
    return salted(again, groups, "sha", F.col("row")).select(
        *[F.col(c) for c in again.columns],
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("row") == F.col("first_row"))).alias("kept"),
    )


def exact_groups(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    hashed = cut(with_hash(addressed(docs), ["doc_id"]).drop("doc"))
    bits = filter_bits(hashed.count(), max_bits)
    rows = probed(hashed, repeated_cells(hashed.select("sha"), bits), bits)
    once = rows.where("not maybe").drop("maybe").select(
        "*", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    return once.unionByName(judged_groups(rows.where("maybe").drop("maybe"))).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def exact_dedup(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay, with all their columns.

    The texts are hashed on a first scan, of which narrow columns are written, and again on the
    scan that returns the documents: those that the filter clears never leave their task.
    """
    whole = with_hash(addressed(docs), docs.columns)
    hashed = cut(whole.drop("doc"))
    bits = filter_bits(hashed.count(), max_bits)
    bitmaps = cut(repeated_cells(hashed.select("sha"), bits))
    stay = cut(judged_groups(probed(hashed, bitmaps, bits).where("maybe").drop("maybe")).where("kept").select("row"))
    rows = probed(whole, bitmaps, bits)
    again = rows.where("maybe").join(stay, "row", "left_semi")
    return rows.where("not maybe").select("doc.*").unionByName(again.select("doc.*"))
