"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents.  Labels for the toxicity model come from the folder of tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenura.llm.exact_dedup import exact_dedup
from tenura.llm.mixing import mixed
from tenura.llm.near_copies import near_copies_dropped
from tenura.llm.packing import packed_pieces
from tenura.llm.toxicity import without_toxic
from tenura.session import cut


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share four fifths of their five-word shingles one document stays."""
    return near_copies_dropped(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is taken to its target; a document that is taken twice is there twice."""
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packed_pieces(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

# No SQL: the first stage's model, the rounding and the packing cannot be written in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
