"""Near-duplicates of word shingles by min-max hashing.

A-Z are lower-cased, words are runs of anything but the six white-space characters, and a document's set has its
distinct shingles of two words (a single word is one shingle).  Two documents link if 100 times the intersection of their
sets is at least 80 times the union; linked documents form components.

Each permutation is evaluated once over a set and gives two places of the signature, its minimum and its
maximum.  Either agrees in two sets with a chance equal to their similarity, and as the two cannot both be wrong for the same
element, their mean varies less than that of two permutations.  A band is ``rows`` minima, and its twin the maxima of the same
permutations.  ``rows`` grows with the number of documents (unlike sets then seldom meet) and the number of bands with it,
so that a pair at the threshold shares no band with a chance of 1 in 100 000 at most.  Sets that share a
band meet in a node; pairs whose whole signatures agree in too few places (five standard deviations below
the threshold) are left out there, all others form clusters, and within a cluster all sets are compared in full (``clusters``).

Equal sets, told by a 128-bit hash, are one set throughout.  Shingles are held as 64-bit hashes.

Defined results: null, empty and blank texts have no shingles, link with nothing, and are kept; repeated rows link like
any equal texts; null ids are never the smallest unless a component has no other; an empty table gives
an empty result.  Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ROW, addressed, ready, salted
from tenura.llm.clusters import alike_groups, bytes_apart, candidate_clusters
from tenura.llm.simhash import one_of_each, shingle_hashes
from tenura.session import cut

WIDTH = 2
SEED = 42
SIMILAR = (80, 100)
MISSED = 1e-5  # chance that a pair at the threshold shares no band
LEAST_ROWS = 5
DEVIATIONS = 5
FIRST_BANDS = 4
CHUNK = 1 << 13  # shingles whose permutations are evaluated at once


@dataclass(frozen=True)
class Plan:
    """How many permutations make a band, and how many bands there are (half of them minima)."""

    rows: int
    bands: int
    similar: tuple[int, int] = SIMILAR
    width: int = WIDTH
    seed: int = SEED

    @property
    def permutations(self) -> int:
        return self.rows * self.bands // 2

    @property
    def most(self) -> int:
        """Places in which signatures of linked sets may differ."""
        places, s = 2 * self.permutations, self.similar[0] / self.similar[1]
        return math.floor(places * (1 - s) + DEVIATIONS * math.sqrt(places * s * (1 - s)))


def plan_of(documents: int, similar: tuple[int, int] = SIMILAR, width: int = WIDTH, seed: int = SEED) -> Plan:
    rows = max(LEAST_ROWS, math.ceil(math.log10(max(documents, 1))))
    together = (similar[0] / similar[1]) ** rows
    return Plan(rows, 2 * math.ceil(math.log(MISSED) / math.log(1 - together) / 2), similar, width, seed)


def shingle_set(data: bytes | None, plan: Plan) -> np.ndarray:
    return np.unique(shingle_hashes(data or b"", plan.width, plan.seed))


class MinMax:
    """Signatures under the permutations of a plan."""

    def __init__(self, plan: Plan) -> None:
        rng = np.random.default_rng(plan.seed)
        self.plan = plan
        self.flip, self.factor = rng.integers(0, 1 << 63, (2, plan.permutations), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.mix = rng.integers(0, 1 << 63, plan.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Minima, then maxima, of a set that is not empty."""
        low = high = None
        for at in range(0, len(hashes), CHUNK):
            values = (hashes[at : at + CHUNK, None] ^ self.flip) * self.factor
            least, most = values.min(axis=0), values.max(axis=0)
            low = least if low is None else np.minimum(low, least)
            high = most if high is None else np.maximum(high, most)
        return np.concatenate([low, high])

    def nodes(self, signature: np.ndarray) -> np.ndarray:
        """A number for each band."""
        bands = signature.reshape(self.plan.bands, self.plan.rows)
        mixed = ((bands ^ (bands >> np.uint64(29))) * self.mix).sum(axis=1, dtype=np.uint64)
        mixed = (mixed ^ np.arange(len(bands), dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def _marks(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = MinMax(plan)
        for batch in batches:
            sizes, names, nodes, prints = [], [], [], []
            for text in batch.column(2).to_pylist():
                own = shingle_set(text, plan)
                sizes.append(len(own))
                if len(own):
                    signature = hashing.of(own)
                    names.append(xxhash.xxh3_128_digest(own.tobytes(), plan.seed))
                    nodes.append(hashing.nodes(signature))
                    prints.append((signature >> np.uint64(24)).astype(np.uint8).tobytes())
                else:
                    names.append(None)
                    nodes.append(None)
                    prints.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                    pa.array(nodes, pa.list_(pa.int64())), pa.array(prints, pa.binary()),
                ],
                names=["id", "row", "n_shingles", "set", "nodes", "print"],
            )

    return run


def _sets(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, plan).tobytes() for t in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "cluster", "shingles"])

    return run


def shared_nodes(reps: DataFrame, first: int, stop: int) -> DataFrame:
    """node, key of the bands from ``first`` to ``stop`` that at least two sets share."""
    bands = reps.select("key", F.explode(F.slice("nodes", first + 1, stop - first)).alias("node"))
    repeated = bands.groupBy("node").agg(F.count("*").alias("size")).where("size > 1").select("node")
    return cut(salted(bands, repeated, "node", F.col("key"), "inner").select("node", "key"))


def labelled(docs: DataFrame, rows: DataFrame, similar: tuple[int, int], width: int, seed: int) -> DataFrame:
    """id, row, n_shingles, root (null if alone) and component (the smallest id reachable) of every document."""
    ready(docs.sparkSession)
    narrow = rows.select(F.col("doc_id").alias("id"), F.col(ROW).alias("row"), F.col("text").cast("binary").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    plan = plan_of(docs.count(), similar, width, seed)
    schema = f"id {kinds['id']}, row {kinds['row']}, n_shingles long, set binary, nodes array<long>, print binary"
    marks = cut(narrow.mapInArrow(_marks(plan), schema))
    reps = marks.where("set is not null").groupBy("set").agg(
        F.min("row").alias("row"), F.min("id").alias("first"), F.count("*").alias("n"),
        F.first("nodes").alias("nodes"), F.first("print").alias("print"), F.first("n_shingles").alias("n_shingles"),
    )
    reps = cut(reps.withColumn("key", F.monotonically_increasing_id()))

    def sets_of(clusters: DataFrame) -> DataFrame:
        wanted = reps.select("row", "key").join(clusters, "key")
        return narrow.select("row", "text").join(wanted, "row").select("key", "cluster", "text").mapInArrow(
            _sets(plan), "key long, cluster long, shingles binary"
        )

    shared = [shared_nodes(reps, 0, FIRST_BANDS), shared_nodes(reps, FIRST_BANDS, plan.bands)]
    clusters = candidate_clusters([(s.join(reps.select("key", "print"), "key"), s) for s in shared], bytes_apart, plan.most)
    roots = alike_groups(clusters, sets_of, reps.select("key", "n_shingles"), similar)
    named = reps.select("set", "key", "first", "n").join(roots, "key", "left").where("n > 1 or root is not null")
    named = cut(named.select("set", F.coalesce("root", "key").alias("root"), "first"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    groups = salted(named, smallest, "root", F.col("set"), "inner").select("set", "root", "component")
    met = salted(marks.select("id", "row", "n_shingles", "set"), groups, "set", F.col("row"))
    return met.withColumn("component", F.coalesce("component", "id"))


def near_groups(docs: DataFrame, similar: tuple[int, int] = SIMILAR, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (it is the smallest of its component) for every document."""
    found = labelled(docs, addressed(docs), similar, width, seed)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def near_dedup(docs: DataFrame, similar: tuple[int, int] = SIMILAR, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns."""
    rows = addressed(docs)
    groups = labelled(docs, rows, similar, width, seed).where("root is not null").select("id", "row", "root")
    return one_of_each(docs, rows, groups)
