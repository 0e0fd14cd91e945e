"""Near copies by shingle similarity, found with SimHash and confirmed: a stage of the pipeline.

A text's shingles are five words joined by a space, A-Z lower-cased, each counted once (a shorter text is
one shingle); two texts are near copies if their sets have a Jaccard similarity of 0.8 or more.
Texts with equal sets are one node; of what near copies link, the document of the smallest id stays.

Candidates: two texts of similarity s differ in about arccos(2s / (1 + s)) / pi of their SimHash bits, 0.15 at
0.8 (10 of 64, with a wide spread), so each set has 128 bits and pairs may differ in up to 34.  No split of so many
bits into bands is both selective and free of loss; instead ``tables`` stated choices of ``bits`` places name the
nodes in which a set is compared.  ``bits`` grows with the number of sets, so that a node keeps some 512,
and ``tables`` with it, so that a pair at 0.8 shares no node with a chance of about one in a thousand.

Within a node the fingerprints go through the Gray-order hierarchical index of ``simhash``: sorted by Gray rank, under levels
of shared bits, and searched from the top for the links that join its components.
Sets that a node shows within the limit of one another form clusters, and within a cluster all sets are
compared exactly (``clusters``), so no candidate is lost, also in dense and very large nodes, and a fingerprint that
is close by chance links nothing.  Sets are told apart by 128 bits of hash.

Defined results: texts without words have equal, empty sets; null ids are kept only where a component has
no other; an empty table gives an empty result.  Other columns are carried in a struct.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ROW, addressed, ready, salted
from tenura.llm.clusters import alike_groups, bits_apart, candidate_clusters, joined
from tenura.llm.simhash import CHUNK_ROWS, GrayIndex, one_of_each, shingle_hashes
from tenura.session import cut

WIDTH = 5
SEED = 42
SIMILAR = (4, 5)  # at least 4/5
MOST = 34
LEAST_BITS = 12
FIRST_TABLES = 5
DIFFERS = 0.152  # share of bits that differ at 0.8


def shingle_set(data: bytes | None) -> np.ndarray:
    return np.unique(shingle_hashes(data or b"", WIDTH, SEED))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """Two words of 64 bits: each bit is 1 if it is set in over half the hashes."""
    counts = np.zeros(128, np.int64)
    for at in range(0, len(hashes), CHUNK_ROWS):
        part = hashes[at : at + CHUNK_ROWS]
        more = (part ^ (part >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        more = (more ^ (more >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        both = np.stack([part, more ^ (more >> np.uint64(32))], axis=1).astype("<u8")
        counts += np.unpackbits(both.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in batch.column(2).to_pylist()]
        names = [xxhash.xxh3_128_digest(s.tobytes(), SEED) for s in sets]
        prints = [wide_fingerprint(s).tobytes() for s in sets]
        sizes = pa.array([len(s) for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names, pa.binary()), pa.array(prints, pa.binary()), sizes],
            names=["id", "row", "set", "print", "n_shingles"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t).tobytes() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], names=["key", "cluster", "shingles"])


def gray_places(prints: np.ndarray, most: int) -> np.ndarray:
    """For each fingerprint of a node the first that it is connected with, by the index's links."""
    index = GrayIndex(np.ascontiguousarray(prints).view(np.uint64))
    a, b = index.forest(most)
    return joined(len(prints), index.order[a], index.order[b])


def plan_of(n: int) -> tuple[int, int]:
    """(bits that name a node, tables) for so many sets."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(n, 1) / 512)))
    return bits, math.ceil(math.log(0.001) / math.log(1 - (1 - DIFFERS) ** bits))


def _named(bits: int, first: int, stop: int):
    rng = np.random.default_rng(SEED)
    places = [rng.choice(128, bits, replace=False) for _ in range(stop)]
    powers = 1 << np.arange(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, 16)
            all_bits = np.unpackbits(prints, axis=1, bitorder="little")
            for t in range(first, stop):
                node = (t << bits) + all_bits[:, places[t]] @ powers
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.astype(np.int64)), batch.column(0), batch.column(1)], names=["node", "key", "print"]
                )

    return run


def near_copies_dropped(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns."""
    ready(docs.sparkSession)
    rows = addressed(docs)
    narrow = rows.select(F.col("doc_id").alias("id"), F.col(ROW).alias("row"), F.col("text").cast("binary").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    marks = cut(narrow.mapInArrow(_marks, f"id {kinds['id']}, row {kinds['row']}, set binary, print binary, n_shingles long"))
    reps = marks.groupBy("set").agg(
        F.min("row").alias("row"), F.first("print").alias("print"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("n")
    )
    reps = cut(reps.withColumn("key", F.monotonically_increasing_id()))

    def sets_of(clusters: DataFrame) -> DataFrame:
        wanted = reps.select("row", "key").join(clusters, "key")
        return narrow.select("row", "text").join(wanted, "row").select("key", "cluster", "text").mapInArrow(
            _sets, "key long, cluster long, shingles binary"
        )

    bits, tables = plan_of(reps.count())
    spans = ((0, FIRST_TABLES), (FIRST_TABLES, tables))
    named = [reps.select("key", "print").mapInArrow(_named(bits, *span), "node long, key long, print binary") for span in spans]
    clusters = candidate_clusters([(n, n) for n in named], bits_apart, MOST, gray_places)
    roots = alike_groups(clusters, sets_of, reps.select("key", "n_shingles"), SIMILAR)
    groups = reps.select("set", "key", "n").join(roots, "key", "left").where("n > 1 or root is not null")
    groups = cut(groups.select("set", F.coalesce("root", "key").alias("root")))
    return one_of_each(docs, rows, salted(marks, groups, "set", F.col("row"), "inner").select("id", "row", "root"))
