"""Exact groups of near copies from nodes that hold sets which may be alike, without a pair for each two of a group.

A set has a ``key``, a ``print`` (its fingerprint or signature, by which the distance of two sets is guessed), and stands in
nodes.  Two steps, neither of which ever lists the pairs of a group:

1. Candidates.  In each node the sets within the limit of one another are found, by comparing prints or by an index that the
   caller gives (``places``); what is reached from set to set is one cluster, written as one row a set.  Clusters of all nodes that share a set are joined.
   So every pair that some node shows within the limit is in one cluster.  Nodes come in two batches; in the second,
   sets go by the cluster that the first has given them, so a large group costs one row a set and node of the
   first, small batch only.
2. Exact sets.  The sets of a cluster meet in a task, once, and all their intersections are counted together as
   products of incidence matrices of their shingles.  Sets that are alike are joined to groups; unlike pairs
   leave nothing behind, however many there are.

Nodes and clusters that are too large for a task are dealt into parts by a hash of the key, and every two parts
meet in a task of their own, so no pair is left out, and no task holds more than two parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import salted
from tenura.llm.simhash import components
from tenura.session import cut

NODE_ROWS = 16_384  # prints of one part of a node
CLUSTER_ROWS = 1024  # sets of one part of a cluster,
CLUSTER_SHINGLES = 1 << 21  # and their shingles
CHUNK_ROWS = 1 << 14
CHUNK_BYTES = 1 << 25
CELLS = 1 << 23  # bytes of prints that are compared at once
DENSE = 4  # close pairs for each print beyond which prints are walked; either way gives the same
COLUMNS = 4096  # shingles of one product
FEW = 6  # sets so few are compared one by one
Apart = Callable[[np.ndarray, np.ndarray], np.ndarray]
Places = Callable[[np.ndarray, int], np.ndarray]


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of prints, rows of bytes whose number is divisible by eight."""
    a, b = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    total = np.bitwise_count(a[..., 0] ^ b[..., 0]).astype(np.uint16)
    for word in range(1, a.shape[-1]):
        total += np.bitwise_count(a[..., word] ^ b[..., word])
    return total


def bytes_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in which prints differ."""
    return np.count_nonzero(a != b, axis=-1)


def reached(n: int, near: Callable[[np.ndarray, np.ndarray], np.ndarray], step: int) -> np.ndarray:
    """For each of n places the first place of what can be reached from it; ``near`` compares two lists of places."""
    label, open_places = np.full(n, -1), np.arange(n)
    while len(open_places):
        seed, open_places = open_places[0], open_places[1:]
        label[seed], waiting = seed, np.array([seed])
        while len(waiting) and len(open_places):
            now, waiting = waiting[:step], waiting[step:]
            hit = near(now, open_places).any(axis=0)
            found, open_places = open_places[hit], open_places[~hit]
            label[found] = seed
            waiting = np.concatenate([waiting, found])
    return label


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the first place that pairs (a, b) connect it with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if np.array_equal(label, before):
            return label


def close_places(prints: np.ndarray, apart: Apart, most: int) -> np.ndarray:
    """For each print the first that it is connected with, by steps of at most ``most``.

    All prints are compared while few are close; where many are, they are walked instead, which passes by what is reached.
    """
    n = len(prints)
    step = max(1, CELLS // prints.size)
    a, b, found = [], [], 0
    for at in range(0, n, step):
        i, j = np.nonzero(apart(prints[at : at + step, None, :], prints[None, at:, :]) <= most)
        later = j > i
        a.append(i[later] + at)
        b.append(j[later] + at)
        found += len(a[-1])
        if found > DENSE * n:

            def near(now: np.ndarray, others: np.ndarray) -> np.ndarray:
                return apart(prints[now][:, None, :], prints[others][None, :, :]).reshape(len(now), -1) <= most

            return reached(n, near, step)
    return joined(n, np.concatenate(a), np.concatenate(b))


def _groups(batches: Iterator[pa.RecordBatch], size_of: Callable[[pa.RecordBatch], int]) -> Iterator[pa.Table]:
    """Tables of whole groups, from rows that come sorted by their first column."""
    held, rows, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            split = int(np.searchsorted(group, held[-1].column(0)[-1].as_py(), side="right"))
            if split < len(group):
                yield pa.Table.from_batches([*held, batch.slice(0, split)])
                held, rows, size, batch = [], 0, 0, batch.slice(split)
        held.append(batch)
        rows, size = rows + batch.num_rows, size + size_of(batch)
    if held:
        yield pa.Table.from_batches(held)


def _spans(group: np.ndarray) -> Iterator[tuple[int, int]]:
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist()
    return zip(starts, [*starts[1:], len(group)], strict=True)


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    """The links as stars: each key and the smallest that they connect it with."""
    nothing = [np.zeros(0, np.int64)]
    keys, place = np.unique(np.concatenate([*a, *b] or nothing), return_inverse=True)
    half = len(place) // 2
    label = joined(len(keys), place[:half], place[half:])
    moved = np.flatnonzero(label != np.arange(len(keys)))
    return pa.RecordBatch.from_arrays([pa.array(keys[label[moved]]), pa.array(keys[moved])], names=["a", "b"])


def _candidates(apart: Apart, most: int, places: Places | None = None):
    def compared(prints: np.ndarray, most: int) -> np.ndarray:
        return close_places(prints, apart, most)

    places = places or compared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, lambda b: 0):
            group, key = (table.column(i).to_numpy() for i in (0, 1))
            prints = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(len(key), -1)
            a, b = [], []
            for start, stop in _spans(group):
                own = key[start:stop]  # the set, or the cluster that it has already
                if stop - start < 2 or (own == own[0]).all():
                    continue
                if stop - start == 2:
                    if apart(prints[start], prints[start + 1]) <= most:
                        a.append(own[:1])
                        b.append(own[1:])
                    continue
                label = places(prints[start:stop], most)
                pairs = np.unique(np.stack([own[label], own], axis=1), axis=0)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
            yield _pairs(a, b)

    return run


def alike(sets: list[np.ndarray], side: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """Whether two sets are similar enough, as a matrix; sets of two different parts only, if there are two."""
    part, whole = similar
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    left, right = (np.flatnonzero(side == v) for v in (0, 1))
    if not len(right) or not len(left):
        left = right = np.arange(n)
    both = np.zeros((len(left), len(right)), np.int64)
    if n <= FEW:
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                if x < y and whole * min(sizes[x], sizes[y]) >= part * max(sizes[x], sizes[y]) > 0:
                    at = np.minimum(np.searchsorted(sets[y], sets[x]), sizes[y] - 1)
                    both[i, j] = np.count_nonzero(sets[y][at] == sets[x])
    else:
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), sizes)
        shared = often[column] > 1  # a shingle of one set is in no intersection
        owner, column = owner[shared], column[shared]
        column = np.unique(column, return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            low, high = np.searchsorted(column, [at, at + COLUMNS])
            ones = np.zeros((n, COLUMNS), np.float32)
            ones[owner[low:high], column[low:high] - at] = 1
            both += (ones[left] @ ones[right].T).astype(np.int64)
    near = whole * both >= part * (sizes[left][:, None] + sizes[right][None, :] - both)
    near &= (sizes[left] > 0)[:, None] & (sizes[right] > 0)[None, :]
    out = np.zeros((n, n), bool)
    out[np.ix_(left, right)] = near
    return out | out.T


def _confirmed(similar: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, lambda b: b.column(3).nbytes):
            group, side, key = (table.column(i).to_numpy() for i in (0, 1, 2))
            shingles = table.column(3)
            a, b = [], []
            for start, stop in _spans(group):
                if stop - start < 2:
                    continue
                sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in shingles.slice(start, stop - start)]
                near = alike(sets, side[start:stop], similar)
                label = reached(len(sets), lambda now, others, near=near: near[np.ix_(now, others)], len(sets))
                moved = np.flatnonzero(label != np.arange(len(label)))
                a.append(key[start + label[moved]])
                b.append(key[start + moved])
            yield _pairs(a, b)

    return run


def in_part_pairs(rows: DataFrame, parts: DataFrame, of: str) -> DataFrame:
    """``rows`` with the group in which a row is compared: its ``of``, or every pair of parts that holds
    its own part; ``side`` tells the two parts of a pair."""
    if parts.isEmpty():
        return rows.withColumns({"group": F.col(of), "side": F.lit(0)})
    dealt = salted(rows, parts, of, F.col("key")).withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    paired = dealt.withColumn("part", F.expr("pmod(xxhash64(key), parts)"))
    paired = paired.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
    group = f"CASE WHEN parts = 1 THEN {of} ELSE xxhash64({of}, least(part, other), greatest(part, other)) END"
    side = F.expr("CAST(part > other AS int)")
    return paired.withColumns({"group": F.expr(group), "side": side}).drop("parts", "part", "other")


def candidate_clusters(
    batches: Iterable[tuple[DataFrame, DataFrame]], apart: Apart, most: int, places: Places | None = None
) -> DataFrame:
    """key, cluster of every set that some node (node, key, print) shows within ``most`` of another.

    Each batch is its nodes and a frame with the same nodes, to count their sets from.  ``places(prints, most)`` gives for
    each print of a node the first that it is connected with; without it, prints are compared by ``apart``.
    """
    clusters = None
    for named, counted in batches:
        sizes = counted.groupBy("node").agg(F.count("*").alias("size")).where(F.col("size") > NODE_ROWS)
        parts = cut(sizes.select("node", F.expr(f"(size + {NODE_ROWS - 1}) div {NODE_ROWS}").alias("parts")))
        rows = in_part_pairs(named, parts, "node")
        if clusters is not None:
            rows = rows.join(clusters, "key", "left").withColumn("key", F.coalesce("cluster", "key"))
        rows = rows.select("group", "key", "print").repartition("group").sortWithinPartitions("group")
        found = rows.mapInArrow(_candidates(apart, most, places), "a long, b long")
        moved = cut(components(cut(found.distinct())).select(F.col("node").alias("key"), F.col("root").alias("cluster")))
        if clusters is None:
            clusters = moved
        else:
            to = moved.select(F.col("key").alias("cluster"), F.col("cluster").alias("to"))
            kept = salted(clusters, to, "cluster", F.col("key")).select("key", F.coalesce("to", "cluster").alias("cluster"))
            clusters = cut(kept.unionByName(moved).distinct())
    return clusters


def alike_groups(clusters: DataFrame, sets_of: Callable[[DataFrame], DataFrame], sizes: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """key, root of every set that is similar enough to another of its cluster, directly or through others.

    ``sets_of(keys)`` gives (key, shingles: sorted 64-bit hashes) for (key, ...); ``sizes`` has key, n_shingles.
    """
    weighed = clusters.join(sizes, "key").groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight"))
    number = F.greatest(F.ceil(F.col("size") / CLUSTER_ROWS), F.ceil(F.col("weight") / CLUSTER_SHINGLES))
    parts = cut(weighed.withColumn("parts", number.cast("long")).where("parts > 1 and size > 1").select("cluster", "parts"))
    rows = in_part_pairs(sets_of(clusters), parts, "cluster").select("group", "side", "key", "shingles")
    found = cut(rows.repartition("group").sortWithinPartitions("group").mapInArrow(_confirmed(similar), "a long, b long"))
    return cut(components(found).select(F.col("node").alias("key"), "root"))
