"""SimHash near-deduplication with a Gray-order hierarchical index.

A text's words are taken after A-Z are lower-cased, its shingles are ``width`` words joined by a space,
repeats included (a shorter text is one shingle), and each shingle is hashed by XXH64.  A bit
of the 64-bit fingerprint is 1 if it is set in over half the hashes.  Fingerprints link
at ``most`` or fewer differing bits; linked fingerprints form components.

Only distinct fingerprints are compared; copies meet in an aggregation.  Among 64 bits in four
bands, two fingerprints with at most three differences agree on one band, so each
fingerprint goes to four nodes, named by a band and its bits.  A node that is larger than
``node_rows`` is split once and once more by the same rule on the bits that it does not
share.  Within a node the fingerprints are sorted by Gray rank, so neighbours differ in few
bits; runs of them are leaves, and each upper node keeps the bits that all below it share (a
mask and a pattern).  Pairs of nodes are compared from the top: differences on bits that both
share are accumulated on the way down, and a pair is pruned when they exceed ``most``, or
when all below both is already one component.  The links that remain are checked bit
by bit.  From a large node only links that join components are returned, a spanning forest,
which loses no component.  Components come from alternating large-star and small-star steps on
the links, each written to the shared folder.

Defined results: null, empty and blank texts have fingerprint zero and link like any other;
repeated rows have equal fingerprints; null ids are ignored as the smallest id unless a component has
no other; an empty table gives an empty result.  Only id and text are read, other columns are
carried in a struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ROW, addressed, quoted, ready, salted
from tenura.session import cut

WIDTH = 3
SEED = 42
MOST = 3
NODE_ROWS = 4096
LEAF = 32
FAN = 8
CHUNK_ROWS = 1 << 16


def shingle_hashes(data: bytes, width: int, seed: int) -> np.ndarray:
    words = data.lower().split()  # on bytes: A-Z only, and exactly the six white-space characters
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    spans = zip((ends - lengths).tolist(), ends[width - 1 :].tolist(), strict=False)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - width + 1)


def fingerprint(data: bytes | None, width: int = WIDTH, seed: int = SEED) -> int:
    """The fingerprint as a signed 64-bit number."""
    hashes = shingle_hashes(data or b"", width, seed)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK_ROWS):
        part = hashes[at : at + CHUNK_ROWS].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, width: int = WIDTH, seed: int = SEED) -> Column:
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width, seed) for t in texts], dtype="int64")

    return F.pandas_udf(of, "long")(text.cast("binary"))


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in the binary reflected Gray order."""
    out = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _ones(values: np.ndarray) -> np.ndarray:
    """Bits set in each fingerprint, which is one word or a row of words."""
    counts = np.bitwise_count(values)
    return counts if counts.ndim == 1 else counts.sum(axis=1, dtype=np.int64)


class GrayIndex:
    """Fingerprints of one node (words, or rows of words) in Gray order, under levels of shared bits."""

    def __init__(self, values: np.ndarray) -> None:
        ranks = gray_rank(values)
        self.order = np.argsort(ranks, kind="stable") if values.ndim == 1 else np.lexsort(ranks.T[::-1])
        self.values = values[self.order]
        n = len(self.values)
        size, both, some = LEAF, self.values, self.values
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (mask of shared bits, their pattern), leaves first
        while True:
            starts = np.arange(0, len(both), size)
            both, some = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(some, starts)
            mask = ~(both ^ some)
            self.levels.append((mask, both & mask))
            if len(both) == 1:
                break
            size = FAN
        self.spans = [LEAF * FAN**k for k in range(len(self.levels))]
        self.n = n

    def forest(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Links that join the components of this node, as places (a, b) in Gray order."""
        v, n = self.values, self.n
        near = _ones(v[1:] ^ v[:-1]) <= most
        at = np.flatnonzero(near)
        found = [(at, at + 1)]
        run = np.concatenate([[0], np.cumsum(~near)])  # runs of linked neighbours are one component already
        parent = np.arange(run[-1] + 1)
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros_like(v[:1]))]
        while stack:
            level, i, j, differ, seen = stack.pop()
            mask, pattern = self.levels[level]
            shared = mask[i] & mask[j]
            differ = differ + _ones((pattern[i] ^ pattern[j]) & shared & ~seen)
            component = parent[run]
            starts = np.arange(0, n, self.spans[level])
            low, high = np.minimum.reduceat(component, starts), np.maximum.reduceat(component, starts)
            one = (low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j])
            keep = (differ <= most) & ~one
            i, j, differ, seen = i[keep], j[keep], differ[keep], shared[keep]
            if not len(i):
                continue
            if level:
                child = np.arange(FAN)
                ci = (i[:, None, None] * FAN + child[None, :, None]).repeat(FAN, axis=2).ravel()
                cj = (j[:, None, None] * FAN + child[None, None, :]).repeat(FAN, axis=1).ravel()
                differ, seen = differ.repeat(FAN * FAN), seen.repeat(FAN * FAN, axis=0)
                count = len(self.levels[level - 1][0])
                valid = (ci <= cj) & (cj < count) & (ci < count)
                ci, cj, differ, seen = ci[valid], cj[valid], differ[valid], seen[valid]
                for k in range(0, len(ci), 1024):
                    stack.append((level - 1, ci[k : k + 1024], cj[k : k + 1024], differ[k : k + 1024], seen[k : k + 1024]))
                continue
            leaf = np.arange(LEAF)
            a = (i[:, None, None] * LEAF + leaf[None, :, None]).repeat(LEAF, axis=2).ravel()
            b = (j[:, None, None] * LEAF + leaf[None, None, :]).repeat(LEAF, axis=1).ravel()
            valid = (a < b) & (b < n)
            a, b = a[valid], b[valid]
            hit = _ones(v[a] ^ v[b]) <= most
            a, b = a[hit], b[hit]
            ra, rb = component[a], component[b]
            joins = ra != rb
            if not joins.any():
                continue
            a, b, ra, rb = a[joins], b[joins], ra[joins], rb[joins]
            first = np.unique(np.minimum(ra, rb) * len(parent) + np.maximum(ra, rb), return_index=True)[1]
            used = []
            for k in first.tolist():
                x, y = int(ra[k]), int(rb[k])
                while parent[x] != x:
                    x = int(parent[x])
                while parent[y] != y:
                    y = int(parent[y])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    used.append(k)
            parent = _roots(parent)
            found.append((a[used], b[used]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def node_links(node: np.ndarray, values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprints a, b) within each node; nodes of a leaf's size are compared as one leaf."""
    order = np.lexsort((gray_rank(values), node))
    node, values = node[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    sizes = np.diff(np.append(starts, len(node)))
    out = []
    for start, size in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist(), strict=True):
        index = GrayIndex(values[start : start + size])
        a, b = index.forest(most)
        out.append((index.values[a], index.values[b]))
    small = np.repeat(sizes <= LEAF, sizes)
    node, values = node[small], values[small]
    for d in range(1, min(LEAF, len(node))):
        near = (node[d:] == node[:-d]) & (np.bitwise_count(values[d:] ^ values[:-d]) <= most)
        out.append((values[:-d][near], values[d:][near]))
    a = np.concatenate([x[0] for x in out]) if out else np.zeros(0, np.uint64)
    b = np.concatenate([x[1] for x in out]) if out else np.zeros(0, np.uint64)
    return a, b


def _link_batches(most: int):
    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        a, b = node_links(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), most)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0  # rows come sorted by node: a node ends where the next begins
        for batch in batches:
            node = batch.column(0).to_numpy(zero_copy_only=False)
            value = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(node):
                continue
            if rows >= CHUNK_ROWS:
                last = held[-1][0][-1]
                split = int(np.searchsorted(node, last, side="right"))
                if split < len(node):
                    yield from flush([*held, (node[:split], value[:split])])
                    held, rows, node, value = [], 0, node[split:], value[split:]
            held.append((node, value))
            rows += len(node)
        if held:
            yield from flush(held)

    return run


def _banded(rows: DataFrame, width: int) -> DataFrame:
    """Each row in four nodes, one for each quarter of its ``width`` remaining bits."""
    size = width // 4
    band = rows.withColumn("band", F.explode(F.array(*[F.lit(b) for b in range(4)])))
    low, mask = f"band * {size}", (1 << size) - 1
    return band.select(
        F.expr(f"xxhash64(node, band, shiftrightunsigned(rest, {low}) & {mask})").alias("node"),
        "fp",
        F.expr(
            f"CASE WHEN band = 3 THEN rest & {(1 << (3 * size)) - 1}L ELSE "
            f"shiftleft(shiftrightunsigned(rest, {low} + {size}), {low}) | (rest & (shiftleft(1L, {low}) - 1)) END"
        ).alias("rest"),
    )


def links(fps: DataFrame, most: int = MOST, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints; every component of close ones is joined."""
    assert most <= 3, "four bands find at most three differences"
    width = 64
    rows = _banded(fps.select(F.lit(0).cast("long").alias("node"), "fp", F.col("fp").alias("rest")), width)
    ready_rows = []
    for _ in range(2):
        width -= width // 4
        large = cut(rows.groupBy("node").count().where(F.col("count") > node_rows).select("node", F.lit(True).alias("big")))
        if large.isEmpty():
            break
        marked = cut(salted(rows, large, "node", F.col("fp")))
        ready_rows.append(marked.where("big is null").select("node", "fp"))
        rows = _banded(marked.where("big").select("node", "fp", "rest"), width)
    ready_rows.append(rows.select("node", "fp"))
    nodes = reduce(DataFrame.unionByName, ready_rows)
    found = nodes.repartition("node").sortWithinPartitions("node").mapInArrow(_link_batches(most), "a long, b long")
    return found.distinct()


def are_stars(links: DataFrame) -> bool:
    """Whether each u of links (u, v) has one v, and no v is a u: every component is a star then."""
    ends = links.selectExpr("inline(array(named_struct('node', u, 'up', 1), named_struct('node', v, 'up', 0)))")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return nodes.where("up > 1 or up = 1 and n > 1").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node that has a link.

    Rounds end as soon as the links are stars; links that are stars already take none.
    """
    stars = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not are_stars(stars):
        both = stars.selectExpr("inline(array(named_struct('u', u, 'v', v), named_struct('u', v, 'v', u)))")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = salted(both, least, "u", F.col("v"), "inner").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted(large, low, "u", F.col("v"), "inner")
        moved = small.selectExpr("inline(array(named_struct('u', u, 'v', m), named_struct('u', v, 'v', m)))")
        stars = cut(moved.where("u <> v").distinct())
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def labelled(rows: DataFrame, most: int = MOST, node_rows: int = NODE_ROWS) -> DataFrame:
    """``rows`` (a written table with id, fp, row) with ``component``, the smallest id reachable, and ``root``.

    The root names the group by one of its fingerprints; it is null for a row that is alone.
    """
    reps = cut(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    linked = cut(components(links(reps, most, node_rows))).withColumnRenamed("node", "fp")
    named = linked.join(reps, "fp")
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    joined = salted(named, smallest, "root", F.col("fp"), "inner").select("fp", "root", "component")
    groups = (
        reps.join(joined, "fp", "left")
        .where("n > 1 or root is not null")
        .select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "first").alias("component"))
    )
    return salted(rows, groups, "fp", F.col("row")).withColumn("component", F.coalesce("component", "id"))


def with_fingerprints(rows: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """id, fp and row of addressed documents, written once."""
    ready(rows.sparkSession)
    return cut(rows.select(F.col("doc_id").alias("id"), fingerprints(F.col("text"), width, seed).alias("fp"), F.col(ROW).alias("row")))


def near_components(docs: DataFrame, width: int = WIDTH, seed: int = SEED, most: int = MOST) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    return labelled(with_fingerprints(addressed(docs), width, seed), most).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def near_dedup(docs: DataFrame, width: int = WIDTH, seed: int = SEED, most: int = MOST) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns.

    Which rows go is found on narrow columns; the documents are then scanned again and
    those rows left out by their addresses, which no two share.
    """
    rows = addressed(docs)
    groups = labelled(with_fingerprints(rows, width, seed), most).where("root is not null").select("id", "row", "root")
    return one_of_each(docs, rows, groups)


def one_of_each(docs: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` without the rows of ``groups`` (id, row, root) that are not the first of their root."""
    groups = cut(groups)
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    stay = groups.groupBy("root").agg(F.min(rank).alias("best")).select(F.col("best.row").alias("row"))
    gone = cut(groups.select("row").join(stay, "row", "left_anti"))
    whole = rows.select(F.struct(*quoted(docs.columns)).alias("doc"), F.col(ROW).alias("row"))
    return whole.join(gone, "row", "left_anti").select("doc.*")
