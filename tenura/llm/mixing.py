"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies, target / size of the
source.  The whole part is taken; the fraction is rounded dependently: two documents of
the same source exchange probability mass, in a random direction that keeps both
expectations, until one of them is 0 or 1.  Mass is counted in words, so a pair's expected
words stay as they are, and the words taken from a source meet its target but for the last
residual.

The exchange is a reduction tree.  Documents are dealt by source, size class (power of two)
and a hash of the id into nodes of about ``node_rows``; a node turns all but one of its documents
integral and passes the residual up, until each source and size class has one residual.
The top nodes of a source (at most ``node_rows`` documents a class) meet in one small group: the
residuals are rounded to the nearest from the largest class down, each taking over the
words that the classes above left open, and the words still open are settled by turning
single documents of the nearest size from taken to not taken or back.

Sources are ordered by code point, null last, and weigh 1, 2, 3, repeating, unless weights
are given; they share ``share`` of all words, and no target is above ``most`` times the
source's words: the excess is shared again by weight among the others until none is above.

Defined results: a null or blank text has size 0 and takes 0 words; a source without words
has target 0; repeated rows are rounded as rows of their own; reruns agree, since all random
numbers are hashes of the seed, the id and the size.  Null ids are an id like any other.  An
empty table gives an empty result.  Input columns are carried in a struct, so no name clashes.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ROW, SALTS, WORD, addressed, quoted, ready
from tenura.session import cut

NODE_ROWS = 512
MOST = 3.0
WEIGHTS = (1.0, 2.0, 3.0)


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST
) -> DataFrame:
    """source, source_size, target, from one row per source (source, source_size).

    The rank comes from a range-partitioned sort with numbered rows, the water level from
    sums over the table, one row each; nothing of the size of the table reaches the driver.
    """
    spark = sizes.sparkSession
    order = sizes.orderBy(F.col("source").isNull(), "source").select("source", "source_size")
    ranked = order.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    ranked = spark.createDataFrame(ranked, "source string, source_size long, rank long")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = cut(ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, before = 0.0, -1.0
    while level > before:  # the level only rises, and each rise caps at least one more source
        capped = F.col("source_size") * most <= F.lit(level) * F.col("weight")
        held, free = ranked.agg(
            F.sum(F.when(capped, F.col("source_size") * most).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not free:
            break
        before, level = level, max(level, (total - held) / free)
    target = F.least(F.col("source_size") * F.lit(float(most)), F.lit(float(level)) * F.col("weight"))
    return ranked.select("source", "source_size", "rank", target.cast("double").alias("target"))


def _exchange(p: np.ndarray, s: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Pair documents in order until at most one is fractional; its place, or -1."""
    p, at = p.copy(), -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            p[j] = round(p[j])
            continue
        if at < 0:
            at = j
            continue
        i = at
        up = min((1 - p[i]) * s[i], p[j] * s[j])  # words that could move from j to i
        down = min(p[i] * s[i], (1 - p[j]) * s[j])  # and from i to j
        moved = up if u[j] * (up + down) < down else -down
        p[i] += moved / s[i]
        p[j] -= moved / s[j]
        for k in (i, j):
            if p[k] < 1e-9 or p[k] > 1 - 1e-9:
                p[k] = round(p[k])
        at = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return p, at


def _node(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["pick", "size"], kind="stable").reset_index(drop=True)
    p, at = _exchange(group["p"].to_numpy(float), group["size"].to_numpy(float), group["u"].to_numpy(float))
    group["p"] = p
    group["final"] = np.arange(len(group)) != at
    return group


def _land(group: pd.DataFrame) -> pd.DataFrame:
    """Round the residuals, then settle what is left by turning documents of the nearest size."""
    group = group.sort_values(["size", "pick"], ascending=[False, True], kind="stable").reset_index(drop=True)
    p, s = group["p"].to_numpy(float).copy(), group["size"].to_numpy(float)
    carry = 0.0  # words still to be taken
    for i in np.flatnonzero((p > 0) & (p < 1)):
        wanted = p[i] * s[i] + carry
        p[i] = 1.0 if wanted > s[i] / 2 else 0.0
        carry = wanted - p[i] * s[i]
    turns = np.flatnonzero(group["part"].to_numpy(bool) & (s > 0))
    while len(turns):
        gain = np.where(p[turns] == 0, s[turns], -s[turns])
        best = int(np.argmin(np.abs(carry - gain)))
        if abs(carry - gain[best]) >= abs(carry) - 0.5:
            break
        p[turns[best]] = 1 - p[turns[best]]
        carry -= gain[best]
    group["p"], group["final"] = p, True
    return group


def copies(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.0,
    most: float = MOST,
    seed: int = 17,
    node_rows: int = NODE_ROWS,
    carried: list[str] | None = None,
) -> DataFrame:
    """doc (struct of the carried columns), size, source_size, target, copies; a row per document."""
    ready(docs.sparkSession)
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    sized = cut(
        docs.select(
            F.struct(*quoted(carried or ["doc_id"])).alias("doc"),
            F.col("source").cast("string").alias("source"),
            words.alias("size"),
            F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("pick"),
        ).withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int"))
    )
    by_class = cut(sized.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    targets = source_targets(by_class.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    plan = by_class.alias("c").join(targets.alias("t"), F.expr("c.source <=> t.source")).select(
        F.col("c.source").alias("source"), "class", "source_size", "rank", "target",
        F.ceil(F.col("n") / node_rows).cast("long").alias("nodes"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )
    plan = cut(plan)
    deepest = plan.agg(F.max("nodes")).first()[0] or 0
    salt = F.pmod(F.col("pick"), F.lit(SALTS)).cast("int")
    spread = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = sized.alias("d").join(
        spread.alias("s"), (F.expr("d.source <=> s.source")) & (F.expr("d.class = s.class")) & (salt == F.col("s.salt"))
    ).select(
        "doc", "rank", F.col("d.class").alias("class"), "size", "source_size", "target", "pick",
        F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"),
        F.pmod(F.col("pick"), F.col("nodes")).alias("node"), "nodes", (F.col("rate") > F.floor("rate")).alias("part"),
    )
    rows = rows.withColumn("whole", F.when(F.col("class") < 0, 0).otherwise(F.col("whole"))).withColumn(
        "p", F.when(F.col("class") < 0, F.lit(0.0)).otherwise(F.col("p"))
    )
    done, tops, level = [], [], 0
    while True:
        chance = F.pmod(F.xxhash64(F.lit(seed + level), "pick", "size"), F.lit(1 << 40)) / float(1 << 40)
        rows = rows.withColumn("u", chance)
        schema = rows.withColumn("final", F.lit(True)).schema
        rows = cut(rows.groupBy("rank", "class", "node").applyInPandas(_node, schema))
        top, inner = rows.where("nodes <= 1"), rows.where("nodes > 1")
        tops.append(top)
        done.append(inner.where("final"))
        if deepest <= 1:
            break
        deepest, level = math.ceil(deepest / node_rows), level + 1
        rows = inner.where("not final").drop("final", "u").select(
            *[c for c in inner.columns if c not in ("final", "u", "node", "nodes")],
            F.expr(f"node div {node_rows}").alias("node"), F.ceil(F.col("nodes") / node_rows).cast("long").alias("nodes"),
        )
    last = reduce(DataFrame.unionByName, tops)
    done.append(last.groupBy("rank").applyInPandas(_land, last.schema))
    return reduce(DataFrame.unionByName, done).select("doc", "size", "source_size", "target", (F.col("whole") + F.round("p")).cast("long").alias("copies"))


def mixed(docs: DataFrame, **how: object) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Copies are settled on narrow columns and joined to the documents by their addresses.  A
    blank document has no words to give or take and stays as it is, once.
    """
    rows = addressed(docs)
    out = copies(rows, carried=[ROW], **how)
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).cast("int").alias("times")
    taken = out.select(F.col(f"doc.{ROW}").alias("row"), times).where("times > 0")
    whole = rows.select(F.struct(*quoted(docs.columns)).alias("doc"), F.col(ROW).alias("row"))
    return whole.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select("doc.*")


def shares(docs: DataFrame, **how: object) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies."""
    return copies(docs, **how).select(
        "doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


