"""Language-model scoring by cross-entropy difference.

Two matched bigram models, of the target and of the background, share one vocabulary, the ids of
a public byte-level BPE, so no word is unknown to either.  The target is every document labelled
as good, the background every document.  Every token and every pair of neighbours is counted
exactly, so the models grow with the corpus and are never held in one place: tokenised documents
are written in blocks of about ``block_tokens``; each block gives one row per pair, token and its total;
sums over all blocks go back to the blocks that hold the pair, and each block is scored with the
part of the models that it needs.  A pair has at most one row per block, so no pair is a hot key.
Labels meet the narrow addresses of documents (block, place), and both steps read one shuffle of
the ids, so texts are never shuffled.

A token's probability after another is their pair's count, smoothed towards the token's share by
``prior`` pseudo-counts; the share itself has one pseudo-count per token.  A document's score is
the mean over its tokens of target loss less background loss, in bits: the lower, the more it is
like the target.

Defined results: a null or empty text has no token, losses and score 0; repeated rows count as
often as they occur and get equal scores; labels that are null or contradict each other count as
the largest that is not null; without a target all target probabilities are uniform;
an empty table gives an empty result.  A text longer than a block is a block of its own.  Only doc_id,
text and the labels' doc_id and quality are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import ready
from tenura.llm.tokens import byte_bpe, default_path
from tenura.session import cut

VOCABULARY = 50_257
PRIOR = 200.0
BLOCK_TOKENS = 1 << 21

# Keys of counts: a pair is first * VOCABULARY + second, a token -1 - id, all tokens together TOTAL.
TOTAL = -1 - VOCABULARY


def _encoded(path: str, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block, place, held = byte_bpe(path), TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            blocks, at, out = [], [], []
            for text in batch.column(1).to_pylist():
                ids = np.frombuffer(encoder.encode(text or ""), "<u4")
                if len(ids) and ids.max() >= VOCABULARY:
                    raise ValueError(f"id {ids.max()} is beyond the vocabulary of {VOCABULARY} tokens")
                if held and held + len(ids) > block_tokens:
                    block, place, held = block + 1, 0, 0
                blocks.append(block)
                at.append(place)
                out.append(ids.astype("<u2").tobytes())  # the vocabulary's ids fit in 16 bits
                place, held = place + 1, held + len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(at, pa.int64()), batch.column(0), pa.array(out, pa.binary())],
                names=["block", "place", "doc_id", "ids"],
            )

    return run


def encoded(docs: DataFrame, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """block, place in it, doc_id, ids of every document, written once, so that blocks stay as they are."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return cut(rows.mapInArrow(_encoded(path, block_tokens), f"block long, place long, doc_id {kind}, ids binary"))


def places(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pairs of neighbours, and which ids follow another of their own document."""
    follows = np.ones(len(ids), bool)
    follows[starts[starts < len(ids)]] = False
    at = np.flatnonzero(follows)
    return ids[at - 1] * VOCABULARY + ids[at], at


def tallied(keys: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key, how often it is in good documents and in all."""
    both, n = np.unique(keys * 2 + good, return_counts=True)  # the last bit tells the good ones apart
    if not len(both):
        return both, n, n
    key, first = np.unique(both >> 1, return_index=True)
    return key, np.add.reduceat(n * (both & 1), first), np.add.reduceat(n, first)


def block_counts(texts: list[bytes], good: np.ndarray) -> list[np.ndarray]:
    """key, target and background counts of the documents of one block."""
    ids = np.frombuffer(b"".join(texts), "<u2").astype(np.int64)
    lengths = np.fromiter((len(t) // 2 for t in texts), np.int64, len(texts))
    flags = np.repeat(good, lengths)
    pairs, at = places(ids, np.cumsum(lengths) - lengths)
    total = tuple(np.array([n], np.int64) for n in (TOTAL, flags.sum(), len(flags)))
    return [np.concatenate(x) for x in zip(tallied(-1 - ids, flags), tallied(pairs, flags[at]), total, strict=True)]


def _counted(docs: pa.Table, good: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return pa.table({name: pa.array([], pa.int64()) for name in ("block", "key", "target", "background")})
    flags = np.isin(docs["place"].to_numpy(), good["place"].to_numpy())
    counts = block_counts(docs["ids"].to_pylist(), flags)
    block = pa.array(np.full(len(counts[0]), docs["block"][0].as_py()), pa.int64())
    return pa.table([block, *map(pa.array, counts)], names=["block", "key", "target", "background"])


def gathered(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """block, key, target, background: counts over all documents of every key that the block holds."""
    good = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    good = blocks.join(good.where("quality > 0"), "doc_id", "left_semi").select(F.expr("block AS block"), F.expr("place AS place"))
    parts = blocks.groupBy("block").cogroup(good.groupBy("block"))
    parts = parts.applyInArrow(_counted, "block long, key long, target long, background long")
    everywhere = Window.partitionBy("key")
    return parts.select(
        "block", "key", F.sum("target").over(everywhere).alias("target"), F.sum("background").over(everywhere).alias("background")
    )


def probabilities(
    key: np.ndarray, counts: np.ndarray, ids: np.ndarray, starts: np.ndarray, prior: float
) -> np.ndarray:
    """Probability of each id under one model; the keys are sorted."""

    def of(wanted: np.ndarray) -> np.ndarray:
        return counts[np.searchsorted(key, wanted)]

    tokens = of(-1 - ids)
    p = (tokens + 1) / (of(np.array([TOTAL]))[0] + VOCABULARY)
    pairs, at = places(ids, starts)
    p[at] = (of(pairs) + prior * p[at]) / (tokens[at - 1] + prior)
    return p


def _losses(prior: float):
    def run(docs: pa.Table, model: pa.Table) -> pa.Table:
        order = np.argsort(model["key"].to_numpy())
        key = model["key"].to_numpy()[order]
        texts = docs["ids"].to_pylist()
        ids = np.frombuffer(b"".join(texts), "<u2").astype(np.int64)
        lengths = np.fromiter((len(t) // 2 for t in texts), np.int64, len(texts))
        starts, some = np.cumsum(lengths) - lengths, lengths > 0
        out = []
        for name in ("target", "background"):
            loss = np.zeros(len(texts))
            if len(ids):
                p = probabilities(key, model[name].to_numpy()[order].astype(np.float64), ids, starts, prior)
                loss[some] = np.add.reduceat(-np.log2(p), starts[some]) / lengths[some]
            out.append(pa.array(loss))
        return pa.table([docs["doc_id"], pa.array(lengths), *out], names=["doc_id", "n_tokens", "target_loss", "background_loss"])

    return run


def cross_entropy_difference(
    docs: DataFrame, labels: DataFrame, path: str | None = None, prior: float = PRIOR, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score for every document."""
    ready(docs.sparkSession)
    blocks = encoded(docs, path or default_path("byte_bpe_50k.json"), block_tokens)
    schema = f"doc_id {blocks.schema['doc_id'].dataType.simpleString()}, n_tokens long, target_loss double, background_loss double"
    found = blocks.groupBy("block").cogroup(gathered(blocks, labels).groupBy("block")).applyInArrow(_losses(prior), schema)
    return found.withColumn("score", F.col("target_loss") - F.col("background_loss"))
