"""Best-fit packing of documents into sequences by swap-based local search.

A document is its token ids and an end id.  Documents longer than a sequence are cut into
pieces of full length, the first of which takes the rest and may be shorter; full pieces are
sequences of their own.  All other pieces are dealt by a hash into blocks of ``block_rows``.
In a block each piece goes, longest first, to the fullest sequence with room; then local
search takes the least filled sequence and moves a piece out of it, or exchanges one or two
of its pieces for a smaller one of another underfull sequence.  Every step moves tokens to
a fuller sequence, so the sum of squared fills rises until the sequence is empty or nothing
fits.  Sequences still less than ``closed`` full are opened again and their pieces dealt into
the next, much smaller round of blocks, until one block is left or a round no longer helps.

Defined results: a null text is empty and gives one piece with the end id; repeated rows
give pieces of their own; piece numbers, starts and offsets count from 0 without gaps; an
empty table gives no pieces; only doc_id and text are read, so other columns cannot clash.
Pieces shorter than a sequence are packed whole and never cut again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ready
from tenura.llm.tokens import byte_bpe, default_path
from tenura.session import cut

LENGTH = 1024
END_ID = 2
BLOCK_ROWS = 1024
CLOSED = 0.97


def token_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian uint32) of every piece."""
    ready(docs.sparkSession)
    path = path or default_path("byte_bpe_50k.json")
    end = int(end_id).to_bytes(4, "little")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(path)
        for batch in batches:
            docs_of, pieces, starts, lengths, ids = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = encoder.encode(text or "") + end
                n = len(data) // 4
                at = 0
                for piece in range(-(-n // length)):
                    stop = at + (n % length or length) if piece == 0 else at + length
                    docs_of.append(i)
                    pieces.append(piece)
                    starts.append(at)
                    lengths.append(stop - at)
                    ids.append(data[4 * at : 4 * stop])
                    at = stop
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(docs_of, pa.int64())), pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        cut_up, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


def best_fit(lengths: np.ndarray, room: int) -> list[list[int]]:
    """Longest piece first into the fullest bin with room; places of the pieces by bin."""
    by_free: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    some = 0  # bit f is set if a bin with f free places exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        above = some >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                some &= ~(1 << free)
        else:
            free, b = room, len(bins)
            bins.append([])
        bins[b].append(i)
        by_free.setdefault(free - size, []).append(b)
        some |= 1 << (free - size)
    return bins


def local_search(lengths: np.ndarray, bins: list[list[int]], room: int) -> list[list[int]]:
    """Empty the least filled bins by moves and exchanges with other underfull bins.

    Each step puts more tokens into a fuller bin, which raises the sum of squared fills; a
    bin that no step changes is left alone, and the search ends when as few bins remain as
    the tokens need or none can be changed.  The free rooms in order, and for each length the most that a
    piece of it can be exchanged for, answer all moves and all exchanges of a bin at once.
    """
    items = [list(own) for own in bins]
    bin_of, fill = np.zeros(len(lengths), np.int64), np.zeros(len(bins), np.int64)
    for b, own in enumerate(items):
        bin_of[own], fill[b] = b, lengths[own].sum()
    needed = max(-(-int(lengths.sum()) // room), int((2 * lengths > room).sum()))
    alive = int((fill > 0).sum())
    stuck = fill == 0
    while alive > needed and not stuck.all():
        low = int(np.argmin(np.where(stuck, room + 1, fill)))
        free = np.where(fill >= fill[low], room - fill, 0)
        free[low] = 0
        rooms = np.sort(free[free > 0])
        reach = np.zeros(room + 1, np.int64)
        np.maximum.at(reach, lengths, np.where(free[bin_of] > 0, free[bin_of] + lengths, 0))
        reach = np.maximum.accumulate(reach)  # of the pieces up to a length
        own = np.array(items[low])
        x, y = np.triu_indices(len(own), 1)
        step = None
        for out in (own[:, None], np.stack([own[x], own[y]], axis=1)):  # one piece, then two
            if not len(out):
                continue
            size = lengths[out].sum(axis=1)
            at = np.searchsorted(rooms, size)
            if at.min() < len(rooms):  # a move, to where the least room is left
                spare = np.where(at < len(rooms), rooms[np.minimum(at, len(rooms) - 1)] - size, room + 1)
                best = int(np.argmin(spare))
                step = out[best], int(np.argmax(free == size[best] + spare[best])), None
                break
            back = np.searchsorted(reach, size)  # the shortest piece whose bin can take the difference
            gain = np.where(back < size, size - back, 0)
            best = int(np.argmax(gain))
            if gain[best]:  # an exchange, by as many tokens as fit
                piece = int(np.argmax((lengths == back[best]) & (free[bin_of] >= gain[best])))
                step = out[best], int(bin_of[piece]), piece
                break
        if step is None:
            stuck[low] = True
            continue
        gone, target, back = step
        moved = int(lengths[gone].sum()) - (0 if back is None else int(lengths[back]))
        for piece in gone.tolist():
            items[low].remove(piece)
            items[target].append(piece)
        bin_of[gone] = target
        if back is not None:
            items[target].remove(back)
            items[low].append(back)
            bin_of[back] = low
        fill[low], fill[target] = fill[low] - moved, fill[target] + moved
        stuck = fill == 0
        alive -= int(fill[low] == 0)
    order = np.argsort(bin_of, kind="stable")
    return [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(bin_of[order])) + 1) if len(part)]


def pack_block(group: pd.DataFrame, room: int, closed: float) -> pd.DataFrame:
    group = group.sort_values(["length", "pick", "row"], ascending=[False, True, True]).reset_index(drop=True)
    lengths = group["length"].to_numpy(np.int64)
    bins = local_search(lengths, best_fit(lengths, room), room)
    number, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
    done = np.zeros(len(group), bool)
    for b, places in enumerate(bins):
        ends = np.cumsum(lengths[places])
        number[places], offset[places] = b, ends - lengths[places]
        done[places] = ends[-1] >= closed * room
    return group.assign(number=number, offset=offset, done=done)


def _packer(room: int, closed: float):
    return lambda group: pack_block(group, room, closed)


def pack(pieces: DataFrame, length: int = LENGTH, block_rows: int = BLOCK_ROWS, closed: float = CLOSED) -> DataFrame:
    """``pieces`` (a written table with ``length`` and a unique ``row``) as row, sequence_id, offset."""
    full = pieces.where(F.col("length") == length).select(
        "row", (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < length).select("row", "length")
    out, level, before = full, 0, None
    slots = 4 * pieces.sparkSession.sparkContext.defaultParallelism
    while True:
        n = rest.count()
        last = n <= block_rows or (before is not None and n > 0.8 * before)
        blocks = max(1, -(-n // block_rows))
        dealt = rest.withColumn("pick", F.xxhash64(F.lit(level), "row")).withColumn(
            "block", F.pmod(F.col("pick"), F.lit(blocks))
        )
        schema = "row long, length long, pick long, block long, number long, offset long, done boolean"
        limit = 0.0 if last else closed
        dealt = dealt.repartition(min(blocks, max(slots, blocks // 16)), "block")  # the search is work, not bytes
        packed = cut(dealt.groupBy("block").applyInPandas(_packer(length, limit), schema))
        number = (F.lit(level) * (1 << 56) + F.col("block") * (1 << 20) + F.col("number")) * 2 + 1
        out = out.unionByName(packed.where("done").select("row", number.alias("sequence_id"), "offset"))
        if last:
            return out
        rest, before, level = packed.where("not done").select("row", "length"), n, level + 1


def packed_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    pieces = token_pieces(docs, path, length, end_id).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    pieces = cut(pieces.withColumn("row", F.monotonically_increasing_id()))
    return pieces.join(pack(pieces, length), "row").drop("row")


def sequences(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """sequence_id and ids (array of int) of every packed sequence, for training."""
    pieces = cut(token_pieces(docs, path, length, end_id).withColumn("row", F.monotonically_increasing_id()))
    placed = pieces.join(pack(pieces.drop("ids"), length), "row")
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select(
        "sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids")
    )
