"""Alignment of two public tokenizers by their spans, and what each document's links count corpus-wide.

A is a byte-level BPE, read from a ``tokenizers`` file and given a space and the text; B is a SentencePiece model,
which adds that space itself.  The places where tokens end come from the libraries' own spans: A's character
offsets, turned into bytes, and B's spans from its immutable protobuf.  Those are coarse where several tokens share one
character (byte pieces of a multibyte character in A, byte-fallback tokens in B); there the ends are refined
by the tokens' decoded bytes, counted back from the next coarse end.  Where tokens of A and B
both end, both sequences are cut into groups, and the last tokens of a group are linked.

A space between two characters that are no white space opens a new token in both (checked for B's vocabulary when
it is loaded; else texts are encoded whole), so a text is cut there into parts, and parts not met before are
joined again by spaces and encoded together, each part once as long as the worker's dictionary holds it.  A part whose
bytes either side does not give back sends its texts to be encoded and compared whole.

Documents are gathered into blocks of some ``block_links`` links, a longer text being a block of its own.  A block's
distinct id pairs are its dictionary, to which a document's links refer.  Counts of pairs are summed over all
dictionaries, the highest count of each B id is found, and both are joined back to the dictionaries,
which then meet their documents: links are never rows of their own, and nothing is broadcast.

Defined results: null and empty texts, and texts that either side does not give back byte by byte (for instance those that
hold U+2581, B's sign for a space), have zeros and an empty string; repeated rows and null ids count like any
others; an empty table gives an empty result.  Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ready, salted
from tenura.llm.tokens import default_path
from tenura.session import cut

CUT = re.compile(r"(?<=\S) (?=\S)")
BLOCK_LINKS = 4_000_000
KEPT_PARTS = 300_000  # bounds the dictionary, not the result
JOINED = 4000  # parts that are encoded together
MARK = "▁"


def unicode_bytes() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the
    others for the characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Places(dict):
    """Places of parts; a part that is not there gets the next place and is noted as new."""

    def __init__(self, known=()) -> None:
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = at = len(self)
        self.new.append(part)
        return at


class Aligner:
    """Both tokenizers and the parts that one worker has met."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_char = unicode_bytes()
        n_a, n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        names = [self.a.id_to_token(i) for i in range(n_a)]
        self.bytes_a = [bytes(of_char[c] for c in t) if all(c in of_char for c in t) else t.encode() for t in names]
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.n_b = n_b
        self.separable = not any(MARK in p.lstrip(MARK) for p in pieces)
        # Each id with the sign behind it: "," within a side of a group, "|" and ";" after its last, a line
        # break after the last of a part.
        self.written = [f"{i}{sign}" for sign in ",|" for i in range(n_a)] + [f"{i}{sign}" for sign in ",;\n" for i in range(n_b)]
        self.n_a = n_a
        self.clear()

    def clear(self) -> None:
        self.place = Places()
        self.groups: list[str | None] = []  # None: not given back
        self.counts = np.zeros((0, 3), np.int64)  # tokens of A, of B, groups
        self.used = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.uint32)

    def ends(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, their ends in the bytes of a space and ``text``, and the same of B."""
        spaced = " " + text
        enc = self.a.encode(spaced, add_special_tokens=False)
        ids_a = np.array(enc.ids, np.int64)
        last_char = np.fromiter((stop for _, stop in enc.offsets), np.int64, len(ids_a))
        points = np.frombuffer(spaced.encode("utf-32-le"), "<u4")
        upto = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])
        whole_char = np.append(last_char[1:] != last_char[:-1], True)[: len(ids_a)]  # the last token of a character
        ends_a = refined(upto[last_char], whole_char, self.size_a[ids_a])
        pieces = [x for p in self.b.encode(text, return_type="proto").pieces for x in (p.id, p.end)]
        ids_b, stop = np.array(pieces, np.int64).reshape(-1, 2).T
        ends_b = refined(stop + 1, np.diff(stop, prepend=0) > 0, self.size_b[ids_b])
        return ids_a, ends_a, ids_b, ends_b

    def gives_back(self, text: str, ids_a: np.ndarray, ids_b: np.ndarray) -> bool:
        wanted = b" " + text.encode()
        return all(
            b"".join(map(of.__getitem__, ids.tolist())) == wanted for of, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))
        )

    def align(self, parts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray] | None:
        """(tokens of A, of B, groups) and the groups as text of each part, and the linked id pairs of all in
        order; None if the joined parts are not given back."""
        text = " ".join(parts)
        ids_a, ends_a, ids_b, ends_b = self.ends(text)
        if not self.gives_back(text, ids_a, ids_b):
            return None
        in_a = np.isin(ends_a, ends_b, kind="sort" if len(ends_a) < 64 else None)
        last_a = np.flatnonzero(in_a)
        common = ends_a[last_a]
        last_b = np.searchsorted(ends_b, common)
        links = (ids_a[last_a] * self.n_b + ids_b[last_b]).astype(np.uint32)
        stops = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in parts), np.int64, len(parts)))
        cuts = [np.searchsorted(ends, stops, "right") for ends in (ends_a, ends_b, common)]
        sign_b = np.zeros(len(ids_b), np.int64)
        sign_b[last_b] = 1
        sign_b[cuts[1] - 1] = 2
        code = np.concatenate([ids_a + in_a * self.n_a, 2 * self.n_a + ids_b + sign_b * self.n_b])
        group = np.concatenate([np.searchsorted(common, ends_a) * 2, np.searchsorted(common, ends_b) * 2 + 1])
        words = map(self.written.__getitem__, code[np.argsort(group, kind="stable")].tolist())
        return np.diff(np.stack(cuts, axis=1), axis=0, prepend=0), "".join(words).split("\n")[:-1], links

    def add(self, counts: np.ndarray, groups: list[str | None], links: np.ndarray) -> None:
        self.counts = np.concatenate([self.counts, counts])
        self.used = np.concatenate([self.used, np.zeros(len(groups), np.int64)])
        self.pairs = np.concatenate([self.pairs, links])
        self.groups += groups

    def learn(self, parts: list[str]) -> None:
        """Align parts that are new in the dictionary, in its order."""
        nothing = np.zeros((1, 3), np.int64), [None], np.zeros(0, np.uint32)
        for at in range(0, len(parts), JOINED):
            some = parts[at : at + JOINED]
            plain = all(some) and all(p == p.strip() for p in some) and MARK not in "".join(some)
            found = self.align(some) if plain else None
            if found is None:  # some part must stand alone
                for run, group in itertools.groupby(some, lambda p: bool(p) and p == p.strip() and MARK not in p):
                    group = list(group)
                    found = self.align(group) if run else None
                    if found:
                        self.add(*found)
                        continue
                    for part in group:
                        self.add(*((self.align([part]) if part else None) or nothing))
            else:
                self.add(*found)

    def forget(self) -> None:
        """Keep the parts that came more than once since the last time, if they are few enough."""
        keep = np.flatnonzero(self.used > 1)
        if len(keep) > KEPT_PARTS // 2:
            self.clear()
            return
        names = list(self.place)
        sizes = self.counts[:, 2]
        self.pairs = self.pairs[np.repeat(self.used > 1, sizes)]
        self.place = Places((names[k], i) for i, k in enumerate(keep.tolist()))
        self.groups = [self.groups[k] for k in keep.tolist()]
        self.counts, self.used = self.counts[keep], np.zeros(len(keep), np.int64)

    def texts(self, texts: list[str | None]) -> list[tuple[np.ndarray, str, np.ndarray]]:
        """(counts, digest of the groups, linked pairs) of each text."""
        if len(self.place) > KEPT_PARTS:
            self.forget()
        find = self.place.__getitem__
        split = CUT.split if self.separable else lambda t: [t]
        places = [list(map(find, split(t or ""))) for t in texts]
        self.learn(self.place.new)
        self.place.new = []
        self.used += np.bincount(np.concatenate([np.zeros(0, np.int64), *places]).astype(np.int64), minlength=len(self.used))
        starts = np.cumsum(self.counts[:, 2]) - self.counts[:, 2]
        out = []
        for text, at in zip(texts, places, strict=True):
            written = list(map(self.groups.__getitem__, at))
            if None not in written:
                at = np.array(at, np.int64)
                counts, sizes = self.counts[at].sum(axis=0), self.counts[at, 2]
                ends = np.cumsum(sizes)
                pairs = self.pairs[np.repeat(starts[at] - ends + sizes, sizes) + np.arange(ends[-1])]
                joined = ";".join(written)
            else:
                found = self.align([text]) if text and len(at) > 1 and MARK not in text else None
                counts, joined, pairs = (found[0][0], found[1][0], found[2]) if found else ((0, 0, 0), None, np.zeros(0, np.uint32))
            digest = "" if joined is None else hashlib.sha256(joined.encode()).hexdigest()
            out.append((counts, digest, pairs))
        return out


def refined(ends: np.ndarray, coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens: where ``coarse`` the span's own, elsewhere counted back from the next by decoded bytes."""
    if not len(ends):
        return ends
    upto = np.cumsum(sizes)
    at = np.where(coarse, np.arange(len(ends)), len(ends))
    at[-1] = len(ends) - 1
    anchor = np.minimum.accumulate(at[::-1])[::-1]
    return ends[anchor] - (upto[anchor] - upto)


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One a worker; its dictionary lives as long as the worker."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Aligner(path_a, path_b)
    return _loaded[path_a, path_b]


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed: most of the upper planes are zeros."""
    return zlib.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def packed_block(pairs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    """The block's distinct pairs, how often each is linked, and for each document its entries and their counts."""
    lengths = np.fromiter(map(len, pairs), np.int64, len(pairs))
    dictionary, entry, totals = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
    entries, counts, at = [], [], 0
    for n in lengths.tolist():
        own, times = np.unique(entry[at : at + n], return_counts=True)
        entries.append(_planes(np.diff(own, prepend=0)))
        counts.append(_planes(times))
        at += n
    return dictionary, totals, entries, counts


FIELDS = "n_a long, n_b long, n_groups long, groups_sha256 string, entries binary, times binary, pairs binary, totals binary"


def _blocks(path_a: str, path_b: str, block_links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        ids, held, links, kind = [], [], 0, pa.int64()

        def flush() -> pa.RecordBatch:
            dictionary, totals, entries, times = packed_block([h[2] for h in held])
            counts = [[int(h[0][k]) for h in held] + [None] for k in range(3)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * (len(held) + 1), pa.int64()), pa.array([*ids, None], kind),
                    *[pa.array(c, pa.int64()) for c in counts], pa.array([*[h[1] for h in held], None], pa.string()),
                    pa.array([*entries, None], pa.binary()), pa.array([*times, None], pa.binary()),
                    pa.array([None] * len(held) + [_planes(np.diff(dictionary.astype(np.int64), prepend=0))], pa.binary()),
                    pa.array([None] * len(held) + [_planes(totals)], pa.binary()),
                ],
                names=["block", "doc_id", *[f.split()[0] for f in FIELDS.split(", ")]],
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id, aligned in zip(batch.column(0).to_pylist(), found.texts(batch.column(1).to_pylist()), strict=True):
                if held and links + len(aligned[2]) > block_links:
                    yield flush()
                    block, ids, held, links = block + 1, [], [], 0
                ids.append(doc_id)
                held.append(aligned)
                links += len(aligned[2])
        if held:
            yield flush()

    return run


def _dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, totals in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            pair = np.cumsum(_numbers(pairs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pair), block)), pa.array(pair), pa.array(_numbers(totals))], names=["block", "pair", "n"]
            )


def _summed(docs: pa.Table, counted: pa.Table) -> pa.Table:
    order = np.argsort(counted["pair"].to_numpy())
    n, best = counted["n"].to_numpy()[order], counted["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
    n_best, total = [], []
    for entries, times in zip(docs["entries"].to_pylist(), docs["times"].to_pylist(), strict=True):
        at, often = np.cumsum(_numbers(entries)), _numbers(times)
        n_best.append(int(often @ best[at]) if len(at) else 0)
        total.append(int(often @ n[at]) if len(at) else 0)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    columns = [*[docs[c] for c in names[:4]], docs["n_groups"], pa.array(n_best, pa.int64()), pa.array(total, pa.int64())]
    return pa.table([*columns, docs["groups_sha256"]], names=names)


def pair_counts(blocks: DataFrame, pieces: int) -> tuple[DataFrame, DataFrame]:
    """(block, pair, n) of every dictionary, and (pair, n, best) over all documents."""
    inside = blocks.where("pairs is not null").select("block", "pairs", "totals")
    inside = inside.mapInArrow(_dictionaries, "block long, pair long, n long")
    total = inside.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("of_b", F.col("pair") % pieces)
    highest = total.groupBy("of_b").agg(F.max("n").alias("highest"))
    counted = total.join(highest, "of_b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    return inside, counted


def aligned(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_links: int = BLOCK_LINKS
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every document."""
    ready(docs.sparkSession)
    path_a, path_b = path_a or default_path("byte_bpe_50k.json"), path_b or default_path("piece_bpe_32k.model")
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(_blocks(path_a, path_b, block_links), f"block long, doc_id {kind}, {FIELDS}")
    blocks = cut(rows)
    inside, counted = pair_counts(blocks, pieces)
    back = salted(inside.select("block", "pair"), cut(counted), "pair", F.col("block"), "inner")
    texts = blocks.where("pairs is null").drop("pairs", "totals")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_summed, schema)
