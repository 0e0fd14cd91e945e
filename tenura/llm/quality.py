"""Quality rules: base rules on words, and the fertility of a public tokeniser.

Base: words, their code points, symbols, repeated lines, and words in five-word windows that occur
at least twice.  A document fails with fewer than ten words or more than a fifth of
them in repeated windows.

Fertility: the words are encoded one by one with a public vocabulary that falls back to bytes.
Characters per token, the share of byte tokens and the entropy of a document's tokens (as a share of
the highest that its number of tokens allows) are each held against a band for its
group: the language if one is stated, else the script of most of its letters, and the power of two
of its number of tokens, since short texts vary more.  Bands come from all documents that
pass the base rules, equal measures counting once so that copies have no weight: the
quartiles of the group, stretched by ``reach`` times their distance and by at least a stated
slack.  A document outside any band is not kept.

Defined results: a null, empty or blank text has no words and fails the base rules; repeated rows get
equal results; groups whose language is null go by script; an empty table gives an empty result.
Only doc_id, text and lang are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ready, salted
from tenura.llm.langid import script
from tenura.llm.tokens import default_path
from tenura.session import cut

MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
WINDOW = 5
REACH = 3.0
KEPT_WORDS = 300_000

# The characters that count as symbols, and the least slack of each band.
SYMBOLS = b"#*$%&|<>"
SLACK = {"chars_per_token": 0.1, "byte_share": 0.01, "entropy": 0.03}


class Pieces(dict):
    """From words (bytes) to (code points, tokens, byte tokens, place of the first id)."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.table = np.zeros((1 << 14, 3), np.int64)  # code points, tokens, byte tokens of each known word
        self.ids = np.zeros(1 << 16, np.int32)
        self.first = np.zeros(1 << 14, np.int64)
        self.used = self.stored = 0

    def add(self, words: set[bytes]) -> None:
        if self.used > KEPT_WORDS:
            self.forget()
        new = [w for w in words if w not in self]
        if not new:
            return
        texts = [w.decode("utf-8", "replace") for w in new]
        encoded = self.model.encode(texts, num_threads=1)
        ids = np.array([i for e in encoded for i in e], np.int32)
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ends = np.cumsum(sizes)
        bytes_at = np.concatenate([[0], np.cumsum(self.is_byte[ids])])
        stop, end = self.used + len(new), self.stored + len(ids)
        while stop > len(self.first):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.stored : end] = ids
        self.first[self.used : stop] = self.stored + ends - sizes
        self.table[self.used : stop, 0] = list(map(len, texts))
        self.table[self.used : stop, 1] = sizes
        self.table[self.used : stop, 2] = bytes_at[ends] - bytes_at[ends - sizes]
        self.update(zip(new, range(self.used, stop), strict=True))
        self.used, self.stored = stop, end

    def tokens(self, rows: np.ndarray) -> np.ndarray:
        """The ids of the words in these rows of the table, in order."""
        sizes = self.table[rows, 1]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.first[rows] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words (given as numbers) that lie in a window which occurs at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    mix = np.zeros(n, np.uint64)
    for k in range(window):
        mix = (mix ^ words[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
    order = np.argsort(mix, kind="stable")
    same = mix[order[1:]] == mix[order[:-1]]
    if not same.any():
        return 0
    a, b = order[:-1][same], order[1:][same]
    for k in range(window):  # equal hashes are confirmed word by word
        equal = words[a + k] == words[b + k]
        a, b = a[equal], b[equal]
    covered = np.zeros(len(words) + 1, np.int64)
    for at in (a, b):
        at = np.unique(at)
        covered[at] = 1
    ends = np.convolve(covered[: len(words)], np.ones(window, np.int64))[: len(words)]
    return int((ends > 0).sum())


def duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


LETTERS = re.compile(r"[^\W\d_]")


def main_script(text: bytes) -> str:
    """The script of most letters; for ASCII texts Latin without a look."""
    if text.isascii():
        return "Latin"
    found = Counter(LETTERS.findall(text.decode("utf-8", "replace")))
    scripts: Counter = Counter()
    for letter, n in found.items():
        scripts[script(letter)] += n
    return min(scripts, key=lambda s: (-scripts[s], s)) if scripts else "none"


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, tokens long, "
    "chars_per_token double, byte_share double, entropy double, script string"
)


def measured_text(text: bytes, pieces: Pieces) -> tuple:
    words = text.split()  # on bytes exactly the six white-space characters
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    if not words:
        return 0, 0, symbols, 0, 0, 0, 0.0, 0.0, 0.0, "none"
    pieces.add(set(words))
    rows = np.fromiter(map(pieces.__getitem__, words), np.int64, len(words))
    chars, tokens, in_bytes = pieces.table[rows].sum(axis=0).tolist()
    counts = np.bincount(pieces.tokens(rows))
    shares = counts[counts > 0] / max(tokens, 1)
    entropy = float(-(shares * np.log2(shares)).sum() / np.log2(tokens)) if tokens > 1 else 1.0
    return (
        len(words), chars, symbols, duplicate_lines(text), repeated_words(rows), tokens,
        chars / max(tokens, 1), in_bytes / max(tokens, 1), entropy, main_script(text),
    )


def measured(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, lang and MEASURES of every document."""
    ready(docs.sparkSession)
    path = path or default_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
        fields = [f.split() for f in MEASURES.split(", ")]
        for batch in batches:
            rows = [measured_text(t or b"", pieces) for t in batch.column(2).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
            arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], names=["doc_id", "lang", *[f for f, _ in fields]]
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, lang string, {MEASURES}")


def judged(measures: DataFrame, reach: float = REACH) -> DataFrame:
    """``measures`` (a written table) with base_failed and kept."""
    size = F.floor(F.log2(F.greatest("tokens", F.lit(1)))).cast("string")
    rows = measures.withColumn("group", F.concat_ws(" ", F.coalesce("lang", "script"), size)).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
    )
    once = rows.where("not base_failed").select("group", "n_words", "tokens", *SLACK).distinct()
    quartiles = [F.percentile_approx(c, [0.25, 0.75], 10_000).alias(f"{c}_q") for c in SLACK]
    bands = once.groupBy("group").agg(*quartiles)
    for c, slack in SLACK.items():
        q = F.col(f"{c}_q")
        span = F.greatest((q[1] - q[0]) * reach, F.lit(slack))
        bands = bands.withColumn(f"{c}_low", q[0] - span).withColumn(f"{c}_high", q[1] + span).drop(f"{c}_q")
    met = salted(rows, bands, "group", F.col("doc_id"))
    inside = F.lit(True)
    for c in SLACK:
        inside = inside & F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high"))
    return met.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(F.coalesce(inside, F.lit(True)))).drop(
        *[f"{c}_{side}" for c in SLACK for side in ("low", "high")]
    )


def quality(docs: DataFrame, path: str | None = None, reach: float = REACH) -> DataFrame:
    """doc_id, MEASURES, base_failed, kept for every document."""
    return judged(cut(measured(docs, path)), reach).drop("lang", "group")
