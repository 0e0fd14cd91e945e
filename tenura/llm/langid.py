"""Language identification of spans: scripts narrow the candidates, Viterbi labels the words.

Learning: of each language's documents a bounded sample (of more than ``max_train`` rows those of the
smallest hashes) gives counts of character n-grams, word edges included, and the share of each
script among its letters.  A word's score for a language is the sum of its n-grams' smoothed log
shares.

Prediction: the script of a word's letters, by ranges of code points, leaves those languages that
use it in at least 1 % of their letters (all, if none does).  Viterbi finds the
sequence of languages over the words with the highest sum of scores less a penalty for every
switch; words without letters take part without a score.  Runs of one language are the spans;
the language with the most letters is the document's.  One language throughout is
known to be the best path, without a search, when no stretch of words gains as much in another
language as one switch costs, nor a stretch at the start and one at the end together; otherwise
the search runs.

Defined results: a null text or one without a letter is ``und`` with score 0 and has no span; ties
go to the language that comes first by code point; repeated rows get equal results; without
labelled rows every text is ``und``; an empty table gives an empty result.  Only doc_id, text and,
to learn, lang are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ready
from tenura.session import cut

MAX_TRAIN = 600
PENALTY = 12.0
ORDERS = (2, 3)
LEAST_SHARE = 0.01
KEPT_WORDS = 300_000

# Ranges of code points by script.
SCRIPTS = (
    (0x0041, 0x024F, "Latin"), (0x0370, 0x03FF, "Greek"), (0x0400, 0x052F, "Cyrillic"), (0x0531, 0x058F, "Armenian"),
    (0x0590, 0x05FF, "Hebrew"), (0x0600, 0x077F, "Arabic"), (0x0900, 0x097F, "Devanagari"), (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"), (0x1E00, 0x1EFF, "Latin"), (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x30FF, "Kana"), (0x3400, 0x4DBF, "Han"), (0x4E00, 0x9FFF, "Han"), (0xAC00, 0xD7AF, "Hangul"),
)


def script(letter: str) -> str:
    code = ord(letter)
    return next((name for low, high, name in SCRIPTS if low <= code <= high), "Other")


def letters_of(token: str) -> str:
    return token.lower() if token.isalpha() else "".join(c for c in token.lower() if c.isalpha())


def grams(word: str) -> list[str]:
    edged = f"_{word}_"
    return [edged[i : i + n] for n in ORDERS for i in range(len(edged) - n + 1)]


class Model:
    """Languages, a table of log shares (a row per n-gram, the last for unseen ones) and who uses which script."""

    def __init__(self, langs: list[str], rows: dict[str, int], table: np.ndarray, scripts: dict[str, np.ndarray]) -> None:
        self.langs, self.rows, self.table, self.scripts = langs, rows, table, scripts

    def words(self, words: list[str]) -> np.ndarray:
        """Scores by language of words of letters; languages that do not use the script are out of reach."""
        get, unseen = self.rows.get, len(self.table) - 1
        found = [grams(w) for w in words]
        rows = np.array([get(g, unseen) for gs in found for g in gs], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum([len(gs) for gs in found])[:-1]]).astype(np.int64)
        scores = np.add.reduceat(self.table[rows], starts, axis=0)
        if all(uses.all() for uses in self.scripts.values()):
            return scores
        for i, word in enumerate(words):
            uses = self.scripts.get(script(word[0]))
            if uses is not None and not uses.all() and uses.any():
                scores[i] = np.where(uses, scores[i], -1e6)
        return scores


class Words(dict):
    """From tokens to a row of the table of scores; row 0 is for tokens without letters."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.scores = np.zeros((1 << 14, len(self.model.langs)))
        self.letters = np.zeros(1 << 14, np.int64)
        self.used = 1

    def add(self, tokens: set[str]) -> None:
        """Make the tokens known."""
        if self.used > KEPT_WORDS:
            self.forget()
        new = [t for t in tokens if t not in self]
        words = [letters_of(t) for t in new]
        self.update((t, 0) for t, w in zip(new, words, strict=True) if not w)
        known = [(t, w) for t, w in zip(new, words, strict=True) if w]
        if not known:
            return
        stop = self.used + len(known)
        while stop > len(self.letters):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.scores[self.used : stop] = self.model.words([w for _, w in known])
        self.letters[self.used : stop] = [len(w) for _, w in known]
        self.update((t, self.used + i) for i, (t, _) in enumerate(known))
        self.used = stop


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word: highest sum less a penalty for every switch."""
    rows = scores.tolist()
    best, back = rows[0], []
    for row in rows[1:]:
        high = max(best)
        top, switched = best.index(high), high - penalty
        back.append([i if b >= switched else top for i, b in enumerate(best)])
        best = [(b if b >= switched else switched) + s for b, s in zip(best, row, strict=True)]
    at = best.index(max(best))
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    return np.array(path[::-1])


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """As ``viterbi``; one language throughout is recognised without the search."""
    sums = scores.sum(axis=0)
    top = int(sums.argmax())
    gains = np.cumsum(scores - scores[:, top : top + 1], axis=0)
    floor = np.minimum.accumulate(np.vstack([np.zeros(len(sums)), gains[:-1]]), axis=0)
    ends = max(gains.max(), 0.0) + (gains[-1] - np.minimum(gains.min(axis=0), 0.0)).max()  # if top is nowhere
    if (gains - floor).max() < penalty and ends < penalty:
        return np.full(len(scores), top)
    return viterbi(scores, penalty)


def label(text: str | None, words: Words, penalty: float = PENALTY) -> tuple[str, float, list[tuple[int, int, str]]]:
    """Language, score, and spans (first word, words, language) of a text."""
    langs = words.model.langs
    tokens = (text or "").split()
    if not langs:
        return "und", 0.0, []
    words.add(set(tokens))
    rows = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
    at = np.flatnonzero(rows)
    if not len(at):
        return "und", 0.0, []
    scores, letters = words.scores[rows[at]], words.letters[rows[at]]
    path = best_path(scores, penalty)
    total = np.bincount(path, weights=letters, minlength=len(langs))
    top = int(total.argmax())
    mean = scores[path == top].sum(axis=0) / np.sqrt((path == top).sum())
    odds = np.exp(np.clip(mean - mean.max(), -50, 0))
    score = float(odds[top] / odds.sum() * total[top] / total.sum())
    starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
    stops = np.append(at[starts[1:]], len(tokens))
    spans = [(int(a), int(b - a), langs[path[s]]) for s, a, b in zip(starts, np.append(0, at[starts[1:]]), stops, strict=True)]
    return langs[top], score, spans


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = defaultdict(Counter)
        tokens: dict[str, Counter] = defaultdict(Counter)
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens[lang].update(text.split())
        for lang, found in tokens.items():
            for token, n in found.items():
                word = letters_of(token)
                if word:
                    own = counts[lang]
                    for g in grams(word):
                        own[g] += n
                    own["\n" + script(word[0])] += n * len(word)
        rows = [(lang, g, n) for lang, own in counts.items() for g, n in own.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds = (pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "gram", "n"])


def learn(docs: DataFrame, max_train: int = MAX_TRAIN, least: int = 2) -> Model:
    """A model from documents (text, lang); rows without a language are left out."""
    ready(docs.sparkSession)
    known = docs.where("lang is not null and text is not null").select("text", "lang")
    pick = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    sizes = known.groupBy("lang").count()
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(float(max_train)) / F.col("count")).alias("share"))
    shares = {r["lang"]: r["share"] for r in share.collect()}  # one row a language
    if not shares:
        return Model([], {}, np.zeros((1, 0)), {})
    rate = F.element_at(F.create_map(*[x for l, s in shares.items() for x in (F.lit(l), F.lit(s))]), F.col("lang"))
    sample = known.where(pick < rate * float(1 << 40))
    counts = sample.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = cut(counts.where(F.col("n") >= least)).collect()  # n-grams of the bounded sample
    langs = sorted(shares)
    place = {lang: i for i, lang in enumerate(langs)}
    table: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for r in rows:
        side = scripts if r["gram"].startswith("\n") else table
        key = r["gram"].lstrip("\n")
        side.setdefault(key, np.zeros(len(langs)))[place[r["lang"]]] = r["n"]
    totals = np.zeros((max(ORDERS) + 1, len(langs)))
    for g, n in table.items():
        totals[len(g)] += n
    add = 0.5
    size = Counter(len(g) for g in table)
    base = {n: np.log(totals[n] + add * (size[n] + 1)) for n in ORDERS}
    logs = [np.log(n + add) - base[len(g)] for g, n in table.items()]
    unseen = np.mean([np.log(add) - base[n] for n in ORDERS])  # an n-gram that no language has says nothing
    letters = np.sum(list(scripts.values()), axis=0) if scripts else np.ones(len(langs))
    uses = {s: n >= LEAST_SHARE * np.maximum(letters, 1) for s, n in scripts.items()}
    return Model(langs, {g: i for i, g in enumerate(table)}, np.array([*logs, np.full(len(langs), unseen)]), uses)


def labels_of(text: Column, model: Model, penalty: float = PENALTY) -> Column:
    """struct(lang, score, spans) of each whole text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = Words(model)
        for texts in batches:
            found = [label(t, words, penalty) for t in texts]
            yield pd.DataFrame(
                {
                    "lang": [f[0] for f in found],
                    "score": [f[1] for f in found],
                    "spans": [[{"start": a, "words": n, "lang": g} for a, n, g in f[2]] for f in found],
                }
            )

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    kind = "lang string, score double, spans array<struct<start: int, words: int, lang: string>>"
    return F.pandas_udf(run, kind)(text)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identified(docs: DataFrame, max_train: int = MAX_TRAIN, penalty: float = PENALTY) -> DataFrame:
    """doc_id, held_out, lang, score, spans for every document; held-out rows are never learned from."""
    model = learn(docs.where(~held_out(F.col("doc_id"))), max_train)
    found = labels_of(F.col("text"), model, penalty)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("found"))
    return rows.select("doc_id", "held_out", "found.lang", "found.score", "found.spans")
