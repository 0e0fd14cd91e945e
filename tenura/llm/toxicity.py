"""Toxicity: Levenshtein automata over a lexicon trie, with context-window scores.

Lexicon: insults stated below and stems learned from labelled documents, those word beginnings of three to
twelve letters that occur far more often in toxic documents.  Stems are counted apart for each language or script
that the texts themselves show (by their most frequent function words, or the script of their letters), so a language
with few toxic documents learns its own: a stem must be in at least ``LEAST`` toxic documents of its language, more often
than chance allows there among so many stems (a Chernoff bound), and ``LIFT`` times as frequent in toxic
documents as in clean ones of all languages.  The best are taken, 96 and one more for every 16 toxic documents.  Matching: the trie of the lexicon is walked together
with a Levenshtein automaton, a state being the set of trie nodes that a word's beginning can
have reached and the edits that each has cost.  States are made when they are met and kept with
their transitions, so a word costs a few look-ups, and most end at once in the empty state.  Terms of
five letters allow one edit, of nine letters two; words are case-folded, freed of inner
punctuation, and digits that stand for letters are read as letters.  A word with inner signs is matched as a whole and
by its parts, and in scripts without spaces a match may begin at every letter.

Context: each hit looks at the words around it.  Quotation marks that open before it, or a word of
reporting, make it a quotation; a second person or another hit in the window makes it
abuse.  Hits are weighed by how much more often the term, exact or misspelled, is met in toxic
documents, and a logistic regression on the weights of direct and quoted hits gives the score.

Learning uses a bounded sample of labelled documents: of more than ``max_train`` ids those of the
smallest hashes, about ``max_train`` in all, one row each.  Scores depend on the text alone.

Defined results: null, empty and blank texts have no hits and get the score of a document without
hits; repeated rows get equal scores; labels that are null or contradict each other count as the
largest that is not null; without usable labels stated weights are used; an empty table gives
an empty result.  Only doc_id and text are read to learn and only text to score; other columns
pass by untouched, whatever their names.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import quoted, ready
from tenura.session import cut

MAX_TRAIN = 20_000
LEAST_TERMS = 96
LEAST, LIFT, MARGIN = 3, 15, 6
WINDOW = 6
STEM = (3, 12)

# Plain insults, words of reporting, second persons, signs read as letters.
INSULTS = (
    "clown", "coward", "cretin", "disgusting", "dumb", "filth", "freak", "garbage", "idiot", "imbecile", "jerk",
    "loser", "maggot", "moron", "parasite", "pathetic", "pig", "scum", "stupid", "trash", "vermin", "worthless",
)
REPORTING = frozenset(
    "said says quote quoted quotes wrote writes called term word insult insults sagte schrieb wort dit écrit mot dijo "
    "escribió palabra".split()
)
SECOND_PERSON = frozenset("you your yours youre du dein deine ihr euch tu toi vous votre tú usted vosotros".split())
# Frequent function words, by which a text's language is guessed for counting.
FUNCTION_WORDS = {
    "en": "the of and to in is was that for it with as on be at by this had not are".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "it": "di e il la che in un a per del è della non le si i una da con sono".split(),
    "pt": "de a o que e do da em um para com não uma os no se na por mais as".split(),
    "nl": "de van het een en in is dat op te voor met zijn aan er om niet ook door ze".split(),
}
WITHOUT_SPACES = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
INNER = re.compile(r"[\W_]+")
QUOTES = "\"“”„«»‹›‘‚"
READ_AS = str.maketrans("013457@$", "oieastas")


def folded(token: str) -> str:
    """The token's letters: case-folded, outer signs cut off, inner ones dropped or read as letters."""
    if token.isascii() and token.isalpha():
        return token.lower()
    token = unicodedata.normalize("NFKC", token).casefold()
    start, stop = 0, len(token)
    while start < stop and not token[start].isalnum():
        start += 1
    while stop > start and not token[stop - 1].isalnum():
        stop -= 1
    token = token[start:stop]
    if token.isalpha():
        return token
    if not any(c.isalpha() for c in token):
        return ""
    return "".join(c for c in token.translate(READ_AS) if c.isalpha())


def parts_of(token: str) -> list[str]:
    """What is matched of a token: its letters as one word, its parts between inner signs, and in
    scripts without spaces the rest from every letter on."""
    plain = token.strip(".,;:!?\"'()#$%&*")
    if plain.isascii() and plain.isalpha():
        return [plain.lower()]
    whole = folded(token)
    if plain.isalpha() and not WITHOUT_SPACES.search(plain):
        return [whole] if whole else []
    words = {whole: None}
    if not token.isalpha():
        pieces = [p for p in INNER.split(unicodedata.normalize("NFKC", token)) if p]
        if len(pieces) > 1:
            words |= {folded(p): None for p in pieces}
    for word in list(words):
        if WITHOUT_SPACES.search(word):
            words |= {word[i : i + STEM[1] + 2]: None for i in range(1, len(word))}
    return [w for w in words if w]


def language(text: str) -> str:
    """The language whose function words the text has most of, or the script of most of its letters."""
    words = set(text.lower().split())
    best = max(FUNCTION_WORDS, key=lambda name: sum(w in words for w in FUNCTION_WORDS[name]))
    if sum(w in words for w in FUNCTION_WORDS[best]) >= 3:
        return best
    scripts = Counter(unicodedata.name(c, "none").split()[0] for c in set(text) if c.isalpha())
    return scripts.most_common(1)[0][0].lower() if scripts else "none"


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Product of the lexicon trie and the Levenshtein automaton, made deterministic as it is used.

    Terms are stems: a word matches when a beginning of it is within the term's edits.
    """

    def __init__(self, terms: list[str]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.term_at: list[int] = [-1]
        self.budget: list[int] = [0]  # most edits that any term at or below the node allows
        for i, term in enumerate(terms):
            node, most = 0, edits_allowed(term)
            self.budget[0] = max(self.budget[0], most)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term_at.append(-1)
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], most)
            self.term_at[node] = i
        self.letters = frozenset(c for term in terms for c in term)
        self.reset()

    def reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.states: list[dict[int, int]] = []
        self.hits: list[tuple[tuple[int, int], ...]] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        todo = list(nodes)
        while todo:  # letters of the term that the word lacks
            node = todo.pop()
            for child in self.children[node].values():
                cost = nodes[node] + 1
                if cost <= self.budget[child] and cost < nodes.get(child, 9):
                    nodes[child] = cost
                    todo.append(child)
        key = frozenset(nodes.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(nodes)
            self.moves.append({})
            self.hits.append(
                tuple(
                    (self.term_at[n], e)
                    for n, e in sorted(nodes.items())
                    if self.term_at[n] >= 0 and e <= edits_allowed(self.terms[self.term_at[n]])
                )
            )
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        out: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= self.budget[node] and cost < out.get(node, 9):
                out[node] = cost

        for node, cost in self.states[state].items():
            reach(node, cost + 1)  # a letter that the term lacks
            for letter, child in self.children[node].items():
                reach(child, cost + (letter != c))
        out.pop(0, None) if not self.budget[0] else None
        return self._state(out)

    def match(self, word: str) -> tuple[tuple[int, int], ...]:
        """(term, fewest edits) of each term that a beginning of the word matches."""
        if len(self.states) > 100_000:
            self.reset()
        state, best = self.start, {}
        for c in word:
            c = c if c in self.letters else ""
            moves = self.moves[state]
            if c not in moves:
                moves[c] = self._move(state, c)
            state = moves[c]
            if not self.states[state]:
                break
            for term, edits in self.hits[state]:
                if edits < best.get(term, 9):
                    best[term] = edits
        return tuple(best.items())


class Matches(dict):
    """From raw tokens to their hits."""

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, token: str) -> tuple[tuple[int, int], ...]:
        if len(self) > 400_000:
            self.clear()
        best: dict[int, int] = {}
        for word in parts_of(token):
            for term, edits in self.automaton.match(word):
                best[term] = min(edits, best.get(term, 9))
        self[token] = hits = tuple(best.items())
        return hits


def context(words: list[str], at: int, found: set[int], window: int = WINDOW) -> tuple[bool, bool]:
    """Whether the hit at a place is quoted, and whether it is aimed at someone."""
    low, high = max(0, at - window), min(len(words), at + window + 1)
    near = [words[i].strip(".,;:!?()").lower() for i in range(low, high) if i != at]
    before = sum(words[i].count(q) for i in range(low, at) for q in QUOTES)
    own = words[at]
    opens = own[:1] in QUOTES
    after = any(q in words[i] for i in range(at + 1, high) for q in QUOTES) or own[-1:] in QUOTES
    quoted = ((before % 2 == 1 or opens) and after) or any(w in REPORTING for w in near)
    aimed = any(w in SECOND_PERSON for w in near) or any(i in found for i in range(low, high) if i != at)
    return quoted, aimed


def document_hits(text: str | None, matches: Matches) -> tuple[int, list[tuple[int, int, bool, bool]]]:
    """Number of words, and (term, misspelled, quoted, aimed) of each hit."""
    words = (text or "").split()
    places = [i for i, h in enumerate(map(matches.__getitem__, words)) if h]
    found, out = set(places), []
    for i in places:
        quoted, aimed = context(words, i, found)
        out += [(term, int(edits > 0), quoted, aimed) for term, edits in matches[words[i]]]
    return len(words), out


class Model:
    """Terms, their weights (exact, misspelled) and the regression's coefficients."""

    def __init__(self, terms: list[str], weights: np.ndarray, coefficients: np.ndarray) -> None:
        self.terms, self.weights, self.coefficients = terms, weights, coefficients

    def features(self, n_words: int, hits: list[tuple[int, int, bool, bool]]) -> list[float]:
        direct: dict[int, float] = {}
        cited: dict[int, float] = {}
        aimed = 0
        for term, kind, quoted, at_someone in hits:
            w = self.weights[term, kind]
            if w <= 0:
                continue
            side = cited if quoted else direct
            side[term] = max(side.get(term, 0.0), w)
            aimed += at_someone and not quoted
        return [
            1.0, max(direct.values(), default=0.0), math.log1p(sum(direct.values())),
            max(cited.values(), default=0.0), math.log1p(aimed),
        ]

    def score(self, n_words: int, hits: list[tuple[int, int, bool, bool]]) -> float:
        z = float(np.dot(self.features(n_words, hits), self.coefficients))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


STATED = np.array([-3.0, 0.8, 1.0, 0.1, 0.3])


def fitted(x: np.ndarray, y: np.ndarray, start: np.ndarray = STATED, pull: float = 0.05) -> np.ndarray:
    """Logistic regression, pulled towards the stated coefficients."""
    b = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (y - p) - pull * (b - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(b)), gradient)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


def _stems(text: str) -> set[str]:
    words = {w for t in set(text.split()) for w in parts_of(t)}
    return {w[:n] for w in words for n in range(2 if WITHOUT_SPACES.match(w) else STEM[0], min(STEM[1], len(w)) + 1)}


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, toxic and the language that the text shows."""
    for batch in batches:
        languages = [language(t or "") for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(languages, pa.string())], names=["text", "toxic", "language"])


def _counted(only: frozenset[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, label, name in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                stems = _stems(text or "")
                counts[int(label > 0)].update((name, s) for s in (stems if only is None else stems & only))
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, _ in terms], pa.string()), pa.array([t for _, t in terms], pa.string()),
                    pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64()),
                ],
                names=["language", "term", "toxic", "clean"],
            )

    return run


def _hits(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = Matches(Automaton(terms))
        for batch in batches:
            found = [document_hits(t, matches) for t in batch.column(0).to_pylist()]
            hits = [[8 * t + 4 * m + 2 * q + a for t, m, q, a in sorted(set(h))] for _, h in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([n for n, _ in found], pa.int64()), pa.array(hits, pa.list_(pa.int64()))],
                names=["toxic", "words", "hits"],
            )

    return run


def learned_terms(
    counts: list[tuple[str, int, int]], toxic: int, clean: int, everywhere: dict[str, float]
) -> list[tuple[float, str]]:
    """(strength, stem) of stems met far more often in toxic documents of a language, the shortest of those that
    say the same; ``everywhere`` has the lift of each over all languages."""
    t = {term: a for term, a, _ in counts}
    rate = {term: (c + 0.5) / (clean + 1) for term, _, c in counts}
    lift = {term: everywhere[term] for term, a in t.items() if a >= LEAST}
    chance = math.log(max(len(counts), 1)) + MARGIN

    def beyond_chance(term: str) -> float:
        """Minus the logarithm of a bound on the chance of so many documents."""
        expected = toxic * rate[term]
        return t[term] * math.log(t[term] / expected) - (t[term] - expected)

    longer: dict[str, int] = {}
    for term in t:
        longer[term[:-1]] = max(longer.get(term[:-1], 0), t[term])
    closed = [s for s in lift if lift[s] >= LIFT and beyond_chance(s) >= chance and longer.get(s, 0) < t[s]]
    kept: set[str] = set()
    for stem in sorted(closed, key=lambda s: (len(s), s)):
        shorter = [stem[:n] for n in range(1, len(stem)) if stem[:n] in kept]
        if not any(lift[k] >= 0.3 * lift[stem] for k in shorter):
            kept.add(stem)
    return [(beyond_chance(s), s) for s in kept]


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, toxic) that may be learned from."""
    ready(docs.sparkSession)
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    share = min(1.0, max_train / max(total, 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about max_train narrow rows
    one = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").cast("int").alias("toxic"))
    sample = cut(one.select("text", "toxic").mapInArrow(_grouped, "text string, toxic int, language string"))
    is_toxic = (F.col("toxic") > 0).alias("toxic")
    sizes = {(r["language"], r["toxic"]): r["n"] for r in sample.groupBy("language", is_toxic).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = (sum(n for (_, t), n in sizes.items() if t is label) for label in (True, False))
    counted = "language string, term string, toxic long, clean long"
    terms = list(INSULTS)
    if n_toxic and n_clean:
        sums = F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
        often = sample.where("toxic > 0").mapInArrow(_counted(None), counted).groupBy("language", "term").agg(*sums)
        # Stems of the bounded sample's toxic documents: their number is bounded by max_train.
        candidates = frozenset(r["term"] for r in often.where(F.col("toxic") >= LEAST).select("term").distinct().collect())
        counts = sample.mapInArrow(_counted(candidates), counted).groupBy("language", "term").agg(*sums).collect()
        by_language: dict[str, list[tuple[str, int, int]]] = {}
        in_toxic, in_clean = Counter(), Counter()
        for r in counts:
            by_language.setdefault(r["language"], []).append((r["term"], r["toxic"], r["clean"]))
            in_toxic[r["term"]] += r["toxic"]
            in_clean[r["term"]] += r["clean"]
        lift = {t: (in_toxic[t] + 0.5) / (n_toxic + 1) * (n_clean + 1) / (in_clean[t] + 0.5) for t in in_toxic}
        best: dict[str, float] = {}
        for name, own in by_language.items():
            for strength, stem in learned_terms(own, sizes.get((name, True), 0), sizes.get((name, False), 0), lift):
                best[stem] = max(strength, best.get(stem, 0.0))
        stems = sorted(best, key=lambda s: (-best[s], s))[: LEAST_TERMS + n_toxic // 16]
        terms += [s for s in stems if s not in INSULTS]
    weights = np.tile(np.array([3.0, 2.0]), (len(terms), 1))
    if not (n_toxic and n_clean):
        return Model(terms, weights, STATED)
    found = sample.mapInArrow(_hits(terms), "toxic int, words long, hits array<long>").collect()  # the sample's size bounds it
    seen = np.zeros((2, len(terms), 2))
    for row in found:
        for code in {h >> 2 for h in row["hits"]}:
            seen[int(row["toxic"] > 0), code >> 1, code & 1] += 1
    odds = np.log((seen[1] + 0.5) / (n_toxic + 1)) - np.log((seen[0] + 0.5) / (n_clean + 1))
    odds = np.clip(odds, -2, 7)
    weights[:, 0] = np.where(seen[:, :, 0].sum(axis=0) > 0, odds[:, 0], 3.0)
    stated = np.arange(len(terms)) < len(INSULTS)
    unseen = np.where(stated, 0.6 * weights[:, 0], 0.0)  # a learned stem counts misspelled only where that was seen
    weights[:, 1] = np.where(seen[:, :, 1].sum(axis=0) > 0, odds[:, 1], unseen)
    weights[~stated & (seen[1, :, 1] < LEAST), 1] = 0.0
    model = Model(terms, weights, STATED)
    x = np.array([model.features(r["words"], [(h >> 3, h >> 2 & 1, bool(h & 2), bool(h & 1)) for h in r["hits"]]) for r in found])
    y = np.array([float(r["toxic"] > 0) for r in found])
    return Model(terms, weights, fitted(x, y))


def scores(text: Column, model: Model) -> Column:
    """The score of each whole text, 0 to 1."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matches = Matches(Automaton(model.terms))
        for texts in batches:
            yield pd.Series([model.score(*document_hits(t, matches)) for t in texts], dtype="float64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text)


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether a document may not be learned from, by the CRC-32 of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; held-out rows are never learned from."""
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))), max_train)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scores(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))), max_train)
    whole = docs.select(F.struct(*quoted(docs.columns)).alias("doc"), F.col("text").alias("text"))
    return whole.withColumn("score", scores(F.col("text"), model)).where("score < 0.5").select("doc.*")
