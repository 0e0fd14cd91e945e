"""Tokenizer alignment against a walk over decoded bytes."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from llm.conftest import DOCS, SMALL
from tenura.llm import alignment
from tenura.llm.common import table
from tenura.llm.queries import op12_align_tokenizers
from tenura.llm.tokens import default_path

HARD = [
    "hello  wörld 漢字 \U0001f600 x\n\ny ", " lead", "<s> <0x0A> </s> <unk> <|endoftext|>", "a▁b c", "nul\0x", "é ﬁ ①", "",
    "　x y​z\tq\r\n", "﻿x", " ", "\n", "a", "  ", "x  y", "́a b́ c", "\U0001f468‍\U0001f469 \x85 a\x1cb \x1c c", None,
    "漢 漢字漢字 Ω≈ç√ ∫˜µ", "don't we'll 12345 67,890.12", "x" * 3000, "word " * 2000, "ａ" * 700 + " ▂ ▁",
]


@pytest.fixture(scope="module")
def both():
    return alignment.Aligner(default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model"))


def walked(both, text):
    """Groups of (A ids, B ids), by decoded bytes alone."""
    if not text:
        return [], [], []
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    wanted = (" " + text).encode()
    if b"".join(both.bytes_a[i] for i in a) != wanted or b"".join(both.bytes_b[i] for i in b) != wanted:
        return [], [], []

    def ends(ids, of):
        at, out = 0, []
        for i in ids:
            at += len(of[i])
            out.append(at)
        return out

    of_a, of_b = ends(a, both.bytes_a), ends(b, both.bytes_b)
    groups, i, j = [], 0, 0
    for end in sorted(set(of_a) & set(of_b)):
        ni, nj = of_a.index(end, i) + 1, of_b.index(end, j) + 1
        groups.append((a[i:ni], b[j:nj]))
        i, j = ni, nj
    return a, b, groups


def expected(both, rows):
    all_groups = [walked(both, text) for _, text in rows]
    count = Counter((g[0][-1], g[1][-1]) for _, _, groups in all_groups for g in groups)
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for (doc_id, _), (a, b, groups) in zip(rows, all_groups, strict=True):
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        links = [(x[-1], y[-1]) for x, y in groups]
        best, total = sum(count[k] == highest[k[1]] for k in links), sum(count[k] for k in links)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, total, digest))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def test_query_equals_walk(spark, both):
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    assert found(op12_align_tokenizers(spark, SMALL)) == sorted(expected(both, rows), key=str)


def test_hard_texts(spark, both):
    rows = list(enumerate(HARD)) + [(None, "a third text"), (3, "x"), (3, "x")]
    frame = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOCS).selectExpr("*", "1 AS block", "2 AS pair", "3 AS `a.b`")
    exact = sorted(expected(both, rows), key=str)
    assert found(alignment.aligned(frame)) == exact
    assert found(alignment.aligned(frame, block_links=10)) == exact  # many blocks, texts beyond a block


def test_forgetting_parts_changes_nothing(both, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_PARTS", 5)
    texts = ["the same words again and again", "the same words again but others too", "words", *[t for t in HARD if t]]
    for _ in range(2):
        for text in texts:
            counts, digest, pairs = both.texts([text])[0]
            a, b, groups = walked(both, text)
            assert [int(c) for c in counts] == [len(a), len(b), len(groups)] and len(pairs) == len(groups)
            assert bool(digest) == bool(groups)


def test_whole_texts_where_parts_do_not_separate(both, monkeypatch):
    fresh = alignment.Aligner(default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model"))
    monkeypatch.setattr(fresh, "separable", False)
    for text in HARD:
        (whole, digest, _), (parts, other, _) = fresh.texts([text])[0], both.texts([text])[0]
        assert digest == other and [int(c) for c in whole] == [int(c) for c in parts]


def test_no_documents(spark, no_docs):
    assert alignment.aligned(no_docs).collect() == []
