"""Near copies of the pipeline: exact similarity, recall on planted copies."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tenura.llm import clusters, near_copies, simhash
from tenura.llm.common import table
from llm.conftest import DOCS, SMALL


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def changed(rng, base, least, most):
    """A copy with words replaced until its similarity lies between the bounds."""
    while True:
        copy = list(base)
        for i in rng.sample(range(len(base)), rng.randint(1, max(1, len(base) // 30))):
            copy[i] = f"new{rng.randrange(10**9)}"
        if least <= jaccard(shingles(" ".join(base)), shingles(" ".join(copy))) < most:
            return copy


def stage(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    return {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect()}


def test_planted_copies_go(spark):
    rng = random.Random(4)
    texts, copies = [], defaultdict(list)
    for low in (0.8, 0.85, 0.9):
        for _ in range(150):
            base = words(rng, rng.randint(100, 400))
            texts.append(" ".join(base))
            copies[low].append(len(texts))
            texts.append(" ".join(changed(rng, base, low, low + 0.05)))
    kept = stage(spark, texts)
    assert set(range(0, len(texts), 2)) <= kept
    found = {low: sum(i not in kept for i in ids) / len(ids) for low, ids in copies.items()}
    assert found[0.8] >= 0.98 and found[0.85] >= 0.99 and found[0.9] == 1.0, found


def smallest_of_components(texts):
    """Ids that stay, by the exact similarity of five-word shingles."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and jaccard(sets[a], sets[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in root if find(i) == i}


def test_stage_equals_brute_force(spark):
    rows = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, table(spark, SMALL, "documents"), SMALL).collect()}
    assert kept == smallest_of_components({r.doc_id: r.text for r in rows})


def test_large_group_of_copies_is_one(spark):
    rng = random.Random(6)
    base = words(rng, 200)
    texts = [" ".join(changed(rng, base, 0.9, 1.0)) for _ in range(600)]
    assert stage(spark, texts) == {0}


def test_hard_cases(spark, hard, clashing, no_docs):
    kept = near_copies.near_copies_dropped(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 6, 7, 8]
    assert near_copies.near_copies_dropped(no_docs).collect() == []


def test_close_fingerprints_of_unlike_texts_both_stay(spark):
    rng = random.Random(8)
    line = "the same nine words stand in every single line " * 60  # an odd number of shingles: no ties
    texts = [line + " ".join(words(rng, 12)) for _ in range(2)]
    assert jaccard(*map(shingles, texts)) < 0.8
    a, b = (simhash.fingerprint(t.encode()) for t in texts)
    assert ((a ^ b) % (1 << 64)).bit_count() <= simhash.MOST
    assert stage(spark, texts) == {0, 1}


def test_large_group_costs_a_row_a_set_and_node():
    rng = np.random.default_rng(6)
    prints = np.repeat(rng.integers(0, 256, (1, 16), dtype=np.uint8), 4000, axis=0)
    prints[np.arange(4000), rng.integers(0, 16, 4000)] ^= np.uint8(1)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(4000, np.int64)), pa.array(np.arange(4000)), pa.array([p.tobytes() for p in prints])], names=["group", "key", "print"]
    )
    out = list(clusters._candidates(clusters.bits_apart, near_copies.MOST)(iter([batch])))
    assert sum(o.num_rows for o in out) == 3999


def test_dense_node_of_refused_links_hides_none(spark):
    """Texts within the bit limit but below the similarity, and true copies far down among their nearest."""
    rng = random.Random(9)
    base = words(rng, 150)
    texts = [" ".join(apart(rng, base)) for _ in range(60)]
    for i in (7, 23, 41):
        texts.append(" ".join(changed(rng, texts[i].split(), 0.8, 0.84)))
    assert stage(spark, texts) == smallest_of_components(dict(enumerate(texts)))


def apart(rng, base):
    """A text that shares about four fifths of its words with any other of its kind, but less than 0.8 of its shingles."""
    copy = list(base)
    for i in rng.sample(range(len(base)), 4):
        copy[i] = f"own{rng.randrange(10**9)}"
    return copy


def test_nodes_in_parts_lose_no_link(spark, monkeypatch):
    rng = random.Random(11)
    base = words(rng, 150)
    texts = [" ".join(apart(rng, base)) for _ in range(40)]
    texts += [" ".join(changed(rng, t.split(), 0.8, 0.9)) for t in texts[::5]]
    monkeypatch.setattr(clusters, "NODE_ROWS", 10)
    monkeypatch.setattr(clusters, "CLUSTER_ROWS", 7)
    assert stage(spark, texts) == smallest_of_components(dict(enumerate(texts)))


def test_matrix_of_alike_sets_is_exact():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: rng.integers(200, 300)], rng.integers(0, 1 << 63, rng.integers(0, 60), dtype=np.uint64)])) for _ in range(40)]
    sets.append(np.zeros(0, np.uint64))
    exact = np.array([[5 * len(set(x) & set(y)) >= 4 * len(set(x) | set(y)) if len(x) and len(y) else False for y in sets] for x in map(list, sets)])
    whole = clusters.alike(sets, np.zeros(41, np.int64), (4, 5))
    assert (whole | np.eye(41, dtype=bool) == exact | np.eye(41, dtype=bool)).all()
    side = np.arange(41) % 2
    across = clusters.alike(sets, side, (4, 5))
    assert (across == (exact & (side[:, None] != side[None, :]))).all()
    few = clusters.alike(sets[:5], np.zeros(5, np.int64), (4, 5))
    assert (np.triu(few, 1) == np.triu(exact[:5, :5], 1)).all()


def test_walk_reaches_chains():
    places = np.array([0, 1, 5, 2, 9, 6, 3])
    near = lambda now, others: np.abs(places[now][:, None] - places[others][None, :]) <= 1
    for step in (1, 10):
        assert clusters.reached(7, near, step).tolist() == [0, 0, 2, 0, 4, 2, 0]
