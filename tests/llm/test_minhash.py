"""MinHash near-duplicates against brute force on full sets."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm.conftest import SMALL
from tenura.llm import clusters, minhash
from tenura.llm.common import table
from tenura.llm.queries import op13_minhash_groups


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 2]) for i in range(len(words) - 1)} or ({tuple(words)} if words else set())


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        at = find(i)
        known = [x for x in (least.get(at), doc_id) if x is not None]
        least[at] = min(known) if known else None
    return sorted(((d, len(sets[i]), least[find(i)], least[find(i)] == d) for i, (d, _) in enumerate(rows)), key=str)


def found(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in frame.collect()), key=str)


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def changed(rng, words, n):
    copy = list(words)
    for i in rng.sample(range(len(words)), n):
        copy[i] = f"new{rng.randrange(10**9)}"
    return copy


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    assert found(op13_minhash_groups(spark, SMALL)) == brute(rows)


def test_planted_pairs_at_and_below_the_threshold(spark):
    rng = random.Random(5)
    rows = []
    for n in range(300):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(6, 300))]
        rows += [(2 * n + 1, " ".join(words)), (2 * n, " ".join(changed(rng, words, max(1, round(len(words) * rng.uniform(0.02, 0.07))))))]
    assert found(minhash.near_groups(frame_of(spark, rows))) == brute(rows)


def test_hard_cases(spark, hard_rows, hard, clashing, no_docs):
    rows = [(r[0], r[1]) for r in hard_rows]
    assert found(minhash.near_groups(hard)) == brute(rows)
    assert found(minhash.near_groups(clashing)) == brute(rows)
    assert minhash.near_groups(no_docs).collect() == []
    kept = minhash.near_dedup(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 7, 8]


@pytest.mark.parametrize("part_rows", [clusters.CLUSTER_ROWS, 12])
def test_chains_and_dense_families(spark, monkeypatch, part_rows):
    """One large group of copies, a chain of links, and a family whose members are just too far apart."""
    monkeypatch.setattr(clusters, "CLUSTER_ROWS", part_rows)
    monkeypatch.setattr(clusters, "NODE_ROWS", part_rows)
    rng = random.Random(7)
    base = [f"b{rng.randrange(5000)}" for _ in range(120)]
    texts = [" ".join(changed(rng, base, 2)) for _ in range(60)]
    chain = [f"c{i}" for i in range(400)]
    texts += [" ".join(chain[5 * i : 5 * i + 100]) for i in range(40)]
    family = [f"f{rng.randrange(5000)}" for _ in range(120)]
    texts += [" ".join(changed(rng, family, 9)) for _ in range(60)]
    texts += [" ".join(changed(rng, t.split(), 5)) for t in texts[100:160:6]]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = list(zip(order, texts, strict=True))
    assert found(minhash.near_groups(frame_of(spark, rows))) == brute(rows)


def test_repeated_text_is_a_third_of_the_rows(spark):
    rows = [(i, "the same text stands here many times over") for i in range(400)]
    rows += [(400 + i, f"another text {i} with {i + 1} and {i + 2}") for i in range(800)]
    result = {r.doc_id: r for r in minhash.near_groups(frame_of(spark, rows)).collect()}
    assert {result[i].component_id for i in range(400)} == {0}
    assert sum(r.kept for r in result.values()) == 801


def test_signature_places_agree_as_often_as_sets_are_similar():
    plan = minhash.plan_of(10**5)
    hashing, rng = minhash.MinMax(plan), np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    agree = [(hashing.of(pool[i : i + 900]) == hashing.of(pool[i + 100 : i + 1000])).mean() for i in range(0, 4000, 100)]
    assert abs(np.mean(agree) - 0.8) < 0.01
    assert np.std(agree) < np.sqrt(0.16 / (2 * plan.permutations))  # less than that of as many single hashes


@pytest.mark.parametrize("documents", [0, 1, 10**5, 10**8, 10**11])
def test_plan_keeps_its_chance_of_a_miss(documents):
    plan = minhash.plan_of(documents)
    assert plan.bands % 2 == 0 and (1 - 0.8**plan.rows) ** plan.bands <= minhash.MISSED
