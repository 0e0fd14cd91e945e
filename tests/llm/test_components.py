"""Components of links: rounds end when the links are stars, and a task's links leave it as stars."""

from __future__ import annotations

import numpy as np

from tenura.llm import simhash
from tenura.llm.clusters import _pairs


def rounds(spark, monkeypatch, pairs):
    """Roots by node, and how many rounds they took: one table is written before the first and one in each."""
    written = []
    monkeypatch.setattr(simhash, "cut", lambda df, cut=simhash.cut: written.append(1) or cut(df))
    rows = simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.root for r in rows}, len(written) - 1


def test_stars_take_no_round(spark, monkeypatch):
    pairs = [(1, n) for n in range(2, 40)] + [(n, 100) for n in range(101, 120)] + [(7, 1), (5, 5), (None, 3), (3, None)]
    roots, n = rounds(spark, monkeypatch, pairs)
    assert n == 0
    assert roots == {n: 1 for n in range(1, 40)} | {n: 100 for n in range(100, 120)}


def test_rounds_end_with_stars(spark, monkeypatch):
    roots, n = rounds(spark, monkeypatch, [(1, 2), (2, 3), (9, 8), (8, 10), (20, 30), (21, 30)])
    assert n == 1
    assert roots == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8, 20: 20, 21: 20, 30: 20}


def test_links_of_a_task_become_stars():
    a, b = (np.array(x) for x in ([7, 3, 9, 40], [3, 9, 12, 41]))
    found = _pairs([a[:2], a[2:]], [b[:2], b[2:]]).to_pydict()
    assert dict(zip(found["b"], found["a"], strict=True)) == {7: 3, 9: 3, 12: 3, 41: 40}
    assert _pairs([], []).num_rows == 0
