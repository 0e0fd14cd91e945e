"""The near-dedup stage searches its nodes by the Gray-order index."""

from __future__ import annotations

import numpy as np
import pytest

from tenura.llm import near_copies
from tenura.llm.clusters import bits_apart, close_places


@pytest.mark.parametrize(("n", "families"), [(2, 1), (31, 3), (700, 20), (700, 690), (3000, 5)])
def test_the_index_finds_what_comparing_all_prints_finds(n, families):
    rng = np.random.default_rng(n + families)
    heads = rng.integers(0, 256, (families, 16), np.uint8)
    bits = np.unpackbits(heads[rng.integers(0, families, n)], axis=1)
    bits ^= rng.random((n, 128)) < rng.choice([0.02, 0.1, 0.2], (n, 1))
    prints = np.packbits(bits, axis=1)
    most = near_copies.MOST
    assert np.array_equal(near_copies.gray_places(prints, most), close_places(prints, bits_apart, most))


def test_the_stage_hands_the_index_to_its_nodes(spark, monkeypatch):
    class Seen(Exception):
        pass

    def clusters(batches, apart, most, places=None):
        assert places is near_copies.gray_places
        raise Seen

    monkeypatch.setattr(near_copies, "candidate_clusters", clusters)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g")], "doc_id long, text string")
    path = near_copies.cut(docs)  # addresses name files
    with pytest.raises(Seen):
        near_copies.near_copies_dropped(path)
