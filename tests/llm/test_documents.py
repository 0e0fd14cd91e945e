"""Mixing, exact dedup, packing, SimHash: brute force on small tables and hard cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tenura.llm import exact_dedup, mixing, packing, simhash
from tenura.llm.common import addressed, table
from llm.conftest import DOCS, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def levels(sizes: dict, weights: dict, most: float = 3.0) -> dict:
    """Targets by the rule as it is stated."""
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / total for s in free}
        target |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return target


def check_mix(rows, found):
    sizes: dict = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = levels(sizes, {s: 1 + i % 3 for i, s in enumerate(order)})
    assert len(found) == len(rows)
    by_size = {sizes[s]: target[s] for s in sizes}
    for r in found:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        assert r.target == pytest.approx(by_size[r.source_size])


def test_mix_small_table(spark):
    docs = table(spark, SMALL, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = mixing.shares(docs).collect()
    check_mix(rows, found)
    again = {r.doc_id: r.taken for r in mixing.shares(docs.repartition(3)).collect()}
    assert again == {r.doc_id: r.taken for r in found}


def test_mix_meets_targets_through_many_nodes(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 400), "en", f"s{min(i % 7, 3)}", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.shares(docs, node_rows=16).collect()
    check_mix(rows, found)
    source = {r[0]: r[3] for r in rows}
    taken, target = Counter(), {}
    for r in found:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) < 0.02 * target[s]


def test_exchange_keeps_words_and_expectations():
    rng = np.random.default_rng(0)
    size = np.array([5.0, 3.0, 8.0, 1.0, 13.0])
    start = np.full(5, 0.3)
    seen = np.zeros(5)
    for _ in range(4000):
        p, at = mixing._exchange(start, size, rng.random(5))
        assert p @ size == pytest.approx(start @ size)
        assert sum(0 < x < 1 for x in p) <= 1 and (at < 0 or 0 < p[at] < 1)
        seen += p
    assert np.abs(seen / 4000 - 0.3).max() < 0.03


def test_mix_hard_cases(spark, hard, hard_rows, clashing, no_docs):
    found = mixing.shares(hard).collect()
    check_mix(hard_rows, found)
    assert mixing.shares(no_docs).collect() == []
    mixed = mixing.mixed(clashing)
    assert mixed.columns == clashing.columns
    assert {r.doc_id for r in mixed.collect() if r.text is None} == {1}


def test_exact_groups_equal_sql(spark, duck):
    from tenura.llm.queries import LLM_ORACLES, LLM_QUERIES

    result = duck.execute(LLM_ORACLES["op3_exact_dedup"])
    names = [c[0] for c in result.description]
    found = LLM_QUERIES["op3_exact_dedup"](spark, SMALL).select(names).collect()
    assert sorted(map(tuple, found)) == sorted(result.fetchall())


@pytest.mark.parametrize("max_bits", [exact_dedup.MAX_BITS, exact_dedup.BITMAP])
def test_exact_groups_hard_cases(spark, hard, hard_rows, max_bits):
    found = exact_dedup.exact_groups(hard, max_bits).collect()
    strip = str.maketrans("", "", " \t\n\x0b\x0c\r")
    groups = defaultdict(list)
    for doc_id, text, *_ in hard_rows:
        groups[hashlib.sha256((text or "").translate(strip).encode()).hexdigest()].append((-len(text or ""), doc_id is None, doc_id or 0))
    assert len(found) == len(hard_rows)
    for r in found:
        best = min(groups[r.text_sha256])
        assert r.group_size == len(groups[r.text_sha256])
        assert r.keep_id == (None if best[1] else best[2])
    assert Counter(r.text_sha256 for r in found if r.kept) == Counter(groups.keys())


def test_exact_dedup_keeps_columns(spark, clashing, no_docs):
    kept = exact_dedup.exact_dedup(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len({r.text_sha256 for r in exact_dedup.exact_groups(clashing).collect()})
    assert exact_dedup.exact_dedup(no_docs).collect() == []
    assert exact_dedup.exact_groups(no_docs).collect() == []


def test_rows_that_the_filter_clears_do_not_shuffle(spark):
    rows = [(i, f"text {i % 900}", "en", "a", 0) for i in range(1000)]
    hashed = exact_dedup.cut(exact_dedup.with_hash(addressed(spark.createDataFrame(rows, DOCS)), ["doc_id"]).drop("doc"))
    bits = exact_dedup.filter_bits(1000)
    marked = exact_dedup.probed(hashed, exact_dedup.repeated_cells(hashed, bits), bits)
    maybe = {r.id for r in marked.where("maybe").collect()}
    repeated = {i for i in range(1000) if i < 100 or i >= 900}
    assert repeated <= maybe and len(maybe) < 260


def test_pieces_are_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SMALL, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame(
            [(-1, None), (-2, "a  b \n c  "), (-3, " x  y "), (-4, "Привет мир 12"), (-5, "don't  <|endoftext|> we'll\t\t go")],
            "doc_id long, text string",
        )
    )
    whole = Tokenizer.from_file(packing.default_path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = defaultdict(list)
    for r in packing.packed_pieces(docs).collect():
        found[r.doc_id].append(r)
    assert set(found) == set(texts)
    for doc_id, pieces in found.items():
        ids = [*whole.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert all(r.length == 1024 for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def check_sequences(rows):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places), -(-sum(r.length for r in rows) // 1024)


def test_packing_is_near_the_least(spark):
    rng = random.Random(5)
    rows = [(i, "x " * rng.randint(1, 700), "en", "a", 0) for i in range(3000)]
    used, least = check_sequences(packing.packed_pieces(spark.createDataFrame(rows, DOCS)).collect())
    assert used <= 1.01 * least + 1


def test_packing_hard_cases(spark, hard, hard_rows, no_docs):
    rows = packing.packed_pieces(hard).collect()
    check_sequences(rows)
    assert sum(r.piece == 0 for r in rows) == len(hard_rows)
    assert packing.packed_pieces(no_docs).collect() == []


def test_local_search_empties_bins_and_keeps_pieces():
    lengths = np.array([600, 600, 424, 424, 300, 300, 200, 200, 24, 24, 500, 524])
    poor = [[i] for i in range(len(lengths))]
    found = packing.local_search(lengths, poor, 1024)
    assert sorted(x for b in found for x in b) == list(range(len(lengths)))
    assert max(lengths[b].sum() for b in found) <= 1024
    assert len(found) <= 6


def brute_fingerprint(text: str) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values: list[int], most: int = 3) -> list[int]:
    parent = list(range(len(values)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def check_components(rows, texts):
    ids = sorted(rows, key=lambda d: d)
    values = [int(rows[d].fingerprint, 16) for d in ids]
    assert values == [brute_fingerprint(texts[d]) for d in ids]
    assert [rows[d].component_id for d in ids] == [ids[c] for c in brute_components(values)]


def test_near_components_small_table(spark):
    docs = table(spark, SMALL, "documents")
    rows = {r.doc_id: r for r in simhash.near_components(docs).collect()}
    check_components(rows, {r.doc_id: r.text for r in docs.collect()})


def test_near_components_hard_cases(spark, hard, clashing, no_docs):
    rows = simhash.near_components(hard).collect()
    empty = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert all(r.fingerprint == "0" * 16 and r.component_id == 1 for r in empty)
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert simhash.near_components(no_docs).collect() == []
    kept = simhash.near_dedup(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len({r.component_id for r in rows})
    assert simhash.near_dedup(no_docs).collect() == []


@pytest.mark.parametrize("node_rows", [simhash.NODE_ROWS, 40])
def test_links_join_what_brute_force_joins(spark, node_rows):
    rng = random.Random(9)
    values = set()
    for centre, n, flips in ((0, 150, 4), (rng.getrandbits(64), 120, 3), (rng.getrandbits(64), 200, 6)):
        for _ in range(n):
            v = centre
            for _ in range(rng.randint(0, flips)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values |= {rng.getrandbits(64) for _ in range(300)}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(fps, node_rows=node_rows)).collect()}
    found = [roots.get(v, v) for v in signed]
    brute = brute_components(sorted(values))
    assert len(set(found)) == len(set(brute))
    assert len(set(zip(found, brute, strict=True))) == len(set(brute))


def test_gray_index_prunes_and_finds(spark):
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
    near = values[:300] ^ np.uint64(5)
    values = np.unique(np.concatenate([values, near]))
    index = simhash.GrayIndex(values)
    a, b = index.forest(3)
    assert (np.bitwise_count(index.values[a] ^ index.values[b]) <= 3).all()
    assert len(a) >= 300
    ranks = simhash.gray_rank(index.values)
    assert (ranks[1:] > ranks[:-1]).all()
    assert (np.bitwise_count(np.arange(1, 64, dtype=np.uint64) ^ (np.arange(1, 64, dtype=np.uint64) >> np.uint64(1))) >= 1).all()


def test_long_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {roots[i] for i in range(61)} == {0} and roots[101] == roots[100] == 100
    assert simhash.components(edges.where(F.lit(False))).collect() == []
