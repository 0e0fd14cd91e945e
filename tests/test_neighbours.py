"""Rows next to each other, with one key far above the limit."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import as_rows

from tenura.operators import enrich
from tenura.operators.neighbours import with_neighbours


def _rows(seed: int, n: int, hot_share: float):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot_share else rng.choice(["a", "b", "c", None])
        start = date(2024, 1, 1) + timedelta(days=rng.choice([0, 0, 0, 1, 2, 30, 90]))
        end = start + timedelta(days=rng.randrange(200)) if rng.random() < 0.9 else None
        rows.append((key, start, f"S{i:04d}", end))
    rng.shuffle(rows)
    return rows


def _by_hand(rows):
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(mine):
            out.append(
                (r[0], r[3], mine[i + 1][1] if i + 1 < len(mine) else None,
                 mine[i - 1][3] if i else None, i + 1, r[1], r[2])
            )
    return out


@pytest.mark.parametrize("hot_rows", [10_000, 100, 25, 7])
def test_same_answer_for_any_limit(spark, hot_rows):
    rows = _rows(3, 600, 0.5)
    df = spark.createDataFrame(rows, "account string, start date, sub string, finish date").repartition(5)
    got = with_neighbours(
        df, ["account"], ["start", "sub"],
        next_of={"next_start": "start"}, previous_of={"prev_finish": "finish"},
        sequence="seq", hot_rows=hot_rows,
    ).select("account", "finish", "next_start", "prev_finish", "seq", "start", "sub")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_by_hand(rows), key=key)


def test_all_rows_of_one_key_with_equal_start(spark):
    rows = [("k", date(2024, 5, 1), f"S{i:04d}", date(2024, 6, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "account string, start date, sub string, finish date")
    got = with_neighbours(df, ["account"], ["start", "sub"], sequence="seq", hot_rows=20)
    assert sorted((r["seq"], r["sub"]) for r in got.collect()) == [
        (i + 1, f"S{i:04d}") for i in range(400)
    ]


def test_lifecycle_does_not_depend_on_the_limit(spark, data_dir):
    from tenura.sources import testdata as td

    subs = td.subscriptions(spark, data_dir)
    usual = enrich.enrich_subscriptions(subs)
    split = enrich.enrich_subscriptions(subs, hot_rows=12)
    assert as_rows(usual) == as_rows(split.select(*usual.columns))


def test_a_low_limit_does_not_make_a_task_a_slice(spark, monkeypatch):
    """600 rows and a limit of two rows: slices of two rows, in as many partitions as the session states."""
    from pyspark.sql import functions as F

    from tenura.operators import neighbours

    written = []
    whole = neighbours.cut

    def noted(df):
        out = whole(df.withColumn("_task", F.spark_partition_id()) if "_slice" in df.columns else df)
        if "_slice" in df.columns:
            written.append(out.groupBy("account", "_slice").agg(F.count("*").alias("n"), F.max("_task").alias("task")).collect())
            out = out.drop("_task")
        return out

    monkeypatch.setattr(neighbours, "cut", noted)
    rows = _rows(5, 600, 0.5)
    df = spark.createDataFrame(rows, "account string, start date, sub string, finish date")
    got = with_neighbours(
        df, ["account"], ["start", "sub"],
        next_of={"next_start": "start"}, previous_of={"prev_finish": "finish"}, sequence="seq", hot_rows=2,
    ).select("account", "finish", "next_start", "prev_finish", "seq", "start", "sub")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_by_hand(rows), key=key)
    slices = written[0]
    assert max(r["n"] for r in slices) == 2 and len(slices) >= 300
    assert len({r["task"] for r in slices}) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
