from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenura.functions import dates, values
from tenura.operators import dims


def _one(spark, column, **cells):
    schema = ", ".join(f"{n} {t}" for n, (t, _) in cells.items())
    row = spark.createDataFrame([tuple(v for _, v in cells.values())], schema)
    return row.select(column.alias("x")).first()["x"]


def test_whole_days_floors_backwards(spark):
    gap = dates.whole_days(F.col("later"), F.col("earlier"))
    cases = [
        (datetime(2024, 4, 1), datetime(2024, 1, 31, 10), 60),
        (datetime(2024, 4, 2), datetime(2024, 1, 31, 10), 61),
        (datetime(2024, 1, 31), datetime(2024, 1, 31, 10), -1),
        (datetime(2024, 1, 31), datetime(2024, 1, 30), 1),
    ]
    for later, earlier, days in cases:
        got = _one(spark, gap, later=("timestamp", later), earlier=("timestamp", earlier))
        assert got == days == (later - earlier).days


def test_calendar_attributes(spark):
    rows = {r["date_key"]: r for r in dims.dim_date(spark).collect()}
    assert len(rows) == 1096
    for day, r in rows.items():
        assert r["week_of_year"] == int(day.strftime("%U"))
        assert r["day_of_week"] == day.isoweekday()
        assert r["day_name"] == day.strftime("%A")
        assert r["month_name"] == day.strftime("%B")
        assert r["is_month_end"] == ((day + timedelta(days=1)).day == 1)
        assert r["is_weekend"] == (day.isoweekday() > 5)


def test_month_spine_modes():
    def keys(spine):
        return {m.year * 100 + m.month for m in dates.month_spine(date(2026, 4, 4), spine)}

    assert keys("calendar") - keys("reference") == {202402, 202604}
    late = {m.year * 100 + m.month for m in dates.month_spine(date(2026, 12, 31), "reference")}
    assert 202402 not in late and 202612 not in late and 202611 in late
    assert len(dates.month_spine(date(2026, 12, 31), "calendar")) == 36


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=50))
def test_money_rounds_like_numpy(spark, numbers):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    got = [r["m"] for r in rows.orderBy("i").select(values.money(F.col("x")).alias("m")).collect()]
    assert got == list(np.round(np.array(numbers), 2))


def test_clips_keep_null_apart(spark):
    assert _one(spark, values.at_least(F.col("x"), 0), x=("double", None)) is None
    assert _one(spark, values.non_negative(F.col("x")), x=("double", None)) == 0
    assert _one(spark, values.non_negative(F.col("x")), x=("double", -2.0)) == 0
    assert _one(spark, values.within(F.col("x"), 1, 5), x=("double", 7.5)) == 5
    assert _one(spark, values.within(F.col("x"), 1, 5), x=("double", None)) is None
    assert _one(spark, values.ratio(F.col("x"), F.lit(0)), x=("double", 1.0)) is None


def test_strip_takes_every_blank(spark):
    for text in ("\t a b \n", " a b ", " a b\x1f", "a b"):
        assert _one(spark, values.strip(F.col("x")), x=("string", text)) == text.strip() == "a b"


def test_missing_tokens(spark):
    for text in ("NA", "None", "nan", "", "NULL", "<NA>"):
        assert _one(spark, values.missing_to_null(F.col("x")), x=("string", text)) is None
    assert _one(spark, values.missing_to_null(F.col("x")), x=("string", "none")) == "none"


def test_padded_id_keeps_long_numbers(spark):
    long = 12_345_678_901
    assert _one(spark, values.padded_id("A", F.col("x")), x=("bigint", 7)) == "A000000007"
    assert _one(spark, values.padded_id("A", F.col("x")), x=("bigint", long)) == f"A{long}"


def test_bad_dates_become_null(spark):
    for text in ("not a date", "2025-13-01", ""):
        assert _one(spark, dates.parse_day(F.col("x")), x=("string", text)) is None
    assert _one(spark, dates.parse_day(F.col("x")), x=("string", "2025-01-31 23:59:59")) == date(2025, 1, 31)


def test_month_boundaries(spark):
    got = _one(
        spark, dates.month_boundaries(F.col("a"), F.col("b")),
        a=("date", date(2024, 1, 31)), b=("date", date(2025, 2, 1)),
    )
    assert got == 13
