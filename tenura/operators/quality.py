"""Batch checks, the gate, and declared tests."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura import fixed_values as fv
from tenura.functions.dates import parse_day, parse_timestamp
from tenura.schemas import SourceTable


TEXT = fv.CHECK_TEXT


class DataQualityError(Exception):
    """At least one check failed."""


def _as_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _instant(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return parse_timestamp(c) if _as_text(df, name) else c.cast("timestamp")


def _day(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return parse_day(c) if _as_text(df, name) else F.to_date(c)


def _number(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return c.try_cast("double") if _as_text(df, name) else c.cast("double")


def _status(problem: Column, when_bad: str) -> Column:
    return F.when(problem, F.lit(when_bad)).otherwise(F.lit("PASS"))


def _row(check: str, status: Column, detail: Column, violations: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        status.alias("status"),
        detail.alias("detail"),
        violations.cast("bigint").alias("violations"),
    )


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _listing(columns: Iterable[str], counter: str, word: str, empty: str) -> Column:
    """'a: 3 nulls, b: 1 nulls' over the columns whose count is above zero."""
    counts = {c: F.col(f"_{counter}_{c}") for c in columns}
    parts = [
        F.when(n > 0, _text(f"{c}: ", n.cast("string"), f" {word}")) for c, n in counts.items()
    ]
    joined = F.concat_ws(", ", *parts)
    return F.when(joined == "", F.lit(empty)).otherwise(joined)


def _total(names: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(n) for n in names], F.lit(0))


def check_table(df: DataFrame, table: SourceTable) -> DataFrame:
    """Seven rows: one per check, with status, detail and number of violations.

    All counts but one come from a single pass without a shuffle of rows.  Duplicate
    keys need the keys shuffled, so that pass reads the key column alone.  An empty
    batch skips every check.
    """
    present = set(df.columns)
    revenue = [c for c in table.revenue if c in present]
    critical = [c for c in table.critical if c in present]
    pk = table.key if table.key in present else None

    counts = {"_rows": F.count(F.lit(1))}
    counts["_null_pk"] = F.count_if(F.col(pk).isNull()) if pk else F.lit(-1).cast("bigint")
    counts |= {f"_negative_{c}": F.count_if(_number(df, c) < 0) for c in revenue}
    counts |= {f"_nulls_{c}": F.count_if(F.col(c).isNull()) for c in critical}
    missing = [c for c in table.date_order or () if c not in present]
    if table.date_order and not missing:
        start, end = (_instant(df, c) for c in table.date_order)
        counts["_order"] = F.count_if(end.isNotNull() & (end < start))
    bounded = table.event_date in present
    if bounded:
        day = _day(df, table.event_date)
        counts["_bounds"] = F.count_if(~day.between(F.lit(fv.FIRST_DAY), F.lit(fv.LAST_DAY)))
    totals = df.agg(*[c.alias(name) for name, c in counts.items()])

    rows = [
        _row(
            "non_empty_batch",
            _status(F.col("_rows") == 0, "WARNING"),
            _text(F.format_number("_rows", 0), TEXT["rows"]),
            (F.col("_rows") == 0).cast("int"),
        ),
        _row(
            "no_null_pk",
            _status(F.col("_null_pk") != 0, "FAIL"),
            _text(F.col("_null_pk").cast("string"), TEXT["null_key"].format(key=table.key)),
            F.col("_null_pk"),
        ),
    ]
    if not revenue and not table.revenue:
        rows.append(_row("no_negative_revenue", F.lit("SKIP"), F.lit(TEXT["no_revenue"]), F.lit(0)))
    else:
        negative = _total([f"_negative_{c}" for c in revenue])
        rows.append(
            _row(
                "no_negative_revenue",
                _status(negative > 0, "FAIL"),
                _listing(revenue, "negative", TEXT["revenue_bad"], TEXT["revenue_good"]),
                negative,
            )
        )
    if not table.date_order:
        rows.append(_row("date_order", F.lit("SKIP"), F.lit(TEXT["no_order"]), F.lit(0)))
    elif missing:
        rows.append(_row("date_order", F.lit("SKIP"), F.lit(TEXT["order_missing"].format(columns=missing)), F.lit(0)))
    else:
        rows.append(
            _row(
                "date_order",
                _status(F.col("_order") > 0, "FAIL"),
                _text(F.col("_order").cast("string"), TEXT["order"]),
                F.col("_order"),
            )
        )
    if bounded:
        limits = TEXT["bounds"].format(first=fv.FIRST_DAY, last=fv.LAST_DAY)
        rows.append(
            _row(
                "date_bounds",
                _status(F.col("_bounds") > 0, "WARNING"),
                _text(F.col("_bounds").cast("string"), limits),
                F.col("_bounds"),
            )
        )
    else:
        rows.append(
            _row(
                "date_bounds",
                F.lit("SKIP"),
                F.lit(TEXT["bounds_missing"].format(column=table.event_date)),
                F.lit(0),
            )
        )
    nulls = _total([f"_nulls_{c}" for c in critical])
    rows.append(
        _row(
            "no_null_critical_cols",
            _status(nulls > 0, "FAIL"),
            _listing(critical, "nulls", TEXT["critical_bad"], TEXT["critical_good"]),
            nulls,
        )
    )
    checks = totals.select("_rows", F.explode(F.array(*rows)).alias("_c")).select("_rows", "_c.*")

    if pk:
        repeated = (
            df.groupBy(pk)
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_dups"),
            )
        )
    else:
        repeated = totals.select("_rows", F.lit(-1).cast("bigint").alias("_dups"))
    duplicates = repeated.select(
        "_rows",
        _row(
            "no_duplicate_pk",
            _status(F.col("_dups") != 0, "WARNING"),
            _text(F.col("_dups").cast("string"), TEXT["repeated_key"].format(key=table.key)),
            F.col("_dups"),
        ).alias("_c"),
    ).select("_rows", "_c.*")

    empty = F.col("_rows") == 0
    return checks.unionByName(duplicates).select(
        F.lit(table.name).alias("table_name"),
        "check_name",
        F.when(empty, F.lit("SKIP")).otherwise(F.col("status")).alias("status"),
        F.when(empty, F.lit(TEXT["empty"])).otherwise(F.col("detail")).alias("detail"),
        F.when(empty, F.lit(0).cast("bigint")).otherwise(F.col("violations")).alias("violations"),
    )


def check_tables(frames: Mapping[str, DataFrame], tables: Mapping[str, SourceTable]) -> DataFrame:
    results = [check_table(df, tables[name]) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, results)


def gate_status(results: DataFrame) -> DataFrame:
    """One row: number of checks per status and whether the batch may go on."""
    by = {s: F.count_if(F.col("status") == s) for s in ("PASS", "WARNING", "FAIL", "SKIP")}
    return results.agg(*[c.alias(s.lower()) for s, c in by.items()]).withColumn(
        "gate", F.when(F.col("fail") > 0, F.lit("stop")).otherwise(F.lit("go"))
    )


def enforce(results: DataFrame) -> list[dict]:
    """Collect the results (seven rows per table) and raise if any check failed."""
    rows = [r.asDict() for r in results.collect()]
    failed = [f"{r['table_name']}.{r['check_name']}: {r['detail']}" for r in rows if r["status"] == "FAIL"]
    if failed:
        raise DataQualityError("; ".join(sorted(failed)))
    return rows


def _failures(column: str, test: str, argument: str | None) -> Column:
    c = F.col(column)
    if test == "not_null":
        return F.count_if(c.isNull())
    if test == "expression_is_true":
        return F.count_if(F.expr(f"not ({column} {argument})"))
    raise ValueError(f"unknown test {test}")


def _value_failures(df: DataFrame, column: str, test: str, argument: str | None) -> DataFrame:
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    if test == "unique":
        bad = F.col("_n") > 1
    else:
        bad = ~F.col(column).isin(*argument.split(","))
    return values.agg(F.count_if(bad).alias("failures"))


def declared_tests(
    frames: Mapping[str, DataFrame], tests: Iterable[tuple] = fv.DECLARED_TESTS
) -> DataFrame:
    """Number of failures per declared test.

    Row tests of one model share a single pass; tests on distinct values group first.
    NULL passes every test but not_null.
    """
    parts = []
    for model, df in frames.items():
        mine = [t for t in tests if t[0] == model]
        by_row = [t for t in mine if t[2] in ("not_null", "expression_is_true")]
        if by_row:
            one_pass = df.agg(*[_failures(*t[1:]).alias(f"t{i}") for i, t in enumerate(by_row)])
            cells = F.array(
                *[
                    F.struct(
                        F.lit(t[1]).alias("column_name"),
                        F.lit(" ".join(x for x in t[2:] if x)).alias("test"),
                        F.col(f"t{i}").alias("failures"),
                    )
                    for i, t in enumerate(by_row)
                ]
            )
            parts.append(
                one_pass.select(F.lit(model).alias("model"), F.explode(cells).alias("c")).select(
                    "model", "c.*"
                )
            )
        for _, column, test, argument in (t for t in mine if t not in by_row):
            parts.append(
                _value_failures(df, column, test, argument).select(
                    F.lit(model).alias("model"),
                    F.lit(column).alias("column_name"),
                    F.lit(" ".join(x for x in (test, argument) if x)).alias("test"),
                    "failures",
                )
            )
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") > 0, F.lit("fail")).otherwise(F.lit("pass"))
    )
