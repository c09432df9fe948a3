"""Data tests as DataFrame operators.

Each test returns its *failing rows*; an empty result means the test passes.
``summarize`` folds a failing-rows frame into a one-row verdict without
collecting the failures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TESTS = {"unique": lambda df, column: unique(df, column), "not_null": lambda df, column: not_null(df, column)}


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once (NULLs are ignored).

    Output: (unique_field, n_records).  Counting is partial per scan task, so
    a value held by a third of all rows still ships one row per task.
    """
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def summarize(failures: DataFrame, test_name: str) -> DataFrame:
    """One row: (test_name, failures, status)."""
    return failures.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(test_name).alias("test_name"),
        F.col("failures"),
        F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def duplicate_keys(df: DataFrame, keys: list[str], include_nulls: bool = False) -> DataFrame:
    """Key combinations that occur more than once.

    Rows with a NULL key are ignored unless ``include_nulls`` (for null-safe
    matching, where NULL keys do match each other).
    """
    present = F.lit(True)
    if not include_nulls:
        for k in keys:
            present = present & F.col(k).isNotNull()
    return (
        df.where(present)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def fused(df: DataFrame, tests: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Verdicts of all ``(test name, test, column)`` of one model, in one pass over it.

    ``unique`` tests need their column's values counted.  One column is grouped by as it is, several by
    grouping sets: each row is handed on once per column and counted under that column's value
    alone, partially in every task.  ``not_null`` tests are counts that ride along: in the groups
    of the first set, which hold every row once, or with no ``unique`` test in a plain aggregate
    without any shuffle of rows.
    """
    unknown = [t for _, t, _ in tests if t not in TESTS]
    if unknown:
        raise ValueError(f"no such data tests: {unknown}")
    wanted = [list(dict.fromkeys(c for _, t, c in tests if t == kind)) for kind in ("unique", "not_null")]
    keys, required = ([c for c in columns] for columns in wanted)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(required)]
    if keys:
        grouped = df.groupingSets([[F.col(c)] for c in keys], *keys) if len(keys) > 1 else df.groupBy(*keys)
        sets = [F.grouping(c).alias(f"set_{i}") for i, c in enumerate(keys)] if len(keys) > 1 else []
        counted = grouped.agg(F.count(F.lit(1)).alias("n"), *sets, *nulls)
        counted = counted.toDF(*[f"key_{i}" for i in range(len(keys))], *counted.columns[len(keys):])
        of = [F.col(f"set_{i}") == 0 if sets else F.lit(True) for i in range(len(keys))]
        found = [F.count_if(of[i] & F.col(f"key_{i}").isNotNull() & (F.col("n") > 1)) for i in range(len(keys))]
        found += [F.coalesce(F.sum(F.when(of[0], F.col(f"nulls_{i}"))), F.lit(0)) for i in range(len(required))]
    else:
        counted, found = df, nulls
    at = {("unique", c): i for i, c in enumerate(keys)} | {("not_null", c): len(keys) + i for i, c in enumerate(required)}
    row = counted.agg(*[f.alias(f"failures_{i}") for i, f in enumerate(found)])
    verdict = [F.struct(F.lit(name).alias("test_name"), F.col(f"failures_{at[test, c]}").alias("failures")) for name, test, c in tests]
    return row.select(F.inline(F.array(*verdict))).withColumn(
        "status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail"))
    )


def run_tests(models: Mapping[str, DataFrame], declared: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Evaluate declared data tests: one verdict row per ``(model, test, column)``.

    All tests of a model are planned together (``fused``), so that each model is read once.
    Test names follow ``<test>_<model>_<column>``.
    """
    by_model: dict[str, list] = {}
    for model, test, column in declared:
        by_model.setdefault(model, []).append((f"{test}_{model}_{column}", test, column))
    return reduce(DataFrame.unionByName, [fused(models[model], tests) for model, tests in by_model.items()])
