"""Upsert as a relational operator with SQL MERGE semantics.

``upsert_rows(target, source, keys)`` is ``MERGE INTO target USING source ON
keys WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *``: every
target row matched by a source row takes that row's values, unmatched target
rows stay (no deletes), unmatched source rows are inserted.  It is computed as
one full outer join, so each side is read and shuffled once.  When the target
keys are unique this equals ``source UNION ALL (target ANTI JOIN source)``.

Keys match with ``=`` by default, so a NULL key never matches and a
NULL-keyed row is inserted again on every run; ``null_safe=True`` matches NULLs
with ``<=>`` instead.  Source keys must be unique (a MERGE refuses a target row
matched twice); the table sink checks that before merging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_T, _S = "_t_", "_s_"


def key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False,
                  left_prefix: str = "", right_prefix: str = "") -> Column:
    conds = []
    for k in keys:
        a, b = left[f"{left_prefix}{k}"], right[f"{right_prefix}{k}"]
        conds.append(a.eqNullSafe(b) if null_safe else (a == b))
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def upsert_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Merged rows in the target's column order.

    Both sides are shuffled once on the keys.  Keys are unique per side (the
    sides are aggregates, or the sink checks them first), so no key can pile
    up in one task.
    """
    cols = target.columns
    t = target.select(*[F.col(c).alias(_T + c) for c in cols], F.lit(True).alias("_t_hit"))
    s = source.select(*[F.col(c).alias(_S + c) for c in cols], F.lit(True).alias("_s_hit"))
    j = t.join(s, key_condition(t, s, keys, null_safe, _T, _S), "full_outer")
    # A row that came from the source takes every value from the source.
    return j.select(
        *[F.when(F.col("_s_hit"), F.col(_S + c)).otherwise(F.col(_T + c)).alias(c) for c in cols]
    )
