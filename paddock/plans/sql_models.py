"""The derived models as Spark SQL over temp views.

For users who keep their models as SQL: every statement is made from the same model
definitions (``paddock.operators.models``) as the DataFrame forms, so the two can't drift
apart.  Ordering is left to whoever reads (``models.sort_model``).  Register dimension
views from ``operators.joins.dimension(df)`` so that the measured broadcast hint
travels with the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddock.operators import models


def aggregate(spark: SparkSession, model: models.Aggregate, view: str) -> DataFrame:
    """One aggregate model over a view."""
    return spark.sql(model.sql(view))


def purchase_enriched(spark: SparkSession, purchases_view: str, lookup_views: dict[str, str]) -> DataFrame:
    """Purchases with looked-up names; ``lookup_views`` has a view for each looked-up column."""
    columns = {c: f"base.{c}" for c in models.PURCHASE_COLUMNS}
    source = f"{purchases_view} AS base"
    for at in models.PURCHASE_LOOKUPS:
        columns[at.column] = f"by_{at.column}.{at.name}"
        source += f" JOIN {lookup_views[at.column]} AS by_{at.column} ON base.{at.column} = by_{at.column}.id"
    return spark.sql("SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source}")
