"""Purchase star queries and the data tests on it."""

from __future__ import annotations

import uuid

from paddock.operators import checks, models
from paddock.plans.purchase_models import (
    DECLARED_TESTS,
    ENRICHED_TABLE,
    PURCHASES_VIEW,
    REGION_COUNTS_TABLE,
    PurchaseModelNames,
    build_purchase_models,
)
from paddock.plans.queries.base import enriched_purchases, register, scratch_table
from paddock.plans.queries.oracle import SQL_CP, SQL_PE, check_sql
from paddock.plans.standins import StandIns


# --- purchase star -------------------------------------------------------------------------------

@register("view_passthrough", f"WITH {SQL_CP} SELECT * FROM cp")
def q_view_passthrough(spark, sf_dir):
    view = f"customer_purchases_{uuid.uuid4().hex[:8]}"
    StandIns(spark, sf_dir).purchases().createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {view}")


@register("purchase_enriched", f"WITH {SQL_PE} SELECT * FROM pe")
def q_purchase_enriched(spark, sf_dir):
    return enriched_purchases(spark, sf_dir)


@register(
    "products_purchase_count",
    f"WITH {SQL_PE} SELECT product, COUNT(*) AS orders FROM pe GROUP BY product",
)
def q_products_purchase_count(spark, sf_dir):
    return models.products_purchase_count(enriched_purchases(spark, sf_dir))


@register(
    "region_purchase_count",
    f"WITH {SQL_PE} SELECT region, COUNT(*) AS orders FROM pe GROUP BY region",
)
def q_region_purchase_count(spark, sf_dir):
    return models.region_purchase_count(enriched_purchases(spark, sf_dir))


# --- data tests --------------------------------------------------------------------------------------

@register(
    "check_unique",
    f"WITH {SQL_PE} "
    + check_sql(
        "unique_customer_purchase_enriched_id",
        "SELECT id FROM pe WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1",
    ),
)
def q_check_unique(spark, sf_dir):
    return checks.summarize(
        checks.unique(enriched_purchases(spark, sf_dir), "id"),
        "unique_customer_purchase_enriched_id",
    )


@register(
    "check_unique_failures",
    f"WITH {SQL_PE} SELECT id AS unique_field, COUNT(*) AS n_records FROM pe "
    "WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1",
)
def q_check_unique_failures(spark, sf_dir):
    return checks.unique(enriched_purchases(spark, sf_dir), "id")


@register(
    "check_unique_orders",
    check_sql(
        "unique_orders_o_orderkey",
        "SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL "
        "GROUP BY o_orderkey HAVING COUNT(*) > 1",
    ),
)
def q_check_unique_orders(spark, sf_dir):
    return checks.summarize(
        checks.unique(StandIns(spark, sf_dir).t("orders"), "o_orderkey"),
        "unique_orders_o_orderkey",
    )


@register(
    "check_not_null",
    f"WITH {SQL_CP} "
    + check_sql("not_null_customer_purchases_id", "SELECT * FROM cp WHERE id IS NULL"),
)
def q_check_not_null(spark, sf_dir):
    return checks.summarize(
        checks.not_null(StandIns(spark, sf_dir).purchases(), "id"),
        "not_null_customer_purchases_id",
    )


# The declared tests (unique and not_null on id, for the enriched purchases
# model and the purchases view) live with the model chain.


# DuckDB: the oracle's CTE holding each model, and each test's failing rows.
_MODEL_CTE = {ENRICHED_TABLE: "pe", PURCHASES_VIEW: "cp"}
_FAILING_SQL = {
    "unique": "SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1",
    "not_null": "SELECT {col} FROM {src} WHERE {col} IS NULL",
}


def _data_tests_sql() -> str:
    verdicts = [
        "(" + check_sql(f"{test}_{model}_{col}",
                        _FAILING_SQL[test].format(col=col, src=_MODEL_CTE[model])) + ")"
        for model, test, col in DECLARED_TESTS
    ]
    return f"WITH {SQL_PE} " + " UNION ALL ".join(verdicts)


@register("data_tests", _data_tests_sql())
def q_data_tests(spark, sf_dir):
    s = StandIns(spark, sf_dir)
    models_by_name = {ENRICHED_TABLE: enriched_purchases(spark, sf_dir), PURCHASES_VIEW: s.purchases()}
    return checks.run_tests(models_by_name, DECLARED_TESTS)


# Several columns of a model, tests that fail among them.
_TABLE_TESTS = [
    ("orders", "unique", "o_orderkey"), ("orders", "not_null", "o_orderkey"), ("orders", "unique", "o_custkey"),
    ("orders", "unique", "o_orderdate"), ("orders", "not_null", "o_orderpriority"), ("documents", "not_null", "lang"), ("documents", "not_null", "text"),
]


@register(
    "data_tests_by_column",
    " UNION ALL ".join(
        "(" + check_sql(f"{test}_{model}_{col}", _FAILING_SQL[test].format(col=col, src=model)) + ")" for model, test, col in _TABLE_TESTS
    ),
)
def q_data_tests_by_column(spark, sf_dir):
    s = StandIns(spark, sf_dir)
    return checks.run_tests({model: s.t(model) for model, _, _ in _TABLE_TESTS}, _TABLE_TESTS)


def _build(spark, sf_dir):
    s = StandIns(spark, sf_dir)
    tag, root = scratch_table(spark, "purchase_models")
    names = PurchaseModelNames(prefix=f"{tag}_", path_root=root)
    verdicts = build_purchase_models(spark, s.purchases(), s.regions(), s.products(), names)
    return names, verdicts


@register(
    "purchase_models_build",
    f"WITH {SQL_PE} SELECT region, COUNT(*) AS orders FROM pe GROUP BY region",
)
def q_purchase_models_build(spark, sf_dir):
    """Run the model chain; the region-count table it materialised, read back."""
    names, _ = _build(spark, sf_dir)
    return spark.table(names.table(REGION_COUNTS_TABLE))


@register("purchase_models_tests", _data_tests_sql())
def q_purchase_models_tests(spark, sf_dir):
    """The same chain; its data-test verdicts over the materialised models."""
    _, verdicts = _build(spark, sf_dir)
    return verdicts
