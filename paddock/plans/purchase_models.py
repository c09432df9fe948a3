"""The purchase models, materialised in order, then tested.

Views over the three sources, a full-refresh table joining them, two
full-refresh count tables read from that table, and the declared data tests.
Each step is an ordinary call on the sinks in this package; the dependency
order is the code order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from paddock.operators import checks, models
from paddock.operators.joins import dimension
from paddock.plans import sinks, sql_models

# --- fixed values: model names and the declared tests -----------------------------
PURCHASES_VIEW = "customer_purchases"
REGIONS_VIEW = "regions"
PRODUCTS_VIEW = "products_data"
ENRICHED_TABLE = "customer_purchase_enriched"
PRODUCT_COUNTS_TABLE = "products_purchase_count"
REGION_COUNTS_TABLE = "region_purchase_count"
DECLARED_TESTS = [
    (ENRICHED_TABLE, "unique", "id"),
    (ENRICHED_TABLE, "not_null", "id"),
    (PURCHASES_VIEW, "unique", "id"),
    (PURCHASES_VIEW, "not_null", "id"),
]


@dataclass
class PurchaseModelNames:
    """Where the models go: a name prefix (e.g. ``"analytics."`` or a unique
    tag) and an optional folder for the table data."""

    prefix: str = ""
    path_root: str | None = None

    def view(self, name: str) -> str:
        return self.prefix.replace(".", "_") + name

    def table(self, name: str) -> str:
        return self.prefix + name

    def path(self, name: str) -> str | None:
        return f"{self.path_root.rstrip('/')}/{name}" if self.path_root else None


def build_purchase_models(
    spark: SparkSession,
    customer_purchase: DataFrame,
    region: DataFrame,
    products: DataFrame,
    names: PurchaseModelNames | None = None,
) -> DataFrame:
    """Materialise the purchase models; returns the data-test verdicts."""
    n = names or PurchaseModelNames()
    customer_purchase.createOrReplaceTempView(n.view(PURCHASES_VIEW))
    dimension(region).createOrReplaceTempView(n.view(REGIONS_VIEW))
    dimension(products).createOrReplaceTempView(n.view(PRODUCTS_VIEW))

    enriched = sql_models.purchase_enriched(
        spark, n.view(PURCHASES_VIEW), {"region": n.view(REGIONS_VIEW), "product": n.view(PRODUCTS_VIEW)}
    )
    sinks.refresh(enriched, n.table(ENRICHED_TABLE), path=n.path(ENRICHED_TABLE))
    enriched_table = spark.table(n.table(ENRICHED_TABLE))
    sinks.refresh(models.products_purchase_count(enriched_table), n.table(PRODUCT_COUNTS_TABLE),
                  path=n.path(PRODUCT_COUNTS_TABLE))
    sinks.refresh(models.region_purchase_count(enriched_table), n.table(REGION_COUNTS_TABLE),
                  path=n.path(REGION_COUNTS_TABLE))
    return checks.run_tests(
        {ENRICHED_TABLE: enriched_table, PURCHASES_VIEW: spark.table(n.view(PURCHASES_VIEW))},
        DECLARED_TESTS,
    )
