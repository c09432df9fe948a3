"""Catalog tables and relational (JDBC) sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, by one-, two- or three-part name."""
    return spark.table(name)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a relational table, split into range partitions on a numeric key.

    Without a partition column the whole table comes through one connection
    (one task); give ``partition_column`` and bounds for parallel reads.  The
    bounds only shape the ranges, they do not filter rows.  Credentials come
    from ``properties`` supplied by the caller, never from code.
    """
    props = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=props,
    )
