"""Relational tables over JDBC as DataFrames.

The jobs take DataFrames, so a database table is one more source.  Reads are split into
parallel range queries on a numeric column (``partition_column`` with bounds) or into
explicit ``predicates`` (one task each); filters and projections that Spark can express in
SQL are pushed to the database.  Credentials come from the caller's ``properties``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               predicates: list[str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)

