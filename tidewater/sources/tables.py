"""Read-only access to the warehouse tables (one Parquet dataset per table).

Always select explicit columns: the projection reaches the Parquet reader
(``ReadSchema``), and filters applied afterwards are pushed down.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


class Tables:
    """Attribute access to the driver tables: ``t.lineitem`` -> DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)

    def view(self, *names: str) -> None:
        """Register temp views so SQL-form plans can name the tables."""
        for n in names or TABLES:
            getattr(self, n).createOrReplaceTempView(n)
