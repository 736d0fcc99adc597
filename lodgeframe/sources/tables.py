"""Raw Parquet tables of a data directory.

Reads are lazy: Catalyst prunes columns and pushes filters into the scan
of whatever a query finally selects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the raw tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def register(self) -> None:
        """Register every raw table as a temp view of the same name."""
        for name in TABLES:
            getattr(self, name).createOrReplaceTempView(name)
