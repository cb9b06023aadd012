"""Scans: parquet tables by name, catalog tables, bronze CSV/JSON, SQL sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; column pruning and filter pushdown reach the reader."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan by name (partition pruning via the metastore)."""
    return spark.table(name)


def read_sql(spark: SparkSession, query: str) -> DataFrame:
    """SQL-query source over registered tables/views."""
    return spark.sql(query)


def read_bronze_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Header CSV (UTF-8, BOM tolerated). With no schema every column is a string,
    as in a raw landing zone; typing happens in the cleaning step."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", False)
    return reader.csv(path)


def read_bronze_events(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All landed JSON event documents under ``path`` (recursive), explicit schema,
    malformed lines kept in ``_corrupt_record``."""
    from indicata.operators.events import CORRUPT, ENVELOPE_SCHEMA

    return (spark.read.schema(schema or ENVELOPE_SCHEMA)
            .option("recursiveFileLookup", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path))


def limit_rows(df: DataFrame, n: int | None) -> DataFrame:
    """Optional row cap of an ingest (N > 0), as the ingest tool's flag."""
    if n is None:
        return df
    if n <= 0:
        raise ValueError("row limit must be positive")
    return df.limit(n)
