"""Tables whose partitions are replaced version by version.

A version writes the partitions it replaces into a folder of its own and last a row per partition into the index.
Readers take each partition's newest version that the index names, so they see whole versions only, also while one is
being written or after a writer has died. A version that is written again (a replayed batch) replaces itself and is
computed from older versions only.

The index has one row per partition and version: partition columns are years or id buckets, so what the driver reads of it
is bounded by their number, not by the data.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

VERSION = "versao"


def under(base: str, *names: str) -> str:
    return "/".join([base.rstrip("/"), *names])


def new_version() -> str:
    """Later versions sort after earlier ones."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path of any store Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = hadoop_path(spark, path)
    return fs.exists(at)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, or no rows if nothing was ever written there. Any other failure surfaces."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, at = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, at = hadoop_path(spark, path)
    fs.delete(at, True)


class VersionedTable:
    """A table at ``base`` in partitions of one column ``by`` of ``schema``."""

    def __init__(self, spark: SparkSession, base: str, schema: StructType, by: str):
        self.spark, self.base, self.by = spark, base, by
        self.schema = StructType([*(f for f in schema if f.name != by), schema[by]])
        self.index_schema = StructType([schema[by], StructField("cheia", BooleanType()), StructField(VERSION, StringType())])

    def index(self, before: str | None = None) -> DataFrame:
        rows = read_or_empty(self.spark, under(self.base, "index"), self.index_schema)
        return rows if before is None else rows.filter(F.col(VERSION) < before)

    def newest(self, before: str | None = None) -> DataFrame:
        """(partition, its version in force, whether it has rows), or what was in force before a version."""
        return self.index(before).groupBy(self.by).agg(F.max(VERSION).alias(VERSION), F.max_by("cheia", VERSION).alias("cheia"))

    def read(self, keys: Sequence | None = None, before: str | None = None) -> DataFrame:
        """The rows in force, of all partitions or of those with ``keys``; only their folders are listed."""
        wanted = self.newest(before).filter("cheia")
        if keys is not None:
            wanted = wanted.filter(F.col(self.by).isin(list(keys)))
        paths = [under(self.base, "data", f"{VERSION}={r[VERSION]}", f"{self.by}={r[self.by]}") for r in wanted.collect()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        stored = StructType([*self.schema.fields, StructField(VERSION, StringType())])
        return (self.spark.read.schema(stored).option("basePath", under(self.base, "data")).parquet(*paths)
                .select(*self.schema.names))

    def replace(self, rows: DataFrame, at: str, keys: Sequence) -> None:
        """From version ``at`` on, the partitions ``keys`` hold ``rows`` (none of another partition), or nothing."""
        data = under(self.base, "data", f"{VERSION}={at}")
        (rows.select(*self.schema.names).hint("rebalance", self.by).write.mode("overwrite").partitionBy(self.by).parquet(data))
        filled = {r[0] for r in self.spark.read.schema(self.schema).parquet(data).select(self.by).distinct().collect()}
        named = self.spark.createDataFrame([(k, k in filled) for k in keys], StructType(self.index_schema.fields[:2]))
        # from here on readers see the version
        named.coalesce(1).write.mode("overwrite").parquet(under(self.base, "index", f"{VERSION}={at}"))

    def expire(self, before: str | None = None) -> list[str]:
        """Remove the folders of versions (older than ``before``) of which no partition is in force, and fold their index
        rows away; returns what was removed. Run it when no reader still uses them."""
        used = {r[VERSION] for r in self.newest().select(VERSION).distinct().collect()} | \
            {r[VERSION] for r in self.newest(before).select(VERSION).distinct().collect()}
        gone = []
        for kind in ("index", "data"):
            for name in children(self.spark, under(self.base, kind)):
                at = name.partition("=")[2]
                if name.startswith(f"{VERSION}=") and at not in used and (before is None or at < before):
                    remove(self.spark, under(self.base, kind, name))
                    gone.append(under(kind, name))
        return gone
