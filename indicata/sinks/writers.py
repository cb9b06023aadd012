"""Sinks: partitioned Parquet, catalogued tables, quality outputs, profiles.

Rebuilds stage, then swap: the new data is written in full beside the old
(and its write may fail), then takes its place, then the old data goes. A
failed write leaves the old output as it was. Catalogued tables are swapped by
their location, so readers by name are never without them. Replacing single
partitions uses Spark's dynamic partition overwrite, which stages by itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from indicata.sinks.versions import VERSION, children, new_version, remove, under

# Partition columns of the pipeline outputs.
SILVER_PARTITIONS = ("ano",)
PANEL_PARTITIONS = ("ano_meta",)
EVENT_PARTITIONS = ("ano_ingestao", "mes_ingestao", "dia_ingestao")
HYBRID_PARTITIONS = ("ano_referencia", "nivel")
RUN = "execucao"
TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def _cluster_by(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Group rows of one output partition so each task writes few files.

    ``rebalance`` (not ``repartition``) clusters by the partition columns but
    lets AQE split an oversized cluster into advisory-size pieces: with a few
    distinct years, a plain hash repartition would send each year's whole data
    through one writer task."""
    return df.hint("rebalance", *partitions) if partitions else df


def _swap(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, then rename it into place (Hadoop file system of the path)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex[:12]
    fresh, old = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.{kind}-{mark}")
                  for kind in ("new", "old"))
    try:
        write(fresh.toString())
    except BaseException:
        fs.delete(fresh, True)
        raise
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{path} could not be set aside; the new data is in {fresh.toString()}")
    if not fs.rename(fresh, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{path} could not be replaced; the new data is in {fresh.toString()}")
    if had:
        fs.delete(old, True)


def write_parquet(df: DataFrame, path: str, partitions: Sequence[str] | None = None,
                  overwrite: str = "partitions") -> None:
    """Parquet/Snappy. ``overwrite="partitions"`` replaces only the partitions
    present in ``df`` (years absent from this run survive); ``"table"``
    replaces everything."""
    parts = list(partitions) if partitions is not None else [c for c in ("ano",) if c in df.columns]
    writer = _cluster_by(df, parts).write.mode("overwrite").format("parquet").option("compression", "snappy")
    if parts:
        writer = writer.partitionBy(*parts)
    if overwrite == "partitions" and parts:
        writer.option("partitionOverwriteMode", "dynamic").save(path)
    else:
        _swap(df.sparkSession, path, writer.option("partitionOverwriteMode", "static").save)


def _quoted(table: str) -> str:
    return ".".join(f"`{p}`" for p in table.split("."))


def _ordered(schema: StructType, partitions: Sequence[str]) -> list[StructField]:
    return sorted(schema.fields, key=lambda f: f.name in partitions)  # partition columns come last


def register_table(spark: SparkSession, table: str, path: str, schema: StructType, partitions: Sequence[str] = ()) -> None:
    """Make the catalog's ``table`` show the Parquet data at ``path``.

    A table that is there with the same columns only gets its location changed: one catalog operation, before which readers
    see the old data and after which the new. A table whose columns have changed is dropped and created again, the only
    case with a moment without it. Partitions are found in the folders, not listed in the catalog, where they would keep the old location.
    """
    location = path.replace("'", "\\'")
    wanted = [(f.name, f.dataType.simpleString(), f.name in partitions) for f in _ordered(schema, partitions)]
    if spark.catalog.tableExists(table):
        if [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(table)] == wanted:
            spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {_quoted(table)}")  # external: its data stays
    listed = ", ".join(f"`{name}` {kind}" for name, kind, _ in wanted)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    tracked = spark.conf.get(TRACKED)
    spark.conf.set(TRACKED, "false")
    try:
        spark.sql(f"CREATE TABLE {_quoted(table)} ({listed}) USING parquet{by} LOCATION '{location}'")
    finally:
        spark.conf.set(TRACKED, tracked)


def write_table(df: DataFrame, table: str, path: str, partitions: Sequence[str] = (),
                timestamp_col: str | None = "processado_em_utc", keep: int = 1) -> str:
    """Rebuild a catalogued table: add the processing time, write all data into a new folder below ``path``, point the
    table to it, and remove the folders of earlier rebuilds but for the last ``keep`` (of readers that began before).
    Returns the folder. A reader by name sees the old table or the new one at every moment; a failed write leaves the old."""
    spark = df.sparkSession
    out = df.withColumn(timestamp_col, F.current_timestamp()) if timestamp_col else df
    fresh = under(path, f"{VERSION}={new_version()}")
    writer = _cluster_by(out, partitions).write.mode("overwrite").format("parquet").option("compression", "snappy") \
        .option("partitionOverwriteMode", "static")
    try:
        (writer.partitionBy(*partitions) if partitions else writer).save(fresh)
    except BaseException:
        remove(spark, fresh)
        raise
    register_table(spark, table, fresh, out.schema, partitions)
    earlier = [n for n in children(spark, path) if n.startswith(f"{VERSION}=")][:-1]
    for name in earlier[:len(earlier) - keep]:
        remove(spark, under(path, name))
    return fresh


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def write_rejected(rejected: DataFrame, path: str) -> None:
    """Replace the rejected-records output; without records there is none."""
    if rejected.isEmpty():
        remove(rejected.sparkSession, path)
    else:
        _swap(rejected.sparkSession, path, rejected.write.mode("overwrite").json)


def append_metrics(metrics: DataFrame, path: str, run: str) -> None:
    """The run-metrics row of ``run`` (a single small file), beside those of other runs. A run that is tried again replaces
    its own row: runs are partitions, and only the one written is overwritten."""
    (metrics.withColumn("processado_em_utc", F.current_timestamp()).withColumn(RUN, F.lit(run)).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(RUN).json(path))


def write_unless_exists(df: DataFrame, path: str, overwrite: bool = False, fmt: str = "parquet") -> None:
    """Idempotent ingest: keep an existing target unless overwrite is asked."""
    if overwrite:
        _swap(df.sparkSession, path, df.write.mode("overwrite").format(fmt).save)
    else:
        df.write.mode("ignore").format(fmt).save(path)


PROFILE = ("tabela", "status", "erro", "linhas", "colunas", "nomes_colunas", "anos")


def profile_of(name: str, df: DataFrame, status: str = "ok", year_col: str = "ano") -> DataFrame:
    """One manifest row: row count, column count, column names and the sorted distinct whole years. Years that are
    no number are not listed, so the list is bounded by the calendar."""
    years = F.lit("")
    if year_col in df.columns:
        year = F.col(year_col).cast("string").try_cast("double").try_cast("int")
        years = F.array_join(F.array_sort(F.collect_set(F.when(year.between(0, 9999), year.cast("string")))), ",")
    return df.agg(F.count(F.lit(1)).alias("linhas"), years.alias("anos")).select(
        F.lit(name).alias("tabela"), F.lit(status).alias("status"), F.lit(None).cast("string").alias("erro"), "linhas",
        F.lit(len(df.columns)).alias("colunas"), F.lit(",".join(df.columns)).alias("nomes_colunas"), "anos")


def failed_profile(spark: SparkSession, name: str, error: str) -> DataFrame:
    """The manifest row of a table that could not be ingested."""
    return spark.range(1).select(
        F.lit(name).alias("tabela"), F.lit("erro").alias("status"), F.lit(error).alias("erro"),
        F.lit(None).cast("long").alias("linhas"), F.lit(None).cast("int").alias("colunas"),
        F.lit(None).cast("string").alias("nomes_colunas"), F.lit(None).cast("string").alias("anos"))


def table_profile(tables: Mapping[str, DataFrame], year_col: str = "ano") -> DataFrame:
    """Ingest manifest as a DataFrame, one aggregate per table, unioned."""
    return reduce(lambda a, b: a.unionByName(b), [profile_of(n, df, year_col=year_col) for n, df in tables.items()])
