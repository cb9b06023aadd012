"""Incremental batch runs: every run reads the files that are new since the last one.

Each bronze table has a checkpoint of a file stream that is run with ``availableNow`` and ends. A batch of new files is cleaned,
merged with the survivors of the years it touches and published into those years of the silver table (K1). The merge keeps,
per key, the row that a full run would keep: survivors are stored as they were before the range rule, because that rule runs
after the choice. A replayed batch merges the same rows again, which changes nothing.

Tables derived from others (integration, gold) are brought up to date by year: a derived table keeps the versions of its
sources' years that it has seen, rebuilds the years that have newer ones, and only then marks them as seen; a run that
dies in between does them again. ``painel_metas`` takes a reference year to several target years, so it is rebuilt whole when
any of its sources has changed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from indicata import specs
from indicata.operators import clean, gold
from indicata.operators.integrate import integrate
from indicata.sinks import writers as W
from indicata.sinks.versions import VERSION, VersionedTable, children, new_version, read_or_empty, remove, under

YEAR = "ano"
STATE = "_estado"


@dataclass
class TableRun:
    """What one run of a table read and touched."""

    table: str
    batches: int = 0
    rows: int = 0
    years: tuple[int, ...] = ()


def typed_rows(bronze: DataFrame, spec: specs.CleanSpec) -> DataFrame:
    """The cleaning before the choice of survivors."""
    return (bronze.transform(clean.clean_strings).transform(lambda d: clean.fix_types(d, spec))
            .transform(lambda d: clean.require_columns(d, spec.required)))


def survivors_table(spark: SparkSession, silver_base: str, name: str, schema: StructType) -> VersionedTable:
    return VersionedTable(spark, under(silver_base, STATE, name), schema, YEAR)


def merge_batch(bronze: DataFrame, spec: specs.CleanSpec, silver_base: str, at: str) -> tuple[int, list[int]]:
    """Merge new bronze rows into the silver table as version ``at``: (rows read, touched years)."""
    spark, seen = bronze.sparkSession, Observation()
    rows = typed_rows(bronze.observe(seen, F.count(F.lit(1)).alias("n")), spec).persist()
    try:
        years = sorted(r[YEAR] for r in rows.select(YEAR).distinct().collect())
        if not years:
            return seen.get.get("n", 0), []
        table = survivors_table(spark, silver_base, spec.name, rows.schema)
        merged = table.read(years, before=at).unionByName(rows.select(*table.schema.names))
        table.replace(clean.dedup_by_keys(merged, spec.keys), at, years)
        final = clean.null_out_of_range(table.read(years), spec)
        W.write_parquet(clean.add_audit(final, spec.name) if spec.audit else final, under(silver_base, spec.name), [YEAR],
                        overwrite="partitions")
        return seen.get["n"], years
    finally:
        rows.unpersist()


def _stored_schema(spark: SparkSession, path: str, at: str, fmt: str, options: Mapping[str, str]) -> StructType:
    """The schema of the table's first run, kept beside its checkpoint: a stream needs one, and it must not change."""
    kept = read_or_empty(spark, at, StructType([StructField("json", StringType())])).first()
    if kept is not None:
        return StructType.fromJson(json.loads(kept["json"]))
    schema = spark.read.format(fmt).options(**options).load(path).schema
    spark.createDataFrame([(schema.json(),)], "json string").coalesce(1).write.mode("overwrite").parquet(at)
    return schema


def ingest_new_files(spark: SparkSession, path: str, spec: specs.CleanSpec, silver_base: str, fmt: str = "csv",
                     options: Mapping[str, str] | None = None, files_per_batch: int = 10_000) -> TableRun:
    """Read the files below ``path`` that no earlier run has read, and merge them."""
    options = {"header": "true", "encoding": "UTF-8", **(options or {})} if fmt == "csv" else dict(options or {})
    marks = under(silver_base, STATE, f"{spec.name}.checkpoint")
    schema = _stored_schema(spark, path, under(silver_base, STATE, f"{spec.name}.schema"), fmt, options)
    run = TableRun(spec.name)
    years: set[int] = set()

    def merge(batch: DataFrame, batch_id: int) -> None:
        n, touched = merge_batch(batch, spec, silver_base, f"{batch_id:012d}")
        run.batches, run.rows = run.batches + 1, run.rows + n
        years.update(touched)

    stream = (spark.readStream.schema(schema).format(fmt).options(**options).option("maxFilesPerTrigger", files_per_batch)
              .load(path))
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", marks).trigger(availableNow=True).start().awaitTermination()
    run.years = tuple(sorted(years))
    return run


# ---------------------------------------------------------------- derived tables

@dataclass(frozen=True)
class Derived:
    """A table computed from silver tables. ``build(read)`` gets a reader of source rows by name; a table that isn't
    ``by_year`` is rebuilt whole when any source has changed."""

    name: str
    sources: tuple[str, ...]
    build: Callable[[Callable[[str], DataFrame]], DataFrame]
    partitions: tuple[str, ...] = (YEAR,)
    by_year: bool = True


SEEN = StructType([StructField("fonte", StringType()), StructField(YEAR, IntegerType()), StructField(VERSION, StringType())])


def source_versions(spark: SparkSession, silver_base: str, sources: Sequence[str]) -> DataFrame:
    """(source, year, version in force) of the sources that have been ingested."""
    out = spark.createDataFrame([], SEEN)
    for name in sources:
        table = VersionedTable(spark, under(silver_base, STATE, name), StructType([SEEN[YEAR]]), YEAR)
        out = out.unionByName(table.newest().select(F.lit(name).alias("fonte"), YEAR, VERSION))
    return out


def refresh(spark: SparkSession, silver_base: str, out_base: str, derived: Derived, stamp: str = "processado_em_utc") -> tuple[int, ...]:
    """Bring one derived table up to date; returns the years it rebuilt."""
    marks = under(out_base, STATE, f"{derived.name}.vistos")
    now = source_versions(spark, silver_base, derived.sources).collect()  # a row per source and year
    if {r["fonte"] for r in now} != set(derived.sources):
        return ()  # a source has never been ingested
    folders = children(spark, marks)
    seen = set(map(tuple, spark.read.schema(SEEN).parquet(under(marks, folders[-1])).collect())) if folders else set()
    changed = sorted({r[YEAR] for r in now if tuple(r) not in seen})
    if not changed:
        return ()

    def read(name: str) -> DataFrame:
        rows = spark.read.parquet(under(silver_base, name))
        return rows.filter(F.col(YEAR).isin(changed)) if derived.by_year else rows
    W.write_parquet(derived.build(read).withColumn(stamp, F.current_timestamp()), under(out_base, derived.name), derived.partitions,
                    overwrite="partitions" if derived.by_year else "table")
    spark.createDataFrame(now, SEEN).coalesce(1).write.mode("overwrite").parquet(under(marks, f"v-{new_version()}"))
    for old in folders:
        remove(spark, under(marks, old))
    return tuple(changed)


def integrations(state: specs.PlaceSpec = specs.STATE, city: specs.PlaceSpec = specs.CITY,
                 targets: specs.TargetSpec = specs.TARGETS, strategy: str = "full_outer") -> tuple[Derived, ...]:
    def of(name: str, results: str, wanted: str, place: specs.PlaceSpec) -> Derived:
        return Derived(name, (results, wanted), lambda read: integrate(read(results), read(wanted), place, targets, strategy))
    return (of("integrado_uf", "resultado_uf", "meta_uf", state), of("integrado_municipio", "resultado_municipio", "meta_municipio", city))


def gold_tables(state: specs.PlaceSpec = specs.STATE, city: specs.PlaceSpec = specs.CITY,
                targets: specs.TargetSpec = specs.TARGETS) -> tuple[Derived, ...]:
    """The gold tables by the ingested tables they depend on (comparisons read the integrated table of their level)."""
    return (
        Derived("indicadores_uf", ("resultado_uf",), lambda read: gold.indicators(read("resultado_uf"), state)),
        Derived("indicadores_municipio", ("resultado_municipio",), lambda read: gold.indicators(read("resultado_municipio"), city)),
        Derived("painel_metas", ("meta_brasil", "meta_uf", "meta_municipio"),
                lambda read: gold.targets_panel(read("meta_brasil"), read("meta_uf"), read("meta_municipio"), targets),
                W.PANEL_PARTITIONS, by_year=False),
        Derived("resumo_alunos_municipio", ("alunos",), lambda read: gold.student_summary(read("alunos"))),
        Derived("comparativo_uf", ("resultado_uf", "meta_uf"), lambda read: gold.compare(read("integrado_uf"), state, targets)),
        Derived("comparativo_municipio", ("resultado_municipio", "meta_municipio"),
                lambda read: gold.compare(read("integrado_municipio"), city, targets)),
    )


def incremental_run(spark: SparkSession, bronze: Mapping[str, str], silver_base: str, gold_base: str | None = None,
                    fmt: str = "csv", options: Mapping[str, str] | None = None,
                    clean_specs: Mapping[str, specs.CleanSpec] = specs.CLEAN_SPECS, state: specs.PlaceSpec = specs.STATE,
                    city: specs.PlaceSpec = specs.CITY, targets: specs.TargetSpec = specs.TARGETS,
                    files_per_batch: int = 10_000) -> DataFrame:
    """One run over the bronze folders (table name -> path): new files into silver, then what depends on the years they
    touch. Returns a row per table: what was read and which years were rebuilt."""
    out = []
    for name, path in bronze.items():
        run = ingest_new_files(spark, path, clean_specs[name], silver_base, fmt, options, files_per_batch)
        out.append((name, run.batches, run.rows, ",".join(map(str, run.years))))
    for derived in integrations(state, city, targets):
        out.append((derived.name, None, None, ",".join(map(str, refresh(spark, silver_base, silver_base, derived)))))
    for derived in gold_tables(state, city, targets) if gold_base else ():
        years = refresh(spark, silver_base, gold_base, derived, "processado_gold_em_utc")
        out.append((derived.name, None, None, ",".join(map(str, years))))
    return spark.createDataFrame(out, "tabela string, lotes long, linhas_lidas long, anos string")
