"""Top-1 per key ("latest version wins") and deterministic dedup.

Batch form: ``row_number() == 1`` over a window. Catalyst turns the filter on
the rank into a ``WindowGroupLimit`` that keeps one row per key inside every
map task *before* the shuffle, so a key holding a third of all rows reaches
the final window as at most one row per upstream task.

Streaming form (``latest_by_agg``): ``max_by(struct(row), struct(order))`` in
a ``groupBy``; row_number windows are not allowed on streams. NULL fields
compare lowest inside a struct, which equals "desc nulls last" ordering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def latest_by(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (a total order gives a deterministic survivor)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def total_order(columns: Sequence[str]) -> list[Column]:
    """Ascending, NULLs last, over every given column: a total order on rows in which a measured value comes
    before a missing one."""
    return [F.col(c).asc_nulls_last() for c in columns]


def dedup_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; the survivor is the smallest row by the remaining columns, NULLs last.

    Without keys the whole row is the key, which is plain ``distinct``.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df.distinct()
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    return latest_by(df, keys, total_order(rest))


def latest_by_agg(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Aggregate form of ``latest_by`` for streams (largest ``order`` wins, NULLs lowest)."""
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in payload])
