"""Dense rank of a value inside groups (descending, NULLs last and tied).

Rows of one value have one rank, so only the distinct values of a group are
ranked. They are aggregated before the first shuffle: a value that a third of
all rows have is one row per task there. The ranks return to the rows in an
equi-join on group and value, in which AQE splits a hot value. The plans are
lazy and have no checkpoint.

``distinct`` (default): one window over a group's distinct values. What one
task holds is a group's values, not its rows; rates of two decimals have
10,001 at most.

``bucketed``: for groups with very many distinct values. They are cut into
buckets (rates lie in 0..100, so their whole part is the bucket), each ranked
by a window of its own, and a row per (group, bucket) gives each bucket the
number of values above it.

``window``: one ``dense_rank`` over all rows of a group, for groups known to be
small. The caller chooses; nothing is switched by size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def whole_part(value: Column) -> Column:
    """Bucket of a rate. Any function that never falls while its argument rises will do."""
    return F.floor(value).cast("long")


def _ranked(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    place = Window.partitionBy(*keys).orderBy(F.col("__v").desc_nulls_last())
    return values.withColumn("__rank", F.row_number().over(place))


def _ranked_in_buckets(values: DataFrame, keys: Sequence[str], bucket: Callable[[Column], Column]) -> DataFrame:
    v = F.col("__v")
    place = F.when(v.isNull(), F.lit(LOWEST)).when(F.isnan(v.cast("double")), F.lit(HIGHEST)).otherwise(bucket(v))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(v.desc())
    local = values.withColumn("__bucket", place).withColumn("__local", F.row_number().over(inside))
    above = Window.partitionBy(*keys).orderBy(F.col("__bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (local.groupBy(*keys, "__bucket").agg(F.max("__local").alias("__n"))
             .select(*[F.col(k).alias(f"{k}s") for k in keys], F.col("__bucket").alias("__bs"),
                     F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__above")))
    # null-safe also on buckets, which are never NULL: "=" would add a filter to one branch, and the two would share no exchange
    on = reduce(lambda a, b: a & b, [local[k].eqNullSafe(sizes[f"{k}s"]) for k in keys], local["__bucket"].eqNullSafe(sizes["__bs"]))
    return local.join(sizes, on).select(*keys, "__v", (F.col("__local") + F.col("__above")).alias("__rank"))


def _of_distinct(df: DataFrame, partition: Sequence[str], value: str, out: str,
                 rank: Callable[[DataFrame, Sequence[str]], DataFrame]) -> DataFrame:
    keys = [f"__k{i}" for i in range(len(partition))]
    values = df.select(*[F.col(p).alias(k) for p, k in zip(partition, keys, strict=True)], F.col(value).alias("__v")).distinct()
    ranks = rank(values, keys)
    same = reduce(lambda a, b: a & b, [df[p].eqNullSafe(ranks[k]) for p, k in zip(partition, keys, strict=True)],
                  df[value].eqNullSafe(ranks["__v"]))
    return df.join(ranks, same).select(*[df[c] for c in df.columns], F.col("__rank").cast("int").alias(out))


def dense_rank_within(df: DataFrame, partition: Sequence[str], value: str, out: str, method: str = "distinct",
                      bucket: Callable[[Column], Column] = whole_part) -> DataFrame:
    """Append ``out`` = dense rank of ``value`` (desc, NULLs last) within ``partition``."""
    if method == "window":
        w = Window.partitionBy(*partition).orderBy(F.col(value).desc_nulls_last())
        return df.withColumn(out, F.dense_rank().over(w))
    if method == "distinct":
        return _of_distinct(df, partition, value, out, _ranked)
    if method == "bucketed":
        return _of_distinct(df, partition, value, out, lambda values, keys: _ranked_in_buckets(values, keys, bucket))
    raise ValueError(f"unknown rank method {method!r}")
