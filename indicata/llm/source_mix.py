"""Mixing sources to target weights by weighted fair queueing.

A document's size is its number of words. The sources, in code-point order,
take the weights in turn and share ``share`` of all words; a source's target
stops at ``repeats`` times its own size and what it leaves is shared again by
weight (water-filling, in one pass over the sources sorted by size a weight).

Inside a source, documents are shuffled by a hash of their doc_id, and each of
their ``repeats`` copies finishes at virtual time (words of the source up to
and with it) / target, a further copy of a document one source size later.
All copies of all sources are ordered by finish time and taken while their
words fit the total budget. Every source reaches its target at time 1, so
each gets near its target.

Neither a source nor the order lies in one task: running sums inside a source
go by ``TICKETS`` ranges of the shuffle hash (their sums first, then a
running sum in each), and the global order by ``TIMES`` ranges of the finish
time; only the range the budget ends in is sorted through. The driver sees
one row: the last copy taken. The sources themselves (one row each) are
ranked in one task.

Defined results: null and blank texts have size 0 and are taken with 0 words;
a null source is a source of its own, the last one; documents that repeat a
doc_id are documents of their own, side by side in the shuffle; a null doc_id
is shuffled by the hash of the empty string; without any word all targets are
0. Other columns are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm.common import Steps

TICKETS = 12  # bits
TIMES = 1 << 16


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sized: DataFrame, weights: Sequence[int], share: tuple[int, int], repeats: int) -> DataFrame:
    """(source, place, source_size, target) for each source of ``sized`` (source, size)."""
    every = lcm(*weights)
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("place", place)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") - 1) % len(weights) + 1)
    per = per.withColumn("weight", weight)
    fill = Window.orderBy(F.col("source_size") * (F.lit(every) / F.col("weight")).cast("long"), "place")
    per = (per.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
           .withColumn("below", F.coalesce(F.sum("source_size").over(
               fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * repeats)
           .withColumn("rest", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
           # words left for this source and the later ones, times share[1]
           .withColumn("left", F.col("total") * share[0] - F.col("below") * share[1])
           .withColumn("stops", F.col("left") * F.col("weight") >= F.col("source_size") * repeats * share[1] * F.col("rest")))
    free = F.when(~F.col("stops"), F.struct(F.col("source_size") * (F.lit(every) / F.col("weight")).cast("long"),
                                            F.col("place"), F.col("left"), F.col("rest")))
    per = per.withColumn("free", F.min(free).over(Window.partitionBy()))
    level = (F.col("free.left") * F.col("weight")).cast("double") / (F.col("free.rest") * share[1]).cast("double")
    return per.select("source", "place", "source_size",
                      F.when(F.col("stops"), (F.col("source_size") * repeats).cast("double")).otherwise(level).alias("target"))


def weighted_mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), repeats: int = 2,
                 seed: str = "", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, tag, size, source_size, target, copies, taken (words), finish (first copy)."""
    ticket = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 15)
    steps = Steps(docs.sparkSession, "source-mix")
    sized = steps.write(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("tag"),
        word_count(F.col(text_col)).alias("size"), ticket.alias("ticket")), "sized")
    sized = sized.withColumn("drawer", F.conv(F.substring("ticket", 1, TICKETS // 4), 16, 10).cast("int"))
    targets = source_targets(sized, weights, share, repeats)

    sums = sized.groupBy("source", "drawer").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("drawer").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("drawer").alias("d"),
                       F.coalesce(F.sum("words").over(before), F.lit(0)).alias("ahead"))
    sums = sums.join(targets.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t"))).drop("t")
    within = (Window.partitionBy("source", "drawer").orderBy("ticket", F.col("doc_id").asc_nulls_last(), "tag")
              .rowsBetween(Window.unboundedPreceding, 0))
    served = sized.withColumn("read", F.sum("size").over(within))
    served = steps.write(served.join(sums, served["source"].eqNullSafe(sums["s"]) & (served["drawer"] == sums["d"]))
                    .withColumn("read", F.col("read") + F.col("ahead")).drop("s", "d", "ahead", "drawer"), "served")

    def finish(copy):
        return F.when(F.col("target") > 0, (copy * F.col("source_size") + F.col("read")).cast("double") / F.col("target")
                      ).otherwise(F.lit(0.0))

    copies = served.withColumn("copy", F.explode(F.array(*[F.lit(c) for c in range(repeats)])))
    copies = copies.withColumn("finish", finish(F.col("copy"))).withColumn("range", F.floor(F.col("finish") * TIMES))
    order = ["finish", "place", "ticket", "doc_id", "tag"]
    by_range = copies.groupBy("range").agg(F.sum("size").alias("words"))
    budget = sized.agg((F.coalesce(F.sum("size"), F.lit(0)) * share[0]).alias("budget"))
    upto = by_range.withColumn("ahead", F.sum("words").over(Window.orderBy("range")) - F.col("words"))
    last = (upto.crossJoin(F.broadcast(budget)).filter((F.col("ahead") + F.col("words")) * share[1] > F.col("budget"))
            .agg(F.min(F.struct("range", "ahead", "budget")).alias("at")).select("at.*"))  # the one range the budget ends in
    inside = copies.join(F.broadcast(last), "range")
    running = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    final = (inside.withColumn("used", F.sum("size").over(running) + F.col("ahead"))
             .groupBy("range").agg(F.max(F.when(F.col("used") * share[1] <= F.col("budget"), F.struct(*order))).alias("stop"))
             .first())
    if final is None:  # the budget holds every copy
        taken = F.lit(repeats)
    else:
        taken = F.lit(0)
        for c in range(repeats):
            time = finish(F.lit(c))
            at = F.floor(time * TIMES)
            keep = at < final["range"]
            if final["stop"] is not None:
                stop = final["stop"]
                bound = F.struct(*[F.lit(stop[k]).cast(t).alias(k) for k, t in
                                   zip(order, ("double", "int", "string", served.schema["doc_id"].dataType, "long"), strict=True)])
                here = F.struct(time.alias("finish"), "place", "ticket", "doc_id", "tag")
                keep = keep | ((at == final["range"]) & (here <= bound))
            taken = taken + keep.cast("int")
    return served.select("doc_id", "source", "tag", "size", "source_size", "target", taken.alias("copies"),
                         (F.col("size") * taken).alias("taken"), finish(F.lit(0)).alias("finish"))
