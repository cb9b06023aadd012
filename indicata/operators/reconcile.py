"""Full outer reconciliation that keeps orphans on both sides.

``reconcile`` takes a projection ``project(L, R)`` where ``L(name)`` and
``R(name)`` return the column of each side. Three physical strategies give the
same rows:

* ``"full_outer"`` (default) - one sort-merge full outer join; each input is
  computed and shuffled once. Spark can neither broadcast a full outer join
  nor split a skewed key in it (AQE skew handling does not cover full outer).
* ``"split"`` - inner join + left anti + right anti, each projected with typed
  NULLs for the missing side, then ``unionByName``. AQE can split a hot key
  in the inner and the anti joins, so this is the skew-safe form. Column
  pruning gives the three joins different inputs, so each side is read twice:
  use it on materialized inputs (the jobs reconcile tables they have just
  written, so the second read is a scan, not a recomputation).

* ``"salted"`` - one full outer join that spreads hot keys. Both sides' keys
  are counted first (a narrow, partially aggregated pass over the key columns). A key
  with more than ``rows_per_salt`` rows on a side is hot: the rows of its
  larger side are dealt over salts of about that many rows, the rows of the other side
  are copied to each salt, and the join is on key and salt. A copy without
  a partner in its salt has one in another, so it is no orphan and goes; true
  orphans have keys that the other side lacks, which are never copied. Rows
  with a NULL key, which match nothing, are dealt over salts too. At most one
  key in ``rows_per_salt`` rows can be hot, which bounds the table of hot keys
  that is broadcast (100,000 keys for 10^11 rows).

A side with NULL keys never matches (SQL equality), exactly as in a full
outer join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Getter = Callable[[str], Column]
Projection = Callable[[Getter, Getter], list[Column]]

_L, _R = "__l", "__r"


def _null_getter(df: DataFrame) -> Getter:
    types = {f.name: f.dataType for f in df.schema.fields}
    return lambda name: F.lit(None).cast(types[name])


def reconcile(left: DataFrame, right: DataFrame, on: Sequence[tuple[Column | str, Column | str]] | Callable,
              project: Projection, strategy: str = "full_outer", rows_per_salt: int = 1_000_000) -> DataFrame:
    """Full outer equi-join of ``left`` and ``right`` projected by ``project``.

    ``on`` is a list of (left expr, right expr) pairs; strings are column names.
    """
    lft, rgt = left.alias(_L), right.alias(_R)

    def L(name: str) -> Column:
        return F.col(f"{_L}.{name}")

    def R(name: str) -> Column:
        return F.col(f"{_R}.{name}")

    def side(x, getter):
        return getter(x) if isinstance(x, str) else x(getter)

    cond = reduce(lambda a, b: a & b, [side(a, L) == side(b, R) for a, b in on])

    if strategy == "full_outer":
        return lft.join(rgt, cond, "full_outer").select(*project(L, R))
    if strategy == "salted":
        return _salted(left, right, [[side(x, F.col) for x in pair] for pair in on], rows_per_salt).select(*project(L, R))
    if strategy != "split":
        raise ValueError(f"unknown strategy {strategy!r}")
    both = lft.join(rgt, cond, "inner").select(*project(L, R))
    left_only = lft.join(rgt, cond, "left_anti").select(*project(L, _null_getter(right)))
    right_only = rgt.join(lft, cond, "left_anti").select(*project(_null_getter(left), R))
    return both.unionByName(left_only).unionByName(right_only)


NULL_SALTS = 64
_HERE, _SALT, _SALTS, _BY_LEFT = "__here", "__salt", "__salts", "__by_left"


def _salted(left: DataFrame, right: DataFrame, on: list[list[Column]], rows_per_salt: int) -> DataFrame:
    """The full outer join of the sides, aliased, with hot keys dealt over salts (see the module's text)."""
    names = [f"__k{i}" for i in range(len(on))]
    sides = [df.select("*", *[pair[i].alias(n) for pair, n in zip(on, names, strict=True)], F.lit(True).alias(_HERE))
             for i, df in enumerate((left, right))]

    def counts(df: DataFrame, mine: str, other: str) -> DataFrame:
        return (df.select(*names).dropna().groupBy(*names).agg(F.count(F.lit(1)).alias(mine))
                .filter(F.col(mine) > rows_per_salt).withColumn(other, F.lit(0).cast("long")))
    hot = (counts(sides[0], "__nl", "__nr").unionByName(counts(sides[1], "__nr", "__nl"))
           .groupBy(*names).agg(F.max("__nl").alias("__nl"), F.max("__nr").alias("__nr"))
           .select(*names, F.ceil(F.greatest("__nl", "__nr") / rows_per_salt).cast("int").alias(_SALTS),
                   (F.col("__nl") >= F.col("__nr")).alias(_BY_LEFT)))
    out = []
    for df, is_left in zip(sides, (True, False), strict=True):
        known = df.join(F.broadcast(hot), names, "left")
        dealt = F.monotonically_increasing_id()
        no_key = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
        own = F.col(_BY_LEFT) if is_left else ~F.col(_BY_LEFT)
        salts = (F.when(no_key, F.array((-1 - dealt % NULL_SALTS).cast("int")))
                 .when(F.col(_SALTS).isNull(), F.array(F.lit(0)))
                 .when(own, F.array((dealt % F.col(_SALTS)).cast("int")))
                 .otherwise(F.sequence(F.lit(0), F.col(_SALTS) - 1)))
        copied = F.col(_SALTS).isNotNull() & ~own
        out.append(known.select(*df.columns, F.coalesce(copied, F.lit(False)).alias("__copied"), F.explode(salts).alias(_SALT)))
    lft, rgt = out[0].alias(_L), out[1].alias(_R)
    same = reduce(lambda a, b: a & b, [F.col(f"{_L}.{n}") == F.col(f"{_R}.{n}") for n in [*names, _SALT]])
    alone_l, alone_r = F.col(f"{_R}.{_HERE}").isNull(), F.col(f"{_L}.{_HERE}").isNull()
    return (lft.join(rgt, same, "full_outer")
            .filter(~((alone_l & F.coalesce(F.col(f"{_L}.__copied"), F.lit(False)))
                      | (alone_r & F.coalesce(F.col(f"{_R}.__copied"), F.lit(False))))))


def col_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    """The column cast to ``dtype`` when the frame has it, else a typed NULL."""
    return F.col(name).cast(dtype) if name in df.columns else F.lit(None).cast(dtype)


def with_columns_or_null(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Add typed NULL columns for every wanted column the frame lacks."""
    missing = {n: F.lit(None).cast(t) for n, t in wanted.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df
