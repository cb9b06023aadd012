"""Silver cleaning: one ``select`` per phase, composed with ``DataFrame.transform``.

Order of phases: blank strings -> typing -> required columns -> dedup ->
range rule -> audit columns. The range rule runs after dedup on purpose: an
out-of-range copy can win the dedup and then leave a NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from indicata import specs
from indicata.functions.columns import blank_to_null, lenient_int, parse_decimal_comma, within_range
from indicata.operators.latest import dedup_rows


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and turn blanks into NULL (one projection)."""
    return df.select(*[
        blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def is_decimal_column(name: str, spec: specs.CleanSpec = specs.CleanSpec("")) -> bool:
    return name.startswith(tuple(spec.decimal_prefixes)) or name in spec.decimal_names


def fix_types(df: DataFrame, spec: specs.CleanSpec = specs.CleanSpec("")) -> DataFrame:
    """ids -> string, int columns -> int, decimal-named columns -> double.

    The id and int lists win over the name prefixes; other columns are untouched.
    Casts are lenient (``try_cast``): a value that does not parse becomes NULL.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in spec.id_columns:
            out.append(c.cast("string").alias(f.name))
        elif f.name in spec.int_columns:
            out.append(lenient_int(c).alias(f.name))
        elif is_decimal_column(f.name, spec):
            out.append(parse_decimal_comma(c, isinstance(f.dataType, StringType)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any required column that the table has."""
    present = [c for c in required if c in df.columns]
    return df.dropna(subset=present) if present else df


def dedup_by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key (NULL keys compare equal), deterministic survivor."""
    return dedup_rows(df, keys)


def null_out_of_range(df: DataFrame, spec: specs.CleanSpec = specs.CleanSpec("")) -> DataFrame:
    """Rates, targets, shares and percentages outside [low, high] become NULL."""
    return df.select(*[
        within_range(F.col(c), spec.low, spec.high).alias(c) if c.startswith(tuple(spec.ranged_prefixes)) else F.col(c)
        for c in df.columns
    ])


def add_audit(df: DataFrame, source: str, with_time: bool = True) -> DataFrame:
    cols = [F.lit(source).alias("fonte_tabela")]
    if with_time:
        cols.append(F.current_timestamp().alias("processado_em_utc"))
    return df.select("*", *cols)


def clean_table(df: DataFrame, spec: specs.CleanSpec, with_time: bool = True) -> DataFrame:
    """The whole bronze -> silver cleaning of one table."""
    out = (df.transform(clean_strings)
           .transform(lambda d: fix_types(d, spec))
           .transform(lambda d: require_columns(d, spec.required))
           .transform(lambda d: dedup_by_keys(d, spec.keys))
           .transform(lambda d: null_out_of_range(d, spec)))
    return add_audit(out, spec.name, with_time) if spec.audit else out
