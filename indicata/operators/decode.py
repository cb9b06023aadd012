"""Ingestion decode: EAV dictionary codes and directory names (LEFT joins).

No join is hinted: Spark broadcasts a side itself when its measured or scanned
size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE decides again
from real shuffle sizes, so a dictionary that grows falls back to a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def dictionary_for(dictionary: DataFrame, table: str, column: str) -> DataFrame:
    """Rows of the EAV dictionary for one (table, column): (code, description)."""
    return (dictionary.filter((F.col("id_tabela") == F.lit(table)) & (F.col("nome_coluna") == F.lit(column)))
            .select(F.col("chave").alias(f"__code_{column}"), F.col("valor").alias(f"__desc_{column}")))


def decode_with_dictionary(df: DataFrame, dictionary: DataFrame, table: str, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Replace each coded column by its description (LEFT join; no entry -> NULL).

    ``columns`` lists the coded columns, or maps each one to its name in the
    dictionary. Like the SQL it re-expresses, duplicate dictionary keys fan
    the row out.
    """
    mapping = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    out = df
    for column, dict_name in mapping.items():
        dim = dictionary_for(dictionary, table, dict_name).toDF(f"__code_{column}", f"__desc_{column}")
        code, desc = f"__code_{column}", f"__desc_{column}"
        out = (out.join(dim, out[column] == dim[code], "left")
               .select(*[F.col(desc).alias(column) if c == column else F.col(c) for c in out.columns]))
    return out


def lookup_name(df: DataFrame, directory: DataFrame, key: str, dir_key: str, dir_name: str, out: str) -> DataFrame:
    """Add ``out`` = name from ``SELECT DISTINCT dir_key, dir_name FROM directory`` (LEFT join)."""
    names = directory.select(F.col(dir_key).alias("__dkey"), F.col(dir_name).alias(out)).distinct()
    return df.join(names, df[key] == names["__dkey"], "left").drop("__dkey")
