"""Helpers the operators share: words, hashes, written steps, Arrow batches.

Words are cut from UTF-8 bytes. ``bytes.split()`` cuts at exactly
``\\x20 \\x09-\\x0D`` and ``bytes.lower()`` lower-cases exactly ``A-Z``, so no
regular expression is needed; ``ALNUM`` maps every other separator to a space
first. 64-bit hashes of words, shingles and windows stand for their texts
inside the operators (a wrong match needs a 64-bit collision).
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.session import ensure_checkpoint_dir

#: Byte table: A-Z to a-z; 0-9, a-z and bytes of non-ASCII characters stay; all else is a space.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

U64 = np.uint64
LAST_ID = (1 << 63) - 1


def space_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    return text.split() if text else []


def lower_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(ALNUM).split() if text else []


class WordHashes(dict):
    """64-bit hash of each word; remembers a bounded number of words."""

    limit = 1 << 18

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (shift-multiply rounds)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def rolling(h: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc *= U64(base)
        acc += h[j:j + n]
    return mixed(acc)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U64, copy=False).view(np.int64)


def list_column(parts: Sequence[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One list per array of ``parts``."""
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int64)
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def batched(rows: Iterable[tuple], size: int) -> Iterable[list[tuple]]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield out
            out = []
    if out:
        yield out


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, text as bytes) of each row, free of every other column.

    ``tag`` is a hash of the text: rows that repeat a doc_id with another
    text stay apart in later joins, exact repeats share their decisions.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tag"),
                       F.col(text_col).cast("binary").alias("text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["tag"] == right["tag"])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until the table has no such column (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def release(spark: SparkSession) -> None:
    """Let Spark's context cleaner drop the shuffle files of finished steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Steps:
    """The written steps of one run: tables in a folder of their own under the shared checkpoint folder.

    Writing a step cuts the lineage (an executor lost later costs no
    recomputation of it) and evaluates it once, unlike ``checkpoint()``, which
    runs the last stage twice. Steps that later ones have used up are dropped.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.written = 0
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        self.written += 1
        path = f"{self.base}/{self.written}-{name}"
        df.write.option("compression", compression).parquet(path)
        release(self.spark)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete steps that nothing will read again."""
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
