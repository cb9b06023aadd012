"""Ranked lexical search, reversed: the queries are indexed and the documents stream past them.

An item is a row of the query table; its terms are the words ``alnum_words`` finds. The inverted index (term -> items and
how often each repeats the term) is broadcast, and each document's term counts run through it once: every item that shares a
term gets the document's score. A task keeps the best ``top`` documents per item in a heap, so it gives out at most ``top``
rows per item however many documents it read; the heaps are merged by rank. Before that, a first pass counts documents,
terms and document frequencies over all documents.

The index is broadcast in blocks of items. Blocks are dealt by a hash of the item until none has more postings than
``block_postings`` (or is one item alone); each block reads the documents twice and holds its own heaps.

Ranking: a term in ``df`` of ``N`` documents weighs ``floor(1000 ln((2N+2)/(2df+1)))``; a document of ``n`` of all ``L``
terms has the length norm ``m = 100 - b + (b*n*N) div L`` in per cent; a term found ``tf`` times adds
``weight * ((10^9 tf) div (1000 tf + k m))`` for each time the item has it. Everything but the weight is whole numbers.

Defined cases: null and empty texts have no terms, count in nothing and are never found; items without terms or without a
match have no rows; documents are rows (a repeated doc_id or text is ranked once per row); items are distinct
(item_id, text) pairs, so exact repeats of an item are one item, and an item_id with two texts is ranked for each of them;
equal scores go by doc_id, null ids last. Only the two named columns of each table are read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from indicata.llm.common import LAST_ID, Steps, alnum_words, list_column

#: Rows of the counting pass that are no term: documents with terms, and all their terms.
DOCUMENTS, TERMS = -1, -2
#: Sort position of a document without an id: behind every other.
NO_ID = LAST_ID + 1


@dataclass
class Index:
    """Postings of one block of items: those of term ``t`` stand at ``starts[t]:starts[t + 1]``."""

    terms: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray     # item numbers
    repeats: np.ndarray   # times the item has the term
    n_items: int
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 0
    b: int = 75
    k: int = 8

    def norm(self, n: int) -> int:
        return 100 - self.b + (self.b * n * self.documents) // self.length

    def scores(self, counts: Counter, n: int) -> np.ndarray:
        """Score of every item for a document of ``n`` terms with these counts of indexed terms."""
        found = np.fromiter(counts.keys(), np.int64, len(counts))
        tf = np.fromiter(counts.values(), np.int64, len(counts))
        gain = self.weights[found] * ((10**9 * tf) // (1000 * tf + self.k * self.norm(n)))
        sizes = self.starts[found + 1] - self.starts[found]
        at = np.repeat(self.starts[found] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        out = np.zeros(self.n_items, np.int64)
        np.add.at(out, self.items[at], self.repeats[at] * np.repeat(gain, sizes))
        return out


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def indexed_counts(text: bytes | None, terms: dict[bytes, int]) -> tuple[Counter, int]:
    """Counts of the indexed terms of a text, by term number, and the number of all its terms."""
    words = alnum_words(text)
    counts = Counter(map(terms.get, words))
    counts.pop(None, None)
    return counts, len(words)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [Counter(alnum_words(t.as_py())) for t in batch.column("text")]
        terms = pa.array([list(c) for c in counts], pa.list_(pa.binary()))
        repeats = list_column([np.fromiter(c.values(), np.int64, len(c)) for c in counts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("item"), terms, repeats], names=["item", "terms", "repeats"])


def _counted(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, df, documents, length = shared.value.terms, Counter(), 0, 0
        for batch in batches:
            for text in batch.column("text"):
                counts, n = indexed_counts(text.as_py(), terms)
                df.update(counts.keys())
                documents += n > 0
                length += n
        rows = [*df.items(), (DOCUMENTS, documents), (TERMS, length)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["term", "n"])
    return run


def _best(shared, top: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        heaps: list[list] = [[] for _ in range(index.n_items)]
        least = np.ones(index.n_items, np.int64)  # a score below this enters no more
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                counts, n = indexed_counts(text.as_py(), index.terms)
                if not counts:
                    continue
                scores, place = index.scores(counts, n), NO_ID if doc_id is None else doc_id
                for i in np.flatnonzero(scores >= least):
                    entry = (int(scores[i]), -place)
                    if len(heaps[i]) < top:
                        heapq.heappush(heaps[i], entry)
                    else:
                        heapq.heappushpop(heaps[i], entry)
                    if len(heaps[i]) == top:
                        least[i] = heaps[i][0][0]
        for i, heap in enumerate(heaps):
            if heap:
                ids = [None if -p == NO_ID else -p for _, p in heap]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(heap), pa.int64()), pa.array(ids, pa.int64()), pa.array([s for s, _ in heap], pa.int64())],
                    names=["item", "doc_id", "score"])
    return run


def item_blocks(terms: DataFrame, block_postings: int) -> int:
    """The least power of two of hash blocks of which none has more than ``block_postings`` postings, or holds several
    items if it does."""
    sized = terms.select("item", F.size("terms").alias("n"))
    blocks = 1
    while True:
        part = F.pmod(F.xxhash64("item"), F.lit(blocks))
        over = sized.groupBy(part.alias("block")).agg(F.sum("n").alias("n"), F.count("*").alias("items")) \
            .filter((F.col("n") > block_postings) & (F.col("items") > 1)).limit(1).count()
        if not over:
            return blocks
        blocks *= 2


def block_index(rows: list, b: int, k: int) -> Index:
    """Index of the (item, terms, repeats) rows of one block."""
    postings: dict[bytes, list[tuple[int, int]]] = {}
    for i, r in enumerate(rows):
        for term, repeats in zip(r["terms"], r["repeats"], strict=True):
            postings.setdefault(bytes(term), []).append((i, repeats))
    flat = np.array([p for ps in postings.values() for p in ps], np.int64).reshape(-1, 2)
    starts = np.cumsum([0, *map(len, postings.values())], dtype=np.int64)
    return Index({t: j for j, t in enumerate(postings)}, starts, flat[:, 0].copy(), flat[:, 1].copy(), len(rows), b=b, k=k)


def top_documents(docs: DataFrame, items: DataFrame, top: int = 10, b: int = 75, k: int = 8, block_postings: int = 2_000_000,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``top`` best documents, as the module says."""
    spark = docs.sparkSession
    steps = Steps(spark, "search")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    queries = items.select(F.struct(F.col(item_col).alias("id"), F.xxhash64(query_col).alias("tag")).alias("item"),
                           F.col(query_col).cast("binary").alias("text"))
    schema = StructType([queries.schema["item"], *spark.createDataFrame([], "terms array<binary>, repeats array<long>").schema])
    terms = steps.write(queries.dropDuplicates(["item"]).mapInArrow(_item_terms, schema).filter(F.size("terms") > 0), "terms")
    blocks = item_blocks(terms, block_postings)
    out = []
    for block in range(blocks):
        rows = terms.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).sort("item").collect()  # bounded by item_blocks
        if not rows:
            continue
        index = block_index(rows, b, k)
        shared = spark.sparkContext.broadcast(index)
        counts = dict(source.mapInArrow(_counted(shared), "term long, n long").groupBy("term").agg(F.sum("n")).collect())
        index.documents, index.length = counts.get(DOCUMENTS, 0), counts.get(TERMS, 0)
        if not index.documents:
            continue
        index.weights = np.array([weight(index.documents, counts.get(t, 0)) for t in range(len(index.terms))], np.int64)
        names = spark.createDataFrame([(i, *r["item"]) for i, r in enumerate(rows)],
                                      StructType([StructField("item", LongType()), StructField("item_id", items.schema[item_col].dataType),
                                                  StructField("tag", LongType())]))
        heaps = source.mapInArrow(_best(spark.sparkContext.broadcast(index), top), "item long, doc_id long, score long")
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = heaps.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
        out.append(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], StructType([StructField("item_id", items.schema[item_col].dataType)])) \
            .select("item_id", F.lit(0).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in ("doc_id", "score")])
    for one in out[1:]:
        out[0] = out[0].unionByName(one)
    return out[0]
