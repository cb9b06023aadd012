"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms describe how a text is written: the shape of each word (letter case,
digits, punctuation, runs collapsed; a shape for every piece of a long word),
pairs of neighbouring shapes, and words that repeat one of the last words. Their hashed, log-scaled, idf-weighted and
normalised counts are projected on the leading right singular vectors of the
training rows' term matrix (latent-semantic analysis). Every document is
compared with every kept labelled vector, in blocks of documents (one matrix
product each); the ``neighbours`` most similar ones vote with their cosine to
the power ``sharpness``.

Fitting is bounded and documented: at most ``train_rows`` labelled rows (the
smallest hashes of their ids), whose term counts come from Spark tasks; idf,
the projection and the labelled vectors (train_rows x rank) are the model and
all that is broadcast (about 4 MB at the defaults). Scoring is one narrow
pass over all whole texts.

Defined results: null, empty and wordless texts have a zero vector and get
the share of label 1 among the training rows (0.5 without any); null labels
and labels without a document are left out; of several labels for one doc_id
the largest counts; rows that repeat a doc_id are scored each, and train by the
text of the least hash. Other columns are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from indicata.llm.common import batched, list_column

TERMS = 1 << 13
SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
REMEMBERED = 1 << 16
PIECE, RUNS = 64, 8  # bytes, runs of characters of a class


def word_shapes(word: bytes) -> list[bytes]:
    """``Abcd,`` becomes ``Aa,``: classes of characters with runs collapsed. A word of more than ``PIECE`` bytes or
    ``RUNS`` runs has several shapes, one for each piece of at most so many, so all its bytes count."""
    out = []
    for i in range(0, len(word), PIECE):
        runs = [(c, sum(1 for _ in same)) for c, same in groupby(word[i:i + PIECE].translate(SHAPE))]
        for j in range(0, len(runs), RUNS):
            some = runs[j:j + RUNS]
            # every run of punctuation keeps whether it was longer than one character
            out.append(bytes(c for c, _ in some) + (b"+" if any(n > 1 and c not in b"aA0" for c, n in some) else b""))
    return out


class Shapes(dict):
    """Shape numbers (terms) of each word; remembers a bounded number of words of one piece."""

    def __missing__(self, word: bytes) -> list[int]:
        value = [xxhash.xxh3_64_intdigest(s) & 0x7FFFFFFF for s in word_shapes(word)]
        if len(word) > PIECE:
            return value
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value
        return value


def term_counts(text: bytes | None, shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a text and their counts."""
    words = text.split() if text else []
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    shape = np.fromiter(chain.from_iterable(map(shapes.__getitem__, words)), np.int64)
    numbers: dict[bytes, int] = {}
    same = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    single = shape * 0x9E3779B1 % 2147483647 % TERMS
    double = (shape[:-1] * 31 + shape[1:] * 0x85EBCA6B) % 2147483647 % TERMS
    terms, counts = np.unique(np.concatenate([single, double]), return_counts=True)
    again = np.array([(same[lag:] == same[:-lag]).sum() for lag in (1, 2, 3)])
    fresh = len(numbers) * 8 // len(words)  # how often words repeat at all, in eighths
    extra = np.r_[TERMS + np.flatnonzero(again), TERMS + 3 + fresh]
    return (np.concatenate([terms, extra]).astype(np.int32),
            np.concatenate([counts, again[again > 0], [max(1, len(words) // 4)]]).astype(np.int32))


WIDTH = TERMS + 3 + 9


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray       # WIDTH x rank
    vectors: np.ndarray    # labelled rows x rank
    labels: np.ndarray
    neighbours: int
    sharpness: float
    prior: float

    def weights(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = np.log1p(counts).astype(np.float32) * self.idf[terms]
        norm = np.sqrt((w * w).sum())
        return w / norm if norm > 0 else w

    def projected(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(docs), self.axes.shape[1]), np.float32)
        for i, (terms, counts) in enumerate(docs):
            if len(terms):
                out[i] = self.weights(terms, counts) @ self.axes[terms]
        norm = np.sqrt((out * out).sum(1, keepdims=True))
        return out / np.where(norm > 0, norm, 1)

    def scores(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors."""
        if not len(self.labels):
            return np.full(len(docs), self.prior)
        cosine = np.maximum(self.projected(docs) @ self.vectors.T, 0)
        k = min(self.neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < cosine.shape[1] else \
            np.broadcast_to(np.arange(k), cosine.shape)
        weight = np.take_along_axis(cosine, near, 1).astype(np.float64) ** self.sharpness
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1)
        return np.where(total > 0, vote / np.where(total > 0, total, 1), self.prior)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shapes = Shapes()
    for batch in batches:
        found = [term_counts(t.as_py(), shapes) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), list_column([t for t, _ in found], pa.int32()),
             list_column([c for _, c in found], pa.int32())], names=["doc_id", "label", "terms", "counts"])


def training_labels(labels: DataFrame, label_col: str, usable: Callable[[Column], Column], rows: int,
                    id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``rows`` usable labelled ids, those with the smallest hashes."""
    return (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & usable(F.col(id_col)))
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def training_rows(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, label, text) of the chosen ids; of rows that repeat an id the text with the least hash counts."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("label").alias("label"), first)


def fit(docs: DataFrame, labels: DataFrame, label_col: str, usable: Callable[[Column], Column], train_rows: int = 4000,
        rank: int = 48, neighbours: int = 15, sharpness: float = 4.0, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    chosen = training_labels(labels, label_col, usable, train_rows, id_col)
    rows = (training_rows(docs, chosen, id_col, text_col)
            .mapInArrow(_counted, "doc_id long, label int, terms array<int>, counts array<int>").collect())
    rows.sort(key=lambda r: r["doc_id"])
    found = [(np.array(r["terms"], np.int64), np.array(r["counts"], np.float32)) for r in rows]
    y = np.array([r["label"] for r in rows], np.float64)
    df = np.zeros(WIDTH, np.float32)
    for terms, _ in found:
        df[terms] += 1
    idf = np.log((1 + len(found)) / (1 + df)).astype(np.float32) + 0.1
    model = Model(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), y[:0], neighbours, sharpness,
                  float(y.mean()) if len(y) else 0.5)
    if not len(found):
        return model
    model.axes = latent_axes([(t, model.weights(t, c)) for t, c in found], rank)
    model.vectors, model.labels = model.projected(found), y
    return model


def latent_axes(docs: list[tuple[np.ndarray, np.ndarray]], rank: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors of the sparse matrix with these rows (randomised subspace iteration)."""
    at = np.concatenate([t for t, _ in docs])
    w = np.concatenate([v for _, v in docs])
    ends = np.cumsum([0, *(len(t) for t, _ in docs)])
    row = np.repeat(np.arange(len(docs)), np.diff(ends))
    rank = min(rank, len(docs), WIDTH)
    base = np.random.default_rng(7).standard_normal((WIDTH, min(rank + 8, WIDTH))).astype(np.float32)
    order = np.argsort(at, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
    for _ in range(rounds):
        left = np.zeros((len(docs), base.shape[1]), np.float32)
        full = np.flatnonzero(np.diff(ends) > 0)
        left[full] = np.add.reduceat(base[at] * w[:, None], ends[full], axis=0)
        left, _ = np.linalg.qr(left)
        back = np.zeros_like(base, shape=(WIDTH, left.shape[1]))
        back[at[order][heads]] = np.add.reduceat(left[row[order]] * w[order][:, None], heads, axis=0)
        base = back
    u, s, _ = np.linalg.svd(base, full_matrices=False)
    return np.ascontiguousarray(u[:, :rank])


def _scored(shared, text_col: str, out: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shapes = shared.value, Shapes()
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary())
            scores = [np.zeros(0)]
            for some in batched(texts, block):
                scores.append(model.scores([term_counts(t.as_py(), shapes) for t in some]))
            scores = pa.array(np.clip(np.concatenate(scores), 0, 1), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, out])
    return run


def with_scores(docs: DataFrame, model: Model, out: str = "score", block: int = 256, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its score: how much its neighbours look like label 1."""
    if out in docs.columns:
        raise ValueError(f"the table has a column {out!r} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])
    return docs.mapInArrow(_scored(shared, text_col, out, block), schema)
