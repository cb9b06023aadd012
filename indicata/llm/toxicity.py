"""Toxicity with subword-bag embeddings and a linear softmax.

A word's vector is the mean of the embeddings of its character n-grams (of
``MIN_GRAM`` to ``MAX_GRAM`` bytes of ``<word>``, hashed to ``BUCKETS``
buckets), so an unseen misspelling shares most of its vector with the word it
hides. A passage of ``PASSAGE`` words is the mean of its words' vectors, goes
through a linear softmax, and a text is as toxic as its most toxic passage:
a few words in a long text count as much as in a short one. Embeddings and
softmax are trained jointly in numpy (mini-batches, Adagrad); the gradient
runs through each text's most toxic passage.

Training is bounded and documented: at most ``train_rows`` labelled rows (the
smallest hashes of their ids) with texts of up to ``train_bytes`` bytes each.
Because the softmax is linear, scoring needs one number per bucket (the
difference of the two logits), which is what is broadcast (512 KB). Scoring
is one narrow pass over all whole texts.

Defined results: null, empty and wordless texts score 0; null labels and
labels without a document are left out; of several labels for one doc_id the
largest counts; without two classes to learn from every score is the share of
label 1 (0 without labels). Rows that repeat a doc_id are scored each, and train
by the text of the least hash among those short enough. Other columns are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import U64, alnum_words, keyed, mixed
from indicata.llm.quality_knn import training_labels, training_rows

BUCKETS = 1 << 17
MIN_GRAM, MAX_GRAM = 3, 6
PASSAGE = 16
REMEMBERED = 1 << 18
WORD_BYTES = 64


def word_grams(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, and where each word's begin. Longer words are cut into pieces of
    WORD_BYTES by the caller; every word has one gram at least (itself)."""
    framed = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(U64)
    size = np.array([len(w) + 2 for w in words])
    start = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    left = np.repeat(start + size, size) - np.arange(len(framed))  # bytes from here to the end of the word
    found, owner = [], []
    acc = np.zeros(len(framed), U64)
    for n in range(1, MAX_GRAM + 1):
        rest = framed[n - 1:] if n > 1 else framed
        acc = acc[:len(rest)] * U64(0x9E3779B97F4A7C15) + rest + U64(1)
        if n >= MIN_GRAM:
            ok = left[:len(acc)] >= n
            found.append((mixed(acc[ok] + U64(n)) & U64(BUCKETS - 1)).astype(np.int32))
            owner.append(word[:len(acc)][ok])
    found, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return found[order], np.searchsorted(owner[order], np.arange(len(words)))


def pieces(text: bytes | None) -> list[bytes]:
    words = alnum_words(text)
    if words and max(map(len, words)) > WORD_BYTES:
        words = [w[i:i + WORD_BYTES] for w in words for i in range(0, len(w), WORD_BYTES)]
    return words


def passage_starts(n: int) -> np.ndarray:
    """Passages overlap by half; the last one ends with the text."""
    return np.unique(np.r_[np.arange(0, max(1, n - PASSAGE + 1), PASSAGE // 2), max(0, n - PASSAGE)])


@dataclass
class Model:
    gram_logit: np.ndarray
    bias: float
    fixed: float | None = None  # score without training

    def word_logits(self, words: Sequence[bytes]) -> np.ndarray:
        grams, starts = word_grams(words)
        sums = np.add.reduceat(self.gram_logit[grams], starts)
        return sums / np.diff(np.r_[starts, len(grams)])


class Scorer(dict):
    """Logit of each word; remembers a bounded number of words."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def learn(self, words: Sequence[bytes]) -> None:
        if self.model.fixed is not None:
            return
        new = list(set(words).difference(self.keys()))
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(set(words))
        for i in range(0, len(new), 1 << 15):
            some = new[i:i + (1 << 15)]
            self.update(zip(some, self.model.word_logits(some).tolist(), strict=True))

    def score(self, words: list[bytes]) -> float:
        if self.model.fixed is not None:
            return self.model.fixed
        n = len(words)
        if not n:
            return 0.0
        total = np.concatenate([[0.0], np.cumsum(np.fromiter(map(self.__getitem__, words), np.float64, n))])
        start = passage_starts(n)
        best = ((total[np.minimum(start + PASSAGE, n)] - total[start]) / min(PASSAGE, n)).max()
        return float(1 / (1 + np.exp(-np.clip(best + self.model.bias, -50, 50))))


def all_grams(words: Sequence[bytes], step: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """``word_grams`` of many words, in steps that bound its working memory."""
    parts = [word_grams(words[i:i + step]) for i in range(0, len(words), step)]
    if not parts:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    ahead = np.cumsum([0, *(len(g) for g, _ in parts)])
    return np.concatenate([g for g, _ in parts]), np.concatenate([s + a for (_, s), a in zip(parts, ahead)])


def train(texts: Iterable[list[bytes]], labels: np.ndarray, dim: int = 12, epochs: int = 20, batch: int = 256,
          rate: float = 0.3, seed: int = 11) -> Model:
    """Embeddings (BUCKETS x dim) and softmax (dim x 2) from word lists (read once, one at a time) and 0/1 labels."""
    labels = np.asarray(labels, np.int64)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(np.zeros(1, np.float32), 0.0, float(labels.mean()) if len(labels) else 0.0)
    rng = np.random.default_rng(seed)
    emb = (rng.standard_normal((BUCKETS, dim)) * 0.1).astype(np.float32)
    out = (rng.standard_normal((dim, 2)) * 0.1).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_emb, seen_out, seen_bias = np.full(BUCKETS, 1e-6, np.float32), np.full((dim, 2), 1e-6, np.float32), np.full(2, 1e-6)
    number: dict[bytes, int] = {}
    coded = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)) for words in texts]
    grams, starts = all_grams(list(number))
    del number
    lengths = np.diff(np.r_[starts, len(grams)])
    full = [i for i, c in enumerate(coded) if len(c)]
    weight = np.where(labels == 1, 0.5 / max(1e-9, labels.mean()), 0.5 / max(1e-9, 1 - labels.mean()))
    weight = np.sqrt(weight)
    for _ in range(epochs):
        # words' logits once an epoch choose each text's most toxic passage
        gram_logit = emb @ (out[:, 1] - out[:, 0])
        word_logit = np.add.reduceat(gram_logit[grams], starts) / lengths
        passages = {}
        for i in full:
            total = np.concatenate([[0.0], np.cumsum(word_logit[coded[i]])])
            s = passage_starts(len(coded[i]))
            e = np.minimum(s + PASSAGE, len(coded[i]))
            best = int(np.argmax((total[e] - total[s]) / (e - s)))
            passages[i] = coded[i][s[best]:e[best]]
        order = rng.permutation(full)
        for a in range(0, len(order), batch):
            some = order[a:a + batch]
            words = np.concatenate([passages[i] for i in some])
            owner = np.repeat(np.arange(len(some)), [len(passages[i]) for i in some])
            n_grams = lengths[words]
            offset = np.cumsum(n_grams) - n_grams
            flat = np.arange(n_grams.sum()) - np.repeat(offset, n_grams) + np.repeat(starts[words], n_grams)
            ids = grams[flat]
            # a gram's share of its passage's mean vector
            share = (1 / np.repeat(n_grams, n_grams) / np.repeat([len(passages[i]) for i in some],
                     np.add.reduceat(n_grams, np.flatnonzero(np.r_[True, np.diff(owner) > 0])))).astype(np.float32)
            doc = np.repeat(owner, n_grams)
            heads = np.flatnonzero(np.r_[True, np.diff(doc) > 0])
            vec = np.add.reduceat(emb[ids] * share[:, None], heads, axis=0)
            logit = vec @ out + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            y = labels[some]
            grad = p
            grad[np.arange(len(some)), y] -= 1
            grad *= (weight[some] / len(some))[:, None]
            g_out, g_bias = vec.T @ grad, grad.sum(0)
            # many words share a passage; scale a word's step back up to passage size
            g_vec = (grad @ out.T) * PASSAGE
            uniq, inv = np.unique(ids, return_inverse=True)
            by = np.argsort(inv, kind="stable")
            first = np.searchsorted(inv[by], np.arange(len(uniq)))
            g_emb = np.add.reduceat((g_vec[doc] * share[:, None])[by], first, axis=0)
            seen_emb[uniq] += (g_emb * g_emb).mean(1)
            seen_out += g_out * g_out
            seen_bias += g_bias * g_bias
            emb[uniq] -= rate * g_emb / np.sqrt(seen_emb[uniq])[:, None]
            out -= rate * g_out / np.sqrt(seen_out)
            bias -= (rate * g_bias / np.sqrt(seen_bias)).astype(np.float32)
    return Model((emb @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label_col: str, usable: Callable[[Column], Column], train_rows: int = 6000,
        train_bytes: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    chosen = training_labels(labels, label_col, usable, train_rows, id_col)
    short = docs.filter(F.octet_length(F.col(text_col).cast("binary")) <= train_bytes)
    rows = training_rows(short, chosen, id_col, text_col).toArrow().sort_by("doc_id")
    return train((pieces(t.as_py()) for t in rows["text"]), np.array(rows["label"].to_pylist(), np.int64))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores, held, size = [], [], 0
            for text in batch.column("text"):
                held.append(pieces(text.as_py()))
                size += len(held[-1])
                if size >= 1 << 17:
                    scorer.learn([w for words in held for w in words])
                    scores += map(scorer.score, held)
                    held, size = [], 0
            if held:
                scorer.learn([w for words in held for w in words])
                scores += map(scorer.score, held)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "tag", "score"])
    return run


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, score) of every row."""
    rows = keyed(docs, id_col, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scored(shared), "doc_id long, tag long, score double")
