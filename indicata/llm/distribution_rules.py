"""Quality rules by distribution divergence.

Every document's histogram of character classes and of its language's common words is compared with the language's
reference by Jensen-Shannon distance (base 2, square root, 0 to 1). References are counted over all documents by the
language column: shares of the classes, and of every word that makes up at least ``common`` of the language's words (so
there are at most ``1 / common`` of them, plus one bin for the rest). Languages with at least ``least_share`` of all words
(so at most ``1 / least_share`` languages) and ``reference_words`` words get one.

Short texts spread by chance, so a document is judged only from ``min_words`` words on, its classes also only from
``min_chars`` characters on, and the limit of the word distance is ``word_limit + word_slack / sqrt(words)``.
A document of a language without a reference is not judged; a null language is judged by the nearest reference, and so is
a document that its own language's reference rejects (a mislabelled text is kept if it looks like another language).

Plain rules come first: fewer than ``least_words`` words, or more than ``repeat_share`` per cent of the words in 8-word
windows that the text holds twice or more, reject whatever the distances say.

Words are ``[^\\x20\\x09-\\x0D]+``; those of the histograms are ``alnum_words`` of up to 40 bytes, longer ones count as
rest. Defined cases: null is the empty text, which has zero counts and fails; rows that repeat a doc_id are judged each;
a table without rows gives none; only the three named columns are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import Steps, U64, WordHashes, alnum_words, rolling

SYMBOLS = b"#*$%&|<>"
SENTENCE = b".,;:!?'\"()-"
CLASSES = ("space", "lower", "upper", "digit", "sentence", "control", "symbol", "two bytes", "three bytes", "four bytes")
#: Number of the rows of the counting pass that hold a language's words.
WORDS = len(CLASSES)
LONGEST = 40
#: Entries a task counts before it gives them out.
HELD = 200_000


def _class(byte: int) -> int:
    if byte == 32 or 9 <= byte <= 13:
        return 0
    if byte >= 128:
        return len(CLASSES) if byte < 192 else 7 if byte < 224 else 8 if byte < 240 else 9  # later bytes of a character: none
    if 97 <= byte <= 122 or 65 <= byte <= 90 or 48 <= byte <= 57:
        return 1 if byte >= 97 else 2 if byte >= 65 else 3
    return 4 if byte in SENTENCE else 5 if byte < 32 or byte == 127 else 6


CLASS_OF = np.array([_class(b) for b in range(256)], np.intp)


def byte_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, np.uint8), minlength=256)


def class_counts(by_byte: np.ndarray) -> np.ndarray:
    """Characters of each class."""
    return np.bincount(CLASS_OF, weights=by_byte, minlength=WORDS + 1)[:WORDS].astype(np.int64)


def repeat_words(words: list[bytes], hashes: WordHashes, window: int = 8) -> int:
    """Words in windows of ``window`` words that are there twice or more."""
    if len(words) <= window:
        return 0
    _, which, times = np.unique(rolling(hashes.of(words), window), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[starts] += 1
    edges[starts + window] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base_counts(text: bytes, by_byte: np.ndarray, hashes: WordHashes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words, classes = text.split(), class_counts(by_byte)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), int(classes[1:].sum()), int(by_byte[list(SYMBOLS)].sum()), len(lines) - len(set(lines)),
            repeat_words(words, hashes))


@dataclass
class Reference:
    classes: np.ndarray                     # shares
    words: dict[bytes, float] = field(default_factory=dict)
    rest: float = 1.0


def distance(p: np.ndarray, q: np.ndarray, p_elsewhere: float = 0.0) -> float:
    """Jensen-Shannon distance of two distributions, given where ``q`` is above 0 (or everywhere); ``p_elsewhere`` is the
    share of ``p`` where it isn't."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, min(1.0, (terms.sum() + p_elsewhere) / 2))))


@dataclass
class Limits:
    least_words: int = 20
    repeat_share: int = 30
    min_words: int = 50
    min_chars: int = 300
    class_limit: float = 0.30
    word_limit: float = 0.30
    word_slack: float = 2.0


class Judge:
    """The verdict on a document by the references and limits."""

    def __init__(self, references: dict[str, Reference], limits: Limits):
        self.references, self.limits = references, limits

    def distances(self, ref: Reference, classes: np.ndarray, counts: Counter, n: int) -> tuple[float, float]:
        by_class = distance(ref.classes, classes / max(1, classes.sum()))
        known = [(ref.words[w], k) for w, k in counts.items() if w in ref.words]
        p = np.array([share for share, _ in known] + [ref.rest])
        q = np.array([k for _, k in known] + [n - sum(k for _, k in known)], np.float64) / max(1, n)
        return by_class, distance(p, q, max(0.0, 1.0 - p.sum()))

    def fails(self, near: tuple[float, float], n_chars: int, n: int) -> bool:
        most = self.limits
        return n_chars >= most.min_chars and near[0] > most.class_limit or near[1] > most.word_limit + most.word_slack / np.sqrt(n)

    def verdict(self, lang: str | None, text: bytes, by_byte: np.ndarray) -> tuple[float | None, float | None, bool]:
        """(class distance, word distance, rejected) by the reference that fits; no distances if it isn't judged."""
        own = self.references.get(lang)
        if own is None and lang is not None or not self.references:
            return None, None, False
        words = alnum_words(text)
        if len(words) < self.limits.min_words:
            return None, None, False
        classes, counts, n = class_counts(by_byte), Counter(words), len(words)
        chars = int(classes.sum())
        first = self.distances(own, classes, counts, n) if own is not None else None
        if first and not self.fails(first, chars, n):
            return *first, False
        found = [self.distances(r, classes, counts, n) for r in self.references.values()]
        fit = [d for d in found if not self.fails(d, chars, n)]
        return *(min(fit, key=sum) if fit else first or min(found, key=sum)), not fit


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str | None, Counter] = defaultdict(Counter)
    classes: dict[str | None, np.ndarray] = defaultdict(lambda: np.zeros(WORDS + 1, np.int64))

    def out() -> pa.RecordBatch:
        rows = [(lang, w, None, n) for lang, c in words.items() for w, n in c.items() if len(w) <= LONGEST]
        rows += [(lang, None, i, int(n)) for lang, c in classes.items() for i, n in enumerate(c)]
        words.clear()
        classes.clear()
        kinds = (pa.string(), pa.binary(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          names=["lang", "word", "class", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py() or b""
            found = alnum_words(text)
            words[lang].update(found)
            classes[lang][:WORDS] += class_counts(byte_counts(text))
            classes[lang][WORDS] += len(found)
            if sum(map(len, words.values())) > HELD:
                yield out()
    yield out()


def language_references(docs: DataFrame, common: float = 0.001, least_share: float = 0.005, reference_words: int = 2000,
                        lang_col: str = "lang", text_col: str = "text") -> dict[str, Reference]:
    """The reference of each language: at most ``1 / least_share`` of them with ``1 / common`` words each, whatever the input."""
    steps = Steps(docs.sparkSession, "references")
    source = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("binary").alias("text"))
    counted = steps.write(source.mapInArrow(_counts, "lang string, word binary, class int, n long")
                          .groupBy("lang", "word", "class").agg(F.sum("n").alias("n")), "counts")
    sizes = counted.filter(F.col("class") == WORDS).select("lang", F.col("n").alias("n_words"))
    total = sizes.agg(F.sum("n_words")).first()[0] or 0
    # broadcast: 1 / least_share rows at most
    enough = sizes.filter(F.col("lang").isNotNull() & (F.col("n_words") >= max(reference_words, total * least_share)))
    rows = counted.join(F.broadcast(enough), "lang").filter(F.col("class").isNotNull() | (F.col("n") >= F.col("n_words") * common)).collect()
    out: dict[str, Reference] = {}
    for r in rows:
        ref = out.setdefault(r["lang"], Reference(np.zeros(WORDS)))
        if r["word"] is not None:
            ref.words[bytes(r["word"])] = r["n"] / r["n_words"]
        elif r["class"] < WORDS:
            ref.classes[r["class"]] = r["n"]
    for ref in out.values():
        ref.classes /= max(1.0, ref.classes.sum())
        ref.rest = max(0.0, 1.0 - sum(ref.words.values()))
    return out


def _judged(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, hashes = shared.value, WordHashes()
        most = judge.limits
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or b""
                by_byte = byte_counts(text)
                base = base_counts(text, by_byte, hashes)
                failed = base[0] < most.least_words or 100 * base[4] > most.repeat_share * base[0]
                by_class, by_word, rejected = judge.verdict(lang, text, by_byte)
                rows.append((*base, failed, not (failed or rejected), by_class, by_word))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))],
                                             names=["doc_id", *OUT])
    return run


OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def judged(docs: DataFrame, limits: Limits | None = None, references: dict[str, Reference] | None = None, id_col: str = "doc_id",
           lang_col: str = "lang", text_col: str = "text", **counting) -> DataFrame:
    """One row per document: doc_id, its counts, ``base_failed``, ``kept`` and its distances (null if it wasn't judged)."""
    if references is None:
        references = language_references(docs, lang_col=lang_col, text_col=text_col, **counting)
    shared = docs.sparkSession.sparkContext.broadcast(Judge(references, limits or Limits()))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                         F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(_judged(shared), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                             "n_repeat_words long, base_failed boolean, kept boolean, class_distance double, word_distance double")
