"""Benchmark decontamination with a generalised suffix automaton.

The benchmark's items, as lower-cased words, become one suffix automaton over
words. Each document's words stream through it; the automaton's state and the
length of the longest suffix of the words read that occurs in some item are
tracked. Whenever that length reaches ``window`` words, the last ``window``
words occur in the benchmark; an item shorter than a window counts as one
window as a whole, recognised at the states its own path ends in.

The automaton is bounded: items are read in blocks of up to ``block_words``
words (``toLocalIterator``), each block makes one automaton, which is
broadcast, and its pass over the documents is narrow (no shuffle). With one
block, the usual case, documents are never shuffled; with more, the blocks'
spans are united per document by a group-by before the limits apply.

A document is contaminated if it is hit and at least 1/``share`` of its words
lie inside windows; ``without_contaminated`` drops contaminated documents,
``without_benchmark`` also cuts the spans of ``span_words`` hit words or more
out of the documents it keeps (the others stay as they are), and
``cleaned_texts`` cuts them out of all.

Defined results: null, empty or wordless texts have no word, no hit, and are
clean; null or wordless items match nothing; items with equal words are all
reported; a null item_id is left out of the item list but its text counts;
repeated document rows give a row each; other columns are ignored. An empty
benchmark hits nothing, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import ALNUM, alnum_words, batched, free_name, keyed, list_column

BLOCK_WORDS = 200_000
SPANS = "doc_id long, tag long, n_words long, spans array<int>, items array<string>"


class Automaton:
    """Suffix automaton of several word sequences; see the module's text."""

    def __init__(self, items: Sequence[tuple[str | None, Sequence[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            state = 0
            for word in words:
                state = self._grown(state, word)
        # the states of whole short items, and the items that hold each state's window
        whole: dict[int, list[tuple[int, str | None]]] = {}
        holders: dict[int, set] = {}
        for name, words in items:
            state, read = 0, 0
            for word in words:  # splits may have moved the path's states
                state = self.next[state][word]
                read += 1
                if len(words) >= window and read >= window:
                    at = state
                    while self.length[self.link[at]] >= window:
                        at = self.link[at]
                    holders.setdefault(at, set()).add(name)
            if 0 < len(words) < window:
                whole.setdefault(state, []).append((len(words), name))
        self.shortest = min([window] * bool(holders) + [len(w) for _, w in items if 0 < len(w) < window], default=0)
        # what a state reports: (holders of its last ``window`` words, short items that end there)
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.held: list[set | None] = [None] * len(self.link)
        self.short: list[list] = [[] for _ in self.link]
        for state in order:
            up = self.link[state]
            if self.length[state] >= window:
                self.held[state] = holders.get(state) if self.length[up] < window else self.held[up]
            self.short[state] = self.short[up] + whole.get(state, [])

    def _grown(self, last: int, word: bytes) -> int:
        """State of the sequence read so far extended by ``word`` (every suffix of it gets a path)."""
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            to = nxt[last][word]
            return to if length[to] == length[last] + 1 else self._split(last, word, to)
        new = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and word not in nxt[at]:
            nxt[at][word] = new
            at = link[at]
        if at != -1:
            to = nxt[at][word]
            link[new] = to if length[to] == length[at] + 1 else self._split(at, word, to)
        return new

    def _split(self, at: int, word: bytes, to: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(link)
        nxt.append(dict(nxt[to]))
        link.append(link[to])
        length.append(length[at] + 1)
        link[to] = copy
        while at != -1 and nxt[at].get(word) == to:
            nxt[at][word] = copy
            at = link[at]
        return copy

    def hits(self, words: Sequence[bytes]) -> tuple[list[int], set]:
        """Flat list of maximal hit spans (start, end, ...) and the names of the items that occur."""
        nxt, link, length = self.next, self.link, self.length
        window, shortest = self.window, self.shortest
        spans: list[int] = []
        names: set = set()
        if not shortest:
            return spans, names
        root = nxt[0]
        state = matched = 0
        edges = root
        for i, word in enumerate(words):
            to = edges.get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(word)
            if to is None:
                edges, matched = root, 0
                continue
            state, edges = to, nxt[to]
            matched += 1
            if matched < shortest:
                continue
            size = 0
            if matched >= window:
                size = window
                names |= self.held[state]
            for n, name in self.short[state]:
                if n <= matched:
                    size = max(size, n)
                    names.add(name)
            if size:
                start = i + 1 - size
                while spans and spans[-2] >= start:
                    del spans[-2:]
                if spans and spans[-1] >= start:
                    spans[-1] = i + 1
                else:
                    spans += (start, i + 1)
        names.discard(None)
        return spans, names


def _matched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            total, spans, items = [], [], []
            for text in batch.column("text"):
                words = alnum_words(text.as_py())
                at, names = automaton.hits(words)
                total.append(len(words))
                spans.append(np.array(at, np.int32))
                items.append(sorted(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(total, pa.int64()), list_column(spans, pa.int32()),
                 pa.array(items, pa.list_(pa.string()))], names=["doc_id", "tag", "n_words", "spans", "items"])
    return run


def blocks(benchmark: DataFrame, window: int, block_words: int, id_col: str, text_col: str) -> Iterator[Automaton]:
    """One automaton for every ``block_words`` words of items."""
    items, held = [], 0
    for row in benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        words = alnum_words(row["t"].encode() if row["t"] is not None else None)
        if words:
            items.append((row["i"], words))
            held += len(words)
        if held >= block_words:
            yield Automaton(items, window)
            items, held = [], 0
    if items:
        yield Automaton(items, window)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                   block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id") -> DataFrame:
    """One row per document: doc_id, tag, n_words, spans (start, end, ... of hit words), items (sorted), n_hit,
    n_items, items_sha256, contaminated."""
    rows = keyed(docs, id_col, text_col)
    context = rows.sparkSession.sparkContext
    passes = [rows.mapInArrow(_matched(context.broadcast(a)), SPANS)
              for a in blocks(benchmark, window, block_words, item_col, text_col)]
    if not passes:
        passes = [rows.mapInArrow(_matched(context.broadcast(Automaton([], window))), SPANS)]
    found = passes[0]
    if len(passes) > 1:
        found = _united(passes)
    pairs = F.expr("transform(sequence(0, size(spans) - 1, 2), i -> spans[i + 1] - spans[i])")
    hit = F.when(F.size("spans") > 0, F.aggregate(pairs, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))
    return (found.withColumn("n_hit", hit)
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))))


def with_cuts(batch: pa.RecordBatch, spans: Sequence[Sequence[int] | None], span_words: int | None, text_col: str,
              chars_col: str | None) -> pa.RecordBatch:
    """The rows without their hit spans of ``span_words`` words or more (None: unchanged), their lengths in ``chars_col``."""
    if span_words is None or not any(spans):
        return batch
    column = batch.column(text_col)
    texts, chars = column.cast(pa.binary()).to_pylist(), batch.column(chars_col).to_pylist() if chars_col else []
    for i, at in enumerate(spans):
        cut = without_spans(texts[i], at, span_words)
        if cut != texts[i] and chars_col:
            chars[i] = len(cut.decode())
        texts[i] = cut
    new = {text_col: pa.array(texts, pa.binary()).cast(column.type)}
    if chars_col:
        new[chars_col] = pa.array(chars, batch.column(chars_col).type)
    names = batch.schema.names
    return pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in names], names=names)


def _clean_rows(shared, text_col: str, share: int, span_words: int | None, chars_col: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            keep, found = [], []
            for text in batch.column(text_col).cast(pa.binary()):
                words = alnum_words(text.as_py())
                spans, _ = automaton.hits(words)
                hit = sum(spans[1::2]) - sum(spans[::2])
                keep.append(not hit or hit * share < len(words))
                if keep[-1]:
                    found.append(spans)
            yield with_cuts(batch.filter(pa.array(keep, pa.bool_())), found, span_words, text_col, chars_col)
    return run


def _cut_rows(spans_col: str, span_words: int, text_col: str, chars_col: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select([n for n in batch.schema.names if n != spans_col])
            yield with_cuts(rows, batch.column(spans_col).to_pylist(), span_words, text_col, chars_col)
    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                         block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text",
                         item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    return without_benchmark(docs, benchmark, window, share, None, block_words, id_col, text_col, item_col)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                      span_words: int | None = 13, block_words: int = BLOCK_WORDS, id_col: str = "doc_id",
                      text_col: str = "text", item_col: str = "item_id", chars_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, without their hit spans of ``span_words`` words or more; texts
    that lose spans have their new length in ``chars_col``."""
    found = list(islice(blocks(benchmark, window, block_words, item_col, text_col), 2))
    if len(found) < 2:
        shared = docs.sparkSession.sparkContext.broadcast(found[0] if found else Automaton([], window))
        return docs.mapInArrow(_clean_rows(shared, text_col, share, span_words, chars_col), docs.schema)
    names = {c: free_name(docs, f"{c}_found") for c in ("doc_id", "tag", "spans", "contaminated")}
    hits = (benchmark_hits(docs, benchmark, window, share, block_words, id_col, text_col, item_col).filter("n_hit > 0")
            .select(*[F.col(c).alias(n) for c, n in names.items()]).distinct())
    joined = docs.join(hits, docs[id_col].cast("long").eqNullSafe(hits[names["doc_id"]])
                       & (F.xxhash64(docs[text_col]) == hits[names["tag"]]), "left")
    kept = joined.filter(~F.coalesce(F.col(names["contaminated"]), F.lit(False)))
    if span_words is None:
        return kept.select(*[docs[c] for c in docs.columns])
    return (kept.select(*[docs[c] for c in docs.columns], names["spans"])
            .mapInArrow(_cut_rows(names["spans"], span_words, text_col, chars_col), docs.schema))


def _united(passes: list[DataFrame]) -> DataFrame:
    """Spans and items of all blocks per document; rows equal in doc_id and text keep their number."""
    rows = passes[0].withColumn("block", F.lit(0))
    for i, other in enumerate(passes[1:], 1):
        rows = rows.unionByName(other.withColumn("block", F.lit(i)))
    starts = F.expr("transform(spans, (x, i) -> CASE WHEN i % 2 = 0 THEN struct(x AS a, spans[i + 1] AS b) END)")
    rows = rows.withColumn("spans", F.filter(starts, lambda s: s.isNotNull()))
    together = rows.groupBy("doc_id", "tag", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sum((F.col("block") == 0).cast("int")).alias("copies"))
    merged = F.expr("""
        aggregate(spans, cast(array() AS array<int>), (acc, s) ->
            CASE WHEN size(acc) > 0 AND acc[size(acc) - 1] >= s.a
                 THEN concat(slice(acc, 1, size(acc) - 1), array(greatest(acc[size(acc) - 1], s.b)))
                 ELSE concat(acc, array(s.a, s.b)) END)""")
    return (together.withColumn("spans", merged).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
            .select("doc_id", "tag", "n_words", "spans", "items"))


def _cut(span_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batched(zip(*[batch.column(c) for c in range(batch.num_columns)], strict=True), 1000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0].as_py() for r in some], pa.int64()), pa.array([r[1].as_py() for r in some], pa.int64()),
                     pa.array([without_spans(r[2].as_py(), r[3].as_py(), span_words) for r in some], pa.binary())
                     .cast(pa.string())], names=["doc_id", "tag", "cleaned"])
    return run


def without_spans(text: bytes | None, spans: Sequence[int] | None, span_words: int) -> bytes | None:
    """The text without the bytes of hit spans of ``span_words`` words or more."""
    if text is None or not spans:
        return text
    mapped = text.translate(ALNUM)
    places, at = [], 0
    for word in mapped.split():
        at = mapped.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    out, last = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        if b - a >= span_words:
            out.append(text[last:places[a][0]])
            last = places[b - 1][1]
    return b"".join([*out, text[last:]])


def cleaned_texts(docs: DataFrame, benchmark: DataFrame, window: int = 13, span_words: int = 13, **columns) -> DataFrame:
    """(doc_id, tag, cleaned): every text without its hit spans of ``span_words`` words or more."""
    hits = benchmark_hits(docs, benchmark, window, **columns).select("doc_id", "tag", "spans").distinct()
    rows = keyed(docs, columns.get("id_col", "doc_id"), columns.get("text_col", "text"))
    joined = rows.join(hits, rows["doc_id"].eqNullSafe(hits["doc_id"]) & (rows["tag"] == hits["tag"]))
    return (joined.select(rows["doc_id"], rows["tag"], rows["text"], hits["spans"])
            .mapInArrow(_cut(span_words), "doc_id long, tag long, cleaned string"))


