"""Substring deduplication behind a count-min prefilter.

A window is ``size`` consecutive words of one document. Every word covered by
a window whose word sequence also starts earlier (smaller doc_id, or same
document and earlier start) goes.

Pass 1 builds count-min sketches. To keep them small a window is counted by
its anchor: the leftmost smallest hash among its runs of ``gram`` words. Equal
windows have their anchors at equal offsets, so an anchor value occurs at
least as often as any window that has it: the sketch never underestimates.
Each partition sends its counts as sorted cell numbers per sketch slice; a
slice is merged from a stream of such pieces in constant memory, whatever
their number, and only "counted twice or more" bits (``depth`` rows) reach
the driver and the second pass. The sketch has ``CELLS_PER_ANCHOR`` cells for
every expected anchor, up to ``max_cells``; at that bound, ``max_cells / 8``
bytes are broadcast (64 MB), and a fuller sketch only lets more windows into
the second pass.

Pass 2 hashes all windows again and keeps those estimated at two or more.
Inside a chunk of documents the earliest of equal windows stands for the others,
which are repeats already; so a very common window sends one row per chunk to
the exact group-by, not one per occurrence. There, rows after the earliest
one of a window are repeats. Their starts return to the documents.

Defined results: null, empty or blank texts and texts shorter than a window
lose nothing; a null doc_id counts as the largest one; rows that repeat a
doc_id stand at the same place, so neither is earlier than the other at the
same start; words are compared as they are (64-bit hashes stand for
windows). Other columns are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm.common import LAST_ID, U64, WordHashes, free_name, keyed, list_column, rolling, signed, space_words

GRAM = 10
DEPTH = 2
SLICE_BITS = 20
CELLS_PER_ANCHOR = 16
CHUNK_WORDS = 1 << 20
ROW_SALTS = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xE7037ED1A0B428DB, 0xA0761D6478BD642F)


def chunks(batches: Iterator[pa.RecordBatch], hashes: WordHashes) -> Iterator[tuple]:
    """(ids, tags, word hashes, first word of each document) of documents with CHUNK_WORDS words together."""
    ids, tags, parts, held = [], [], [], 0
    for batch in batches:
        for doc_id, tag, text in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(),
                                     batch.column("text"), strict=True):
            words = space_words(text.as_py())
            ids.append(LAST_ID if doc_id is None else doc_id)
            tags.append(tag)
            parts.append(hashes.of(words))
            held += len(words)
            if held >= CHUNK_WORDS:
                yield _packed(ids, tags, parts)
                ids, tags, parts, held = [], [], [], 0
    if ids:
        yield _packed(ids, tags, parts)


def _packed(ids, tags, parts) -> tuple:
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    parts = [parts[i] for i in order]
    starts = np.cumsum([0, *map(len, parts)])
    return np.array(ids, np.int64)[order], np.array(tags, np.int64)[order], np.concatenate(parts), starts


def inside(starts: np.ndarray, total: int, size: int) -> np.ndarray:
    """Which of the runs of ``size`` words lie in one document."""
    ok = np.ones(max(0, total - size + 1), bool)
    for back in range(1, size):
        at = starts[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


def leftmost_least(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Value and place of the leftmost smallest entry of every ``width`` consecutive ones."""
    value, place = grams, np.arange(len(grams), dtype=np.int32)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(value) - step
        later = value[step:] < value[:n]
        value = np.where(later, value[step:], value[:n])
        place = np.where(later, place[step:], place[:n])
        reach += step
    return value, place


def cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    x = (anchors ^ U64(ROW_SALTS[row])) * U64(ROW_SALTS[(row + 1) % 4] | 1)
    return (x ^ (x >> U64(29))) * U64(0xBF58476D1CE4E5B9) >> U64(64 - bits)


def _sketch(size: int, bits: int):
    """Per partition and slice: sorted numbers of the cells counted once, and of those counted more often."""
    low = min(bits, SLICE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, h, starts in chunks(batches, WordHashes()):
            ok = inside(starts, len(h), size)
            if not ok.any():
                continue
            value, place = leftmost_least(rolling(h, GRAM), size - GRAM + 1)
            place = place[ok]
            first = np.ones(len(place), bool)
            first[1:] = place[1:] != place[:-1]  # neighbours share anchors; places never go back
            anchors = value[ok][first]
            for row in range(DEPTH):
                at, n = np.unique(cells(anchors, row, bits), return_counts=True)
                cut = np.searchsorted(at >> U64(low), np.arange((1 << bits - low) + 1, dtype=U64))
                full = [s for s in range(len(cut) - 1) if cut[s] < cut[s + 1]]
                local = (at & U64((1 << low) - 1)).astype(np.uint32)
                many = np.minimum(n, 2).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(full), pa.int32()), pa.array(full, pa.int32()),
                     pa.array([local[cut[s]:cut[s + 1]].tobytes() for s in full], pa.binary()),
                     pa.array([np.packbits(many[cut[s]:cut[s + 1]] > 1).tobytes() for s in full], pa.binary())],
                    names=["row", "slice", "cells", "many"])
    return run


def _merged(bits: int):
    """Slices arrive whole and in order; counters saturate at two."""
    low = min(bits, SLICE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                 pa.array([np.packbits(count > 1).tobytes()], pa.binary())], names=["row", "slice", "bits"])
        key, count = None, np.zeros(0, np.uint8)
        for batch in batches:
            for row in batch.to_pylist():
                if (row["row"], row["slice"]) != key:
                    if key is not None:
                        yield packed()
                    key, count = (row["row"], row["slice"]), np.zeros(1 << low, np.uint8)
                at = np.frombuffer(row["cells"], np.uint32)
                more = np.unpackbits(np.frombuffer(row["many"], np.uint8), count=len(at))
                count[at] = np.minimum(count[at] + 1 + more, 2)
        if key is not None:
            yield packed()
    return run


def repeat_sketch(rows: DataFrame, size: int, max_cells: int) -> tuple[int, list[np.ndarray]]:
    """Bits per row of the sketch, and for each row the packed bits of the cells counted twice or more."""
    length = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    anchors = length / 6 * 2 / (size - GRAM + 2)  # about six bytes a word
    wanted = max(1 << 16, min(max_cells, int(anchors * CELLS_PER_ANCHOR))) // DEPTH
    bits = wanted.bit_length() - 1
    low = min(bits, SLICE_BITS)
    pieces = rows.mapInArrow(_sketch(size, bits), "row int, slice int, cells binary, many binary")
    merged = (pieces.repartition("row", "slice").sortWithinPartitions("row", "slice")
              .mapInArrow(_merged(bits), "row int, slice int, bits binary"))
    sketch = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(DEPTH)]
    for part in merged.toLocalIterator():
        piece = np.frombuffer(part["bits"], np.uint8)
        sketch[part["row"]][part["slice"] * len(piece):(part["slice"] + 1) * len(piece)] = piece
    assert low >= 3
    return bits, sketch


def _estimated(size: int, bits: int, shared):
    """Windows the sketch counts twice or more; repeats inside the chunk come as runs (start, words > 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for ids, tags, h, starts in chunks(batches, WordHashes()):
            ok = inside(starts, len(h), size)
            value, _ = leftmost_least(rolling(h, GRAM), size - GRAM + 1)
            at = np.flatnonzero(ok)
            for row in range(DEPTH):
                cell = cells(value[at], row, bits)
                at = at[(sketch[row][(cell >> U64(3)).astype(np.int64)] >> (7 - (cell & U64(7))).astype(np.uint8)) & 1 > 0]
            if not len(at):
                continue
            window = rolling(h, size)[at]
            doc = np.searchsorted(starts, at, "right") - 1
            pos = at - starts[doc]
            repeated = (ids[1:] == ids[:-1]).any()  # rows of one doc_id stand in any order, so their positions count
            order = np.lexsort((pos, ids[doc], window)) if repeated else np.argsort(window, kind="stable")
            lead = np.ones(len(at), bool)
            lead[1:] = window[order][1:] != window[order][:-1]
            first = order[np.maximum.accumulate(np.where(lead, np.arange(len(at)), 0))]
            later = np.empty(len(at), bool)
            later[order] = (ids[doc[first]] != ids[doc[order]]) | (pos[first] != pos[order])
            run_start = later.copy()
            run_start[1:] &= ~later[:-1] | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
            heads = np.flatnonzero(run_start)
            spans = np.add.reduceat(later.astype(np.int64), heads) if len(heads) else np.empty(0, np.int64)
            ends = np.r_[heads[1:], len(at)] if len(heads) else heads
            # a run ends where ``later`` stops, so counting ``later`` up to the next head is its length
            assert len(heads) == 0 or (spans <= ends - heads).all()
            alone = np.flatnonzero(~later)
            pick = np.r_[alone, heads]
            length = np.r_[np.zeros(len(alone), np.int64), spans]
            key = np.r_[window[alone], window[heads] ^ (at[heads].astype(U64) * U64(ROW_SALTS[0]))]
            for a in range(0, len(pick), 1 << 17):
                s = slice(a, a + (1 << 17))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(key[s])), pa.array(ids[doc[pick[s]]]), pa.array(tags[doc[pick[s]]]),
                     pa.array(pos[pick[s]].astype(np.int32)), pa.array(length[s].astype(np.int32))],
                    names=["window", "doc_id", "tag", "pos", "run"])
    return run


def kept_words(text: bytes | None, runs: np.ndarray | None, size: int) -> tuple[list[bytes], int, np.ndarray]:
    """Words outside the repeated windows, the number of all words, and the removed spans (start, end, ...)."""
    words = space_words(text)
    if runs is None:
        return words, len(words), np.empty(0, np.int32)
    start, length = runs & 0xFFFFFFFF, runs >> 32
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + length + size - 1, -1)
    cover = (np.cumsum(cover)[:-1] > 0).astype(np.int8)
    spans = np.flatnonzero(np.diff(np.r_[0, cover, 0])).astype(np.int32)
    return [w for w, c in zip(words, cover.tolist(), strict=True) if not c], len(words), spans


def _without(size: int):
    """Words outside the repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept, spans = [], [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
                words, n, removed = kept_words(text.as_py(), runs.values.to_numpy() if runs.is_valid else None, size)
                total.append(n)
                spans.append(removed)
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), list_column(spans, pa.int32()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                names=["doc_id", "tag", "n_words", "n_removed", "kept", "removed", "kept_sha256"])
    return run


def repeated_starts(rows: DataFrame, size: int, max_cells: int) -> DataFrame:
    """(doc_id, tag, runs) of the documents with windows to remove; runs: start + length * 2^32."""
    bits, sketch = repeat_sketch(rows, size, max_cells)
    shared = rows.sparkSession.sparkContext.broadcast(sketch)
    likely = rows.mapInArrow(_estimated(size, bits, shared), "window long, doc_id long, tag long, pos int, run int")
    same = Window.partitionBy("window", F.col("run") > 0)
    place = F.struct("doc_id", "pos")
    return (likely.withColumn("first", F.min(place).over(same))
            .filter((F.col("run") > 0) | (place > F.col("first")))
            .groupBy("doc_id", "tag")
            .agg(F.collect_list(F.col("pos") + F.shiftleft(F.greatest("run", F.lit(1)).cast("long"), 32)).alias("runs")))


def _rewritten(size: int, text_col: str, chars_col: str | None, runs_col: str):
    """Rows with windows to remove get the kept words, joined by a space; the others stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, chars = [], batch.column(chars_col).to_pylist() if chars_col else []
            for i, (text, runs) in enumerate(zip(batch.column(text_col), batch.column(runs_col), strict=True)):
                text = text.as_py()
                if runs.is_valid:
                    words, _, _ = kept_words(text.encode(), runs.values.to_numpy(), size)
                    text = b" ".join(words).decode()
                    if chars_col:
                        chars[i] = len(text)
                texts.append(text)
            new = {text_col: texts, **({chars_col: chars} if chars_col else {})}
            names = [n for n in batch.schema.names if n != runs_col]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[n], batch.schema.field(n).type) if n in new else batch.column(n) for n in names], names=names)
    return run


def deduplicated(docs: DataFrame, size: int = 20, max_cells: int = 1 << 29, id_col: str = "doc_id",
                 text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``; texts that lose windows are rewritten (and their length in ``chars_col``)."""
    found = repeated_starts(keyed(docs, id_col, text_col), size, max_cells)
    names = {c: free_name(docs, f"{c}_found") for c in ("doc_id", "tag", "runs")}
    found = found.select(*[F.col(c).alias(n) for c, n in names.items()])
    on = ((F.coalesce(docs[id_col].cast("long"), F.lit(LAST_ID)) == found[names["doc_id"]])
          & (F.xxhash64(docs[text_col]) == found[names["tag"]]))
    joined = docs.join(found, on, "left").drop(names["doc_id"], names["tag"])
    return joined.mapInArrow(_rewritten(size, text_col, chars_col, names["runs"]), docs.schema)


def without_repeats(docs: DataFrame, size: int = 20, max_cells: int = 1 << 29, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, tag, n_words, n_removed, kept (text), removed (word spans: start, end, ...),
    kept_sha256."""
    if size <= GRAM:
        raise ValueError(f"a window needs more than {GRAM} words")
    rows = keyed(docs, id_col, text_col)
    runs = repeated_starts(rows, size, max_cells)
    found = (rows.join(runs, (F.coalesce(rows["doc_id"], F.lit(LAST_ID)) == runs["doc_id"]) & (rows["tag"] == runs["tag"]),
                       "left").select(rows["doc_id"], rows["tag"], rows["text"], runs["runs"]))
    return found.mapInArrow(_without(size), "doc_id long, tag long, n_words long, n_removed long, kept string, "
                                            "removed array<int>, kept_sha256 string")
