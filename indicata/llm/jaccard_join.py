"""N-gram Jaccard self-join with PartEnum signatures, and its components.

A document's set holds its distinct shingles of ``words`` consecutive words.
Two sets of sizes a, b with Jaccard >= num/den differ in at most
``k = (den - num) * (a + b) // (den + num)`` elements. Sizes fall into bands;
within a band the hashed shingle domain is cut into first-level parts of
``subs`` sub-parts each. Among any ``k // 2 + 1`` parts at least one holds at
most one differing element, so all but one of its sub-parts agree: every set
emits, for each part, one signature per subset of ``subs - 1`` sub-parts, and
two similar sets share one of them. A set goes through the parts in a fixed
order until ``k // 2 + 1`` of them were *good* (every subset holds
``MIN_FEATURES`` shingles or more) and emits only subsets that large; a set
that runs out of parts emits all of its subsets. Either way similar sets
still share a signature (the part that agrees is good for one of the two, and
the other one reaches it or emits everything).

Steps, all Spark jobs: sets and signatures per document; equal sets fall
together (one group-by); signatures that two sets share name a hub (their
smallest doc_id), and every set is compared with its hubs only; after the
connected components of those links, pairs of one signature that are still in
different components are compared too. Pairs inside one component are never
listed. A parity sketch, of 1024 bits or more as the set grows, bounds the
number of differing elements from below and drops hopeless pairs before their
texts are read; each pair left is verified on the exact sets. Signatures have
48 bits: a chance collision costs one comparison of sketches.

Defined results: a text with fewer words than a shingle has one shingle (its
whole sequence); null, empty or blank texts have no shingle, link with
nothing and are their own component; a null doc_id gets a null component and
links with nothing; rows that repeat a doc_id are one document that links if
any of its texts does (each row has its own shingle count). Other columns are
ignored, so their names cannot clash. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import U64, Steps, WordHashes, batched, list_column, lower_words, mixed, rolling, signed
from indicata.llm.components import component_labels

MIN_FEATURES = 1  # asking for more makes most sets run out of parts, and those emit empty subsets too
BAND_GROWTH = 1.6
WIDE_SET = 400
SKETCH_WORDS = 16  # of the smallest sketch; a power of two
SIGN_BITS = U64((1 << 48) - 1)
GROUP_ROWS = 256
DIGEST = "doc_id long, n_shingles long, key1 long, key2 long, sketch array<long>, signs array<long>"


def shingle_set(text: bytes | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    tokens = lower_words(text)
    if not tokens:
        return np.empty(0, U64)
    return np.unique(rolling(hashes.of(tokens), min(words, len(tokens))))


def band_starts(limit: int) -> list[int]:
    starts = [1]
    while starts[-1] <= limit:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_GROWTH)))
    return starts


def signatures(features: np.ndarray, num: int, den: int, starts: list[int]) -> np.ndarray:
    """PartEnum signatures of one sorted set of hashes (see the module's text)."""
    size = len(features)
    largest = size * den // num
    home = int(np.searchsorted(starts, size, "right")) - 1
    last = int(np.searchsorted(starts, largest, "right")) - 1
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(features + U64(0x5851F42D4C957F2D)))])
    high = features >> U64(32)
    out = []
    for band in range(home, last + 1):
        top = starts[band + 1] - 1
        k = (den - num) * (size + min(top, largest)) // (den + num)
        if k == 0:  # only equal sets qualify, and those are found without signatures
            continue
        subs = 3 if top <= WIDE_SET else 2
        enough = (den - num) * 2 * top // (den + num) // 2 + 1
        parts = enough if enough == 1 else enough + max(1, enough * 3 // 20)
        cells = parts * subs
        place = (high * U64(cells)) >> U64(32)
        edges = np.searchsorted(place, np.arange(cells + 1, dtype=U64))
        count = np.diff(edges).reshape(parts, subs)
        part_sum = (sums[edges[1:]] - sums[edges[:-1]]).reshape(parts, subs)
        total = count.sum(1)
        good = np.cumsum((total - count.max(1)) >= MIN_FEATURES)
        need = k // 2 + 1
        reached = int(np.searchsorted(good, need)) + 1
        full = reached > parts
        reached = min(reached, parts)
        for left_out in range(subs):
            kept = [s for s in range(subs) if s != left_out]
            value = part_sum[:reached, kept[0]] * U64(0xC2B2AE3D27D4EB4F)
            for s in kept[1:]:
                value = mixed(value + part_sum[:reached, s]) * U64(0x165667B19E3779F9)
            value = mixed(value + np.arange(reached, dtype=U64) * U64(0x27D4EB2F165667C5)
                          + U64((band * 8 + left_out) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            if not full:
                value = value[(total - count[:, left_out])[:reached] >= MIN_FEATURES]
            out.append(value)
    return np.concatenate(out) & SIGN_BITS if out else np.empty(0, U64)


def sketch_words(size: int) -> int:
    """Length of a set's sketch: a power of two with at least three bits for every four elements, so that the sketches
    of unlike sets differ in more bits than the similarity allows, whatever their size."""
    words = SKETCH_WORDS
    while 64 * words * 4 < 3 * size:
        words *= 2
    return words


def parity_sketch(features: np.ndarray) -> np.ndarray:
    """Bit i: parity of the number of shingles hashed to i. Two sketches differ in at most as many bits as the sets; the
    two halves of a sketch, combined by exclusive or, are the next smaller one."""
    words = sketch_words(len(features))
    bits = np.bincount((mixed(features) & U64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _digest(words: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, starts = WordHashes(), band_starts(64)
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)
            for some in batched(rows, 500):
                ids, sizes, keys, more, sketches, signs = [], [], [], [], [], []
                for doc_id, text in some:
                    features = shingle_set(text.as_py(), words, hashes)
                    if len(features) * den // num >= starts[-2]:
                        starts = band_starts(4 * len(features))
                    ids.append(doc_id)
                    sizes.append(len(features))
                    keys.append(np.bitwise_xor.reduce(mixed(features ^ U64(0xA0761D6478BD642F))))
                    more.append(np.add.reduce(mixed(features + U64(0xE7037ED1A0B428DB))))
                    sketches.append(parity_sketch(features))
                    signs.append(signed(signatures(features, num, den, starts)) if len(features) else
                                 np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(signed(np.array(keys, U64))),
                     pa.array(signed(np.array(more, U64))), list_column(sketches, pa.int64()),
                     list_column(signs, pa.int64())],
                    names=["doc_id", "n_shingles", "key1", "key2", "sketch", "signs"])
    return run


def _compared(words: int, num: int, den: int):
    """Rows come sorted by (hub, part, the hub itself first): keep the hub's set, compare the rest with it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        hub, sets = None, []
        for batch in batches:
            found = []
            for a, b, text in zip(batch.column("hub").to_pylist(), batch.column("doc_id").to_pylist(),
                                  batch.column("text"), strict=True):
                own = shingle_set(text.as_py(), words, hashes)
                if a == b:
                    sets = [*sets, own] if a == hub else [own]  # more than one if a doc_id has several texts
                    hub = a
                    continue
                for features in sets if a == hub else ():
                    both = len(np.intersect1d(features, own, assume_unique=True))
                    if den * both >= num * (len(features) + len(own) - both):
                        found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)],
                                                 names=["a", "b"])
    return run


def _differing(x: Column, y: Column) -> Column:
    """Bits in which two sketches differ, the longer one folded to half its length if they aren't equally long; 0 (no
    bound) for sketches further apart, whose sets are similar at less than one half only."""
    length, longest = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y))

    def folded(sketch: Column) -> Column:
        halves = F.zip_with(F.slice(sketch, 1, length), F.slice(sketch, length + 1, length), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(sketch) > length, halves).otherwise(sketch)
    bits = F.zip_with(folded(x), folded(y), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.when(longest <= 2 * length, F.aggregate(bits, F.lit(0), lambda n, more: n + more)).otherwise(0)


def _allowed(num: int, den: int, x: str, y: str) -> Column:
    """Sizes and parity sketches of sides ``x`` and ``y`` allow the similarity."""
    size_x, size_y, sketch_x, sketch_y = (F.col(f"{c}_{side}") for c in ("size", "sketch") for side in (x, y))
    small = reduce(add, [F.bit_count(sketch_x[i].bitwiseXOR(sketch_y[i])) for i in range(SKETCH_WORDS)])
    differing = F.when(F.greatest(F.size(sketch_x), F.size(sketch_y)) == SKETCH_WORDS, small).otherwise(_differing(sketch_x, sketch_y))
    bound = F.floor((size_x + size_y) * (den - num) / F.lit(den + num))
    return (size_x * den >= size_y * num) & (size_y * den >= size_x * num) & (differing <= bound)


def _sketched(sketches: DataFrame, side: str) -> DataFrame:
    return sketches.select(F.col("doc_id").alias(side), F.col("n_shingles").alias(f"size_{side}"),
                           F.col("sketch").alias(f"sketch_{side}"))


def _hopeful(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose sizes and parity sketches allow the similarity."""
    return (pairs.join(_sketched(sketches, "a"), "a").join(_sketched(sketches, "b"), "b")
            .filter(_allowed(num, den, "a", "b")).select("a", "b").distinct())


def _verified(pairs: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links among ``pairs`` (a, b). Each group of up to GROUP_ROWS partners of one ``a`` meets in one place."""
    sized = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("n")), "a")
    slot = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / GROUP_ROWS))
    members = sized.select(F.col("a").alias("hub"), slot.alias("slot"), F.col("b").alias("doc_id"))
    hubs = members.select("hub", "slot", F.col("hub").alias("doc_id")).distinct()
    rows = members.unionByName(hubs).join(texts, "doc_id")
    met = (rows.repartition("hub", "slot")
           .sortWithinPartitions("hub", "slot", (F.col("doc_id") != F.col("hub"))))
    return met.select("hub", "doc_id", "text").mapInArrow(_compared(words, num, den), "a long, b long")


def _texts(source: DataFrame, pairs: DataFrame) -> DataFrame:
    named = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    return source.join(named, "doc_id")


def _mixed(met: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """The members of signatures that lie in different components, with their sketches."""
    at = (met.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
          .select("sign", "rep", F.coalesce("component", "rep").alias("part")))
    sizes = at.groupBy("sign", "part").agg(F.count("*").alias("n"))
    mixed_signs = (sizes.groupBy("sign").agg(F.count("*").alias("parts"), F.max_by("part", F.struct("n", "part")).alias("main"))
                   .filter("parts > 1").select("sign", "main"))
    return at.join(mixed_signs, "sign").join(_sketched(sketches, "rep"), "rep")


def _across(at: DataFrame, num: int, den: int) -> DataFrame:
    """Hopeful pairs of sets that share a signature but lie in different components so far.

    Per signature, members outside its largest component meet the others;
    members of one component never meet each other. The sketches travel with
    the members, so hopeless pairs (texts that share a common passage, say)
    are never made.
    """
    minor, other = (at.select("sign", F.col("rep").alias(side), F.col("part").alias(f"part_{side}"),
                              F.col("size_rep").alias(f"size_{side}"), F.col("sketch_rep").alias(f"sketch_{side}"),
                              (F.col("part") == F.col("main")).alias(f"main_{side}")) for side in "xy")
    minor = minor.filter(~F.col("main_x"))
    once = (F.col("part_x") != F.col("part_y")) & (F.col("main_y") | (F.col("x") < F.col("y")))
    return (minor.join(other, (minor["sign"] == other["sign"]) & once & _allowed(num, den, "x", "y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_equal (documents with the same set)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    steps = Steps(docs.sparkSession, "jaccard-join")
    digest = steps.write(source.mapInArrow(_digest(words, num, den), DIGEST), "sets", "zstd")
    filled = digest.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    same_set = ["n_shingles", "key1", "key2"]
    classes = steps.write(filled.groupBy(*same_set).agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n_equal"), F.first("sketch").alias("sketch")), "classes")

    signs = filled.select("doc_id", F.explode("signs").alias("sign"))
    # a step of its own, so that the group-by's shuffle files are gone before the join's are written
    hubs = steps.write(signs.groupBy("sign").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n"))
                       .filter("n > 1").select("sign", "hub"), "hubs")
    shared = steps.write(signs.join(hubs, "sign"), "shared")
    slim = steps.write(digest.drop("sketch", "signs"), "documents")
    steps.drop(digest, hubs)
    members = (slim.join(classes.select(*same_set, "rep"), same_set).filter(F.col("doc_id").isNotNull()).select("doc_id", "rep"))
    met = steps.write(shared.join(members.distinct(), "doc_id").select("sign", "hub", "rep").distinct(), "met")
    steps.drop(shared)

    sketches = classes.select(F.col("rep").alias("doc_id"), "n_shingles", "sketch")
    stars = met.select(F.col("hub").alias("a"), F.col("rep").alias("b")).filter("a <> b").distinct()
    stars = steps.write(_hopeful(stars, sketches, num, den), "stars")
    texts = steps.write(_texts(source, stars), "texts")
    links = steps.write(_verified(stars, texts, words, num, den), "links")
    labels = component_labels(links, steps)
    mixed_members = steps.write(_mixed(met, labels, sketches), "mixed")
    steps.drop(met, texts)
    across = steps.write(_across(mixed_members, num, den).join(stars, ["a", "b"], "left_anti"), "across")
    steps.drop(mixed_members)
    if not across.isEmpty():
        texts = steps.write(_texts(source, across), "texts")
        more = steps.write(_verified(across, texts, words, num, den), "links")
        steps.drop(texts)
        labels = component_labels(links.union(more), steps)
    part = (classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
            .select(*same_set, F.coalesce("component", "rep").alias("component_id"), "n_equal"))
    found = slim.join(part, same_set, "left")
    known = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return found.select("doc_id", "n_shingles",
                        F.when(known, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                        F.when(known, F.col("n_equal")).otherwise(F.lit(1)).alias("n_equal"))
