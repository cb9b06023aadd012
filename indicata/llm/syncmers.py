"""Document fingerprints of closed syncmers, in DataFrame functions only.

The letters are the words of a text (split at white space) as 64-bit hashes;
a word of more than ``LONG`` characters gives a letter for each of them, so
scripts without spaces and minified code have anchors like any other text.
A run of ``k`` letters is a closed syncmer if the smallest hash among its inner
runs of ``s`` letters is that of its first or its last inner run. Whether a run
is chosen depends on its own letters alone, so equal passages give equal
anchors wherever they stand. A run of k letters is only sure to be chosen in
texts of ``SURE`` = 2k - s - 1 letters or more, so a fingerprint has levels:
single letters below 2 * ``PAIRS`` letters, pairs (k = 2, s = 1, where every run
is a closed syncmer) from ``PAIRS`` to below 2 * ``SURE``, and runs of k letters
from ``SURE`` on. Levels overlap, so texts of nearly the same length share one,
and only a text without words has no anchor.

A fingerprint lists its anchors level by level, in text order: 2 bits of level
and a hash of 29 bits each, eight hexadecimal digits in print. The likeness of
two fingerprints is the Dice coefficient of their distinct anchors on the levels
both list; 1 for two empty ones, 0 where no level is in both (one text then has
less than half the letters of the other). Nothing but the two lists decides it.

``edited_fingerprints`` also fingerprints every text with its second half
replaced by the beginning of the next text in doc_id order. The next text
comes without a global sort: doc_id ranges (approximate percentiles, a bounded
list of numbers) are the windows, and the first document of each range is also
sent to the range before it. Texts are shuffled once. The list of ranges is one
literal of the plan and is searched in two steps of its square root.

Defined results: null texts are empty ones; null doc_ids come first; rows that
repeat a doc_id are ordered by the hash of their text, and exact repeats come
in any order (they are equal); the rows of one doc_id are one range. A single
row is its own next. Other columns are ignored. An empty table gives an empty
one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 8, 2
SURE, PAIRS = 2 * K - S - 1, 4
LONG = 32
HASH_BITS = 29
FIRST_ID = -(1 << 63)


def word_hashes(text: Column) -> Column:
    """array<long>: one hash per letter, that is per word, or per character of a long word."""
    plain = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    cut = F.flatten(F.transform(words, lambda w: F.when(F.char_length(w) > LONG, F.split(w, "")).otherwise(F.array(w))))
    letters = F.when(plain.rlike(f"[^ ]{{{LONG + 1}}}"), cut).otherwise(words)
    return F.transform(letters, lambda w: F.xxhash64(w))


def inner_hashes(hashes: Column) -> Column:
    """Hashes of the inner runs of two words."""
    n = F.greatest(F.size(hashes) - 1, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, 2, n), lambda x, y: F.xxhash64(x, y))


def anchor(h: Column, level: int) -> Column:
    return (F.shiftrightunsigned(h, 64 - HASH_BITS) + F.lit(level << HASH_BITS)).cast("int")


def level(a: Column) -> Column:
    return F.shiftright(a, HASH_BITS)


def anchors(hashes: Column, inner: Column) -> Column:
    """array<int>: the anchors of every level that the text's length lists, each level in text order."""
    n = F.size(hashes)
    reach = K - S + 1  # inner runs of a syncmer

    def chosen(i: Column) -> Column:
        ends = F.least(F.get(inner, i), F.get(inner, i + reach - 1))
        return F.array_min(F.slice(inner, i + 1, reach)) == ends

    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - K, F.lit(0))), chosen)
    runs = F.transform(starts, lambda i: anchor(F.xxhash64(F.slice(hashes, i + 1, K)), 2))
    pairs = F.transform(inner, lambda h: anchor(h, 1))
    single = F.transform(hashes, lambda h: anchor(h, 0))
    return (F.when(n >= 2 * SURE, runs).when(n >= SURE, F.concat(pairs, runs)).when(n >= 2 * PAIRS, pairs)
            .when(n >= PAIRS, F.concat(single, pairs)).otherwise(single))


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out`` = anchors of the column ``text``. Each step is a column of its own, so no step runs per element."""
    steps = df.withColumn("_h", word_hashes(F.col(text))).withColumn("_i", inner_hashes(F.col("_h")))
    return steps.withColumn(out, anchors(F.col("_h"), F.col("_i"))).drop("_h", "_i")


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two fingerprints on the levels that both list (levels are listed in order, without gaps)."""
    least = [level(F.get(x, F.lit(0))) for x in (a, b)]
    most = [level(F.get(x, F.size(x) - 1)) for x in (a, b)]
    low, high = F.greatest(*least), F.least(*most)
    same = (least[0] == least[1]) & (most[0] == most[1])

    def held(x: Column) -> Column:
        return F.array_distinct(F.when(same, x).otherwise(F.filter(x, lambda v: level(v).between(low, high))))

    both, total = F.size(F.array_intersect(held(a), held(b))), F.size(held(a)) + F.size(held(b))
    return (F.when(F.size(a) + F.size(b) == 0, 1.0).when((F.size(a) == 0) | (F.size(b) == 0) | (low > high), 0.0)
            .otherwise(2.0 * both / total))


def printed(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def listed(values: list[int]) -> Column:
    """A list as one literal of the plan, whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def rank_in(bounds: list[int], key: Column) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``: whole blocks first, then inside the last block."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    blocks = F.size(F.filter(listed(bounds[::step]), lambda b: b <= key))
    block = F.slice(listed(bounds), F.greatest(blocks - 1, F.lit(0)) * step + 1, step)
    return F.greatest(blocks - 1, F.lit(0)) * step + F.size(F.filter(block, lambda b: b <= key))


def range_heads(keys: DataFrame, ranges: int) -> list[int]:
    """The smallest key of each doc_id range, ascending: about ``ranges`` numbers."""
    cuts = ", ".join(f"{i / ranges!r}D" for i in range(1, ranges)) or "0.5D"
    cut = F.expr(f"percentile_approx(key, array({cuts}), {max(10_000, 10 * ranges)})")
    bounds = sorted(set(keys.agg(cut).first()[0] or []))
    firsts = keys.groupBy(rank_in(bounds, F.col("key")).alias("range")).agg(F.min("key").alias("key"))
    return sorted(r["key"] for r in firsts.collect())


def next_texts(docs: DataFrame, ranges: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, text) placed in ranges, ready for windows: range, guest (the first documents of the next range)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID)).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    heads = range_heads(rows.select("key"), ranges)
    if not heads:
        return rows.withColumns({"range": F.lit(0), "guest": F.lit(False)})
    rows = rows.withColumn("at", rank_in(heads, F.col("key")) - 1)
    before = F.when(F.col("at") == 0, len(heads) - 1).otherwise(F.col("at") - 1)
    own, guest = (F.struct(r.alias("range"), F.lit(g).alias("guest")) for r, g in ((F.col("at"), False), (before, True)))
    is_head = F.col("key") == F.get(listed(heads), F.col("at"))
    place = F.explode(F.when(is_head, F.array(own, guest)).otherwise(F.array(own)))
    return rows.withColumn("place", place).select("doc_id", "key", "text", "place.range", "place.guest")


def edited_fingerprints(docs: DataFrame, ranges: int | None = None, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, anchors, edited_anchors (array<int>), fingerprint,
    edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = with_anchors(next_texts(docs, ranges, id_col, text_col).repartition("range"), "text", "own")
    along = Window.partitionBy("range").orderBy("guest", "key", F.xxhash64("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    after = {"next": "text", "next_own": "own"}
    seen = (placed.select("*", *[F.lead(c).over(along).alias(name) for name, c in after.items()])
            .filter(~F.col("guest"))
            .select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own",
                    F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next"), F.lit(1), half)).alias("edited")))
    seen = with_anchors(seen, "edited", "changed")
    return seen.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("own").alias("anchors"),
                       F.col("changed").alias("edited_anchors"), printed(F.col("own")).alias("fingerprint"),
                       printed(F.col("changed")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                       likeness(F.col("own"), F.col("next_own")).alias("near_next"))
