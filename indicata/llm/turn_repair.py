"""Conversation structure repair by scalar integer weights.

A conversation's rows, in order, are edited until their roles' initials read ``(s?(ua)+)?``: Keep costs 0, Rerole (to user or
assistant) 2, Delete 3, Insert of an empty user or assistant turn 2, and a truncated row that stays 1 more. Of the cheapest
edits the one whose audit (initials of the edits in order) is least in ASCII wins.

A path through the edits weighs one integer: in octal, its cost followed by one digit per letter of its audit from the left
(D 1, I 2, K 3, R 4 keep the letters' order) and zeros up to the block's fixed width, so that the smaller integer is the
cheaper path or, at equal cost, the one with the lesser audit. The DAG has four states (nothing yet, after s, u, a), and
the ordinary minimum over integers decides everything.

Rows are range-partitioned by conversation and position and cut into blocks of at most ``block_rows``, so that a conversation
of any length is spread over tasks. A block gives its least weight for each pair of states. Letters are inserted before
rows only, so two paths that reach different states of a boundary differ within their common length, and what later blocks
need of a path is its cost and its order among the (at most four) others: again one integer. Per conversation, narrow block
rows are streamed through the states, the decided pairs are joined back to the blocks, and the texts that stay are
hashed in a stream. One task reads a conversation's final texts because SHA-256 is sequential; it holds one batch of them.

Rows with equal (conversation, turn, role, text) are one row with a count until then, so copies by the million cost one row.

Faults, first one counts: blank (no character outside ``\\x20\\x09-\\x0D``), duplicate (role and text were there earlier in the
conversation), truncated (the last such character isn't one of ``.!?``). Blank and duplicate rows have to be deleted.

Defined cases: a null role or text is one space; null turns come first; equal turns go by role, then md5 of the text; a null
conv_id is a conversation of its own; every conv_id of the input has a row, also if it has no rows to repair; a
role is kept if its first character fits (an empty role never does); columns other than the four named ones aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import Steps

DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
AUDIT = str.maketrans("1234", "DIKR")
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
#: States by what stands last: nothing, system, user, assistant; and the state after a user or assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Weight of what can't be reached.
NEVER = -1


@dataclass
class Step:
    """One row of a block (or ``times`` copies to be deleted)."""

    initial: str
    delete: bool = False
    truncated: bool = False
    times: int = 1

    def kept(self, state: int) -> int | None:
        """The state after keeping the row, if its role fits."""
        if self.initial == "s":
            return SYSTEM if state == NOTHING else None
        after = NEXT[state]
        return after if self.initial == NAMES[after][0] else None


@dataclass
class Weights:
    """Paths of a block of ``width`` letters at most; a path is (weight, its letters so far)."""

    width: int

    def added(self, path: tuple[int, int], letter: int, times: int = 1, more: int = 0) -> tuple[int, int]:
        weight, n = path
        digits = letter * (((1 << 3 * times) - 1) // 7)
        return weight + ((COST[letter] * times + more) << 3 * self.width) + (digits << 3 * (self.width - n - times)), n + times

    def cost(self, weight: int) -> int:
        return weight >> 3 * self.width

    def order(self, weight: int) -> int:
        return weight & ((1 << 3 * self.width) - 1)

    def letters(self, path: tuple[int, int]) -> str:
        return f"{self.order(path[0]):0{self.width}o}"[:path[1]].translate(AUDIT) if self.width else ""

    def after(self, paths: dict[int, tuple[int, int]], step: Step) -> dict[int, tuple[int, int]]:
        """Least path to each state after one more row, with inserts before it."""
        open_, out = dict(paths), {}

        def offer(to: dict, state: int, path: tuple[int, int]) -> None:
            if state not in to or path < to[state]:
                to[state] = path
        for state in (NOTHING, SYSTEM, ASSISTANT, USER):  # user last: an inserted user turn may be answered by an inserted one
            if state in open_:
                offer(open_, NEXT[state], self.added(open_[state], INSERT))
        for state, path in open_.items():
            offer(out, state, self.added(path, DELETE, step.times))
            if not step.delete:
                to = step.kept(state)
                if to is not None:
                    offer(out, to, self.added(path, KEEP, more=step.truncated))
                offer(out, NEXT[state], self.added(path, REROLE, more=step.truncated))
        return out


def least_paths(steps: list[Step], starts: tuple[int, ...]) -> list[dict[int, tuple[int, str, int]]]:
    """For each state a block may start in: {state at its end: (cost, audit, order of the audit among them)}."""
    weights, out = Weights(sum(s.times + 2 for s in steps)), []
    for start in range(4):
        paths = {start: (0, 0)} if start in starts else {}
        for step in steps:
            paths = weights.after(paths, step)
        ranked = sorted(paths, key=lambda t: weights.order(paths[t][0]))
        out.append({t: (weights.cost(paths[t][0]), weights.letters(paths[t]), ranked.index(t)) for t in paths})
    return out


def decided(blocks: list[tuple[list[int], list[int]]]) -> tuple[int, list[tuple[int, int]], int]:
    """(cost, (first, last) state of each block, turns inserted at the end) of the best path through the blocks, each
    given by the costs and orders of its 16 pairs of states (cost ``NEVER``: there is no path)."""
    at, back = {NOTHING: 0}, []
    for costs, orders in blocks:
        found: dict[int, tuple[int, int]] = {}
        for s, weight in at.items():
            for t in range(4):
                if costs[4 * s + t] != NEVER:
                    here = (weight + 4 * costs[4 * s + t], s)
                    if t not in found or here < found[t]:
                        found[t] = here
        order = sorted(found, key=lambda t: (found[t][0] % 4, orders[4 * found[t][1] + t]))
        at = {t: found[t][0] // 4 * 4 + order.index(t) for t in found}
        back.append({t: s for t, (_, s) in found.items()})
    ends = {NOTHING: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
    weight, tail, state = min((w + 4 * COST[INSERT] * ends[t], ends[t], t) for t, w in at.items())
    states = []
    for before in reversed(back):
        states.append((before[state], state))
        state = before[state]
    return weight // 4, states[::-1], tail


def turns(state: int, audit: str, rows: Iterable[tuple]) -> Iterator[tuple[str, object]]:
    """(role, row or None for an inserted turn) of what stays when the audit's edits are made; rows begin with their role."""
    rows = iter(rows)
    audit = audit.rstrip("D")
    for letter in audit:
        row = None if letter == "I" else next(rows)
        if letter == "D":
            continue
        state = SYSTEM if letter == "K" and row[0][:1] == "s" else NEXT[state]
        yield row[0] if letter == "K" else NAMES[state], row


@dataclass
class Block:
    """Rows of one conversation in a task's sorted stream."""

    conv: str
    place: int
    first: bool                                 # the task saw the rows before it, so the conversation begins here
    steps: list[Step] = field(default_factory=list)
    rows: list[tuple] = field(default_factory=list)
    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0, 0])  # blank, duplicate, truncated, illegal, distinct turns
    roles: list[str] = field(default_factory=list)                      # first and last initial
    spans: list[int] = field(default_factory=list)                      # first and last turn that isn't null

    def add(self, turn: int | None, role: str, key: bytes, n: int, blank: bool, repeated: bool, truncated: bool) -> None:
        blank_rows, copies = n if blank else 0, 0 if blank else n if repeated else n - 1
        once = not blank and not repeated
        if once:
            self.steps.append(Step(role[:1], truncated=truncated))
        if gone := blank_rows + copies:
            self.steps.append(Step(role[:1], delete=True, times=gone))
        self.rows.append((role, turn, key, n))
        new_turn = turn is not None and (not self.spans or turn != self.spans[1])
        pair = bool(self.roles) and self.roles[1] + role[:1] not in ("su", "ua", "au")
        for i, more in enumerate((blank_rows, copies, once and truncated, n - 1 + pair, new_turn)):
            self.counts[i] += more
        self.roles = [self.roles[0] if self.roles else role[:1], role[:1]]
        if turn is not None:
            self.spans = [self.spans[0] if self.spans else turn, turn]

    def out(self) -> tuple:
        ways = least_paths(self.steps, (NOTHING,) if self.first else (NOTHING, SYSTEM, USER, ASSISTANT))
        pairs = [ways[s].get(t, (NEVER, "", 0)) for s in range(4) for t in range(4)]
        return (self.conv, self.place, [p[0] for p in pairs], [p[2] for p in pairs], self.counts, self.roles, self.spans or None,
                [p[1] for p in pairs], self.rows)


BLOCK_SCHEMA = ("conv string, place long, costs array<long>, orders array<int>, counts array<long>, roles array<string>, "
                "spans array<long>, letters array<string>, rows array<struct<role: string, turn: bigint, key: binary, n: bigint>>")
BLOCK_ARROW = pa.schema([
    ("conv", pa.string()), ("place", pa.int64()), ("costs", pa.list_(pa.int64())), ("orders", pa.list_(pa.int32())),
    ("counts", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("spans", pa.list_(pa.int64())), ("letters", pa.list_(pa.string())),
    ("rows", pa.list_(pa.struct([("role", pa.string()), ("turn", pa.int64()), ("key", pa.binary()), ("n", pa.int64())])))])


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def _blocks(block_rows: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        base, block, made = TaskContext.get().partitionId() << 32, None, 0
        for batch in batches:
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block is None or block.conv != conv or len(block.rows) == block_rows:
                    if block is not None:
                        yield block.out()
                    block = Block(conv, base + made, first=block is not None and block.conv != conv)
                    made += 1
                block.add(*row)
        if block is not None:
            yield block.out()
    return lambda batches: in_batches(cut(batches), BLOCK_ARROW)


PATH_SCHEMA = "conv string, place long, first int, last int, tail int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
PATH_ARROW = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("tail", pa.int32()),
                        *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))])


def _path(conv: str, places: list[int], blocks: list[tuple], stats: list[int], spans: list[int] | None) -> Iterator[tuple]:
    """Rows of one conversation: the states of each block, its figures on the first."""
    cost, states, tail = decided(blocks)
    gaps = spans[1] - spans[0] + 1 - stats[4] if spans else 0
    for i, (place, (first, last)) in enumerate(zip(places, states, strict=True)):
        figures = (gaps, *stats[:4], cost) if i == 0 else (None,) * 6
        yield conv, place, first, last, tail if i == len(places) - 1 else 0, *figures


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[tuple]:
        conv, places, blocks, stats, spans, roles = None, [], [], [], None, None
        for batch in batches:
            for key, place, costs, orders, counts, ends, turns_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != conv:
                    if conv is not None:
                        yield from _path(conv, places, blocks, stats, spans)
                    conv, places, blocks, stats, spans, roles = key, [], [], [0] * 5, None, None
                places.append(place)
                blocks.append((costs, orders))
                stats = [a + b for a, b in zip(stats, counts, strict=True)]
                stats[3] += roles is not None and roles[1] + ends[0] not in ("su", "ua", "au")
                if turns_:
                    stats[4] -= spans is not None and spans[1] == turns_[0]
                    spans = [spans[0] if spans else turns_[0], turns_[1]]
                roles = ends
        if conv is not None:
            yield from _path(conv, places, blocks, stats, spans)
    return in_batches(each(), PATH_ARROW)


LINE_SCHEMA = "conv string, place long, at int, role_out string, role string, turn long, key binary"
LINE_ARROW = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("at", pa.int32()), ("role_out", pa.string()),
                        ("role", pa.string()), ("turn", pa.int64()), ("key", pa.binary())])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stays of each block: (role, which row's text, none for an inserted turn) at its place."""
    def each() -> Iterator[tuple]:
        for batch in batches:
            for conv, place, first, audit, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                each_row = ((r["role"], r["turn"], r["key"]) for r in rows for _ in range(r["n"]))
                for i, (role, row) in enumerate(turns(first, audit, each_row)):
                    yield conv, place, i, role, *(row or (None, None, None))
    return in_batches(each(), LINE_ARROW, 4096)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come in order; no conversation is held."""
    def each() -> Iterator[tuple]:
        conv, digest = None, None
        for batch in batches:
            for key, line in zip(batch.column("conv").to_pylist(), batch.column("line"), strict=True):
                if key != conv:
                    if conv is not None:
                        yield conv, digest.hexdigest()
                    conv, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.as_py())
        if conv is not None:
            yield conv, digest.hexdigest()
    return in_batches(each(), pa.schema([("conv", pa.string()), ("sha", pa.string())]), 4096)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the damage that the crc32 of their ``conv_id:turn`` (nulls: one space) names: of 20,
    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user."""
    id_of, turn_of = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    rule = F.crc32(F.concat_ws(":", id_of, turn_of).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return (conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), rule.alias("rule"),
                                 F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"))
            .filter("rule <> 0")
            .select("conv_id", "turn", F.when(F.col("rule") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("rule") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
            .drop("copy"))


def repaired(rows: DataFrame, ids: DataFrame | None = None, block_rows: int = 1024) -> tuple[DataFrame, DataFrame]:
    """(report, turns) of the conversations in ``rows`` (conv_id, turn, role, text).

    The report has one row per conv_id of ``ids`` (of ``rows``, if None): gaps, blank, duplicate, truncated, illegal, cost, audit
    and repaired_sha256; the turns are the repaired conversations' (conv_id, position, role, text), positions from 0 within
    ``place`` (places in order).
    """
    spark = rows.sparkSession
    steps = Steps(spark, "repair")
    conv = F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit("")).alias("conv")
    source = rows.select(conv, F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text")).withColumn("key", F.unhex(F.md5("text")))
    end = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    row_key, text_key = ["conv", "turn", "role", "key"], ["conv", "role", "key"]
    narrow = (source.select(*row_key, (end == "").alias("blank"), (~end.isin("", ".", "!", "?")).alias("truncated"))
              .groupBy(*row_key).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")))
    # A text's first turn: nulls come first, so any null is it.
    earliest = narrow.groupBy(*text_key).agg(F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("null_turn"))
    again = F.col("turn").isNotNull() & (F.col("null_turn") | (F.col("turn") > F.col("least")))
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("key")]
    blocks = steps.write(
        narrow.join(earliest, text_key).select(*row_key, "n", "blank", again.alias("repeated"), "truncated")
        .repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(block_rows), BLOCK_SCHEMA), "blocks")
    paths = steps.write(
        blocks.select("conv", "place", "costs", "orders", "counts", "roles", "spans")
        .repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(_paths, PATH_SCHEMA), "paths")
    letters = F.concat(F.element_at("letters", F.col("first") * 4 + F.col("last") + 1), F.repeat(F.lit("I"), F.col("tail")))
    chosen = blocks.join(paths, ["conv", "place"]).withColumn("audit", letters)
    lines = chosen.select("conv", "place", "first", "audit", "rows").mapInArrow(_lines, LINE_SCHEMA)
    texts = source.dropDuplicates(row_key)
    same = [lines[c] == texts[c] for c in text_key] + [lines["turn"].eqNullSafe(texts["turn"])]
    stays = lines.join(texts, same, "left").select(lines["conv"], "place", "at", F.col("role_out").alias("role"),
                                                 F.coalesce(texts["text"], F.lit("")).alias("text"))
    stays = steps.write(stays, "turns")
    hashes = (stays.select("conv", "place", "at", F.concat_ws(":", "role", "text").cast("binary").alias("line"))
              .repartition("conv").sortWithinPartitions("conv", "place", "at").select("conv", "line")
              .mapInArrow(_hashed, "conv string, sha string"))
    audits = chosen.groupBy("conv").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "audit"))), lambda x: x["audit"]), "")
                                        .alias("audit"))
    names = (rows if ids is None else ids).select("conv_id", conv).distinct()
    figures = paths.filter(F.col("cost").isNotNull()).select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    report = (names.join(figures, "conv", "left").join(audits, "conv", "left").join(hashes, "conv", "left")
              .select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))
    return report, names.join(stays, "conv").select("conv_id", "place", F.col("at").alias("position"), "role", "text")
