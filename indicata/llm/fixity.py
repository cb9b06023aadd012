"""Merkle fixity audit of WARC replicas.

A replica is a table of records (archive, offset, length, digest of the
bytes). Per archive a hash tree stands over ordered offset ranges: a leaf
hashes the records that begin in ``span`` consecutive bytes, in offset order,
and every node above hashes ``fanout`` neighbouring ranges in order, up to one
root. Groups are bounded: a leaf by its span, a node by the fanout. Two
replicas are compared root by root; where roots differ, the children of the
differing nodes are compared, and so on down, so each level joins only the
branches that lead to damage; at last the records of the differing leaves
tell which are changed, missing or extra.

Defined results: a null archive is an archive of its own; records without an
offset cannot be placed and are compared in leaves of their own, dealt by the
hash of length and digest (``UNPLACED`` an archive) before all others;
records that share an offset are hashed in the order of their length and
digest and compared as a multiset of (length, digest); null digests and
lengths compare equal to each other. Extra columns are ignored. Two empty
tables have no difference; an archive one replica lacks is missing record by
record.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm.common import Steps

SPAN = 1 << 16
FANOUT = 16
UNPLACED = 1 << 20
RECORD = ("archive", "offset", "length", "digest", "page_id")


def warc_record(url: Column, body: Column, record_id: Column) -> Column:
    """A response record's bytes: WARC header lines, the payload, two line ends."""
    payload = F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, payload, F.lit("\r\n\r\n"))


def warc_records(pages: DataFrame, per_archive: int, id_col: str = "page_id", url_col: str = "url",
                 body_col: str = "html") -> DataFrame:
    """(page_id, url, archive, record, length): ``per_archive`` consecutive ids an archive."""
    record = warc_record(F.col(url_col), F.col(body_col), F.col(id_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.floor(F.col(id_col) / per_archive).cast("long").alias("archive"),
                        record.alias("record"))
    return rows.withColumn("length", F.octet_length("record").cast("long"))


def digest(record: Column) -> Column:
    return F.sha2(record.cast("binary"), 256)


def with_offsets(rows: DataFrame, tie: str) -> DataFrame:
    """Add ``offset``: the bytes before a record in its archive, in the order of page_id, then ``tie``. All columns go
    through the sort, so callers bring lengths and digests, not bytes."""
    before = Window.partitionBy("archive").orderBy("page_id", tie).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))


def leaf_of(span: int) -> Column:
    """The leaf of a record: its span of bytes; negative without an offset."""
    unplaced = F.lit(-1) - F.pmod(F.xxhash64("length", "digest"), F.lit(UNPLACED))
    return F.coalesce(F.floor(F.col("offset") / span), unplaced)


def tree(digests: DataFrame, span: int, fanout: int, levels: int, steps: Steps) -> list[DataFrame]:
    """Nodes (archive, node, hash) of each level, leaves first. A level is an aggregation of the level below."""
    line = F.concat_ws(" ", F.coalesce(F.col("offset").cast("string"), F.lit("-")),
                       F.coalesce(F.col("length").cast("string"), F.lit("-")), F.coalesce("digest", F.lit("-")))
    leaves = (digests.withColumn("node", leaf_of(span))
              .groupBy("archive", "node")
              .agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
                  F.col("offset").alias("o"), F.col("length").alias("l"), line.alias("line")))), lambda x: x["line"]), "\n"),
                  256).alias("hash")))
    out = [steps.write(leaves, "leaves")]
    for _ in range(levels):
        up = F.floor(F.col("node") / fanout)
        nodes = (out[-1].groupBy("archive", up.alias("node"))
                 .agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))),
                                                      lambda x: F.concat_ws(" ", x["node"].cast("string"), x["hash"])), "\n"),
                             256).alias("hash")))
        out.append(steps.write(nodes, "nodes"))
    return out


def depth(digests: list[DataFrame], span: int, fanout: int) -> int:
    """Levels above the leaves until one node covers the longest archive of either replica."""
    most = max((d.agg(F.max("offset")).first()[0] or 0) for d in digests)
    nodes, levels = most // span + 1, 0
    while nodes > 1:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels + 1


def differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """(archive, node) of the nodes that differ or that one side lacks."""
    a, b = one.withColumnRenamed("hash", "ha"), two.withColumnRenamed("hash", "hb")
    on = a["archive"].eqNullSafe(b["archive"]) & (a["node"] == b["node"])
    return (a.join(b, on, "full_outer").filter(~F.col("ha").eqNullSafe(F.col("hb")))
            .select(F.coalesce(a["archive"], b["archive"]).alias("archive"), F.coalesce(a["node"], b["node"]).alias("node")))


def below(nodes: DataFrame, bad: DataFrame, fanout: int) -> DataFrame:
    """The children of the differing nodes."""
    parents = bad.select(F.col("archive").alias("pa"), F.col("node").alias("pn"))
    return nodes.join(parents, nodes["archive"].eqNullSafe(F.col("pa")) & (F.floor(nodes["node"] / fanout) == F.col("pn")),
                      "left_semi")


def audit(primary: DataFrame, replica: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """Damaged records: archive, offset, page_id, kind (changed, missing or extra in the replica), length,
    replica_length. Inputs: archive, offset, length, digest, page_id."""
    steps = Steps(primary.sparkSession, "fixity")
    sides = [steps.write(primary, "primary"), steps.write(replica, "replica")]
    levels = depth(sides, span, fanout)
    trees = [tree(d, span, fanout, levels, steps) for d in sides]
    bad = differing(trees[0][-1], trees[1][-1])
    for level in range(levels - 1, -1, -1):
        bad = steps.write(differing(below(trees[0][level], bad, fanout), below(trees[1][level], bad, fanout)), "differing")
    leaf = bad.select(F.col("archive").alias("pa"), F.col("node").alias("pn"))
    records = []
    for side, suffix in zip(sides, "ab", strict=True):
        hit = side.withColumn("node", leaf_of(span))
        hit = hit.join(leaf, hit["archive"].eqNullSafe(F.col("pa")) & (hit["node"] == F.col("pn")), "left_semi")
        same = Window.partitionBy("archive", "offset", "length", "digest").orderBy("page_id")
        hit = hit.withColumn("again", F.row_number().over(same))
        records.append(hit.select(*[F.col(c).alias(f"{c}_{suffix}") for c in (*RECORD, "again")]))
    a, b = records
    equal = reduce(and_, [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in ("archive", "offset", "length", "digest", "again")])
    place = Window.partitionBy("archive", "offset").orderBy("length", "digest", "page_id")
    gone, come = (own.join(other, equal, "left_anti").select(*[F.col(f"{c}_{x}").alias(c) for c in RECORD])
                  .withColumn("nth", F.row_number().over(place)) for own, other, x in ((a, b, "a"), (b, a, "b")))
    pair = gone["archive"].eqNullSafe(come["archive"]) & gone["offset"].eqNullSafe(come["offset"]) & (gone["nth"] == come["nth"])
    kind = F.when(come["nth"].isNull(), "missing").when(gone["nth"].isNull(), "extra").otherwise("changed")
    return gone.join(come, pair, "full_outer").select(
        F.coalesce(gone["archive"], come["archive"]).alias("archive"), F.coalesce(gone["offset"], come["offset"]).alias("offset"),
        F.coalesce(gone["page_id"], come["page_id"]).alias("page_id"), kind.alias("kind"), gone["length"].alias("length"),
        come["length"].alias("replica_length"))
