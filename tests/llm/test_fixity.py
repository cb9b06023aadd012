import random

import pytest
from pyspark.sql import functions as F

from indicata.llm import fixity as X
from indicata.llm.common import Steps


def records(spark, rows):
    return spark.createDataFrame(rows, "archive long, offset long, length long, digest string, page_id long")


def archives(n=4, per=300):
    rng, out = random.Random(5), []
    for a in range(n):
        at = 0
        for i in range(per):
            size = rng.randrange(1, 900)
            out.append((a, at, size, f"{a}/{i}", a * 1000 + i))
            at += size
    return out


def found(df):
    return sorted(((r["archive"], r["offset"], r["page_id"], r["kind"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("span, fanout", [(X.SPAN, X.FANOUT), (500, 2), (1, 3), (10**9, 16)])
def test_damage_is_located(spark, span, fanout):
    good = archives()
    bad = list(good)
    bad[7] = (*bad[7][:3], "other", bad[7][4])
    bad[900] = (*bad[900][:2], bad[900][2] + 1, *bad[900][3:])
    lost, extra = bad.pop(450), (2, 10**7, 5, "new", 99)
    bad.append(extra)
    want = sorted([(*good[7][:2], good[7][4], "changed"), (*good[900][:2], good[900][4], "changed"),
                   (*lost[:2], lost[4], "missing"), (2, 10**7, 99, "extra")], key=str)
    assert found(X.audit(records(spark, good), records(spark, bad), span, fanout)) == want


def test_equal_replicas_and_empty_ones(spark):
    good = archives(2, 50)
    assert found(X.audit(records(spark, good), records(spark, good[::-1]))) == []
    assert found(X.audit(records(spark, []), records(spark, []))) == []
    assert len(found(X.audit(records(spark, good), records(spark, [])))) == 100
    assert {k for *_, k in found(X.audit(records(spark, good[:50]), records(spark, good)))} == {"extra"}


def test_only_branches_with_damage_are_descended(spark):
    good = archives(3, 400)
    bad = list(good)
    bad[1] = (*bad[1][:3], "x", bad[1][4])
    one, two = records(spark, good), records(spark, bad)
    levels = X.depth([one, two], 500, 4)
    trees = [X.tree(t, 500, 4, levels, Steps(spark, "fixity")) for t in (one, two)]
    assert trees[0][-1].count() == 3  # one root an archive
    nodes = X.differing(trees[0][-1], trees[1][-1])
    for level in range(levels - 1, -1, -1):
        assert nodes.count() == 1
        assert X.below(trees[0][level], nodes, 4).count() <= 5
        nodes = X.differing(X.below(trees[0][level], nodes, 4), X.below(trees[1][level], nodes, 4))
    assert nodes.count() == 1


def test_odd_rows(spark):
    good = [(None, 0, 5, "a", 1), (None, None, 5, "b", 2), (1, None, None, None, None), (1, 0, 4, "c", 4), (1, 0, 4, "c", 4), (1, 0, 4, "d", 5)]
    assert found(X.audit(records(spark, good), records(spark, good))) == []
    bad = [good[0], (None, None, 5, "x", 2), good[2], good[3], good[5]]
    assert found(X.audit(records(spark, good), records(spark, bad))) == sorted(
        [(None, None, 2, "changed"), (1, 0, 4, "missing")], key=str)


def test_archives_from_pages(spark):
    pages = spark.createDataFrame([(1, "u", "é"), (0, None, None), (1001, "v", ""), (None, "w", "x")], "page_id long, url string, html string")
    rows = X.with_offsets(X.warc_records(pages.withColumn("record", F.lit(1)), 1000), "record").collect()
    at = {r["page_id"]: r for r in rows}
    assert at[0]["offset"] == 0 and at[1]["offset"] == at[0]["length"] and at[1001]["archive"] == 1
    assert all(r["length"] == len(r["record"].encode()) for r in rows)
    assert "Content-Length: 2\r\n\r\né\r\n" in at[1]["record"]


def test_records_without_an_offset_are_many_leaves(spark):
    good = [(1, None, 5, f"d{i}", i) for i in range(500)]
    bad = [*good[:7], (1, None, 5, "x", 7), *good[8:400], *good[401:]]
    assert records(spark, good).select(X.leaf_of(X.SPAN).alias("node")).distinct().count() > 490
    got = X.audit(records(spark, good), records(spark, bad)).collect()
    assert sorted(r["kind"] for r in got) == ["changed", "missing"] and {r["page_id"] for r in got} <= {7, 400}
