import random

import brute
import pytest
from pyspark.sql import functions as F

from indicata.llm import source_mix as M


def rows(spread, seed=1):
    rng = random.Random(seed)
    out = []
    for source, n in spread.items():
        out += [(len(out) + i, " ".join(["w"] * rng.randrange(0, 90)), source) for i in range(n)]
    return [(i, t, s) for i, (_, t, s) in enumerate(out)]


@pytest.mark.parametrize("spread", [
    {"a": 300, "b": 40, "c": 40, None: 30}, {"a": 50}, {"é": 60, "z": 60, "Z": 60, "": 5}, {f"s{i}": 5 + 7 * i for i in range(9)}])
def test_targets_and_what_is_taken(table, spread):
    got = M.weighted_mix(table(rows(spread))).collect()
    sizes = {s: sum(r["size"] for r in got if r["source"] == s) for s in spread}
    want = brute.targets(sizes)
    largest = max(r["size"] for r in got)
    for s in spread:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]}
        assert all(r["target"] == pytest.approx(want[s]) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= 2 * largest
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    assert 1.5 * total - 2 * largest * len(spread) <= sum(r["taken"] for r in got) <= 1.5 * total


def test_order_is_fair_queueing(table):
    """Every copy taken finishes before every copy that isn't, up to the copy the budget ends in."""
    got = M.weighted_mix(table(rows({"a": 200, "b": 100, "c": 30}))).collect()
    times = lambda r, c: r["finish"] + c * r["source_size"] / r["target"]
    taken = [times(r, c) for r in got for c in range(r["copies"])]
    left = [times(r, c) for r in got for c in range(r["copies"], 2)]
    assert max(taken) <= min(left) + 1e-12


def test_reruns_and_partitions_agree(table):
    data = rows({"a": 100, "b": 50})
    one, two = (sorted(map(tuple, M.weighted_mix(table(data, p)).collect())) for p in (1, 7))
    assert one == two


def test_odd_rows(table):
    data = [(1, None, None), (2, "", "a"), (None, "x y", "a"), (None, "x y", "a"), (3, "x y z", None), (3, "x y z", None),
            (3, "other words here now", "b")]
    got = M.weighted_mix(table(data)).collect()
    assert len(got) == len(data) and sum(r["size"] for r in got) == 14
    assert {r["source"]: r["source_size"] for r in got} == {None: 6, "a": 4, "b": 4}


def test_no_words_and_no_rows(table):
    assert {(r["target"], r["taken"]) for r in M.weighted_mix(table([(1, "", "a"), (2, None, "b")])).collect()} == {(0.0, 0)}
    assert M.weighted_mix(table([])).collect() == []


def test_sizes(spark):
    texts = ["a b", "\x1fa\x1cb c", " \t\n\x0b\x0c\r", "é x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(M.word_count(F.col("t")).alias("n"))
    assert [r["n"] for r in df.collect()] == [len(brute.SPACE.findall(t or "")) for t in texts]
