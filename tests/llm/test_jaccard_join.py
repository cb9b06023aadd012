import brute
import data
import numpy as np
import pytest

from indicata.llm import jaccard_join as J
from indicata.llm.common import WordHashes


@pytest.mark.parametrize("k, num", [(4, 85), (5, 80), (2, 50), (3, 95)])
def test_components_equal_brute_force(table, k, num):
    docs = data.corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(table(docs), k, num, 100).collect()}
    assert got == brute.components(docs, k, num, 100)


@pytest.mark.parametrize("num", [50, 80, 85, 90, 99])
def test_similar_sets_always_share_a_signature(num):
    """The guarantee itself, on random sets at and around the bound, of all sizes."""
    rng = np.random.default_rng(num)
    starts = J.band_starts(10_000)
    tried = 0
    for size in [*range(1, 60), *range(60, 900, 37), 2500]:
        for _ in range(6):
            base = rng.integers(0, 2**63, 3 * size, dtype=np.uint64)
            gone, new = rng.integers(0, min(size, size * (100 - num) // num + 1) + 1, 2)
            a = np.unique(base[:size])
            b = np.unique(np.concatenate([base[gone:size], base[size:size + new]]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < num * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            tried += 1
            assert np.isin(J.signatures(a, num, 100, starts), J.signatures(b, num, 100, starts)).any()
            differing = len(a) + len(b) - 2 * both
            assert bits_apart(J.parity_sketch(a), J.parity_sketch(b)) <= differing
    assert tried > 20


def bits_apart(x, y):
    """Differing bits of two sketches, the longer one folded."""
    while len(x) != len(y):
        x, y = sorted((x, y), key=len)
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))


def test_sketches_reject_unlike_sets_of_any_size(spark):
    from pyspark.sql import functions as F

    rng, rows = np.random.default_rng(5), []
    for size in (40, 1300, 1400, 2600, 2900, 9000, 30_000):
        for other in (size, int(size * 0.82)):
            base, fresh = (rng.integers(0, 2**63, size, dtype=np.uint64) for _ in range(2))
            kept = int(other * 0.93)
            for partner in (fresh[:other], np.concatenate([base[:kept], fresh[:other - kept]])):
                a, b = np.unique(base), np.unique(partner)
                both = len(np.intersect1d(a, b))
                rows.append((len(rows), [int(v) for v in J.parity_sketch(a)], [int(v) for v in J.parity_sketch(b)], len(a), len(b), both))
    df = spark.createDataFrame(rows, "id int, sketch_x array<long>, sketch_y array<long>, size_x long, size_y long, both long")
    got = {r["id"]: r for r in df.withColumns({"allowed": J._allowed(80, 100, "x", "y"), "apart": J._differing(F.col("sketch_x"), F.col("sketch_y"))}).collect()}
    for i, x, y, size_x, size_y, both in rows:
        assert got[i]["apart"] == bits_apart(np.array(x), np.array(y)) <= size_x + size_y - 2 * both
        if 100 * both >= 80 * (size_x + size_y - both):
            assert got[i]["allowed"]
        elif both == 0:
            assert not got[i]["allowed"]
    far = spark.createDataFrame([([0] * 64, [1] * 16)], "x array<long>, y array<long>")
    assert far.select(J._differing(F.col("x"), F.col("y"))).first()[0] == 0


def test_odd_rows(table):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in
                  J.jaccard_components(table(data.ODD), 4, 85, 100).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (None, 1, None), (None, 0, None), (5, 2, 5), (5, 2, 5),
                          (5, 3, 5), (6, 2, 5)], key=str)


def test_empty_table(table):
    assert J.jaccard_components(table([])).collect() == []


def test_groups_above_the_compare_size(table):
    """A group of near copies of one hub that is compared in several parts."""
    docs = [(i, data.edited(data.prose("big", 150), f"big{i}", 0.004)) for i in range(700)]
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(table(docs), 4, 85, 100).collect()}
    assert got == {i: c for i, (_, c) in brute.components(docs, 4, 85, 100).items()}


def test_shingles_of_short_texts():
    assert len(J.shingle_set(b"a b", 4, WordHashes())) == 1
    assert len(J.shingle_set(b" ", 4, WordHashes())) == 0
