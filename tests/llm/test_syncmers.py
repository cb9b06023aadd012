import hashlib
import random

import data
import pytest
from pyspark.sql import functions as F

from indicata.llm import syncmers as S


def listed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r["a"] for r in S.with_anchors(df, "t", "a").orderBy("i").collect()]


def test_syncmers_are_context_free(spark):
    """A passage gives the same anchors in any surroundings, and half of them or so survive in an edited text."""
    passage = data.prose("core", 80)
    alone, inside, other = listed(spark, [passage, data.prose("l", 33) + " " + passage + " " + data.prose("r", 21), data.prose("o", 80)])
    assert len(alone) > 10 and "|".join(map(str, alone)) in "|".join(map(str, inside))
    assert not set(alone) & set(other)


def test_definition(spark):
    """Against the definition: a run is chosen if its least inner hash is the first's or the last's."""
    text = data.prose("d", 120)
    df = spark.createDataFrame([(text,)], "t string").select(S.word_hashes(F.col("t")).alias("h"))
    row = S.with_anchors(df.select("h", F.lit(text).alias("t")), "t", "a").withColumn("i", S.inner_hashes(F.col("h"))).first()
    reach = S.K - S.S + 1
    chosen = [i for i in range(len(row["h"]) - S.K + 1)
              if min(row["i"][i:i + reach]) in (row["i"][i], row["i"][i + reach - 1])]
    assert len(chosen) == len(row["a"]) > 0
    assert len(set(row["a"])) == len(row["a"])


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_edited_texts_and_next(spark, table, ranges):
    docs = [(i * 7 - 30, t) for i, t in enumerate([t for _, t in data.corpus()][::3])]
    got = {r["doc_id"]: r for r in S.edited_fingerprints(table(docs), ranges).collect()}
    assert len(got) == len(docs)
    texts = [t or "" for _, t in docs]
    for n, (i, _) in enumerate(docs):
        text, after = texts[n], texts[(n + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text == after:
            assert r["near_next"] == 1.0
        if edited == text:
            assert r["near_edited"] == 1.0 and r["fingerprint"] == r["edited_fingerprint"]
    same = {}
    for n, (i, _) in enumerate(docs):
        assert same.setdefault(texts[n], got[i]["fingerprint"]) == got[i]["fingerprint"]


def test_half_edited_texts_are_half_alike(table):
    docs = [(i, data.prose(f"t{i}", 300)) for i in range(12)]
    got = S.edited_fingerprints(table(docs), 4).collect()
    assert all(0.3 < r["near_edited"] < 0.7 and r["near_next"] < 0.05 for r in got)


def test_short_texts_have_anchors_of_their_own(spark, table):
    """Unrelated texts of 1 to 13 words, several of each length, are unlike each other and unlike an empty text."""
    texts = [" ".join(f"w{n}x{i}x{j}" for j in range(n)) for n in range(1, 14) for i in range(6)]
    found = listed(spark, texts)
    assert all(found) and len({x for a in found for x in a}) == sum(map(len, found))
    rows = [t for text in texts for t in (text, "")][:-1]
    for docs in (texts, rows):
        got = S.edited_fingerprints(table(list(enumerate(docs))), 3).collect()
        assert all(r["near_next"] == 0.0 and bool(r["fingerprint"]) == bool(r["n_chars"]) for r in got)
    assert all(r["near_next"] == 1.0 for r in S.edited_fingerprints(table([(1, ""), (2, None), (3, " ")]), 2).collect())


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 10, 12])
def test_half_edited_short_texts_keep_some_likeness(table, n):
    docs = [(i, " ".join(f"{i}w{j:02}" for j in range(n))) for i in range(1, 7)]
    assert all(0.1 < r["near_edited"] < 0.7 for r in S.edited_fingerprints(table(docs), 2).collect())


def test_texts_of_different_scales_are_compared_on_the_smaller(table):
    words = [f"w{j}" for j in range(40)]
    docs = [(n, " ".join(words[:n])) for n in (2, 3, 4, 5, 11, 12, 13, 14)]
    got = {r["doc_id"]: r["near_next"] for r in S.edited_fingerprints(table(docs), 1).collect()}
    assert got[3] == pytest.approx(2 * 3 / (3 + 4)) and got[12] == pytest.approx(2 * 11 / (11 + 12))


def dice(one, two):
    """Likeness of two printed fingerprints, from the strings alone."""
    a, b = ({int(f[i:i + 8], 16) for i in range(0, len(f), 8)} for f in (one, two))
    both = {x >> S.HASH_BITS for x in a} & {x >> S.HASH_BITS for x in b}
    if not a and not b:
        return 1.0
    a, b = ({x for x in s if x >> S.HASH_BITS in both} for s in (a, b))
    return 2 * len(a & b) / (len(a) + len(b)) if both else 0.0


def test_likeness_is_that_of_the_printed_fingerprints(table):
    """Texts of 0 to 60 words in mixed order, so that neighbours lie on the same and on different levels."""
    words = [f"w{j}" for j in range(60)]
    docs = [(i, " ".join(words[:i * 23 % 61])) for i in range(61)]
    rows = sorted(S.edited_fingerprints(table(docs), 5).collect(), key=lambda r: r["doc_id"])
    for r, after in zip(rows, rows[1:] + rows[:1], strict=True):
        assert r["near_edited"] == pytest.approx(dice(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(dice(r["fingerprint"], after["fingerprint"]))


@pytest.mark.parametrize("signs", ["abcdefghijklmnopqrstuvwxyz0123456789+/", "".join(map(chr, range(0x4E00, 0x5200))),
                                   "".join(map(chr, range(0x1F300, 0x1F500)))])
def test_texts_without_spaces(table, signs):
    """Characters are the letters: a half-edited text is half alike, unrelated ones are not, and a shared half is found
    where it stands at another offset."""
    rng = random.Random(3)
    docs = [(i, "".join(rng.choices(signs, k=600 + i))) for i in range(6)]
    docs += [(10, docs[0][1][:300] + "".join(rng.choices(signs, k=300))), (11, "".join(rng.choices(signs, k=307)) + docs[0][1][:300])]
    got = {r["doc_id"]: r for r in S.edited_fingerprints(table(docs), 3).collect()}
    assert all(0.35 < got[i]["near_edited"] < 0.65 for i in got if i < 11)
    assert got[11]["near_edited"] > 0.9  # its second half is the beginning of the next text already
    assert all(got[i]["near_next"] < 0.05 for i in range(6)) and got[10]["near_next"] > 0.35


def test_many_ranges_are_one_literal(spark, table):
    """The plan does not grow with the number of ranges, and keys near the ends of a long find their neighbours."""
    ids = [None, -(1 << 63) + 1, -5, 0, 7, (1 << 53) + 1, (1 << 53) + 2, (1 << 62) + 1, (1 << 63) - 1]
    docs = [(i, data.prose(str(i), 30)) for i in ids]
    got = {r["doc_id"]: r["edited_sha256"] for r in S.edited_fingerprints(table(docs), 2000).collect()}
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(text) // 2
        assert got[i] == hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()
    bounds = list(range(0, 60_000, 3))
    ranks = spark.range(-5, 60_005, 7).select("id", S.rank_in(bounds, F.col("id")).alias("r")).collect()
    assert all(r["r"] == max(0, min(len(bounds), r["id"] // 3 + 1)) for r in ranks)


def test_odd_rows_and_empty_table(table):
    got = S.edited_fingerprints(table(data.ODD), 3).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got) == sorted(
        (str(i), len(t or "")) for i, t in data.ODD)
    assert S.edited_fingerprints(table([])).collect() == []
    one = S.edited_fingerprints(table([(1, "a b")])).first()
    assert (one["near_next"], one["edited_sha256"]) == (1.0, hashlib.sha256(b"a a").hexdigest())


def test_no_python_in_the_plan(table):
    plan = S.edited_fingerprints(table(data.corpus()), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
