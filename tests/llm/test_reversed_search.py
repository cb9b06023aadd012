import math
from collections import Counter

import brute
import data
import pytest

from indicata.llm import reversed_search as R

ITEMS = [(1, "bala bema, bila bela"), (2, "same text here and there"), (3, None), (4, ""), (5, "nothing of the kind xyzzy"),
         (6, "bala bala BALA bema"), (7, "word"), (7, "word"), (7, "another text"), (None, "one two"), (8, "é É ß"), (9, "a b a"),
         (10, data.prose(3, 400)), (11, "bala"), (12, "...")]


def ranked(docs, items, top=10):
    """{item text: [(score, doc_id)]}, best first."""
    found = [(i, brute.ALNUM.findall(brute.lower(t))) for i, t in docs]
    counts = [(i, Counter(w), len(w)) for i, w in found]
    n_docs, length = sum(n > 0 for _, _, n in counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = {}
    for item, text in set(items):
        rows = []
        for i, c, n in counts:
            score = 0
            for t in brute.ALNUM.findall(brute.lower(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // length)))
            if score > 0:
                rows.append((score, i))
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        if rows:
            out.setdefault(item, []).extend((k + 1, i, s) for k, (s, i) in enumerate(rows[:top]))
    return {k: sorted(v, key=str) for k, v in out.items()}


@pytest.fixture()
def items(spark):
    from pyspark.sql import functions as F

    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string").withColumns({"score": F.lit("x"), "item": F.lit(1), "rank": F.lit(2)})
    return make


def result(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {k: sorted(v, key=str) for k, v in out.items()}


@pytest.mark.parametrize("block_postings, top", [(2_000_000, 10), (6, 10), (1, 3)])
def test_equals_brute_force(table, items, block_postings, top):
    docs = [*data.corpus(), *data.ODD, (77, "Bala bema"), (77, "bala"), (20_000, "one two " * 30)]
    got = result(R.top_documents(table(docs, 5), items(ITEMS), top=top, block_postings=block_postings))
    assert got == ranked(docs, ITEMS, top)


def test_ties_go_by_id_and_repeated_rows_are_ranked_each(table, items):
    docs = [(i, "bala bema") for i in (9, 3, 7, 3, None, 1)] + [(50, "other words")]
    got = result(R.top_documents(table(docs), items([(1, "bala"), (1, "bala")]), top=5))
    assert [r[1] for r in sorted(got[1])] == [1, 3, 3, 7, 9] and len({r[2] for r in got[1]}) == 1


def test_empty_tables(table, items):
    for docs, qs in (([], ITEMS), ([(1, "bala")], []), ([(1, None), (2, " ")], ITEMS), ([(1, "bala")], [(1, None)])):
        out = R.top_documents(table(docs), items(qs))
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


def test_blocks_hold_at_most_the_bound_or_one_item(spark):
    rows = [(i, list(range(5 + i % 7))) for i in range(300)]
    terms = spark.createDataFrame(rows, "item long, terms array<int>")
    blocks = R.item_blocks(terms, 60)
    sizes, held = Counter(), Counter()
    for r in terms.selectExpr("size(terms) n", f"pmod(xxhash64(item), {blocks}) b").collect():
        sizes[r["b"]] += r["n"]
        held[r["b"]] += 1
    assert blocks > 1 and all(n <= 60 or held[b] == 1 for b, n in sizes.items())
    assert R.item_blocks(terms.limit(0), 60) == 1 and R.item_blocks(terms.limit(1), 1) == 1
