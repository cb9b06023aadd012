import random

import brute
import data
import pytest

from indicata.llm import decontaminate as D
from indicata.llm.common import alnum_words

ITEMS = [(1, data.prose("i1", 30)), (2, data.prose("i2", 13)), (3, data.prose("i3", 12)), (4, "alpha"), (5, None), (6, " .,"),
         (7, data.prose("i1", 30)), (8, data.prose("i8", 80)), (None, "beta gamma"), (9, "é-É x"), (10, "alpha alpha")]


def documents():
    rng = random.Random(3)
    out = [None, "", "...", "ALPHA", "x alpha, alpha alpha y", "Beta? gamma! beta", "É é É x", data.prose("long", 9000)]
    for i, (_, text) in enumerate(ITEMS):
        words = (text or "").split()
        for cut in (5, 12, 13, 14, 20, 30):
            a = rng.randrange(max(1, len(words) - cut + 1))
            out.append(data.prose(f"a{i}", 40) + " " + " ".join(words[a:a + cut]).upper() + " " + data.prose(f"b{i}", 11 * cut))
    out.append(" ".join(t or "" for _, t in ITEMS))
    out.append(" ".join((data.prose("i8", 80).split() * 2)[40:120]))
    return [(i, t) for i, t in enumerate(out)]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block", [D.BLOCK_WORDS, 40, 1])
def test_equal_brute_force_in_one_and_many_blocks(spark, table, block):
    docs = documents()
    items = [x for x in ITEMS if x[0] is not None]
    hits = D.benchmark_hits(table(docs), benchmark(spark, items), block_words=block)
    got = sorted(tuple(r) for r in hits.select(*COLUMNS).collect())
    assert got == brute.contamination(docs, items)


@pytest.mark.parametrize("window", [1, 2, 5, 13])
def test_automaton_on_repetitive_words(window):
    rng = random.Random(window)
    for _ in range(150):
        items = [(str(i), [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 18))]) for i in range(4)]
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(60)]
        spans, names = D.Automaton(items, window).hits(words)
        text = lambda w: " ".join(x.decode() for x in w)
        want = brute.contamination([(0, text(words))], [(n, text(w)) for n, w in items], window)[0]
        assert (sum(spans[1::2]) - sum(spans[::2]), len(names)) == (want[2], want[3])


def test_null_item_ids_count_but_are_not_listed(spark, table):
    r = D.benchmark_hits(table([(1, "beta gamma")]), benchmark(spark, [(None, "beta gamma")])).first()
    assert (r["n_hit"], r["n_items"], r["contaminated"]) == (2, 0, True)


def test_odd_rows_and_empty_tables(spark, table):
    hits = D.benchmark_hits(table(data.ODD), benchmark(spark, [(1, "same text")]))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"]) for r in hits.collect()) == sorted(
        [("1", 0, 0), ("2", 0, 0), ("3", 0, 0), ("4", 1, 0), ("None", 1, 0), ("None", 0, 0), ("5", 5, 2), ("5", 5, 2), ("5", 6, 0),
         ("6", 5, 2)])
    assert D.benchmark_hits(table(data.ODD), benchmark(spark, [])).filter("contaminated").count() == 0
    assert D.benchmark_hits(table([]), benchmark(spark)).collect() == []
    many = D.benchmark_hits(table(data.ODD), benchmark(spark, [(1, "same text"), (2, "word")]), block_words=1)
    assert many.count() == len(data.ODD)


@pytest.mark.parametrize("block", [D.BLOCK_WORDS, 40])
def test_removal(spark, table, block):
    docs = table(documents())
    flagged = {r["doc_id"]: r["contaminated"] for r in D.benchmark_hits(docs, benchmark(spark)).collect()}
    kept = D.without_contaminated(docs, benchmark(spark), block_words=block)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, c in flagged.items() if not c)


@pytest.mark.parametrize("block", [D.BLOCK_WORDS, 40])
def test_pipeline_cuts_long_spans_of_kept_documents(spark, tmp_path, monkeypatch, block):
    """A whole window in a long text is cut out, a short item and texts without a hit stay, contaminated texts go."""
    import corpus_pipeline

    monkeypatch.setattr(D.without_benchmark, "__defaults__",
                        tuple(block if d == D.BLOCK_WORDS else d for d in D.without_benchmark.__defaults__))
    long, hit = " ".join(f"É{i}," for i in range(400)), data.prose("i8", 80).split()[5:20]
    texts = {1: f"{long} ({' '.join(hit).upper()}) {long}", 2: long, 3: "x " + " ".join(hit), 4: f"{long} ALPHA {long}", 5: None,
             6: "ALPHA " + long + " " + " ".join(hit) + " " + long + " " + " ".join(hit[:13]) + "."}
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, t, t and len(t), "tag") for i, t in texts.items()],
                                 "doc_id long, text string, n_chars long, tag string")
    out = corpus_pipeline.decontamination(spark, docs.union(docs.filter("doc_id = 1")), str(tmp_path))
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()]
    left = {1: f"{long} () {long}", 2: long, 4: texts[4], 5: None}
    last = [t for i, t, _ in got if i == 6]
    assert len(last) == 1 and last[0].startswith("ALPHA É0, É1,") and not set(last[0].split()) & set(hit)
    assert sorted((i, t) for i, t, _ in got if i < 5) == sorted([*((i, t) for i, t in left.items() if t), (1, left[1])])
    assert all(n == (t and len(t)) for _, t, n in got) and {i for i, _, _ in got} == {1, 2, 4, 5, 6}


def test_spans_are_cut_from_the_text(spark, table):
    words = data.prose("i8", 80).split()
    docs = [(1, "Keep this, (" + " ".join(words[10:40]).upper() + ") and that. " + " ".join(words[:5])), (2, "clean"), (3, None)]
    got = {r["doc_id"]: r["cleaned"] for r in D.cleaned_texts(table(docs), benchmark(spark, [(8, " ".join(words))])).collect()}
    assert got[2] == "clean" and got[3] is None
    assert got[1].startswith("Keep this, (") and got[1].endswith("and that. " + " ".join(words[:5]))
    assert not set(w.lower() for w in words[20:30]) & set(x.decode() for x in alnum_words(got[1].encode())[2:4])
