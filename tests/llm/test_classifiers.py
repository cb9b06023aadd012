import data
import numpy as np
import pytest
from pyspark.sql import functions as F

from indicata.llm import quality_knn as Q
from indicata.llm import toxicity as T
from indicata.llm.queries import LLM_REGISTRY

SF = "/root/testdata/sf0.01"
ALL = lambda _: F.lit(True)


def auc(labels, scores):
    labels, scores = np.array(labels), np.array(scores)
    good, bad = scores[labels == 1], scores[labels == 0]
    return ((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2)


def held_out(spark, name, label):
    rows = LLM_REGISTRY[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    return [r[label] for r in rows], [r["score"] for r in rows], [r["predicted"] for r in rows]


def test_quality_on_held_out_rows(spark):
    labels, scores, predicted = held_out(spark, "op9_quality_knn", "quality")
    assert auc(labels, scores) > 0.97
    assert np.mean(np.array(labels) == predicted) > 0.95


def test_toxicity_on_held_out_rows(spark):
    """A few dozen toxic rows to learn from at this size; see the README for the larger tables."""
    labels, scores, _ = held_out(spark, "op10_toxicity", "toxic")
    assert auc(labels, scores) > 0.7


def test_neighbour_vote_equals_brute_force(spark, table):
    docs = [(i, data.prose(i, 60) if i % 3 else " ".join(w + "***" for w in data.prose(i, 60).split())) for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    model = Q.fit(table(docs), labels, "quality", ALL, neighbours=7, sharpness=2.0)
    got = {r["doc_id"]: r["score"] for r in Q.with_scores(table(docs), model, out="_s").select("doc_id", F.col("_s").alias("score"))
           .collect()}
    shapes = Q.Shapes()
    for i, text in docs:
        v = model.projected([Q.term_counts(text.encode(), shapes)])[0]
        cosine = np.maximum(model.vectors @ v, 0)
        near = np.argsort(-cosine, kind="stable")[:7]
        cut = np.sort(cosine)[-7]
        if (cosine >= cut).sum() == 7:  # no tie at the edge
            weight = cosine[near].astype(float) ** 2
            assert got[i] == pytest.approx((weight * model.labels[near]).sum() / weight.sum(), abs=1e-5)
    assert all((got[i] >= 0.5) == (i % 3 > 0) for i, _ in docs)


def test_all_bytes_of_a_long_word_count(spark, table):
    """Texts without white space whose beginnings and repeats are the same."""
    assert Q.word_shapes(b"Abcd,") == [b"Aa,"] and Q.word_shapes(b"a--b") == [b"a-a+"] and len(Q.word_shapes(b"x" * 65)) == 2
    shared = "a,B;1.c--" * 3
    ends = ["", "x" * 300, "x" * 900, "1" * 300, "Ab" * 300, "k=v&" * 300, "k=v&" * 900, "http://h/p," * 50 + "!?" * 5]
    counted = [Q.term_counts((shared + e).encode(), Q.Shapes()) for e in ends]
    assert len({(tuple(t), tuple(c)) for t, c in counted}) == len(ends)
    assert [len(Q.word_shapes(("a1" * n).encode())) for n in (4, 5, 32, 33)] == [1, 2, 8, 9]
    docs = [(i, data.prose(i, 40) if i % 2 else "k=v&" * (10 + i)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = Q.fit(table(docs), labels, "quality", ALL)
    new = [(1, shared + "k=v&" * 200), (2, shared + "x" * 200)]
    one, two = (r["_s"] for r in Q.with_scores(table(new), model, out="_s").orderBy("doc_id").collect())
    assert one != two


def test_latent_axes_are_the_leading_singular_vectors():
    rng = np.random.default_rng(0)
    docs = [(np.sort(rng.choice(200, 20, replace=False)), rng.random(20).astype(np.float32)) for _ in range(60)]
    dense = np.zeros((60, Q.WIDTH), np.float32)
    for i, (t, w) in enumerate(docs):
        dense[i, t] = w
    axes = Q.latent_axes(docs, 8, rounds=30)
    _, s, _ = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(axes.T @ axes, np.eye(8), atol=1e-3)
    assert np.linalg.norm(dense @ axes) == pytest.approx(np.sqrt((s[:8] ** 2).sum()), rel=1e-2)


@pytest.mark.parametrize("labels", [[], [(1, None), (77, 1)], [(4, 1), (4, 0), (4, None)]])
def test_odd_rows(spark, table, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = table(data.ODD)
    scored = Q.with_scores(docs, Q.fit(docs, known, "quality", ALL), out="_s")
    assert scored.columns == [*docs.columns, "_s"]
    rows = scored.collect()
    assert len(rows) == len(data.ODD) and all(0 <= r["_s"] <= 1 for r in rows)
    toxic = T.toxicity_scores(docs, T.fit(docs, known, "quality", ALL)).collect()
    assert len(toxic) == len(data.ODD) and all(0 <= r["score"] <= 1 for r in toxic)
    if not labels or labels[0][0] == 1:
        assert {r["_s"] for r in rows} == {0.5} and {r["score"] for r in toxic} == {0.0}
    none = table([])
    assert Q.with_scores(none, Q.fit(none, known, "quality", ALL), out="_s").collect() == []


def test_repeated_ids_train_the_same_model_in_any_row_order(spark, table):
    """Every labelled id has three texts; which of them trains does not depend on their order or partitions."""
    docs = [(i, data.prose(f"{i}/{j}", 40) + (" vilest" if i % 3 == 0 else "")) for i in range(30) for j in range(3)]
    known = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(30)], "doc_id long, quality int")
    orders = [table(docs, 1), table(docs[::-1], 1), table(docs[1::2] + docs[::2], 5)]
    one, *others = [Q.fit(t, known, "quality", ALL) for t in orders]
    assert all(np.array_equal(one.idf, m.idf) and np.array_equal(one.labels, m.labels) for m in others)
    one, *others = [T.fit(t, known, "quality", ALL) for t in orders]
    assert all(np.array_equal(one.gram_logit, m.gram_logit) for m in others)


def test_scores_come_from_the_text_alone(spark, table):
    docs = [(i, data.prose(i, 50) + (" vilest" if i % 4 == 0 else "")) for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    model = T.fit(table(docs), labels, "toxic", ALL)
    one = {r["doc_id"]: r["score"] for r in T.toxicity_scores(table(docs, 1), model).collect()}
    two = {r["doc_id"] - 1000: r["score"] for r in T.toxicity_scores(table([(i + 1000, t) for i, t in docs], 5), model).collect()}
    assert one == two


def test_unseen_misspellings_and_long_texts(spark, table):
    """One bad word in a long text counts, and so do spellings never seen in training."""
    docs = [(i, data.prose(i, 40 + i % 300) + (" worthless " if i % 5 == 0 else " ") + data.prose(-i, 20)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = T.fit(table(docs), labels, "toxic", ALL)
    new = [(1, data.prose("c1", 2000)), (2, data.prose("c2", 1000) + " worthless " + data.prose("c3", 1000)),
           (3, data.prose("c4", 100) + " worthles " + data.prose("c5", 100)), (4, data.prose("c6", 100)),
           (5, data.prose("c7", 60) + " Worthlesss!!! " + data.prose("c8", 60)), (6, None), (7, "x" * 5000)]
    got = {r["doc_id"]: r["score"] for r in T.toxicity_scores(table(new), model).collect()}
    assert min(got[2], got[3], got[5]) > 0.3 > max(got[1], got[4], got[6], got[7]), got


def test_word_grams():
    grams, starts = T.word_grams([b"ab", b"abcd", b"a"])
    sizes = np.diff([*starts, len(grams)])
    assert sizes.tolist() == [sum(max(0, n + 2 - g + 1) for g in range(T.MIN_GRAM, T.MAX_GRAM + 1)) for n in (2, 4, 1)]
    alone, _ = T.word_grams([b"abcd"])
    assert sorted(alone) == sorted(grams[starts[1]:starts[2]])


def test_toxicity_score_by_its_definition():
    """Words of a text one by one, every passage summed anew, against the vectorised scorer."""
    import math

    rng = np.random.default_rng(3)
    model = T.Model(rng.standard_normal(T.BUCKETS).astype(np.float32), 0.3)
    texts = [data.prose(f"t{i}", n) for i, n in enumerate((1, 2, 15, 16, 17, 23, 24, 25, 40, 333))] + ["a" * 200 + " b", "é É x", "Z"]

    def word_logit(word):
        grams, _ = T.word_grams([word])
        return sum(float(model.gram_logit[g]) for g in grams) / len(grams)
    scorer = T.Scorer(model)
    for text in texts:
        words = T.pieces(text.encode())
        logits = [word_logit(w) for w in words]
        n = len(words)
        starts = {0, *range(0, max(1, n - T.PASSAGE + 1), T.PASSAGE // 2), max(0, n - T.PASSAGE)}
        best = max(sum(logits[s:s + T.PASSAGE]) / len(logits[s:s + T.PASSAGE]) for s in starts)
        scorer.learn(words)
        assert scorer.score(words) == pytest.approx(1 / (1 + math.exp(-(best + model.bias))), rel=1e-6)
    assert T.Scorer(model).score([]) == 0.0


def test_toxicity_training_lowers_its_own_loss():
    """More epochs fit the training texts better, by the cross-entropy of their scores, and the same seed gives the same model."""
    texts = [T.pieces((data.prose(i, 30) + (" vilest" if i % 3 == 0 else "")).encode()) for i in range(120)]
    labels = np.array([i % 3 == 0 for i in range(120)], np.int64)

    def loss(model):
        scorer = T.Scorer(model)
        scorer.learn([w for t in texts for w in t])
        p = np.clip([scorer.score(t) for t in texts], 1e-9, 1 - 1e-9)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))
    short, middle, long, again = (T.train(texts, labels, epochs=n) for n in (1, 15, 60, 60))
    assert loss(long) < loss(middle) < loss(short) and loss(long) < loss(short) / 2
    assert np.array_equal(long.gram_logit, again.gram_logit) and long.bias == again.bias
