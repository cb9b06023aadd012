import math
import random
import re
from collections import Counter, defaultdict

import brute
import data
import pytest

from indicata.llm import distribution_rules as R

KINDS = [r"[\x20\x09-\x0D]", "[a-z]", "[A-Z]", "[0-9]", r"[.,;:!?'\"()\-]", r"[\x00-\x08\x0E-\x1F\x7F]", r"[#-&*+/<=>@\[-`{-~]",
         "[\x80-߿]", "[ࠀ-￿]", "[\U00010000-\U0010ffff]"]
COMMON = {"en": "the of and to in that is was for with".split(), "de": "der die und zu in ist war für mit nicht".split()}


def language(lang, seed, n):
    """Words of which four in ten are common in the language, the others rare."""
    rng = random.Random(f"{lang}{seed}")
    return " ".join((rng.choice(COMMON[lang]) if rng.random() < 0.4 else "".join(rng.choice("aeioubdglmnrst") for _ in range(rng.randint(3, 9))))
                    + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


def documents():
    """(doc_id, text, lang): clean texts of two languages, then junk, odd and short ones."""
    clean = [(lang, language(lang, i, 20 + 17 * i)) for lang in COMMON for i in range(40)]
    lines = "first line\nsecond line\n\nfirst line \nfirst line\n" + language("en", "lines", 60) + "\nsecond line"
    other = [("en", None), ("en", ""), ("en", " \n\t"), ("en", "w " * 19), ("en", language("en", "dup", 9) + " " + "again and again it goes on and on " * 20),
             ("en", " ".join(f"{x}###$$" for x in language("en", "junk", 200).split())), ("en", "".join(chr(0x4E00 + i) + " " for i in range(400))),
             ("en", " ".join(f"{i * 7919 % 100003}" for i in range(300))), ("en", language("de", "swapped", 300)), (None, language("de", "null", 300)),
             (None, "%$& " * 300), ("xx", "%$& ".join(str(i) for i in range(300))), ("en", lines), ("en", language("en", "long", 30_000)), ("en", "x" * 200_000),
             ("de", "\U0001F600é\x00 " * 120), ("en", "same eight words are here twice over now " * 2 + language("en", "tail", 60))]
    return [(i * 2, text, lang) for i, (lang, text) in enumerate(clean + other)]


def share(counts, total):
    return {k: n / total for k, n in counts.items() if n}


def distance(p, q):
    out = 0.0
    for k in {*p, *q}:
        a, b = p.get(k, 0), q.get(k, 0)
        out += (a and a * math.log2(2 * a / (a + b))) + (b and b * math.log2(2 * b / (a + b)))
    return math.sqrt(max(0, out / 2))


def rules(docs, common=0.001, least_share=0.005, reference_words=2000):
    """{doc_id: row} by the definition, with dictionaries."""
    classes = {i: Counter({k: len(re.findall(p, t or "")) for k, p in enumerate(KINDS)}) for i, t, _ in docs}
    tokens = {i: brute.ALNUM.findall(brute.lower(t)) for i, t, _ in docs}
    sizes, words, chars = Counter(), defaultdict(Counter), defaultdict(Counter)
    for i, _, lang in docs:
        sizes[lang] += len(tokens[i])
        words[lang].update(tokens[i])
        chars[lang].update(classes[i])
    ref = {}
    for lang, n in sizes.items():
        if lang is not None and n >= reference_words and n >= least_share * sum(sizes.values()):
            top = {w for w, k in words[lang].items() if k >= common * n and len(w.encode()) <= 40}
            ref[lang] = (share(chars[lang], sum(chars[lang].values())), top, share(Counter(w if w in top else None for w in words[lang].elements()), n))
    out = {}
    for i, text, lang in docs:
        text = text or ""
        w, lines = brute.SPACE.findall(text), [x for x in text.split("\n") if brute.SPACE.search(x)]
        spots = defaultdict(list)
        for a in range(len(w) - 7):
            spots[tuple(w[a:a + 8])].append(a)
        again = {j for s in spots.values() if len(s) > 1 for a in s for j in range(a, a + 8)}
        failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
        t, n, fit = tokens[i], len(tokens[i]), True
        if n >= 50 and (lang is None or lang in ref):
            fit = not ref
            for c, top, p in ref.values():
                near = distance(c, share(classes[i], sum(classes[i].values()))), distance(p, share(Counter(x if x in top else None for x in t), n))
                fit = fit or not (len(text) >= 300 and near[0] > 0.30 or near[1] > 0.30 + 2 / math.sqrt(n))
        out[i] = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed, not failed and fit)
    return out


@pytest.fixture()
def languages(spark):
    from conftest import CLASHING
    from pyspark.sql import functions as F

    def make(rows, partitions=4):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(partitions)
        return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}).withColumns({"kept": F.lit("x"), "class": F.lit(1)})
    return make


def result(df):
    return {r["doc_id"]: tuple(r)[1:8] for r in df.collect()}


@pytest.mark.parametrize("held, partitions", [(200_000, 4), (50, 1)])
def test_equals_brute_force(languages, monkeypatch, held, partitions):
    monkeypatch.setattr(R, "HELD", held)  # a task gives out its counts in many pieces, or in one
    docs = documents()
    assert result(R.judged(languages(docs, partitions))) == rules(docs)


def test_clean_documents_are_kept_and_junk_goes(languages):
    docs = documents()
    got, text = result(R.judged(languages(docs))), {i: t for i, t, _ in docs}
    junk = {2 * (80 + k) for k in (4, 5, 6, 7, 10, 15)}
    for i, row in got.items():
        if i < 160:
            assert row[-1] == (len(text[i].split()) >= 20), row
        assert not (i in junk and row[-1]), text[i][:60]
    assert got[2 * (80 + 8)][-1] and got[2 * (80 + 9)][-1]  # a wrong language column, and none
    assert got[2 * (80 + 11)][-1]  # no reference for its language


def test_odd_rows_and_empty_tables(languages):
    rows = [(i, t, None if t and len(t) < 5 else "en") for i, t in data.ODD]
    got = R.judged(languages(rows)).collect()
    assert len(got) == len(rows) and not any(r["kept"] for r in got) and all(r["class_distance"] is None for r in got)
    assert R.judged(languages([])).collect() == []
    assert result(R.judged(languages([(1, language("en", 1, 300), "en")]))) == rules([(1, language("en", 1, 300), "en")])


def test_references_stay_within_their_bounds(languages):
    docs = [(i, language("en", i, 400), f"l{i % 30}") for i in range(90)] + [(500, "rare " * 600, "rare")]
    found = R.language_references(languages(docs), common=0.01, least_share=0.02, reference_words=1000)
    assert len(found) == 30 and "rare" in R.language_references(languages(docs), least_share=0.01, reference_words=500)
    for ref in found.values():
        assert len(ref.words) <= 100 and min(ref.words.values()) >= 0.01
        assert abs(sum(ref.words.values()) + ref.rest - 1) < 1e-9 and abs(ref.classes.sum() - 1) < 1e-9
