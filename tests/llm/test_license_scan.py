import brute
import data
import pytest

from indicata.llm import license_scan as L

BASE = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def documents():
    gpl = "GNU General Public License"
    out = [None, "", "...", "MIT License", f"{gpl}, {gpl}; the gnu general public licence", "cc-by / CC BY 4.0. cc by cc by", "cc by",
           "apache license mit license " * 40, "license apache license", "gnu general public",
           data.prose("x", 300) + f" This work is licensed under the {gpl}, version 3. " + data.prose("y", 300)]
    out += [data.prose(f"n{i}", 50) + " " + text + " " + data.prose(f"m{i}", 50) for i, (text, _) in enumerate(L.NOTICES)]
    out.append(data.prose("long", 20_000) + " mit license")
    return list(enumerate(out))


def test_base_equals_brute_force(table):
    docs = documents()
    got = sorted(tuple(r) for r in L.license_scan(table(docs)).select(*BASE).collect())
    assert got == [(i, *brute.license_base(t, L.PHRASES)) for i, t in docs]


def test_notices_are_found_also_when_edited(table):
    for change in (lambda w: w, lambda w: w[:4] + ["really"] + w[4:], lambda w: w[:-1] if len(w) > 8 else w):
        docs = [(i, data.prose(f"n{i}", 60) + " " + " ".join(change(text.split())).upper() + " " + data.prose(f"m{i}", 60))
                for i, (text, _) in enumerate(L.NOTICES)]
        got = {r["doc_id"]: r for r in L.license_scan(table(docs)).collect()}
        for i, (_, label) in enumerate(L.NOTICES):
            assert label in got[i]["labels"].split(","), (label, got[i])
            assert 0.8 <= got[i]["score"] <= 1.0


def test_scattered_words_give_nothing(table):
    words = " ".join(L.NOTICES[5][0].split()[::-1])
    docs = [(1, words), (2, data.prose("c", 2000)), (3, "the software is free and the license of the software and the of")]
    assert {(r["labels"], r["score"]) for r in L.license_scan(table(docs)).collect()} == {("", 0.0)}


def test_odd_rows_and_empty_table(table):
    rows = [*data.ODD, (9, "MIT License"), (9, "MIT License"), (9, "cc by"), (None, "apache license")]
    got = L.license_scan(table(rows)).collect()
    assert len(got) == len(rows)
    assert sorted((str(r["doc_id"]), r["base_labels"], r["n_base"]) for r in got if r["n_base"]) == [
        ("9", "cc-by", 1), ("9", "mit", 1), ("9", "mit", 1), ("None", "apache", 1)]
    assert L.license_scan(table([])).collect() == []


def test_templates_fit_the_votes():
    assert all(2 <= len(t.words) <= 63 and 1 <= t.least <= t.grams for t in L.TEMPLATES)
    assert L.in_order([b"a", b"b", b"c"], [b"x", b"a", b"c", b"b", b"c"]) == 3


@pytest.mark.parametrize("phrase, label", L.PHRASES)
def test_phrase_across_punctuation(table, phrase, label):
    r = L.license_scan(table([(1, "see " + phrase.upper().replace(" ", " - ") + "!")])).first()
    assert (r["n_base"], r["first_word"], r["base_labels"], r["score"]) == (1, 1, label, 1.0)
