import brute
import data
import numpy as np
import pytest

from indicata.llm import substring_dedup as S

COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("cells, chunk", [(1 << 29, 1 << 20), (1 << 29, 100), (8, 3000)])
def test_equal_brute_force(table, monkeypatch, cells, chunk):
    """Also with tiny chunks, and with a sketch so full that nearly every window goes to the exact pass."""
    monkeypatch.setattr(S, "CHUNK_WORDS", chunk)
    docs = data.corpus()
    got = sorted(tuple(r) for r in S.without_repeats(table(docs), 20, max_cells=cells).select(*COLUMNS).collect())
    assert got == brute.without_repeats(docs)


def test_spans_and_documents(table):
    docs = data.corpus()
    spans = {r["doc_id"]: r for r in S.without_repeats(table(docs)).collect()}
    source = table(docs)
    new = S.deduplicated(source, 20, chars_col="size")
    assert new.columns == source.columns
    texts = dict(docs)
    for r in new.collect():
        found = spans[r["doc_id"]]
        if found["n_removed"]:
            words = brute.SPACE.findall(texts[r["doc_id"]])
            gone = {j for a, b in zip(found["removed"][::2], found["removed"][1::2]) for j in range(a, b)}
            assert r["text"] == found["kept"] == " ".join(w for j, w in enumerate(words) if j not in gone)
            assert len(gone) == found["n_removed"]
        else:
            assert r["text"] == texts[r["doc_id"]] and found["removed"] == []


@pytest.mark.parametrize("chunk, partitions", [(1 << 20, 1), (1 << 20, 4), (20, 1), (20, 3)])
def test_rows_that_repeat_a_doc_id(table, monkeypatch, chunk, partitions):
    """The earliest start wins, by (doc_id, start), in whatever order and chunks the rows come."""
    monkeypatch.setattr(S, "CHUNK_WORDS", chunk)
    passage = " ".join(f"p{i}" for i in range(25))
    a, b = "one two three four five six seven eight nine ten " + passage + " end", "x y z " + passage + " other end"
    rows = [(5, a), (5, b), (None, "q " + passage), (None, passage), (9, passage + " tail"), (9, a), (5, a)]
    first = {}
    for i, text in rows:
        w = text.split()
        for at in range(len(w) - 19):
            key = tuple(w[at:at + 20])
            first[key] = min(first.get(key, (np.inf, 0)), (np.inf if i is None else i, at))
    want = []
    for i, text in rows:
        w, gone = text.split(), set()
        for at in range(len(w) - 19):
            if first[tuple(w[at:at + 20])] < (np.inf if i is None else i, at):
                gone.update(range(at, at + 20))
        want.append((i, " ".join(x for j, x in enumerate(w) if j not in gone)))
    for order in (rows, rows[::-1]):
        got = [(r["doc_id"], r["kept"]) for r in S.without_repeats(table(order, partitions)).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert (5, a.replace(passage + " ", "")) in want and (5, b) in want


def test_leftmost_least():
    rng = np.random.default_rng(1)
    for width in range(1, 14):
        x = rng.integers(0, 5, 40).astype(np.uint64)
        value, place = S.leftmost_least(x, width)
        want = [i + int(np.argmin(x[i:i + width])) for i in range(41 - width)]
        assert place.tolist() == want and value.tolist() == [x[i] for i in want]


def test_odd_rows(table):
    long = " ".join(f"w{i}" for i in range(25))
    rows = [*data.ODD, (7, long), (7, long), (None, long), (8, long), (8, "x " + long)]
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in S.without_repeats(table(rows)).collect()), key=str)
    want = [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (None, 1, 0), (None, 0, 0), (5, 5, 0), (5, 5, 0), (5, 6, 0), (6, 5, 0),
            (7, 25, 0), (7, 25, 0), (None, 25, 25), (8, 25, 25), (8, 26, 25)]
    assert got == sorted(want, key=str)


def test_empty_table(table):
    assert S.without_repeats(table([])).collect() == []


def test_a_window_needs_words(table):
    with pytest.raises(ValueError, match="words"):
        S.without_repeats(table([]), 5)
