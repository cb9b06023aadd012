"""Deterministic texts with near copies, shared passages and odd cases."""

import random

WORDS = [a + b for a in "ba be bi bo bu da de di do du ka ke".split() for b in "la ma na ra sa ta".split()]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", ",", ".", "\n", "  "]) for _ in range(n))


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split())


def corpus():
    """(doc_id, text): near copies of several closeness, exact copies, a passage that many share, empty and long texts."""
    out, passage = [], prose("passage", 60)
    for base in range(12):
        text = prose(base, 40 + 30 * base)
        out.append(text)
        out += [edited(text, f"{base}/{i}", share) for i, share in enumerate((0.0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.2))]
        out += [text.upper(), text, " " + text + "\t"]
    out += [prose(f"p{i}", 30 + i) + " " + passage + " " + prose(f"q{i}", 25) for i in range(40)]
    out += [edited(prose("hub", 200), f"hub{i}", 0.02) for i in range(60)]
    out += [None, "", "  \t\n", "one", "one", "One two", "one two three", "ONE two three", "é É ß", "\x00 a\x00b", prose("long", 12000),
            edited(prose("long", 12000), "l", 0.01), "a " * 500, "a b " * 300, "a " * 499]
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


ODD = [(1, None), (2, ""), (3, " \n"), (4, "word"), (None, "word"), (None, None), (5, "same text here and there"),
       (5, "same text here and there"), (5, "another text under the same id"), (6, "same text here and there")]
