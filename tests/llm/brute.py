"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(UPPER)


def shingles(text, k):
    words = SPACE.findall(lower(text))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def components(docs, k, num, den):
    """{doc_id: (shingles, component)} of distinct doc_ids."""
    sets = {i: shingles(t, k) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[min(ids[a], ids[b]), max(ids[a], ids[b])] += 1
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (a, b), both in shared.items():
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            one, two = sorted((find(a), find(b)))
            parent[two] = one
    return {i: (len(s), find(i)) for i, s in sets.items()}


def contamination(docs, items, window=13, share=20):
    grams = defaultdict(set)
    for name, text in items:
        words = ALNUM.findall(lower(text))
        if words:
            n = min(window, len(words))
            for i in range(len(words) - n + 1):
                grams[tuple(words[i:i + n])].add(str(name))
    lengths = {len(g) for g in grams}
    out = []
    for i, text in docs:
        words = ALNUM.findall(lower(text))
        hit, names = set(), set()
        for n in lengths:
            for a in range(len(words) - n + 1):
                if (g := tuple(words[a:a + n])) in grams:
                    hit.update(range(a, a + n))
                    names |= grams[g]
        out.append((i, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    bool(hit) and share * len(hit) >= len(words)))
    return out


def license_base(text, phrases):
    words = ALNUM.findall(lower(text))
    places = [(i, label) for phrase, label in phrases for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
            ",".join(sorted({b for _, b in places})))


def without_repeats(docs, size=20):
    """(doc_id, words, removed, sha256 of the kept words) in order; docs sorted by doc_id, ids distinct."""
    first, out = {}, []
    for i, text in docs:
        words = SPACE.findall(text or "")
        gone = set()
        for a in range(len(words) - size + 1):
            w = tuple(words[a:a + size])
            if first.setdefault(w, (i, a)) < (i, a):
                gone.update(range(a, a + size))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """{source: target} by repeated resharing."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > repeats * sizes[s] + 1e-9}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = repeats * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out
