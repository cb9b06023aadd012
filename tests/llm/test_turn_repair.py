import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from indicata.llm import turn_repair as T

SHAPE = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """First fault of each (turn, role, text) row in order: b, d, t or an empty string."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        out.append("b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def every_edit(rows, bad):
    """(cost, audit, lines) of the least of all edits, by listing them (with up to two inserts before each row and at the end)."""
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    choices = []
    for (_, role, text), fault in zip(rows, bad, strict=True):
        ways = [(3, "D", [])]
        if fault not in ("b", "d"):
            ways += [((fault == "t"), "K", [(role, text)]), *((2 + (fault == "t"), "R", [(r, text)]) for r in ("user", "assistant"))]
        choices.append([(c + 2 * len(ins), "I" * len(ins) + letter, [(r, "") for r in ins] + lines) for c, letter, lines in ways for ins in inserts])
    choices.append([(2 * len(ins), "I" * len(ins), [(r, "") for r in ins]) for ins in inserts])
    best = None
    for way in itertools.product(*choices):
        lines = [x for w in way for x in w[2]]
        if SHAPE.fullmatch("".join(r[:1] or "-" for r, _ in lines)):
            here = (sum(w[0] for w in way), "".join(w[1] for w in way), lines)
            best = min(best or here, here, key=lambda x: x[:2])
    return best


def steps_of(rows, bad):
    return [T.Step(role[:1], f in ("b", "d"), f == "t") for (_, role, _), f in zip(rows, bad, strict=True)]


def by_blocks(steps, size):
    """(cost, audit) of the steps cut into blocks of ``size``."""
    blocks = [T.least_paths(steps[i:i + size], (0, 1, 2, 3)) for i in range(0, len(steps), size)]
    flat = [([ways[s].get(t, (T.NEVER, "", 0))[0] for s in range(4) for t in range(4)],
             [ways[s].get(t, (0, "", 0))[2] for s in range(4) for t in range(4)]) for ways in blocks]
    cost, states, tail = T.decided(flat)
    return cost, "".join(ways[s][t][1] for ways, (s, t) in zip(blocks, states, strict=True)) + "I" * tail


def test_least_of_all_edits():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 3, 3, 4):
        for _ in range(12):
            rows = [(i, rng.choice(["user", "assistant", "assistant", "user", "system", "tool", " ", ""]),
                     rng.choice(["yes.", "yes.", "no", "", "ok!", "so it goes"])) for i in range(n)]
            bad = faults(rows)
            want = every_edit(rows, bad)
            for size in (1, 2, 9):
                cost, audit = by_blocks(steps_of(rows, bad), size)
                assert (cost, audit) == want[:2], rows
            assert [(r, x[2] if x else "") for r, x in T.turns(T.NOTHING, audit, [(r, t, x) for t, r, x in rows])] == want[2]


def test_blocks_don_t_matter():
    rng = random.Random(2)
    for _ in range(200):
        steps = [T.Step(rng.choice("uaus t"), rng.random() < 0.15, rng.random() < 0.2) for _ in range(rng.randint(5, 40))]
        assert len({by_blocks(steps, size) for size in (1, 2, 3, 7, 100)}) == 1


def test_many_copies_are_one_step():
    one = [T.Step("u"), T.Step("u", delete=True, times=500), T.Step("a")]
    each = [T.Step("u"), *[T.Step("u", delete=True)] * 500, T.Step("a")]
    assert by_blocks(one, 9) == by_blocks(each, 9) == by_blocks(each, 50) == (1500, "K" + "D" * 500 + "K")


def report(rows, ids):
    """{conv_id: row of the report} of (conv_id, turn, role, text) rows, with tuples and strings for weights."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv in ids:
        own = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        bad, count = faults(own), Counter(faults(own))
        paths = {"": (0, "", [])}  # by last initial; s only at the start

        def least(new):
            return {k: min((p for q, p in new if q == k), key=lambda p: p[:2]) for k in {q for q, _ in new}}

        def insert(paths):
            new = list(paths.items())
            new += [("u", (c + 2, a + "I", x + ["user:"])) for q, (c, a, x) in paths.items() if q != "u"]
            paths = least(new)
            if "u" in paths:
                c, a, x = paths["u"]
                paths = least([*paths.items(), ("a", (c + 2, a + "I", x + ["assistant:"]))])
            return paths
        for (_, role, text), fault in zip(own, bad, strict=True):
            new = []
            for q, (c, a, x) in insert(paths).items():
                new.append((q, (c + 3, a + "D", x)))
                if fault not in ("b", "d"):
                    more, to = c + (fault == "t"), "a" if q == "u" else "u"
                    new.append((to, (more + 2, a + "R", x + [("user:" if to == "u" else "assistant:") + text])))
                    if role[:1] == to or role[:1] == "s" and q == "":
                        new.append(("s" if role[:1] == "s" else to, (more, a + "K", x + [f"{role}:{text}"])))
            paths = least(new)
        cost, audit, lines = min((p for q, p in insert(paths).items() if q in ("", "a")), key=lambda p: p[:2])
        known = {r[0] for r in own if r[0] is not None}
        pairs = zip(own, own[1:], strict=False)
        out[conv] = (max(known) - min(known) + 1 - len(known) if known else 0, count["b"], count["d"], count["t"],
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations():
    rng = random.Random(3)
    out = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            out.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]),
                        rng.choice(["Yes.", "No!", "", " \t", "Same text.", "cut off", f"{turn} words?", None])))
    out += [(100, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(700)]                  # long and sound
    out += [(101, i // 3, rng.choice(["user", "assistant", "system"]), f"turn {i}" + rng.choice([".", ""])) for i in range(400)]
    out += [(102, 5, "user", "again and again.")] * 300 + [(102, 6, "assistant", "fine.")]              # one row many times
    out += [(103, None, None, None), (103, None, "user", "x."), (103, 4, "assistant", None), (103, 2, "assistant", "x.")]
    out += [(None, 1, "user", "no id."), (None, 2, "assistant", "none."), (104, 1, "", "no role."), (105, 3, "sys", "only this."),
            (106, 1, "user", "é" * 30_000 + "."), (106, 2, "assistant", "\n\n.\n"), (107, -(2**40), "user", "a."), (107, 2**40, "assistant", "b.")]
    out += [(108, t, "user", "same.") for t in (None, 1, 2, 2)]
    return out


@pytest.fixture()
def turns_table(spark):
    from conftest import CLASHING
    from pyspark.sql import functions as F

    def make(rows, partitions=3):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(partitions)
        return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}).withColumns({"place": F.lit(7), "conv": F.lit("c")})
    return make


@pytest.mark.parametrize("block_rows", [1024, 3])
def test_report_equals_brute_force(spark, turns_table, block_rows):
    rows = conversations()
    ids = {r[0] for r in rows} | {999}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(block_rows == 1024).lower())  # long conversations cross tasks
    try:
        got, turns = T.repaired(turns_table(rows), turns_table([*rows, (999, 1, "user", "lost.")]), block_rows=block_rows)
        got = {r[0]: tuple(r)[1:] for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == report(rows, ids) and got[999] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    lines = defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: (r["place"], r["position"])):
        lines[r["conv_id"]].append((r["role"], r["text"]))
    for conv, said in lines.items():
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in said).encode()).hexdigest() == got[conv][-1]
        assert SHAPE.fullmatch("".join(a[:1] for a, _ in said))


def test_damage(turns_table):
    rows = [*conversations(), (None, None, "user", "a. b! c?")]
    want = []
    for conv, turn, role, text in rows:
        rule = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if rule:
            hurt = (conv, turn, "user" if rule == 4 else role, "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text)
            want += [hurt] * (2 if rule == 3 else 1)
    got = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in T.damaged(turns_table(rows)).collect()]
    assert Counter(got) == Counter(want)


def test_empty_table(turns_table):
    report_, turns = T.repaired(T.damaged(turns_table([])))
    assert report_.collect() == [] and turns.collect() == []
