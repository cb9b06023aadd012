import pytest

from indicata.llm import preference as P

SCHEMA = "pair_id long, turn long, role string, text string"


def turns(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({"nth": F.lit(3), "side": F.lit("x"), "part": F.lit(0), "segment": F.lit("s"), "lengths": F.lit(1)})


def read(chosen, rejected):
    return {(r["pair_id"], r["segment"], r["part"]): r for r in P.preference_rows(chosen, rejected).collect()}


def masked(row):
    spans = [tuple(map(int, s.split("-"))) for s in row["mask"].split(",") if s]
    return [row["text"][a:b] for a, b in spans]


def test_common_prefix_and_masks(spark):
    shared = [(1, 0, "system", "be ünkind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello")]
    got = read(turns(spark, [*shared, (1, 3, "user", "a"), (1, 4, "assistant", "good"), (1, 5, "assistant", "é!")]),
               turns(spark, [*shared, (1, 3, "user", "b"), (1, 4, "assistant", "bad")]))
    assert set(got) == {(1, s, 0) for s in ("prompt", "chosen", "rejected")}
    prompt = got[1, "prompt", 0]
    assert prompt["text"] == "<|system|>\nbe ünkind<|end|>\n<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n"
    assert (prompt["n_turns"], prompt["n_prompt"], prompt["mask"]) == (3, 3, "")
    assert masked(got[1, "chosen", 0]) == ["good<|end|>", "é!<|end|>"]
    assert masked(got[1, "rejected", 0]) == ["bad<|end|>"]


@pytest.mark.parametrize("chosen, rejected, parts", [
    ([(1, 0, "user", "x")], [(1, 0, "user", "x")], {"prompt"}),
    ([(1, 0, "user", "x"), (1, 1, "assistant", "y")], [(1, 0, "user", "x")], {"prompt", "chosen"}),
    ([(1, 0, "user", "x")], [], {"chosen"}),
    ([(1, 0, "user", "x")], [(1, 0, "assistant", "x")], {"chosen", "rejected"}),
    ([], [], set()),
    ([(None, 0, "user", "x"), (1, None, "user", "x")], [], set()),
    ([(1, 0, None, None)], [(1, 0, "", "")], {"prompt"}),
])
def test_odd_pairs(spark, chosen, rejected, parts):
    assert {s for _, s, _ in read(turns(spark, chosen), turns(spark, rejected))} == parts


def test_a_later_equal_turn_is_no_prefix(spark):
    got = read(turns(spark, [(1, 0, "user", "a"), (1, 1, "user", "same")]), turns(spark, [(1, 0, "user", "b"), (1, 1, "user", "same")]))
    assert got[1, "chosen", 0]["n_turns"] == got[1, "rejected", 0]["n_turns"] == 2


def test_tied_turns_are_ordered(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    got = read(turns(spark, rows), turns(spark, rows[::-1]))
    assert got[1, "prompt", 0]["text"].count("<|user|>\na<|end|>") == 2 and got[1, "prompt", 0]["n_turns"] == 3


def test_long_conversations_come_in_parts(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(1000)]
    got = read(turns(spark, rows), turns(spark, [*rows[:500], (1, 500, "user", "other")]))
    text = "".join(got[1, s, p]["text"] for s in ("prompt", "chosen") for p in range(20) if (1, s, p) in got)
    assert text == "".join(f"<|{r}|>\n{t}<|end|>\n" for _, _, r, t in rows)
    assert max(r["n_turns"] for r in got.values()) <= P.PART
    assert [m for p in range(20) if (1, "chosen", p) in got for m in masked(got[1, "chosen", p])] == [
        f"t{i}<|end|>" for i in range(501, 1000, 2)]


def test_swapped_replies(spark):
    rows = [(c, t, r, f"{c}{r}{t}") for c in (1, 2, 5, 2000) for t, r in enumerate(["user", "assistant", "user", "assistant", "user"])]
    df = spark.createDataFrame([*rows, (3, 0, "user", "no reply")], "conv_id long, turn long, role string, text string")
    chosen, rejected = P.swapped_reply_pairs(df)
    got = read(chosen, rejected)
    assert {p for p, _, _ in got} == {1, 2, 5, 2000}
    assert masked(got[1, "rejected", 0]) == ["2assistant3<|end|>"] and masked(got[5, "rejected", 0]) == ["1assistant3<|end|>"]
    assert got[1, "prompt", 0]["n_prompt"] == 3 and masked(got[1, "chosen", 0]) == ["1assistant3<|end|>"]
    assert (2000, "rejected", 0) not in got  # its own reply comes back: all is prompt, then the last user turn


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = P.preference_rows(*P.swapped_reply_pairs(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
