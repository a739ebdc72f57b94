import hashlib
import random

from snapdemand.llm import chat


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, turns in by_conv.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), digest("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), digest(loss)))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def back(df):
    found = chat.digests(chat.examples(df)).drop("formatted_chars").collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_everything_can_be_read_back(spark):
    rng, rows = random.Random(1), []
    bits = ["\\", "\\\\", "#", "###", "### assistant: ", "</turn>", "</turn>\n", "<", "</", "\n", "a", "é", "😀", "$1", ": ", " "]
    for conv in range(300):
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "a: b\n#", "\\"]),
                         "".join(rng.choices(bits, k=rng.randint(0, 9)))))
    assert back(frame(spark, rows)) == brute(rows)


def test_each_reply_is_one_example_after_all_that_came_before(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi #1"), (1, 2, "assistant", "yo"), (1, 3, "user", "bye"),
            (1, 4, "assistant", "</turn>"), (1, 5, "user", "?"), (2, 0, "user", "alone")]
    found = chat.examples(frame(spark, rows)).orderBy("conv_id", "position").collect()
    start = "### system: be kind</turn>\n### user: hi #\\1</turn>\n"
    first = start + "### assistant: yo</turn>\n"
    second = first + "### user: bye</turn>\n### assistant: <\\/turn></turn>\n"
    assert [r.formatted for r in found] == [first, second, second + "### user: ?</turn>\n", "### user: alone</turn>\n"]
    assert [r.formatted[r.loss_start:r.loss_start + r.loss_length] for r in found] == ["yo", "<\\/turn>", "", ""]


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, None, None, "before"), (1, 0, "assistant", ""), (1, 0, "assistant", "x"), (1, 0, "assistant", "x"),
            (None, 1, "user", "a"), (None, 2, "assistant", "b"), (3, 1, "assistant", "z" * 200_000)]
    df = frame(spark, rows)
    assert back(df) == brute(rows)
    clash = df.selectExpr("*", "1 as position", "2 as turns", "3 as formatted", "4 as t", "5 as loss")
    assert back(clash) == brute(rows)
    assert back(df.limit(0)) == []


def test_no_python_in_the_plan(spark):
    plan = chat.digests(chat.examples(frame(spark, [(1, 1, "user", "a")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
