import random

from pyspark.sql import functions as F

from waymark.llm.chat import Template, format_chats, loss_text, read_turns
from waymark.llm.queries import TRICKY


def test_round_trip_and_loss(spark):
    rng = random.Random(7)
    bits = ["\\", "#", "###", "<", "</turn>\n", ": ", "\\h", "\\b", "\\l", "a", "é", "\n", "### Assistant: ", "漢"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["system", "user", "assistant", "tool", "a: b#\\c", None])
            rows.append((conv, turn, role, rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))]), "x"))
    rows += [(100, 0, "user", TRICKY, ""), (100, 1, "assistant", TRICKY, ""), (None, 1, "user", "q", ""), (None, None, "assistant", "first", "")]
    rows += [(101, 3, "user", "b", ""), (101, 3, "user", "a", ""), (101, 3, "user", "a", "")] + [(102, i, "user", "t" * 50, "") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = format_chats(df).select("*", read_turns(F.col("formatted")).alias("back"), loss_text(F.col("segments")).alias("learnt")).collect()
    want = {}
    for conv, turn, role, text, _ in rows:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert len(got) == len(want)
    for r in got:
        turns = sorted(want[r.conv_id])
        assert [tuple(t) for t in r.back] == [(t[2], t[3]) for t in turns]
        assert r.learnt == "".join(t[3] for t in turns if t[2] == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.formatted.count("</turn>") == len(turns) and r.formatted.count("### ") == len(turns)
    assert format_chats(df.limit(0)).count() == 0


def test_turn_order(spark):
    cases = {1: ["user", "assistant"], 2: ["system", "user", "assistant", "user", "assistant"], 3: ["assistant"], 4: ["user", "user"], 5: ["user"], 6: ["user", "assistant", "tool", "assistant"], 7: ["system", "system"]}
    df = spark.createDataFrame([(c, i, r, "t") for c, rs in cases.items() for i, r in enumerate(rs)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.valid, r.first_bad) for r in format_chats(df, Template()).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, None), 6: (True, None), 7: (False, 1)}
