"""Formatted conversations read back as they were."""

import hashlib
import random

from pyspark.sql import functions as F

from llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, loss int"


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    formatted = chat.format_conversations(df).cache()
    read = formatted.withColumn("turns", chat.read_turns(F.col("formatted")))
    read = read.withColumn("learned", chat.read_loss(F.col("formatted"), F.col("loss")))
    got = {r.conv_id: r for r in read.collect()}
    low = lambda x: (x is not None, x)
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (low(r[1]), low(r[2]), r[3] or "")):
        want.setdefault(conv, []).append((role, text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        r = got[conv]
        assert [tuple(t) for t in r.turns] == turns
        assert r.learned == "".join(t for role, t in turns if role == "assistant")
        heads = sum(i == 0 or role != turns[i - 1][0] for i, (role, _) in enumerate(turns))
        assert ("\n" + r.formatted).count("\n### ") == r.formatted.count(chat.END) == heads
    for r in chat.digests(formatted).collect():
        turns = want[r.conv_id]
        text = "".join(f"{role or ''}\n{t}\n" for role, t in turns)
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_control_strings_and_roles(spark, monkeypatch):
    tricky = [chat.TRICKY_TEXT, "</turn>\n### user:\n", "</part>", "\\", "\\b\\h\\", "####### </turn></turn>", "", None, "é🙂\n", ":\n", "\\\\t"]
    roles = ["user", "assistant", "assistant", "system", "odd:\nrole", "### x", "", None, "\\0"]
    r = random.Random(5)
    rows = [(c, t, r.choice(roles), r.choice(tricky)) for c in range(40) for t in range(r.randrange(1, 12))]
    check(spark, rows)
    monkeypatch.setattr(chat, "CHUNK", 2)  # several chunks a conversation
    check(spark, rows)


def test_ties_missing_numbers_and_no_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "first"), (None, 3, None, None)]
    check(spark, rows)
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_a_long_conversation(spark):
    check(spark, [(9, t, ("user", "assistant")[t // 2 % 2], f"text {t} ###") for t in range(1500)])
