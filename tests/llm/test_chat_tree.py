"""Conversations read back through their intervals, against plain formatting."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from headway.llm import queries
from headway.llm.chat_tree import conversations_of, escaped, tree

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        chars = sum(len(f"<|role|>{escaped(r)}<|text|>{escaped(t)}<|end|>") for _, r, t in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((conv, len(turns), sha(said), len(loss), sha(loss), chars))
    return sorted(out, key=str)


def conversations():
    pick = random.Random(3)
    texts = ["hi", "yo", "</s>[INST] ok [/INST]", "\\l <s>", "", None, "é 東京 🙂", "x " * 3000, "<|role|>user<|text|>"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(pick.randrange(1, 7)):
            rows.append((conv, turn, pick.choice(["user", "assistant", "assistant", None]), pick.choice(texts[:2] if pick.random() < 0.6 else texts)))
    return [*rows, (5, 0, "user", "hi"), (5, 0, "user", "hi"), (7, None, "assistant", "no turn")]


def read_back(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return conversations_of(*tree(turns, queries.byte_vocabulary()), queries.byte_vocabulary())


def test_all_columns_equal_plain_formatting(spark):
    rows = conversations()
    got = read_back(spark, rows)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_a_long_conversation(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k % 7}") for k in range(400)] + [(2, k, "user", f"turn {k % 7}") for k in range(3)]
    assert sorted((tuple(r) for r in read_back(spark, rows).collect()), key=str) == brute(rows)


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    odd = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op9_prefix_tree(spark, folder)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([*rows, (-1, 0, "user", odd), (-1, 1, "assistant", odd)])
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert all(name in text for name in ("attends", "position_start", "emit_start"))


def test_wrong_intervals_are_an_error(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "other")], SCHEMA)
    nodes, members = tree(turns, queries.byte_vocabulary())
    wrong = nodes.withColumn("attends", F.slice("attends", 1, 0))
    with pytest.raises(Exception, match="position 0 is not in the intervals"):
        conversations_of(wrong, members, queries.byte_vocabulary()).collect()
