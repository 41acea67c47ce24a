"""Conversations whose turn numbers repeat or are null are cut into blocks too."""

from pyspark.sql import functions as F

from stowage.llm import chat


def test_repeated_and_null_turns(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 4)
    rows = [(None, i % 3, "user", f"t{i:02}") for i in range(30)]
    rows += [(7, None, "user", f"n{i:02}") for i in range(10)] + [(8, 5, "user", "same")] * 9
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    placed = chat.placed_turns(chat.turns_of(frame))
    assert placed.groupBy("conv", "block").count().agg(F.max("count")).first()[0] <= 4
    got = sorted(chat.chat_texts(frame).collect(), key=lambda r: (str(r.conv_id), r.part))
    for conv, n in ((None, 30), (7, 10), (8, 9)):
        parts = [r for r in got if r.conv_id == conv]
        assert [r.part for r in parts] == list(range(-(-n // 4))) and {r.n_turns for r in parts} == {n}
        assert all(r.text.count("<|im_start|>") <= 4 for r in parts)
        texts = sorted(x.split("\n")[1].removesuffix("<|im_end|>") for r in parts for x in r.text.split("<|im_start|>")[1:])
        assert texts == sorted(t for c, _, _, t in rows if c == conv)
    turn_of = {t: k for c, k, _, t in rows if c is None}
    first = "".join(r.text for r in got if r.conv_id is None)
    order = [turn_of[x.split("\n")[1].removesuffix("<|im_end|>")] for x in first.split("<|im_start|>")[1:]]
    assert order == sorted(order)
