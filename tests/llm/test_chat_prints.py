"""Layouts are selected by the hash of field paths, down to the leaves."""

import json

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import chat_format


def test_tables_of_either_kind(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a", "x")], "conv_id long, turn int, role string, text string, prompt string")
    assert chat_format.layout_of(rows).name == "turn_rows"
    assert [tuple(r) for r in chat_format.turn_rows(rows).collect()] == [(1, 0, "user", "a")]
    messages = spark.createDataFrame([(1, [("human", "a"), ("gpt", "b")], "z"), (2, [], "z"), (3, None, "z")], "conv_id long, conversations array<struct<`from`:string,value:string>>, extra string")
    assert sorted(tuple(r) for r in chat_format.turn_rows(messages).collect()) == [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    pairs = spark.createDataFrame([(1, "p", "r", None)], "conv_id long, prompt string, response string, system string")
    assert sorted(tuple(r) for r in chat_format.turn_rows(pairs).collect()) == [(1, 0, "user", "p"), (1, 1, "assistant", "r")]
    with pytest.raises(ValueError):
        chat_format.turn_rows(pairs.drop("response"))


def test_the_hash_selects_the_layout_of_the_query(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn int, role string, text string")
    monkeypatch.setattr(chat_format, "fingerprint", lambda paths: "another")
    with pytest.raises(ValueError):
        chat_format.turn_rows(rows)


def test_messages_without_a_leaf_have_another_print(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant"}]},
        {"messages": [{"content": "a"}]},
        {"conversations": [{"from": "human"}]},
        {"messages": [{"role": "user", "content": ""}]},
        {"messages": []},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, payload string")
    assert [(r["layout"], r["turns"] and len(r["turns"])) for r in chat_format.canonical_records(df).orderBy("i").collect()] == [(None, None)] * 3 + [("messages", 1), ("messages", [])]


def test_parts_and_empty_messages(spark):
    part = lambda *texts: [{"type": "text", "text": t} for t in texts]
    records = [
        {"messages": [{"role": "user", "content": part("a", "b")}, {"role": "assistant", "content": part("c")}]},
        {"messages": []},
        {"messages": [{"role": "user", "content": []}]},
        {"messages": [{"role": "user", "content": part("a")}, {"role": "assistant", "content": "[c"}]},
        {"messages": [{"role": "user", "content": "[\"not\", \"parts\"]"}], "extra": {"deep": [1]}},
        {"messages": [{"role": "user", "content": [{"type": "image"}]}]},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, payload string")
    out = {r["i"]: (r["layout"], [tuple(t) for t in r["turns"]] if r["turns"] is not None else None) for r in chat_format.canonical_records(df).collect()}
    assert out[0] == ("message_parts", [("user", "ab"), ("assistant", "c")])
    assert out[1] == ("messages", []) and [out[i] for i in (2, 3, 5)] == [(None, None)] * 3
    assert out[4] == ("messages", [("user", '["not", "parts"]')])


def test_records_of_mixed_layouts_tell_the_same_turns(spark):
    texts = ["", "x", "a <b> \\ c", 'say "hi"\n\t\u0001', "[{\"text\":\"no part\"}]", "日本 é", None, "{}"]
    rows = []
    for i in range(120):
        roles = [["user", "assistant"], ["system", "user", "assistant"], ["human", "gpt"], ["user", "assistant", "user"], [""]][i % 5]
        rows += [(i, k, r, texts[(i + k) % len(texts)]) for k, r in enumerate(roles)]
    turns = chat_format.turn_rows(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    whole = chat_format.gathered(turns)
    read = chat_format.canonical_records(chat_format.as_records(whole))
    kinds = {r["layout"]: r["n"] for r in read.groupBy("layout").agg(F.count("*").alias("n")).collect()}
    assert set(kinds) == {"messages", "message_parts", "from_value", "prompt_response"}
    want = {r["conv_id"]: r["turns"] for r in whole.collect()}
    assert {r["conv_id"]: r["turns"] for r in read.collect()} == want and len(want) == 120
