from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from fathomline.llm import chat
from fathomline.llm.queries import HOSTILE, ORACLES, op8_chat
from tests.compare import database, difference, spark_rows, sql_rows, type_difference

TURNS = "conv_id long, turn long, role string, text string"


def back(spark, rows):
    read = chat.read_chat(chat.format_chat(chat.canonical_turns(spark.createDataFrame(rows, TURNS))))
    return {r["conv_id"]: r for r in read.collect()}


def test_equals_the_sql(spark, sf):
    con = database(sf)
    df = op8_chat(spark, sf)
    assert difference(spark_rows(df), sql_rows(con, ORACLES["op8_chat"])) is None
    assert type_difference(df, con, ORACLES["op8_chat"]) is None


def test_hostile_conversation(spark, sf):
    row = {r["conv_id"]: r for r in op8_chat(spark, sf).collect()}[-1]
    turns = f"user\n{HOSTILE}\nassistant\n{HOSTILE}\n".encode()
    assert row["turns_sha256"] == hashlib.sha256(turns).hexdigest()
    assert (row["loss_chars"], row["loss_sha256"]) == (len(HOSTILE), hashlib.sha256(HOSTILE.encode()).hexdigest())


def test_any_text_comes_back(spark):
    nasty = ["<|", "<\\|", "<\\\\|im_end|>", "<|im_start|>user\nx<|im_end|>\n", "", "$1 \\1 <||>", "a\nb\n", "é😀<|n|>", "<<||", "<|" * 50]
    rows = [(1, i, ["user", "assistant", "assis\ntant", "<|n|>", "\\"][i % 5], t) for i, t in enumerate(nasty * 3)]
    row = back(spark, rows)[1]
    assert [(t["role"], t["text"]) for t in row["turns"]] == [(r[2], r[3]) for r in rows]
    assert "".join(row["learned"]) == "".join(r[3] for r in rows if r[2] == "assistant")


def test_awkward_rows(spark):
    rows = [
        (1, 2, "assistant", "second"), (1, None, None, None), (1, 2, "assistant", "second"), (1, 0, "user", "x" * 60000),
        (None, 0, "assistant", "no id"), (2, 0, "user", None),
    ]
    got = back(spark, rows)
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("", ""), ("user", "x" * 60000), ("assistant", "second"), ("assistant", "second")]
    assert got[None]["learned"] == ["no id"] and got[2]["learned"] == []
    assert back(spark, []) == {}
    extra = spark.createDataFrame(rows, TURNS).withColumn("n", F.lit(1)).withColumn("formatted", F.lit("x")).withColumn("loss", F.lit(2))
    digest = chat.chat_digest(chat.format_chat(chat.canonical_turns(extra)))
    assert {r["conv_id"]: r["n_turns"] for r in digest.collect()} == {1: 4, None: 1, 2: 1}


def turns_of(df):
    return {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.canonical_turns(df).collect()}


def test_layouts_are_chosen_by_their_fields(spark):
    two = [("user", "q"), ("assistant", "a")]
    assert turns_of(spark.createDataFrame([(1, "q", "a", "x")], "conv_id long, prompt string, completion string, source string"))[1] == two
    assert turns_of(spark.sql("select 1L conv_id, array(named_struct('from','human','value','q'), named_struct('from','gpt','value','a')) conversations"))[1] == two
    assert turns_of(spark.sql("select 1L conv_id, array(named_struct('role','human','content','q')) messages"))[1] == [("human", "q")]
    assert turns_of(spark.sql("select 1L conv_id, named_struct('prompt','q','response','a') data"))[1] == two
    rows = spark.createDataFrame([(1, "do", "", "done"), (2, "do", "this", None)], "conv_id long, instruction string, input string, output string")
    assert turns_of(rows) == {1: [("user", "do"), ("assistant", "done")], 2: [("user", "do"), ("user", "this"), ("assistant", "")]}
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, "q")], "conv_id long, prompt string"))
    assert len(chat.BY_FINGERPRINT) == len(chat.LAYOUTS)


def test_columns_named_like_other_layouts_are_extra(spark):
    rows = spark.createDataFrame([(1, 0, "user", "q", "x", "y", "z"), (1, 1, "assistant", "a", "x", "y", "z")], TURNS + ", system string, input string, prompt string")
    assert turns_of(rows)[1] == [("user", "q"), ("assistant", "a")]
    pair = spark.createDataFrame([(1, "q", "a", "x", "y")], "conv_id long, prompt string, response string, answer string, role string")
    assert turns_of(pair)[1] == [("user", "q"), ("assistant", "a")]
    both = spark.createDataFrame([(1, "s", "q", "a", "x")], "conv_id long, system string, prompt string, response string, input string")
    assert turns_of(both)[1] == [("system", "s"), ("user", "q"), ("assistant", "a")]


def test_records_each_in_its_own_layout(spark):
    texts = [
        '{"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}',
        '{"response": "a", "prompt": "q"}',
        '{"instruction": "do", "input": null, "output": "done"}',
        '{"conversations": [{"from": "human", "value": "q"}]}',
        '{"data": {"prompt": "q", "response": 3}}',
        '{"other": 1}', "no json", None, '{"prompt": "only"}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "conv_id long, body string")
    got = {r["conv_id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical_records(df, "conv_id", "body").collect()}
    two = [("user", "q"), ("assistant", "a")]
    assert got[0] == ("messages", two) and got[1] == ("prompt and response", two)
    assert got[2] == ("instruction, input and output", [("user", "do"), ("assistant", "done")])
    assert got[3] == ("from-value list", [("user", "q")])
    assert got[4] == ("nested prompt", [("user", "q"), ("assistant", "3")])
    assert [got[i] for i in (5, 6, 7, 8)] == [(None, None)] * 4


def test_no_python_in_the_plan(spark, sf):
    plan = op8_chat(spark, sf)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
