import pytest
from pyspark.sql import functions as F

from veilcorpus.operators import chat


def messages(df, mapper=None):
    return [None if r["messages"] is None else [(m["role"], m["content"]) for m in r["messages"]] for r in chat.to_chat(df, mapper).collect()]


def test_sharegpt_roles(spark):
    df = spark.createDataFrame([([("human", "a"), ("gpt", "b"), ("system", "c"), ("tool", "d")],)], "conversations array<struct<`from`:string,value:string>>")
    assert messages(df) == [[("user", "a"), ("assistant", "b"), ("system", "c"), ("tool", "d")]]


def test_instruction_shapes(spark):
    alpaca = spark.createDataFrame([("i", "", "o"), ("i", None, "o"), ("i", "ctx", "o")], "instruction string, input string, output string")
    assert [m[0][1] for m in messages(alpaca)] == ["i", "i", "i\n\nctx"]
    dolly = spark.createDataFrame([("i", "ctx", "r")], "instruction string, context string, response string")
    assert messages(dolly) == [[("user", "i\n\nctx"), ("assistant", "r")]]
    flan = spark.createDataFrame([("q", "a")], "inputs string, targets string")
    assert messages(flan) == [[("user", "q"), ("assistant", "a")]]


def test_messages_win_and_a_mapper_wins_over_all(spark):
    df = spark.createDataFrame([([("user", "m")], "i", "o")], "messages array<struct<role:string,content:string>>, instruction string, output string")
    assert messages(df) == [[("user", "m")]]
    assert messages(df, "user=instruction,assistant=output") == [[("user", "i"), ("assistant", "o")]]


def test_bad_rows_are_listed(spark):
    df = spark.createDataFrame([([("user", "m")],), (None,)], "messages array<struct<role:string,content:string>>")
    assert chat.bad_chat_rows(df).count() >= 1


@pytest.mark.parametrize("mapper, word", [("user:q", "malformed"), ("bot=q", "role"), ("user=q", "assistant"), ("user=q,assistant=nope", "nope")])
def test_mapper_faults(spark, mapper, word):
    df = spark.createDataFrame([("q", "a")], "q string, a string")
    with pytest.raises(ValueError, match=word):
        chat.to_chat(df, mapper)


def test_no_shape_lists_the_columns(spark):
    with pytest.raises(ValueError, match="'a', 'q'"):
        chat.to_chat(spark.createDataFrame([("q", "a")], "q string, a string"))


def test_system_turn_is_left_out_where_empty(spark):
    df = spark.createDataFrame([("q", "a", ""), ("q", "a", "s"), ("q", "a", None)], "q string, a string, s string")
    assert [len(m) for m in messages(df, "user=q,assistant=a,system=s")] == [2, 3, 2]


def test_prompt_and_gold(spark):
    df = spark.createDataFrame([([("system", "s"), ("user", "q"), ("assistant", "a")],)], "messages array<struct<role:string,content:string>>")
    row = df.select(chat.prompt_messages(F.col("messages")).alias("p"), chat.gold_answer(F.col("messages")).alias("g")).first()
    assert [m["role"] for m in row["p"]] == ["system", "user"] and row["g"] == "a"


def test_missing_content_has_a_defined_result(spark):
    df = spark.createDataFrame([("q", None, None), (None, "a", "s")], "question string, answer string, system string")
    made = messages(df, "user=question,assistant=answer,system=system")
    assert made == [[("user", "q"), ("assistant", None)], [("system", "s"), ("user", None), ("assistant", "a")]]
    chats = chat.to_chat(df, "user=question,assistant=answer")
    assert [r["g"] for r in chats.select(chat.gold_answer(F.col("messages")).alias("g")).collect()] == ["{}", "a"]
    text = chats.select(chat.render_chat(F.col("messages"), default_system="").alias("t")).first()["t"]
    assert text == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nnull<|im_end|>\n"
    assert chat.bad_chat_rows(df.select(F.col("question").alias("inputs"), F.col("answer").alias("targets"))).count() == 2


@pytest.mark.parametrize("mapper", ["user=q,assistant=a", " user = q , assistant=a ,", ",,user=x,user=q,  ,assistant = a"])
def test_mappers_that_mean_the_same(mapper):
    assert chat.parse_mapper(mapper) == {"user": "q", "assistant": "a"}
    assert chat.parse_mapper("") is None and chat.parse_mapper(None) is None
