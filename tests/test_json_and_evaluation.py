import json
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from veilcorpus.fixed_values import CATEGORIES
from veilcorpus.functions import jsonx
from veilcorpus.operators import chat, evaluate

TRUE = ['{"address":["a"]}', '{"address":["a"]}\n', "{}", '{"address":[NaN]}', '{"x":Infinity}', '{"address":1,"email_address":["e"]}']
FALSE = [
    '{"address":["a"]} trailing', '{"address":["a"]},{"b":1}', '{"address":["a"]', "{'address':['a']}", "[1]", '"x"', "1", "null", "",
    "// c\n{}", '{"address":["a\nb"]}', '{"address":["a\tb"]}', "not json", None,
]


def parsed(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    return [r for r in evaluate.parse_columns(df, {"raw": ("pred", "ok")}).orderBy("i").collect()]


def test_quoting_is_that_of_python(spark):
    texts = ["", 'a"b', "x\\u001f", "日本 é", "\n\r\t\b\f", "".join(map(chr, range(32))), "/", "\x7f", "\\\x0b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["q"] for r in df.select(jsonx.quote(F.col("t")).alias("q")).collect()]
    assert got == [None if t is None else json.dumps(t, ensure_ascii=False) for t in texts]


def test_annotation_text_and_back(spark):
    rows = [(["a\"b", "x,y", "日"],), ([],), (None,)]
    df = spark.createDataFrame(rows, "v array<string>")
    assert [r["j"] for r in df.select(jsonx.encode_strings(F.col("v")).alias("j")).collect()] == ['["a\\"b", "x,y", "日"]', "[]", "[]"]
    whole = spark.createDataFrame([('{"address": ["b", "a"], "human_name": null}',)], "t string")
    back = whole.select(jsonx.decode_annotation(F.col("t")).alias("a")).first()["a"]
    assert back["address"] == ["b", "a"] and back["human_name"] == [] and len(back) == len(CATEGORIES)


def test_only_one_whole_object_counts(spark):
    rows = parsed(spark, TRUE + FALSE)
    assert [r["ok"] for r in rows] == [True] * len(TRUE) + [False] * len(FALSE)
    assert rows[5]["pred"]["address"] == [] and rows[5]["pred"]["email_address"] == ["e"]


def test_element_text_is_that_of_python(spark):
    raws = [
        '{"address":["x",1,true,null,{"k":"v","n":null},[1, 2]]}', '{"address":[1.5,false]}', '{"address":{"a":1}}', '{"address":["a"],"address":["b"]}',
        '{"address":[12345678901234567890]}',
    ]
    got = [r["pred"]["address"] for r in parsed(spark, raws)]
    assert set(got[0]) == {"x", "1", "True", "None", "v", "[1, 2]"}
    assert got[1] == ["1.5", "False"] and got[2] == [] and got[4] == ["12345678901234567890"]


def test_scores_of_the_worked_case(spark):
    gold = [{"address": ["a", "b"], "human_name": ["x"]}, {"address": ["d"]}, {}]
    pred = ['{"address":["a","c","a"],"human_name":["x"]}', "not json", "{}"]
    df = spark.createDataFrame([(i, p, json.dumps(g)) for i, (p, g) in enumerate(zip(pred, gold))], "row_id int, raw_output string, gold_json string")
    table = {r["category"]: r for r in evaluate.evaluation_table(evaluate.parse_predictions(df)).collect()}
    a = table["address"]
    assert (a["tp"], a["fp"], a["fn"]) == (1, 1, 2) and a["precision"] == 0.5 and a["recall"] == pytest.approx(1 / 3) and a["f1"] == pytest.approx(0.4)
    assert table["human_name"]["f1"] == 1.0 and table["company_name"]["f1"] == 0.0
    micro = table["micro avg"]
    assert (micro["tp"], micro["fp"], micro["fn"]) == (2, 1, 2) and micro["f1"] == pytest.approx(4 / 7)
    assert micro["json_parse_rate"] == pytest.approx(2 / 3)
    empty = evaluate.evaluation_table(evaluate.parse_predictions(df.limit(0))).collect()
    assert len(empty) == 12 and all(r["f1"] == r["precision"] == r["json_parse_rate"] == 0.0 for r in empty)
    shown = evaluate.weakest_first(evaluate.evaluation_table(evaluate.parse_predictions(df))).collect()
    assert shown[-1]["category"] == "micro avg" and [r["f1"] for r in shown[:-1]] == sorted(r["f1"] for r in shown[:-1])


def test_input_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def model(i):
        seen.add(1)
        return '{"address":[1.5]}' if i % 2 else "{}"

    df = spark.range(40).select(model.asNondeterministic()("id").alias("raw_output"), F.lit("{}").alias("gold_json"))
    evaluate.evaluation_table(evaluate.parse_predictions(df)).collect()
    assert seen.value == 40


def _fuzz():
    rng = random.Random(4)
    letters = ["a", "é", "日", '"', "\\", "\n", "\t", "'", "/", "\x1f", "\x7f", "\u200b", "\xa0", "😀", " ", "<", ",", ":", "{", "\u2028", "\x03"]

    def value(depth=0):
        kind = rng.random()
        if kind < 0.35:
            return "".join(rng.choices(letters, k=rng.randint(0, 6)))
        if kind < 0.6:
            return rng.choice([0, -1, 12345678901234567890123, 7, 1.5, -0.0, 1e22, 0.1, 3.0, 1e-7, 123456.789])
        if kind < 0.7 or depth > 2:
            return rng.choice([True, False, None])
        if kind < 0.85:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        return {"".join(rng.choices('ab"\\\n:é', k=rng.randint(0, 3))): value(depth + 1) for _ in range(rng.randint(0, 3))}

    def text(v):
        return json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1]), separators=rng.choice([None, (",", ":")]))

    return rng, value, text


def test_floats_are_written_as_python_does(spark):
    rng = random.Random(1)
    floats = [1.0, 0.1, 1e16, 1e15, 1e-4, 1e-5, 5e-324, 1.7976931348623157e308, -0.0, 0.0, 2e-3, 8.41e21, 2e23, 100.0, math.inf, -math.inf, math.nan]
    floats += [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(1500)]
    floats += [rng.random() * 10 ** rng.randint(-10, 15) for _ in range(1500)] + [round(rng.random() * 1000, rng.randint(0, 6)) for _ in range(1000)]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in floats], "x double").select(jsonx.python_float(F.col("x"))).collect()]
    assert [(repr(x), t) for x, t in zip(floats, got) if repr(x) != t and not 2**53 < abs(x) < 2**63] == []
    assert all(float(t) == x or x != x for x, t in zip(floats, got))


def test_json_values_are_written_as_python_does(spark):
    _, value, text = _fuzz()
    values = [value() for _ in range(800)]
    texts = [text(v) for v in values] + ["-0", "[1E3 , 2.50]", '{ "a" : 1.0 }', '"\\/"', "1e400"]
    values += [0, [1000.0, 2.5], {"a": 1.0}, "/", math.inf]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for v, r in zip(values, df.select(jsonx.python_json(F.col("t")).alias("j"), jsonx.python_text(F.col("t")).alias("p")).collect()):
        assert (r["j"], r["p"]) == (json.dumps(v, ensure_ascii=False), repr(v))


def test_element_texts_follow_python_without_a_python_worker(spark):
    rng, value, text = _fuzz()

    def texts(v):
        out = []
        for x in v if isinstance(v, list) else []:
            out += [y if isinstance(y, str) else str(y) for y in ([z for z in x.values() if z is not None] if isinstance(x, dict) else [x])]
        return out

    names = ("address", "human_name", "project_info")
    rows = [{c: value() if rng.random() < 0.3 else [value() for _ in range(rng.randint(0, 4))] for c in rng.sample((*names, "other"), 3)} for _ in range(600)]
    raw = [text(r) for r in rows]
    odd = ['{"address":[{"a":1,"b":"x","a":"y"}],"human_name":["z",{"k":1,"k":null}]}', '{"address":["a"]} x', "[1]", '{"address":"[1]","human_name":"x"}', None, ""]
    for t in odd:
        raw.append(t)
        parsed = json.loads(t) if t and not t.endswith("x") else None
        rows.append(parsed if isinstance(parsed, dict) else None)
    df = spark.createDataFrame([(t, "user") for t in raw], "t string, _read string")
    out = evaluate.parse_columns(df, {"t": ("p", "ok")})
    for t, row, r in zip(raw, rows, out.collect()):
        assert r["ok"] == (row is not None) and r["_read"] == "user", t
        # Scores compare sets; of a key that is repeated the last value counts.
        assert {c: sorted(r["p"][c]) for c in names} == {c: sorted(texts(row.get(c))) if row else [] for c in names}, t
    plan = out._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert evaluate.parse_rate(df, "t").first()["json_parse_rate"] == pytest.approx(sum(r is not None for r in rows) / len(rows))
    assert evaluate.parse_rate(df.limit(0), "t").first()["json_parse_rate"] == 0.0


def test_chats_with_any_json_content_are_rendered(spark):
    chats = [
        [{"role": "user", "content": {"b": [1, 2.50, None], "a": "<x> \"q\" é"}}, {"role": "tool", "content": [True, {"k": "v"}]}],
        [{"role": "system", "content": "s"}, {"role": "user", "content": 7}, {"role": "assistant", "content": None}, {"role": "user"}],
        [{"role": "user", "content": '{"not": "an object"}'}, {"role": "assistant", "content": ""}],
    ]

    def shown(m):
        content = m.get("content")
        content = content if isinstance(content, str) else json.dumps(content, ensure_ascii=False)
        content = f"<|tool_response_start|>{content}<|tool_response_end|>" if m["role"] == "tool" else content
        return f"<|im_start|>{m['role']}\n{content}<|im_end|>\n"

    tools = ["search", {"name": "sum", "of": [1.0, "<"]}]
    listed = 'List of tools: <|tool_list_start|>[search, {"name": "sum", "of": [1.0, "<"]}]<|tool_list_end|>'
    df = spark.createDataFrame([(json.dumps(c, separators=(",", ":")), json.dumps(tools)) for c in chats], "t string, tools string")
    out = df.select(chat.render_chat(chat.messages_from_json(F.col("t")), "", chat.tools_from_json(F.col("tools"))).alias("r")).collect()
    for c, r in zip(chats, out):
        first = c[0]["content"] + "\n" if c[0]["role"] == "system" else ""
        rest = c[1:] if c[0]["role"] == "system" else c
        assert r["r"] == f"<|im_start|>system\n{first}{listed}<|im_end|>\n" + "".join(map(shown, rest))
    bad = spark.createDataFrame([("{}",), ("[1] x",), ("",), (None,)], "t string").select(chat.messages_from_json(F.col("t")).alias("m"))
    assert [r["m"] for r in bad.collect()] == [None] * 4
    variant = spark.sql("select parse_json(c) v from values ('{\"b\":1.5,\"a\":\"x\"}'), ('\"text\"'), ('[1,null]') t(c)")
    assert [r["x"] for r in variant.select(chat.variant_text(F.col("v")).alias("x")).collect()] == ['{"a": "x", "b": 1.5}', "text", "[1, null]"]
