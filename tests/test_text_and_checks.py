import pytest
from pyspark.sql import functions as F

from veilcorpus.functions import detect, scorers, text as tx
from veilcorpus.operators import annotate, compare, profile
from veilcorpus.functions.jsonx import decode_annotation


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, clean",
    [("```json\nabc\n```", "abc"), ('"abc"', "abc"), ("'abc'", "abc"), ("「abc」", "abc"), ("\"abc'", "\"abc'"), ('"「abc」"', "abc"), ("  abc \n", "abc")],
)
def test_model_output_is_cleaned(spark, raw, clean):
    assert one(spark, raw, tx.clean_output) == clean


@pytest.mark.parametrize("line", ["- value", "1. value", "・value"])
def test_pool_lines(spark, line):
    assert one(spark, f"{line}\n\n{line}\nother", tx.clean_pool_lines) == ["value", "other"]


def test_pool_line_with_digits(spark):
    raw = "0 2 * * * /opt/scripts/db.sh"
    assert one(spark, raw, tx.clean_pool_lines) == [raw]
    assert one(spark, raw, lambda t: tx.clean_pool_lines(t, compat=True)) == ["/opt/scripts/db.sh"]


def test_a_dash_before_a_digit_is_a_marker(spark):
    assert one(spark, "- 5 apples\n- /etc/x\n- * star\n* 2 * * * /x.sh", tx.clean_pool_lines) == ["5 apples", "/etc/x", "* star", "* 2 * * * /x.sh"]


def test_markdown_cells(spark):
    assert one(spark, "a|b\nc", lambda t: tx.markdown_cell(t, None)) == "a\\|b c"
    assert one(spark, "abcdef", lambda t: tx.markdown_cell(t, 3)) == "abc"
    rows = spark.createDataFrame([("p" * 100, "b" * 200, "f|")], "prompt string, base string, finetune string")
    whole = compare.markdown_rows(rows).first()["line"]
    cut = compare.markdown_rows(rows, 60, 120).first()["line"]
    assert "p" * 100 in whole and "b" * 200 in whole and "f\\|" in cut
    assert "p" * 61 not in cut and "b" * 121 not in cut


@pytest.mark.parametrize("category, text, leaks", [("system_config", "社内db.local", True), ("system_config", "db.local です", True), ("system_config", "db.localです", False)])
def test_leak_patterns_with_japanese(spark, category, text, leaks):
    assert any(one(spark, text, lambda t: detect.has_leak(t, c)) for c in (category, "network_identifier")) == leaks


def test_verbatim(spark):
    df = spark.createDataFrame([("a b c", ["a", "c"]), ("a b", ["x"]), ("a", []), ("a", None)], "t string, e array<string>")
    assert [r["v"] for r in df.select(detect.all_verbatim(F.col("t"), F.col("e")).alias("v")).collect()][:3] == [True, False, True]


def test_masked_corpus_of_japanese_rows(spark):
    mask = [("一郎", "GIVENNAME"), ("田中", "SURNAME"), ("t@x.jp", "EMAIL"), ("zz", "UNKNOWN"), ("田中", "SURNAME")]
    rows = [("田中一郎 t@x.jp", "ja", [(v, lab, 0, 1) for v, lab in mask]), ("other", "en", [])]
    df = spark.createDataFrame(rows, "source_text string, language string, privacy_mask array<struct<value:string,label:string,start:int,end:int>>")
    out = annotate.annotate_masked_text(df).select("input_text", decode_annotation(F.col("annotation_json")).alias("a")).collect()
    assert len(out) == 1
    a = out[0]["a"].asDict()
    assert a.pop("human_name") == ["一郎", "田中", "田中"] and a.pop("email_address") == ["t@x.jp"] and not any(a.values())


def test_profile_and_weight(spark):
    ddl = "annotation struct<address:array<string>,email_address:array<string>>"
    sizes = spark.createDataFrame([((["a", "b"], []),), (([], []),), ((["c"], []),)], ddl)
    empty = F.array().cast("array<string>")

    def full(df):
        from veilcorpus.fixed_values import CATEGORIES

        have = df.schema["annotation"].dataType.names
        return df.select("*", F.struct(*[(F.col(f"annotation.{c}") if c in have else empty).alias(c) for c in CATEGORIES]).alias("whole")).drop("annotation").withColumnRenamed("whole", "annotation")

    by = {r["category"]: r for r in profile.category_profile(full(sizes)).collect()}
    assert len(by) == 11 and (by["address"]["entity_count"], by["address"]["row_count"]) == (3, 2)
    assert by["address"]["coverage"] == pytest.approx(66.7, abs=0.05) and by["human_name"]["coverage"] == 0.0
    four = full(spark.createDataFrame([((["a"], ["e"]),), ((["a"], []),), ((["a"], []),), ((["a"], []),)], ddl))
    weights = four.select(profile.sample_weight(profile.rarity_terms(four), F.col("annotation")).alias("w")).collect()
    assert sorted(round(r["w"], 9) for r in weights) == [1e-9, 1e-9, 1e-9, 1.386294361]


def test_scorers(spark):
    word = "w "
    assert [one(spark, word * n, scorers.length_score) for n in (100, 50, 250)] == [1.0, 0.5, 0.0]
    assert one(spark, "a A b", scorers.diversity_score) == pytest.approx(2 / 3) and one(spark, "", scorers.diversity_score) == 0.0
    assert [one(spark, t, scorers.coherence_score) for t in ("no full stop", "a b. b c.", "a b. c d.")] == [0.5, 1.0, 0.0]


def test_improvement_rate(spark):
    rows = [(1, "m", 0.5), (2, "m", 0.6), (1, "z", 0.0), (2, "z", 3.0), (1, "n", -0.5), (2, "n", 0.0), (1, "gone", 1.0)]
    df = spark.createDataFrame(rows, "step int, metric string, value double")
    got = {r["metric"]: r["improvement"] for r in compare.improvement_rate(df).collect()}
    assert got == {"m": pytest.approx(20.0), "z": 0.0, "n": 100.0}
