import pytest
from pyspark.sql import functions as F

from tabulyst.operators import replies


def _points(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    return replies.with_points(df, "text", "points").first()["points"]


@pytest.mark.parametrize("text,want", [
    ('["a", " b ", "", 3]', ["a", "b", "3"]),
    ('{"insights": [], "bullets": ["x"]}', ["x"]),
    ('{"insights": "words"}', ['{"insights": "words"}']),
    ("- one\n• two\n\n3. three\n4、four\n- one", ["one", "two", "three", "four"]),
    ("2023 rose", ["rose"]),
    ('["broken', ['["broken']),
    ("1\n2\n3", []),
    ("a\nb\nc\nd\ne\nf\ng", ["a", "b", "c", "d", "e", "f"]),
    ("[]", []), ("", []), (None, []), ("17", []),
    ("  * -  5) deep\r\nnext ", ["-  5) deep", "next"]),
])
def test_points(spark, text, want):
    assert _points(spark, text) == want


@pytest.mark.parametrize("text,want", [
    ('{"k": 1}', 1), ('see ```json\n{"k": 2}\n``` ok', 2), ('well {"k": {"z": 1}} then', None),
    ('{broken} {"k": 3}', None), ("no", None), (None, None), ('[1, {"k": 4}]', 4),
    ('```json {bad} ``` {"k": 5}', None), (' {"k": 6} ', 6),
])
def test_json_object(spark, text, want):
    df = replies.with_json_object(spark.createDataFrame([(text,)], "text string"), "text", "o")
    assert df.select(F.try_variant_get("o", "$.k", "int")).first()[0] == want


@pytest.mark.parametrize("text,analyses,stop", [
    ("nothing", ["payment_summary", "company_summary", "time_patterns"], False),
    ('{"extra_analyses": null, "stop": null}', [], False),
    ('{"extra_analyses": ["company_summary"], "stop": "no"}', ["company_summary"], True),
    ('{"stop": 0}', ["payment_summary", "company_summary", "time_patterns"], False),
    ('{"stop": [0]}', ["payment_summary", "company_summary", "time_patterns"], True),
    ('{"stop": {}}', ["payment_summary", "company_summary", "time_patterns"], False),
    ('{"stop": true, "llm_insights_md": "hi"}', ["payment_summary", "company_summary", "time_patterns"], True),
])
def test_plan(spark, text, analyses, stop):
    row = replies.with_plan(spark.createDataFrame([(text,)], "text string"), "text").first()
    assert row["extra_analyses"] == analyses and row["stop"] is stop


def test_merge(spark):
    df = spark.createDataFrame([(["a ", "b"], ["b", " ", "c"]), (None, ["x", "x"])], "p array<string>, q array<string>")
    got = [r[0] for r in df.select(replies.merge_points(F.col("p"), F.col("q"))).collect()]
    assert got == [["a", "b", "c"], ["x"]]
