from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tabulyst.functions import scalars as S
from tabulyst.operators import cleaning, features
from tabulyst.operators import profile as P
from tabulyst.operators import roles as R
from tabulyst.plans import tables
from tabulyst.sources import extract, sinks
from tabulyst.sources.readers import read_csv, read_part


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [
        (1, "1.5", "2024-01-31 10:00:00", "a", 7, None, None, None),
        (2, " 2 ", "01/15/2024 01:05:00 pm", None, None, None, 4.0, True),
        (3, "1d", "never", "b", 9, None, float("nan"), False),
        (4, "inf", "2024/2/3", "a", 9, None, 8.0, None),
        (5, "-2.", None, "a", 9, 1.0, 1.0, True),
        (5, "-2.", None, "a", 9, 1.0, 1.0, True),
    ] + [(i, "1e3", "2024-03-01", "a", 1, None, 2.0, True) for i in range(6, 40)]
    schema = ("k long, text_number string, start_text string, kind string, zip_code long, "
              "nearly_empty double, amount double, flag boolean")
    return S.nan_to_null(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def roles(dirty):
    return R.infer_roles(dirty)


def test_roles(roles):
    assert roles == {
        "k": "numeric", "text_number": "numeric", "start_text": "datetime", "kind": "categorical",
        "zip_code": "categorical", "nearly_empty": "numeric", "amount": "numeric", "flag": "categorical",
    }


def test_name_traps(spark):
    df = spark.createDataFrame(
        [(1, "f", "good", 1.0, 5, [1.0]), (2, "m", "bad", 2.0, 6, [2.0]), (3, "f", "bad", 2.0, 6, None)] * 5,
        "population_id int, gender string, sentiment string, `Pickup Centroid Latitude` double, zip_code int, vec array<double>")
    assert R.infer_roles(df) == {
        "population_id": "numeric", "gender": "categorical", "sentiment": "categorical",
        "Pickup Centroid Latitude": "numeric", "zip_code": "categorical", "vec": "unsupported"}


def test_text_role_at_the_bounds(spark):
    df = spark.range(2000).select(
        (F.col("id") % 200).cast("string").alias("a"), (F.col("id") % 201).cast("string").alias("b"))
    words = df.select(*[F.concat(F.lit("w"), c).alias(c) for c in df.columns])
    assert R.infer_roles(words) == {"a": "categorical", "b": "text"}
    few = spark.createDataFrame([("x",), ("y",), ("x",)], "w string")
    assert R.infer_roles(few) == {"w": "text"}


def test_numbers_and_times(dirty):
    got = dirty.where("k < 6").distinct().orderBy("k").select(
        S.to_number(F.col("text_number"), dirty.schema["text_number"].dataType).alias("n"),
        S.to_time(F.col("start_text"), dirty.schema["start_text"].dataType).alias("t")).collect()
    assert [r["n"] for r in got] == [1.5, 2.0, None, None, -2.0]
    assert [r["t"] for r in got] == [
        datetime(2024, 1, 31, 10), datetime(2024, 1, 15, 13, 5), None, datetime(2024, 2, 3), None]


@pytest.mark.parametrize("text,want", [
    ("20240229", datetime(2024, 2, 29)), ("2024", datetime(2024, 1, 1)), ("1200-01-01", None),
    ("3/4/2024", datetime(2024, 3, 4)), ("3/4/2024 7:05", datetime(2024, 3, 4, 7, 5)),
    ("13/14/2024", None), ("5-Mar-2024", datetime(2024, 3, 5)), ("12:30", None), ("x", None),
])
def test_time_shapes(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.to_time(F.col("t"), df.schema["t"].dataType).alias("v")).first()["v"] == want


def test_clean(spark, dirty, roles):
    clean, kept, log = cleaning.clean(dirty, roles)
    assert log.dropped_duplicates == 1
    assert log.dropped_columns == [("nearly_empty", "missing_rate>=0.95")]
    assert "nearly_empty" not in kept and "nearly_empty" not in clean.columns
    assert log.type_conversions == [("text_number", "numeric"), ("start_text", "datetime")]
    assert log.imputations == [
        ("text_number", "median", "1000.0"), ("kind", "missing_category", "Missing"),
        ("zip_code", "missing_category", "Missing"), ("amount", "median", "2.0"),
        ("flag", "missing_category", "Missing")]
    rows = {r["k"]: r for r in clean.where("k < 6").collect()}
    assert rows[2]["kind"] == "Missing" and rows[2]["zip_code"] == "Missing" and rows[1]["zip_code"] == "7"
    assert rows[3]["text_number"] == 1000.0 and rows[3]["amount"] == 2.0 and rows[1]["flag"] == "Missing"
    assert rows[3]["start_text"] is None
    # cleaning what is clean changes nothing
    again, _, second = cleaning.clean(clean, kept)
    assert second.dropped_duplicates == 0 and not second.imputations and not second.dropped_columns
    assert again.exceptAll(clean).count() == 0 and clean.exceptAll(again).count() == 0


def test_all_missing_number_becomes_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert [r["v"] for r in cleaning.fill_median(df, ["v"]).collect()] == [0.0, 0.0]


def test_even_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert cleaning.medians(df, ["v"]) == {"v": 2.5}


def test_date_features(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 05:00:00' as t")
    out, added = features.add_features(df, {"t": R.DATETIME})
    assert added == ["t_year", "t_month", "t_dow"]
    assert tuple(out.first())[1:] == (2024, 1, 0)


def test_csv_types(spark, tmp_path):
    path = tmp_path / "na_tokens.csv"
    path.write_text('a,b,c,d,e,f\n1,NA,True,x,,"q ""z"""\n2,n/a,,NaN,,w\n3,1.5,False,y,,null\n')
    df = read_csv(spark, str(path))
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "string", "e": "double", "f": "string"}
    rows = df.orderBy("a").collect()
    assert [r["b"] for r in rows] == [None, None, 1.5] and [r["d"] for r in rows] == ["x", None, "y"]
    assert [r["f"] for r in rows] == ['q "z"', "w", None]
    assert read_csv(spark, str(path), max_rows=2).count() == 2


def test_nan_is_null(spark):
    df = S.nan_to_null(spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "v double"))
    assert P.missing_rates(df).first()["missing_rate"] == pytest.approx(2 / 3)
    assert P.distinct_counts(df, ["v"]).first()["n_unique"] == 1


def test_extract_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(None, None), (1, "a"), (2, "b,c"), (3, "d")], "k int, v string")
    sinks.write_csv(extract.first_n(df, 2, ["k"]), str(tmp_path / "out"))
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "out")).orderBy("k").collect()] == [(1, "a"), (2, "b,c")]
    part = spark.createDataFrame([("x", None, [1.5])], "a string, b double, c array<double>")
    sinks.write_parts({"p": part}, str(tmp_path / "run"))
    assert read_part(spark, str(tmp_path / "run"), "p", part.schema).collect() == part.collect()


def test_profile_does_not_depend_on_partitions(spark, sf):
    df = tables.trips(spark, sf)
    roles = R.infer_roles(df)
    one = P.column_profile(df.coalesce(1), roles).orderBy("position").collect()
    many = P.column_profile(df.repartition(13, "fare"), roles).orderBy("position").collect()
    for a, b in zip(one, many):
        assert (a["n_unique"], a["missing_rate"], a["top_values"]) == (b["n_unique"], b["missing_rate"], b["top_values"])
        if a["summary"]:
            assert a["summary"]["median"] == b["summary"]["median"]
            assert a["summary"]["std"] == pytest.approx(b["summary"]["std"], rel=1e-9)
