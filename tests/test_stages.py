"""Tables that cost joins are put together once, however often an operator reads them."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.operators import copies
from tabulyst.plans import queries, tables

COUNTED = ["ols_trips", "ols_simple", "regression_checked", "training_fills", "category_bars", "lowest_cardinality",
           "fill_median", "payment_money_summary", "payment_trip_summary", "column_profile", "numeric_summary", "top_values",
           "analysis_digest"]
REPEATED = ["dedup_rows", "dedup_count", "findings", "clean_table", "cleaning_log"]


def own_trips(spark, n, seen):
    """Trips of the test's own, which count how often a row is made."""
    def made(key):
        seen.add(1)
        return True

    rows = spark.range(n, numPartitions=2).where(F.udf(made, T.BooleanType()).asNondeterministic()("id"))
    return rows.selectExpr(
        "id as trip_key", "cast(id % 3 as int) as leg", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) as trip_start_timestamp",
        "element_at(array('a', 'b', null), cast(id % 3 as int) + 1) as payment_type", "concat('c', id % 5) as company",
        "id * 1.25D as fare", "case when id % 4 > 0 then id * 0.5D end as tips", "id * 2D as trip_total", "cast(id * id % 17 as double) as trip_miles",
        "case when id % 7 > 0 then id * 3D + id % 5 end as trip_seconds", "case when id % 50 = 0 then 1D end as mostly_missing",
        "cast(id % 9 as string) as miles_text", "id % 6 as pickup_zone_code")


def made_rows(spark, sf, monkeypatch, name, n):
    seen = spark.sparkContext.accumulator(0)
    for module in (tables, queries):
        monkeypatch.setattr(module, "trips", lambda session, folder: own_trips(session, n, seen))
    assert queries.registered()[name](spark, sf).collect()
    return seen.value


@pytest.mark.parametrize("name", [*REPEATED, *COUNTED])
def test_trips_are_joined_once(spark, sf, monkeypatch, name):
    assert made_rows(spark, sf, monkeypatch, name, 240) == 240


def test_no_plan_holds_the_filter(spark, monkeypatch, capsys):
    monkeypatch.setattr(copies, "BITS_EACH", 1 << 12)
    df = spark.createDataFrame([(i % 300, f"text {i % 300}") for i in range(500)], "k long, t string")
    rows = copies.Repeated(df).marked()
    rows.explain(True)
    assert len(capsys.readouterr().out) < 100_000
    assert rows.filter(copies.MAYBE).count() >= 400


def test_a_crowded_filter_is_still_used(spark, monkeypatch):
    monkeypatch.setattr(copies, "FILTER_BITS", 1 << 14)
    df = spark.createDataFrame([(i % 3000, f"text {i % 3000}") for i in range(5000)], "k long, t string")
    found = copies.Repeated(df)
    assert found.twice == 2000 and found.fits and found.bits == 1 << 14
    single, rest = found.parts()
    assert rest.count() < 4600 and single.count() + rest.count() == 5000
    counted = copies.counted_rows(df)
    assert counted.count() == 3000 and counted.agg(F.sum(copies.COPIES)).first()[0] == 5000
