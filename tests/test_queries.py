"""Every registered query against its SQL, and the whole analysis of a CSV."""

import compare
import pytest

import __spark_entry__ as contract
from tabulyst import AnalysisConfig, run_analysis
from tabulyst.plans import tables
from tabulyst.plans.analysis import digest_of
from tabulyst.sources import sinks
from tabulyst.sources.readers import read_part

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return compare.duck(sf)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 6


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    cols, rows = compare.rows_of_spark(QUERIES[name](spark, sf))
    if name not in SQL:
        assert rows
        return
    want_cols, want = compare.rows_of_duck(con, SQL[name])
    assert cols == want_cols
    assert rows == want


def test_whole_analysis(spark, sf, tmp_path):
    source = str(tmp_path / "trips.csv")
    sinks.write_csv(tables.repeated_trips(spark, sf), source)
    done = run_analysis(spark, source, str(tmp_path / "out"), "trip_seconds", AnalysisConfig(), ["time_patterns"])
    assert {"columns", "cleaning", "dataset", "tests", "insights", "model", "vif", "summary_hour"} <= set(done.parts)
    assert "summary_company" not in done.parts
    back = read_part(spark, f"{tmp_path}/out/{done.run_id}", "model", done.parts["model"].schema).first()
    assert back["enabled"] and back["task_type"] == "regression" and back["r2"] > 0.8
    assert done.roles["trip_start_timestamp"] == "datetime" and done.roles["miles_text"] == "numeric"
    assert {r["part"] for r in digest_of(done).collect()} == {"dataset", "top_missing_cols", "tests", "rule_insights"}
