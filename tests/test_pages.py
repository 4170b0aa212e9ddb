"""Deep pages against a plain sort."""

import datetime
import random

import pytest

from tabulyst.sources import pages

SCHEMA = "day timestamp_ntz, k long, x double, name string"


def made(seed, n, hot):
    rng = random.Random(seed)
    start = datetime.datetime(2020, 1, 1)
    days = [start + datetime.timedelta(minutes=rng.randrange(10**6)) for _ in range(40)]
    return [(days[0] if rng.random() < hot else rng.choice(days) if rng.random() < 0.5 else start + datetime.timedelta(seconds=rng.randrange(10**8)),
             rng.randrange(-50, 50) * 10**rng.choice([0, 15]), rng.choice([1e300, -2.5, rng.random()]), f"n{i:05d}") for i in range(n)]


def place(r):
    return (-(r[0] - datetime.datetime(1970, 1, 1)).total_seconds(), r[1], r[2], r[3])


@pytest.mark.parametrize("hot", [0.0, 0.6])
@pytest.mark.parametrize("offset", [0, 1, 700, 1999, 2990, 3000, 9000])
def test_pages(spark, monkeypatch, hot, offset):
    monkeypatch.setattr(pages, "ENOUGH", 20)
    monkeypatch.setattr(pages, "BINS", 16)
    rows = made(int(hot * 10), 3000, hot)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = pages.ordered_page(df, [("day", True), ("k", False), ("x", False), ("name", False)], 25, offset).collect()
    assert [tuple(r) for r in got] == sorted(rows, key=place)[offset : offset + 25]


def test_a_page_orders_few_rows(spark, monkeypatch):
    monkeypatch.setattr(pages, "ENOUGH", 200)
    df = spark.range(100000).selectExpr("id as k", "cast(id % 7 as string) as t")
    rows, need, n, single = pages._narrowed(df, pages._place(df, "k"), False, 76543, 50)
    assert n <= 200 and not single and rows.count() == n
    assert [r["k"] for r in pages.ordered_page(df, [("k", False)], 50, 76543).collect()] == list(range(76543, 76593))


def test_nulls_and_texts(spark, monkeypatch):
    monkeypatch.setattr(pages, "ENOUGH", 2)
    rows = [(None, None), (3, "c"), (1, "a"), (None, "b"), (2, None), (2, "z")]
    df = spark.createDataFrame(rows, "k long, t string")
    got = [tuple(r) for r in pages.ordered_page(df, [("k", True), ("t", False)], 3, 2).collect()]
    assert got == [(2, "z"), (1, "a"), (None, None)]
    assert pages.ordered_page(df.filter("false"), [("k", True)], 3, 2).collect() == []
    assert [r["t"] for r in pages.ordered_page(df, [("t", False)], 2, 4).collect()] == ["c", "z"]
