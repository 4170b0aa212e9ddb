"""Whole-row de-duplication by digests, against plain counting."""

import random
from collections import Counter

import pytest

from tabulyst.operators import cleaning, copies

SCHEMA = "k long, x double, t string, a array<string>, s struct<p:int,q:string>, digest string"


def made(rng, n, kinds):
    pool = [
        (rng.randrange(5), rng.choice([0.0, 1.5, float("nan"), None]), rng.choice(["é", "", None, "long " * 20]),
         rng.choice([None, [], ["a", None]]), rng.choice([None, (1, "z"), (None, None)]), rng.choice(["d", None]))
        for _ in range(kinds)
    ]
    return [rng.choice(pool) for _ in range(n)] + [(1000 + i, 2.0, f"only {i}", None, None, None) for i in range(n)] + pool[:1] * n


def shown(rows):
    return Counter(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("staged", [False, True])
def test_counts_each_row(spark, staged):
    rows = made(random.Random(1), 400, 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = copies.counted_rows(df, staged).collect()
    assert {str(tuple(r)[:-1]): r[copies.COPIES] for r in got} == dict(shown(df.collect()))
    assert cleaning.drop_duplicates(df).columns == df.columns
    counts = cleaning.duplicate_count(df).first()
    assert tuple(counts) == (len(rows), len(got), len(rows) - len(got))


def test_signed_zeros_are_one(spark):
    df = spark.createDataFrame([(0.0, "t" * 9), (-0.0, "t" * 9), (float("nan"), "t"), (float("nan"), "t")], "x double, t string")
    assert cleaning.drop_duplicates(df).count() == 2


def test_no_copies_and_no_rows(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "k long, t string")
    assert cleaning.drop_duplicates(df).count() == 100
    assert tuple(cleaning.duplicate_count(df).first()) == (100, 100, 0)
    assert cleaning.drop_duplicates(df.filter("false")).count() == 0
    assert tuple(cleaning.duplicate_count(df.filter("false")).first()) == (0, 0, 0)


@pytest.mark.parametrize("bits, each", [(1 << 14, 16), (1 << 27, 1)])
def test_small_and_crowded_filters(spark, monkeypatch, bits, each):
    monkeypatch.setattr(copies, "FILTER_BITS", bits)
    monkeypatch.setattr(copies, "BITS_EACH", each)
    rows = made(random.Random(2), 300, 200)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert {str(tuple(r)[:-1]): r[copies.COPIES] for r in copies.counted_rows(df).collect()} == dict(shown(df.collect()))


def test_the_filter_keeps_rows_in_place(spark):
    df = spark.createDataFrame([(i % 2000 if i < 2020 else i, f"text {i % 2000 if i < 2020 else i}") for i in range(4000)], "k long, t string")
    found = copies.Repeated(df)
    assert (found.rows, found.twice) == (4000, 20)
    single, rest = found.parts()
    assert 40 <= rest.count() <= 80 and single.count() + rest.count() == 4000
