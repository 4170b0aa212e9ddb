"""Top values by summaries and distinct counts by bitmaps, against plain counting."""

import datetime
import random
from collections import Counter

import pytest

from tabulyst.operators import heavy, profile
from tabulyst.operators.distinct import distinct_facts

SCHEMA = "key long, few int, skewed string, flat string, money double, odd double, day timestamp_ntz, gone string, flag boolean"


def made(seed, n):
    rng = random.Random(seed)
    day = datetime.datetime(2020, 1, 1)
    return [(
        i * 7 - 3 * n, rng.choice([None, 1, 2, -3, 70000]), rng.choice(["a", "b", "é", "NaN", None]) if rng.random() < 0.5 else f"s{rng.randrange(n)}",
        f"f{rng.randrange(n // 2)}", rng.choice([None, 0.0, -0.0, rng.randrange(10**6) / 100, -1.07]),
        rng.choice([1e300, 0.1 + 0.2, 0.3, 1 / 3, float("inf"), None, 2.0**60]), day + datetime.timedelta(days=rng.randrange(40), hours=rng.choice([0, 5])),
        None, rng.random() < 0.5,
    ) for i in range(n)]


def label(v, name):
    if v is None:
        return "NaN"
    if name in ("money", "odd"):
        return None  # doubles are shown by Spark; their counts are compared
    return str(v).lower() if isinstance(v, bool) else str(v)


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("tracked, asked", [(heavy.TRACKED, heavy.ASKED), (60, 40)])
def test_top_values(spark, monkeypatch, keep, tracked, asked):
    rows = made(3, 3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    names = [n.split()[0] for n in SCHEMA.split(", ")]
    some = ["key", "few", "skewed", "flat", "gone", "flag", "day"]
    proven, rest = heavy.proven_top(df, some, 5, keep, tracked, asked)
    assert {"key", "few", "gone", "flag"} <= set(proven)
    monkeypatch.setattr(heavy, "TRACKED", tracked)
    got = {}
    for r in profile.top_values(df, some, 5, keep).orderBy("name", "rank").collect():
        got.setdefault(r["name"], []).append((r["value"], r["count"]))
    for c in some:
        values = [r[names.index(c)] for r in rows]
        counts = Counter((label(v, c), v is None) for v in values if keep or v is not None)
        want = sorted(((v, n) for (v, _), n in counts.items()), key=lambda x: (-x[1], x[0].encode()))[:5]
        if c == "day":
            want = [n for _, n in want]
            assert [n for _, n in got[c]] == want
        else:
            assert got.get(c, []) == want
            assert c not in proven or proven[c] == want


def test_skewed_values_are_proven_among_many_others(spark):
    rng = random.Random(5)
    values = [f"top{i}" for i in range(12) for _ in range(900 - 20 * i)] + [f"rare{i}" for i in range(30000)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    proven, rest = heavy.proven_top(df, ["v"], 10, True)
    assert proven["v"] == [(f"top{i}", 900 - 20 * i) for i in range(10)] and not rest


def test_distinct_counts(spark):
    rows = made(4, 2000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for i, r in enumerate(distinct_facts(df, df.columns, ["flat"]).orderBy("position").collect()):
        values = [row[i] for row in rows]
        assert (r["position"], r["name"], r["n_rows"]) == (i, df.columns[i], 2000)
        assert r["n_missing"] == sum(v is None for v in values)
        assert r["n_unique"] == len({v for v in values if v is not None})


def test_extreme_whole_numbers(spark):
    values = [-(2**63), 2**63 - 1, -1, 0, 1, 63, 64, -64, -65, None, 63]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert distinct_facts(df, ["v"]).first()["n_unique"] == 9
    assert distinct_facts(df.filter("false"), ["v"]).collect() == []
    assert profile.top_values(df.filter("false"), ["v"], 3).collect() == []
