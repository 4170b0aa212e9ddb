import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulyst.operators import selection
from tabulyst.operators.selection import distinct_up_to, exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def _shapes():
    rng = random.Random(7)
    return {
        "uniform": [rng.random() for _ in range(3000)],
        # a third of the rows share one value
        "heavy": [5.0] * 1500 + [rng.gauss(0, 100) for _ in range(3000)],
        "two": [1.0] * 700 + [2.0] * 701,
        "wide": [10.0 ** rng.uniform(-200, 200) * rng.choice([-1, 1]) for _ in range(2500)],
        "one": [42.0],
        "even": [1.0, 2.0, 3.0, 10.0],
        "edge": [0.0] * 1000 + [1.0] * 999 + [2.0],
    }


@pytest.mark.parametrize("rows", [1_000_000, 50, 5])
def test_quantiles_by_group(spark, rows):
    shapes = _shapes()
    data = [(k, v) for k, vs in shapes.items() for v in vs] + [("gaps", None), (None, 3.0), (None, 4.0)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    got = exact_quantiles(df, {"v": F.col("v")}, PROBS, ["k"], ordered_rows=rows)
    for key, values in [*shapes.items(), (None, [3.0, 4.0])]:
        for p in PROBS:
            want = float(np.quantile(values, p))
            assert got.get("v", p, (key,)) == pytest.approx(want, rel=1e-12, abs=1e-12), (key, p)
    assert got.get("v", 0.5, ("gaps",)) is None


@pytest.mark.parametrize("rows", [1_000_000, 40])
def test_quantiles_of_several_columns(spark, rows):
    rng = random.Random(3)
    data = [(rng.random(), float(rng.randint(0, 3)), None if i % 3 else rng.gauss(0, 1)) for i in range(4000)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = exact_quantiles(df, {c: F.col(c) for c in "abc"}, PROBS, ordered_rows=rows, moments=True)
    for i, c in enumerate("abc"):
        values = [r[i] for r in data if r[i] is not None]
        for p in PROBS:
            assert got.get(c, p) == pytest.approx(float(np.quantile(values, p)), rel=1e-12), (c, p)
        m = got.moments[((), c)]
        assert m["n"] == len(values) and m["std"] == pytest.approx(np.std(values, ddof=1))


def test_refinement_runs(spark, monkeypatch):
    """A tiny bound really takes the narrowing path, more than once."""
    calls = []
    refine = selection._refine
    monkeypatch.setattr(selection, "_refine", lambda *a: (calls.append(1), refine(*a)))
    monkeypatch.setattr(selection, "_GRID_POINTS", ",".join(str(i / 10) for i in range(11)))
    monkeypatch.setattr(selection, "GRID", 10)
    values = list(range(20000))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(6)
    got = exact_quantiles(df, {"v": F.col("v")}, [0.3, 0.5], ordered_rows=100, slack=1)
    assert len(calls) >= 2
    assert got.get("v", 0.5) == 9999.5 and got.get("v", 0.3) == pytest.approx(5999.7)


def test_too_many_groups(spark):
    df = spark.range(1000).select("id", F.col("id").cast("double").alias("v"))
    with pytest.raises(ValueError):
        exact_quantiles(df, {"v": F.col("v")}, [0.5], ["id"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantiles(df, {"v": F.col("v")}, [0.5]).get("v", 0.5) is None


def test_distinct_up_to(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("few"), "id", F.lit(None).cast("int").alias("none"))
    assert distinct_up_to(df, ["few", "id", "none"], 20) == {"few": 7, "id": None, "none": 0}
    assert distinct_up_to(df, ["few", "id"], {"few": 6, "id": 5000}) == {"few": None, "id": 5000}
