import math
import random
from fractions import Fraction

import compare
import duckdb
import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tabulyst.functions import scalars as S
from tabulyst.functions import tails
from tabulyst.operators import charts, diagnostics, model
from tabulyst.operators import findings as fnd
from tabulyst.operators import roles as R
from tabulyst.operators import stat_tests as st
from tabulyst.operators import summaries as sm
from tabulyst.plans import tables


def test_tails():
    # published table values
    assert tails.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-7)
    assert tails.f_upper(3.492828, 2, 20) == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_upper(9.487729, 4) == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_upper(3.841459, 1) == pytest.approx(0.05, abs=1e-7)
    # many rows: t approaches the normal, F times d1 the chi-square
    assert tails.t_two_sided(1.959963985, 1e12) == pytest.approx(0.05, rel=1e-8)
    assert tails.f_upper(1.7, 4, 1e13) == pytest.approx(tails.chi2_upper(6.8, 4), rel=1e-9)
    # the two ways meet where one takes over
    assert tails.t_two_sided(2.5, 199_999) == pytest.approx(tails.t_two_sided(2.5, 200_001), rel=1e-6)
    assert tails.t_two_sided(1e6, 1e6) < 1e-300


def test_p_format(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1e-301,), (0.0004,), (0.05,), (float("nan"),)], "p double")
    assert [r[0] for r in df.select(S.format_p(F.col("p"))).collect()] == [
        "NA", "<1e-300", "<1e-300", "4.00e-04", "0.0500", "NA"]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(float(i), 0.1, float(-i)) for i in range(50)], "x double, k double, y double")
    got = {(r["x"], r["y"]): r["r"] for r in charts.pair_correlations(df, ["x", "k", "y"]).collect()}
    assert got[("x", "k")] is None and got[("k", "y")] is None
    assert got[("x", "y")] == pytest.approx(-1.0)


def test_matrix_and_pairs_agree(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(1e6, 1.0, (400, 18))
    data[:, 3] += data[:, 2]
    cols = [f"c{i}" for i in range(18)]
    df = spark.createDataFrame(data.tolist(), cols)
    want = np.corrcoef(data.T)
    for some in (cols, cols[:6]):
        for r in charts.pair_correlations(df, some).collect():
            assert r["r"] == pytest.approx(want[r["i"], r["j"]], abs=1e-6)


def test_wide_columns_with_gaps(spark):
    rng = np.random.default_rng(6)
    data = rng.normal(1e5, 3.0, (900, 150))
    data[:, 7] += data[:, 9]
    data[rng.random(data.shape) < 0.2] = np.nan
    data[:, 20] = 4.25
    data[:, 21] = np.nan
    data[10:, 22] = np.nan
    data[:10, 23] = 7.0
    cols = [f"c{i}" for i in range(data.shape[1])]
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in row] for row in data], ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(r["i"], r["j"]): r for r in charts.pair_correlations(df, cols).collect()}
    assert len(got) == 150 * 149 // 2
    for (i, j), r in got.items():
        both = ~np.isnan(data[:, i]) & ~np.isnan(data[:, j])
        x, y = data[both, i], data[both, j]
        assert (r["x"], r["y"], r["n"]) == (cols[i], cols[j], both.sum())
        if len(x) < 2 or x.min() == x.max() or y.min() == y.max():
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)
    small = {(r["i"], r["j"]): r["r"] for r in charts.pair_correlations(df, cols[:6]).collect()}
    assert all(got[k]["r"] == pytest.approx(v, abs=1e-9) for k, v in small.items())
    none = charts.pair_correlations(df.filter("false"), cols[:20]).collect()
    assert len(none) == 190 and {(r["n"], r["r"]) for r in none} == {(0, None)}


def exact_least_squares(rows, target):
    """Coefficients (constant first) in fractions, by elimination on the normal equations."""
    rows = [[Fraction(1), *map(Fraction, r)] for r in rows]
    p = len(rows[0])
    system = [[sum(r[i] * r[j] for r in rows) for j in range(p)] + [sum(r[i] * Fraction(y) for r, y in zip(rows, target, strict=True))] for i in range(p)]
    for i in range(p):
        pivot = next(k for k in range(i, p) if system[k][i])
        system[i], system[pivot] = system[pivot], system[i]
        for k in range(p):
            if k != i and system[k][i]:
                factor = system[k][i] / system[i][i]
                system[k] = [a - factor * b for a, b in zip(system[k], system[i], strict=True)]
    return [system[i][p] / system[i][i] for i in range(p)]


def test_nearly_dependent_columns_keep_their_digits(spark):
    rng = np.random.default_rng(9)
    a, b, tiny = rng.integers(-1000, 1000, 300) / 8, rng.integers(-1000, 1000, 300) / 8, rng.integers(-64, 64, 300) / 2.0**29
    x = np.stack([a, b, a + b + tiny], axis=1)
    y = 3 * a - 2 * b + rng.integers(-8, 8, 300) * 2.0**-29 + 1e6 * tiny + 5
    scaled = (x - x.mean(0)) / x.std(0)
    assert 1e8 < np.linalg.cond(scaled) < 1e10
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)], "a double, b double, c double, y double").repartition(7)
    got = {r["term"]: r["coef"] for r in diagnostics.diagnose(df, "y").coefficient_frame(spark).collect()}
    want = exact_least_squares(x.tolist(), y.tolist())
    for term, value in zip(("const", "a", "b", "c"), want, strict=True):
        assert got[term] == pytest.approx(float(value), rel=1e-6)


def test_many_levels_by_counts(spark):
    rng = random.Random(11)
    rows = [(rng.gauss(1e6, 3), rng.choice([None, rng.random()]), *(f"v{int(20 * rng.random() ** (1 + k / 9))}" if rng.random() < 0.95 else None for k in range(12)), rng.gauss(0, 1)) for _ in range(1500)]
    schema = "x double, z double, " + ", ".join(f"s{k} string" for k in range(12)) + ", y double"
    df = spark.createDataFrame(rows, schema).repartition(6)
    numbers, categories = diagnostics.design_parts(df, "y")
    got = diagnostics.parted_moments(df, numbers, categories, "y")
    design = diagnostics.dense(numbers, categories)
    data = np.array(df.select(*design.values(), "y").collect(), float)
    assert got.terms == list(design) and got.n == 1500 and len(got.terms) > 150
    assert np.allclose(got.mean, data.mean(0), rtol=1e-12) and np.allclose(got.std, data.std(0, ddof=1), rtol=1e-9)
    assert np.allclose(got.corr, np.corrcoef(data.T), atol=1e-9)


def test_factor_and_moments_agree(spark):
    rng = np.random.default_rng(10)
    data = rng.normal(50, 2, (500, 4))
    df = spark.createDataFrame(data.tolist(), "a double, b double, c double, y double").repartition(9)
    design = diagnostics.design_columns(df, "y")
    m = diagnostics.design_moments(df, design, "y")
    plain, factored = diagnostics.least_squares(m), diagnostics.least_squares(m, diagnostics.factor(df, design, "y", m))
    for one, other in zip(plain[0], factored[0], strict=True):
        assert one[2:] == pytest.approx(other[2:], rel=1e-8)
    assert plain[1] == pytest.approx(factored[1], rel=1e-8)


def test_yates(spark):
    lines = tables.table(spark, "/root/testdata/sf0.01", "lineitem").where("l_returnflag <> 'A'")
    got = st.chi2(lines, "l_returnflag", "l_linestatus").first()
    assert got["statistic"] == pytest.approx(0.0584081, abs=1e-6)


def test_chi2_with_an_empty_cell(spark):
    rows = [("a", "x")] * 10 + [("b", "y")] * 12 + [("a", "y")] * 3
    df = spark.createDataFrame(rows, "p string, q string")
    got = st.chi2_from_counts(st.contingency(df, "p", "q")).first()
    table = np.array([[10, 3], [0, 12]], float)
    e = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert got["statistic"] == pytest.approx(((np.abs(table - e) - 0.5) ** 2 / e).sum())
    wide = spark.createDataFrame(rows + [("c", "x")] * 4, "p string, q string")
    table = np.array([[10, 3], [0, 12], [4, 0]], float)
    e = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    got = st.chi2_from_counts(st.contingency(wide, "p", "q")).first()
    assert got["statistic"] == pytest.approx(((table - e) ** 2 / e).sum()) and got["dof"] == 2


def _groups(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows = [(k, rng.gauss(i, 1 + i)) for i, (k, n) in enumerate(sizes.items()) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "g string, v double")


def test_two_groups_use_welch(spark):
    rows, df = _groups(spark, {"a": 30, "b": 40, "tiny": 4})
    got = st.group_difference(df, "g", "v").collect()
    a, b = (np.array([v for k, v in rows if k == g]) for g in "ab")
    t = (a.mean() - b.mean()) / math.sqrt(a.var(ddof=1) / 30 + b.var(ddof=1) / 40)
    assert len(got) == 1 and got[0]["test"] == "t_test" and got[0]["statistic"] == pytest.approx(t)


def test_anova_uses_the_first_five_groups(spark):
    rows, df = _groups(spark, {k: 20 for k in "fedcba"})
    got = st.group_difference(df, "g", "v").first()
    gs = [np.array([v for k, v in rows if k == g]) for g in "abcde"]
    every = np.concatenate(gs)
    between = sum(len(g) * (g.mean() - every.mean()) ** 2 for g in gs) / 4
    within = sum(((g - g.mean()) ** 2).sum() for g in gs) / (len(every) - 5)
    assert got["test"] == "anova" and got["statistic"] == pytest.approx(between / within)


def _f_of_groups(groups):
    every = np.concatenate(groups)
    between = sum(len(g) * (g.mean() - every.mean()) ** 2 for g in groups) / (len(groups) - 1)
    return between / (sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(every) - len(groups)))


def test_anova_over_every_group(spark):
    rows, df = _groups(spark, {k: 20 + i for i, k in enumerate("hgfedcba")} | {"tiny": 4})
    got = st.group_difference(df, "g", "v", most=None).collect()
    f = _f_of_groups([np.array([v for k, v in rows if k == g]) for g in "abcdefgh"])
    assert [r["test"] for r in got] == ["anova"] and got[0]["statistic"] == pytest.approx(f)


def test_all_groups_of_two_use_welch(spark):
    _, df = _groups(spark, {"a": 30, "b": 40, "tiny": 4})
    assert st.group_difference(df, "g", "v", most=None).collect() == st.group_difference(df, "g", "v").collect()


def test_trip_tests_use_every_payment_type(spark, tmp_path):
    lines = spark.range(600).selectExpr(
        "id div 3 as l_orderkey", "cast(id % 3 as int) as l_linenumber", "id % 7 as l_suppkey",
        "timestamp_ntz'2024-01-01 00:00:00' as l_shipdate", "cast(pmod(hash(id), 5000) as double) as l_extendedprice",
        "0.05D as l_discount", "0.02D as l_tax", "cast(pmod(hash(id, 1), 40) + (id div 3) % 8 as double) as l_quantity")
    orders = spark.range(200).selectExpr("id as o_orderkey", "concat('kind ', id % 8) as o_orderpriority")
    suppliers = spark.range(7).selectExpr("id as s_suppkey", "concat('company ', id) as s_name")
    con = duckdb.connect()
    for name, df in (("lineitem", lines), ("orders", orders), ("supplier", suppliers)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    rows = tables.trips(spark, str(tmp_path)).select("payment_type", "trip_seconds").collect()
    filled = np.median([r["trip_seconds"] for r in rows if r["trip_seconds"] is not None])
    groups = {}
    for kind, seconds in rows:
        groups.setdefault(kind or "Missing", []).append(filled if seconds is None else seconds)
    f = _f_of_groups([np.array(g) for g in groups.values()])
    cols, got = compare.rows_of_spark(contract.queries()["trip_tests"](spark, str(tmp_path)))
    tests = {r[cols.index("test")]: float(r[cols.index("statistic")]) for r in got}
    assert len(groups) == 9 and set(tests) == {"pearsonr", "anova", "chi2"} and tests["anova"] == pytest.approx(f, abs=1e-6)
    assert (cols, got) == compare.rows_of_duck(con, contract.oracle_sql()["trip_tests"])


def test_one_group_gives_no_test(spark):
    _, df = _groups(spark, {"a": 30, "tiny": 4})
    assert st.group_difference(df, "g", "v").count() == 0


def test_pearson_falls_back_when_no_pair_is_meaningful(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(40)], "fare double, total double")
    assert tuple(st.pearson(df, ["fare", "total"]).first())[:3] == ("pearsonr", "fare", "total")


def test_histogram(spark):
    df = spark.createDataFrame([(float(i % 41), 3.0, None) for i in range(410)], "v double, k double, none double")
    rows = charts.histogram(df, ["v", "k", "none"]).collect()
    by = {n: [r["count"] for r in rows if r["name"] == n] for n in ("v", "k", "none")}
    assert sum(by["v"]) == 410 and len(by["v"]) == 40 and max(by["v"]) == 20
    assert sum(by["k"]) == 410 and by["none"] == []


def test_unknown_companies(spark):
    rows = [("Unknown", 1.0)] * 3 + [(None, 2.0)] * 3 + [(f"c{i}", 5.0) for i in range(20)] + [("c1", 7.0)]
    df = spark.createDataFrame(rows, "company string, fare double")
    got = [(r["company"], r["count"]) for r in sm.company(df).collect()]
    # together they are the largest label; they are listed apart
    assert set(got[:2]) == {(None, 3), ("Unknown", 3)} and got[2] == ("c1", 2) and len(got) == 11


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("g"))
    a = model.split_rows(df, 42, "g")
    b = model.split_rows(df.repartition(11, "g"), 42, "g")
    assert a.exceptAll(b).count() == 0
    for r in a.groupBy("g").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert abs(r["t"] - 0.2 * r["n"]) <= 1


def test_unseen_category_is_all_zero(spark):
    m = model.ModelMatrix([], ["c"], [], [])
    train = spark.createDataFrame([("x",), ("y",), ("z",)], "s0 string")
    test = spark.createDataFrame([("z",), ("q",)], "s0 string")
    from pyspark.ml import Pipeline

    out = [list(r["features"]) for r in Pipeline(stages=model._encoder(m)).fit(train).transform(test).collect()]
    assert out == [[0.0, 0.0, 1.0], [0.0, 0.0, 0.0]]


def test_macro_f1(spark):
    rows = [("a", "a")] * 2 + [("b", "b"), ("b", "a"), ("c", "c")]
    got = model.classification_scores(spark.createDataFrame(rows, "label string, prediction string")).first()
    assert got["accuracy"] == pytest.approx(0.8) and got["f1"] == pytest.approx((0.8 + 2 / 3 + 1) / 3)


def test_absent_target_is_recorded(spark):
    got = model.fit_baseline(spark.range(5).toDF("a"), "b").frame(spark).first()
    assert got["enabled"] is False and "b" in got["error"]


def test_classification_after_a_table_was_observed(spark):
    seen = Observation()
    assert spark.range(3).observe(seen, F.count("*").alias("n")).count() == 3 and seen.get == {"n": 3}
    df = spark.range(100).selectExpr("if(id % 2 = 0, 'even', 'odd') as y", "id % 2 * 3.0D + id / 200 as x")
    got = model.fit_baseline(df, "y").record
    assert got.get("error") is None and got["accuracy"] == 1.0


def test_modeling_classification(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("y"),
        ((F.col("id") % 2) * 3.0 + F.rand(1)).alias("x"))
    got = model.fit_baseline(df, "y").record
    assert got["accuracy"] == 1.0 and got["model_name"] == "LogisticRegression" and got["n_test"] == 80


def _regression(spark, n=500):
    rng = np.random.default_rng(2)
    a, b = rng.normal(50, 3, n), rng.normal(-7, 2, n)
    kind = rng.choice(["p", "q", "r"], n)
    y = 3 * a - 2 * b + (kind == "q") * 5 + rng.normal(0, 1, n)
    rows = [(float(u), float(v), str(k), 1.0, float(w)) for u, v, k, w in zip(a, b, kind, y)]
    return a, b, kind, y, spark.createDataFrame(rows, "a double, b double, kind string, flat double, y double")


def test_least_squares(spark):
    a, b, kind, y, df = _regression(spark)
    got = diagnostics.diagnose(df, "y")
    x = np.column_stack([np.ones_like(a), a, b, kind == "q", kind == "r"]).astype(float)
    beta, rss, *_ = np.linalg.lstsq(x, y, rcond=None)
    cov = np.linalg.inv(x.T @ x) * rss[0] / (len(y) - 5)
    assert [c[1] for c in got.coefficients] == ["const", "a", "b", "kind_q", "kind_r"]
    assert [c[2] for c in got.coefficients] == pytest.approx(beta, rel=1e-7)
    assert [c[3] for c in got.coefficients] == pytest.approx(np.sqrt(np.diag(cov)), rel=1e-7)
    assert got.fit["r2"] == pytest.approx(1 - rss[0] / ((y - y.mean()) ** 2).sum())
    z = x[:, 1:]
    for term, vif in got.vif:
        i = ["a", "b", "kind_q", "kind_r"].index(term)
        rest = np.delete(z, i, 1)
        left = z[:, i] - rest @ np.linalg.lstsq(rest, z[:, i], rcond=None)[0]
        assert vif == pytest.approx((z[:, i] @ z[:, i]) / (left @ left), rel=1e-6)


def test_near_copies_are_dropped_and_sums_are_infinite(spark):
    _, _, _, _, df = _regression(spark)
    more = df.withColumn("copy", F.col("a") * 2 + 1).withColumn("total", F.col("a") + F.col("b")).drop("kind")
    got = diagnostics.diagnose(more, "y")
    assert [c[1] for c in got.coefficients] == ["const", "a", "b", "total"]
    assert all(math.isinf(v) for _, v in got.vif)


def test_findings_close_when_nothing_is_found(spark):
    rates = spark.createDataFrame([(0, "a", 0.3)], "position int, name string, missing_rate double")
    none = spark.createDataFrame([(0,)], "dropped_duplicates long")
    some = spark.createDataFrame([(12,)], "dropped_duplicates long")
    tests = spark.createDataFrame([], "test string, x string, y string, statistic double, p_value double, p_value_fmt string")
    assert [r["kind"] for r in fnd.findings(rates, none, tests).collect()] == ["none"]
    got = fnd.findings(rates, some, tests).collect()
    assert [r["kind"] for r in got] == ["duplicates"] and " 12 " in got[0]["message"]


def test_run_tests_picks_by_name(spark, sf):
    df = tables.trips(spark, sf).fillna({"payment_type": "Missing", "company": "Missing"})
    got = st.run_tests(df, R.infer_roles(df)).collect()
    assert [(r["test"], r["x"], r["y"]) for r in got] == [
        ("pearsonr", "trip_miles", "trip_seconds"), ("anova", "payment_type", "trip_seconds"),
        ("chi2", "payment_type", "company")]
