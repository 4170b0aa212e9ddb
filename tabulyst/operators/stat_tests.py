"""Pearson, Welch t, one-way ANOVA and chi-square, each from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulyst.functions import names
from tabulyst.functions import scalars as S
from tabulyst.functions import tails
from tabulyst.functions.scalars import col
from tabulyst.operators import roles as R
from tabulyst.operators.charts import pair_correlations
from tabulyst.operators.selection import distinct_up_to
from tabulyst.operators.summaries import group_moments

# Sizes that admit a column or group to a test, preferred columns.
ANOVA_LEVELS = 50
CHI2_LEVELS = 80
LEAST_VALUES = 30
LEAST_GROUP = 5
ANOVA_GROUPS = 5
GROUP_NAMES = ("Payment Type",)
VALUE_NAMES = ("Trip Seconds", "Trip Miles", "Fare")
SECOND_NAMES = ("Company",)

RESULT = ("test", "x", "y", "statistic", "p_value", "p_value_fmt")


def _result(df: DataFrame, test: str | Column, x: Column, y: Column) -> DataFrame:
    name = F.lit(test) if isinstance(test, str) else test
    return df.select(
        name.alias("test"), x.alias("x"), y.alias("y"),
        "statistic", "p_value", S.format_p(F.col("p_value")).alias("p_value_fmt"),
    )


def ranked_pairs(pairs: DataFrame) -> DataFrame:
    """Column pairs with their validity, strongest correlation first."""
    known = pairs.where(F.col("r").isNotNull()).select("i", "j", "x", "y", "n", "r", F.abs("r").alias("abs_r"))
    return known.orderBy(F.desc("abs_r"), "i", "j")


def valid_pair(columns: Sequence[str], i: Column, j: Column) -> Column:
    """The name rules for pairs, looked up by column position."""
    grid = [[names.is_meaningful_pair(a, b) for b in columns] for a in columns]
    return F.element_at(F.element_at(F.lit(grid), i + 1), j + 1)


def strongest_pair(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The strongest meaningful pair, or the strongest pair if none is."""
    pairs = pair_correlations(df, columns).where(F.col("r").isNotNull())
    meaningful = valid_pair(list(columns), F.col("i"), F.col("j"))
    return (
        pairs.withColumn("meaningful", meaningful)
        .orderBy(F.desc("meaningful"), F.desc(F.abs("r")), "i", "j").limit(1)
    )


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    best = strongest_pair(df, columns)
    free = F.col("n") - 2.0
    t = F.col("r") * F.sqrt(F.try_divide(free, 1.0 - F.col("r") * F.col("r")))
    tested = best.select(
        "x", "y", F.col("r").alias("statistic"),
        F.when(F.abs("r") >= 1.0, 0.0).otherwise(tails.t_tail(t, free)).alias("p_value"),
    )
    return _result(tested, "pearsonr", F.col("x"), F.col("y"))


def groups_for_test(
    df: DataFrame, category: str, value: str, most: int | None = ANOVA_GROUPS
) -> DataFrame:
    """Moments of the groups in key order, numbered: all groups, or the first ``most``.

    One group more than a test uses is enough to tell two groups from several,
    so with ``most`` the windows see a few rows whatever the category holds.
    Without it they see a row per group, and the caller bounds the groups.
    """
    groups = group_moments(df, category, value, LEAST_GROUP)
    if most is not None:
        groups = groups.orderBy("key").limit(most + 1)
    every = W.partitionBy(F.lit(1))
    return (
        groups.withColumn("place", F.row_number().over(every.orderBy("key")))
        .withColumn("groups", F.count("*").over(every))
    )


def welch(groups: DataFrame) -> DataFrame:
    """t, degrees of freedom and p for exactly two groups."""
    def of(place: int, c: str) -> Column:
        return F.max(F.when(F.col("place") == place, F.col(c)))

    two = groups.where(F.col("groups") == 2).agg(
        *[of(p, c).alias(f"{c}{p}") for p in (1, 2) for c in ("n", "mean", "variance")]
    ).where(F.col("n1").isNotNull())
    e1, e2 = (F.try_divide(F.col(f"variance{p}"), F.col(f"n{p}")) for p in (1, 2))
    parts = two.select("*", e1.alias("e1"), e2.alias("e2"))
    e1, e2 = F.col("e1"), F.col("e2")
    t = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(e1 + e2))
    free = F.try_divide(
        (e1 + e2) * (e1 + e2),
        F.try_divide(e1 * e1, F.col("n1") - 1.0) + F.try_divide(e2 * e2, F.col("n2") - 1.0),
    )
    tested = parts.select(t.alias("statistic"), free.alias("free"))
    return tested.withColumn("p_value", tails.t_tail(F.col("statistic"), F.col("free")))


def anova(groups: DataFrame, most: int | None = ANOVA_GROUPS) -> DataFrame:
    """F and p over all groups, or the first ``most`` in key order, for three groups or more."""
    used = groups.where((F.col("groups") >= 3) & (F.col("n") > 0))
    if most is not None:
        used = used.where(F.col("place") <= most)
    every = W.partitionBy(F.lit(1))
    total = F.sum("n").over(every)
    grand = F.sum(F.col("n") * F.col("mean")).over(every) / total
    spread = used.withColumn("off", F.col("mean") - grand)
    sums = spread.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("off") * F.col("off")).alias("between"),
        F.sum((F.col("n") - 1) * F.coalesce("variance", F.lit(0.0))).alias("within"),
    ).where(F.col("k") >= 2)
    d1, d2 = F.col("k") - 1.0, (F.col("n") - F.col("k")).cast("double")
    tested = sums.select(
        F.try_divide(F.try_divide(F.col("between"), d1), F.try_divide(F.col("within"), d2))
        .alias("statistic"),
        d1.alias("d1"), d2.alias("d2"),
    )
    return tested.withColumn(
        "p_value", tails.f_tail(F.col("statistic"), F.col("d1"), F.col("d2"))
    )


def group_difference(
    df: DataFrame, category: str, value: str, most: int | None = ANOVA_GROUPS
) -> DataFrame:
    """Welch's test for two groups, ANOVA for more; no row for fewer.

    ANOVA takes the first ``most`` groups, or with None every group.
    """
    groups = groups_for_test(df, category, value, most)
    two = welch(groups).select(F.lit("t_test").alias("test"), "statistic", "p_value")
    many = anova(groups, most).select(F.lit("anova").alias("test"), "statistic", "p_value")
    return _result(two.unionByName(many), F.col("test"), F.lit(category), F.lit(value))


def contingency(df: DataFrame, x: str, y: str) -> DataFrame:
    """(x, y, observed) for every pair of categories that occurs."""
    pairs = df.where(col(x).isNotNull() & col(y).isNotNull())
    return pairs.groupBy(col(x).alias("x"), col(y).alias("y")).agg(F.count("*").alias("observed"))


def chi2_from_counts(counts: DataFrame) -> DataFrame:
    """(statistic, dof) of a contingency table in long form.

    The caller bounds the table to ``CHI2_LEVELS`` squared cells. Cells that do
    not occur add their expected count, so they need not be listed. With one
    degree of freedom all four deviations are equal and Yates' correction takes
    at most a half off them.
    """
    o = F.col("observed").cast("double")
    expected = F.col("row_total") * F.col("col_total") / F.col("total")
    cells = (
        counts.withColumn("row_total", F.sum(o).over(W.partitionBy("x")))
        .withColumn("col_total", F.sum(o).over(W.partitionBy("y")))
        .withColumn("total", F.sum(o).over(W.partitionBy(F.lit(1))))
        .withColumn("expected", expected)
        .withColumn("gap", F.abs(o - F.col("expected")))
    )
    sums = cells.agg(
        F.count_distinct("x").alias("rows"), F.count_distinct("y").alias("cols"),
        F.max("total").alias("total"), F.sum("expected").alias("covered"), F.max("gap").alias("gap"),
        F.sum(F.col("gap") * F.col("gap") / F.col("expected")).alias("plain"),
        F.sum(o / F.col("row_total") / F.col("row_total")).alias("inverse_rows"),
        F.sum(o / F.col("col_total") / F.col("col_total")).alias("inverse_cols"),
    )
    dof = ((F.col("rows") - 1) * (F.col("cols") - 1)).cast("double")
    reduced = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    yates = reduced * reduced * F.col("total") * F.col("inverse_rows") * F.col("inverse_cols")
    plain = F.col("plain") + (F.col("total") - F.col("covered"))
    return sums.select(F.when(dof == 1, yates).otherwise(plain).alias("statistic"), dof.alias("dof"))


def chi2(df: DataFrame, x: str, y: str) -> DataFrame:
    tested = chi2_from_counts(contingency(df, x, y)).where(F.col("dof") > 0)
    tested = tested.withColumn("p_value", tails.chi2_tail(F.col("statistic"), F.col("dof")))
    return _result(tested, "chi2", F.lit(x), F.lit(y))


def numeric_candidates(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with enough values that differ; codes are left out."""
    columns = [c for c in columns if not names.is_code_like(c)]
    if not columns:
        return []
    numbers = [S.to_number(col(c), df.schema[c].dataType) for c in columns]
    seen = df.agg(
        *[agg.alias(f"{n}{i}") for i, x in enumerate(numbers)
          for n, agg in (("n", F.count(x)), ("lo", F.min(x)), ("hi", F.max(x)))]
    ).first()
    return [
        c for i, c in enumerate(columns)
        if seen[f"n{i}"] >= LEAST_VALUES and seen[f"lo{i}"] < seen[f"hi{i}"]
    ]


def run_tests(
    df: DataFrame, roles: dict[str, str], most_groups: int | None = ANOVA_GROUPS
) -> DataFrame:
    """All tests the columns allow, one row each.

    With None for ``most_groups`` ANOVA takes every group; a grouping column has
    ``ANOVA_LEVELS`` of them at most.
    """
    numbers = R.with_role(roles, R.NUMERIC, df)
    categories = [c for c in R.with_role(roles, R.CATEGORICAL, df) if not names.is_code_like(c)]
    found = []
    if len(numbers) >= 2:
        found.append(pearson(df, numbers))
    levels = {
        c: n for c, n in distinct_up_to(df, categories, CHI2_LEVELS).items() if n and n >= 2
    }
    grouping = [c for c in categories if levels.get(c, ANOVA_LEVELS + 1) <= ANOVA_LEVELS]
    if grouping and numbers:
        values = numeric_candidates(df, numbers)
        group = names.preferred_column(grouping, GROUP_NAMES) or grouping[0]
        value = names.preferred_column(values, VALUE_NAMES) or next(iter(values), None)
        if value:
            found.append(group_difference(df, group, value, most_groups))
    if len(levels) >= 2:
        tabled = [c for c in categories if c in levels]
        x = names.preferred_column(tabled, GROUP_NAMES)
        y = names.preferred_column(tabled, SECOND_NAMES)
        if not (x and y) or x == y:
            x, y = sorted(tabled, key=lambda c: (levels[c], tabled.index(c)))[:2]
        found.append(chi2(df, x, y))
    if not found:
        return df.sparkSession.createDataFrame(
            [], "test string, x string, y string, statistic double, p_value double, p_value_fmt string"
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
