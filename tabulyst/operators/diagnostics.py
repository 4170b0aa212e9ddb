"""Ordinary least squares with its tests, and variance inflation factors.

Spark reduces the rows to counts, means and one matrix of columns by columns;
the linear algebra on that matrix (at most ``MAX_FEATURES`` squared after
selection) is a few numpy lines on the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions import names
from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col
from tabulyst.functions.tails import f_upper, t_two_sided
from tabulyst.operators import profile as P
from tabulyst.operators.cleaning import FILL_LABEL
from tabulyst.operators.model import sample_rows
from tabulyst.operators.qr import triangular_factor
from tabulyst.operators.selection import distinct_up_to, exact_quantiles
from tabulyst.operators.sparse_design import sparse_moments

# Sizes and limits of the diagnostics.
MAX_FEATURES = 30
MAX_LEVELS = 20
COLLINEAR = 0.9999
VIF_SHOWN = 10
SINGULAR = 1e-11
# Under this least eigenvalue of the correlations the design itself is factored; of its largest
# singular value, what counts as none.
ILL_CONDITIONED, DEPENDENT = 1e-6, 1e-13
INTERCEPT = "const"

COEFFICIENT_SCHEMA = "position int, term string, coef double, std_err double, t double, p_value double"
VIF_SCHEMA = "feature string, vif double"


@dataclass
class Diagnostics:
    coefficients: list[tuple] = field(default_factory=list)
    fit: dict = field(default_factory=dict)
    vif: list[tuple[str, float]] = field(default_factory=list)
    error: str | None = None

    def coefficient_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.coefficients, COEFFICIENT_SCHEMA)

    def vif_frame(self, spark, top: int = VIF_SHOWN) -> DataFrame:
        return spark.createDataFrame(self.vif[:top], VIF_SCHEMA)

    def fit_frame(self, spark) -> DataFrame:
        numbers = ("r2", "r2_adj", "f_statistic", "f_p_value", "log_likelihood", "aic", "bic")
        schema = T.StructType(
            [T.StructField("n_obs", T.LongType())]
            + [T.StructField(n, T.DoubleType()) for n in numbers]
            + [T.StructField("error", T.StringType())]
        )
        row = (self.fit.get("n_obs"), *[self.fit.get(n) for n in numbers], self.error)
        return spark.createDataFrame([row], schema)


Categories = dict[str, tuple[Column, list[str]]]


def design_columns(df: DataFrame, target: str) -> dict[str, Column]:
    """Numeric columns with gaps at the median, and a dummy per category level."""
    return dense(*design_parts(df, target))


def dense(numbers: dict[str, Column], categories: Categories) -> dict[str, Column]:
    """The terms of a design; of each category's sorted levels the first has no dummy."""
    return numbers | {f"{c}_{v}": F.when(x == v, 1.0).otherwise(0.0) for c, (x, levels) in categories.items() for v in levels[1:]}


def design_parts(df: DataFrame, target: str) -> tuple[dict[str, Column], Categories]:
    """Numeric columns with gaps at the median, and the categories with their sorted levels.
    Codes and coordinates are left out."""
    features = [f for f in df.schema if f.name != target and not names.is_code_like(f.name)]
    numeric = [
        f.name for f in features
        if S.is_numeric(f.dataType) and not names.is_coordinate_name(f.name)
    ]
    texts = [
        f for f in features if S.is_text(f.dataType) or isinstance(f.dataType, T.BooleanType)
    ]
    fills = exact_quantiles(df, {c: col(c).cast("double") for c in numeric}, [0.5])
    numbers: dict[str, Column] = {}
    for c in numeric:
        x = col(c).cast("double")
        middle = fills.get(c, 0.5)
        numbers[c] = x if middle is None else F.coalesce(x, F.lit(middle))
    counts = distinct_up_to(df, [f.name for f in texts], MAX_LEVELS)
    kept = [f for f in texts if counts[f.name] is not None and counts[f.name] >= 2]
    shown = {f.name: _shown(f) for f in kept}
    levels: dict[str, list[str]] = {c: [] for c in shown}
    if kept:
        # at most MAX_LEVELS + 1 levels per column
        plain = df.select(*[x.alias(c) for c, x in shown.items()])
        for r in P.top_values(plain, list(shown), MAX_LEVELS + 1).collect():
            levels[r["name"]].append(r["value"])
    return numbers, {c: (x, sorted(levels[c])) for c, x in shown.items()}


def _shown(f: T.StructField) -> Column:
    x = col(f.name).cast("string")
    if isinstance(f.dataType, T.BooleanType):
        x = F.initcap(x)
    return F.coalesce(x, F.lit(FILL_LABEL))


@dataclass
class Moments:
    """Count, means, spreads and correlations of the design; the target is last."""

    terms: list[str]
    n: int
    mean: np.ndarray
    std: np.ndarray
    corr: np.ndarray

    def keep(self, places: list[int]) -> Moments:
        at = [*places, len(self.terms)]
        return Moments(
            [self.terms[i] for i in places], self.n, self.mean[at], self.std[at],
            self.corr[np.ix_(at, at)],
        )


def design_moments(df: DataFrame, design: dict[str, Column], target: str) -> Moments:
    y = S.to_number(col(target), df.schema[target].dataType)
    vectors = df.where(y.isNotNull()).select(array_to_vector(F.array(*design.values(), y)).alias("v"))
    stats = vectors.select(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")
    ).first()["s"]
    n = int(stats["count"])
    if n < 2:
        raise ValueError("too few rows with a target value")
    corr = Correlation.corr(vectors, "v").first()[0].toArray()
    return Moments(
        list(design), n, stats["mean"].toArray(), np.sqrt(stats["variance"].toArray()), corr
    )


def parted_moments(df: DataFrame, numbers: dict[str, Column], categories: Categories, target: str) -> Moments:
    """The same from level counts, for designs with categories."""
    y = S.to_number(col(target), df.schema[target].dataType)
    n, mean, std, corr = sparse_moments(df.where(y.isNotNull()), [*numbers.values(), y], list(categories.values()))
    if n < 2:
        raise ValueError("too few rows with a target value")
    return Moments(list(dense(numbers, categories)), n, mean, std, corr)


def select_features(m: Moments, most: int = MAX_FEATURES, collinear: float = COLLINEAR) -> Moments:
    """Drop constants and near copies of an earlier column, keep those closest to y."""
    m = m.keep([i for i in range(len(m.terms)) if m.std[i] > 0])
    size = np.abs(m.corr)
    m = m.keep([
        j for j in range(len(m.terms)) if not any(size[i, j] > collinear for i in range(j))
    ])
    if len(m.terms) > most:
        score = np.nan_to_num(np.abs(m.corr[:-1, -1]))
        m = m.keep(sorted(range(len(m.terms)), key=lambda i: -score[i])[:most])
    return m


def diagnose(df: DataFrame, target: str, max_rows: int | None = None) -> Diagnostics:
    """Fit, coefficient table and VIF over all rows with a target value.

    ``max_rows`` asks for a random sample of the table instead.
    """
    if max_rows is not None:
        df = sample_rows(df, max_rows)
    df = df.where(S.to_number(col(target), df.schema[target].dataType).isNotNull())
    numbers, categories = design_parts(df, target)
    design = dense(numbers, categories)
    if not design:
        return Diagnostics(error="No usable features after filtering.")
    m = select_features(parted_moments(df, numbers, categories, target) if categories else design_moments(df, design, target))
    coefficients, fit = least_squares(m, factor(df, design, target, m) if ill_conditioned(m) else None)
    return Diagnostics(coefficients, fit, inflation(m))


def ill_conditioned(m: Moments) -> bool:
    """Whether the correlations lose more digits than the columns themselves need to."""
    p = len(m.terms)
    return p > 1 and bool(np.linalg.eigvalsh(m.corr[:p, :p])[0] < ILL_CONDITIONED)


def factor(df: DataFrame, design: dict[str, Column], target: str, m: Moments) -> np.ndarray:
    """The triangular factor of 1, the kept columns and the target, in standard units."""
    y = S.to_number(col(target), df.schema[target].dataType)
    units = m.std * math.sqrt(max(m.n - 1, 1))
    columns = [*[design[t] for t in m.terms], y]
    return triangular_factor(df.where(y.isNotNull()), [(x - F.lit(float(c))) / F.lit(float(u) or 1.0) for x, c, u in zip(columns, m.mean, units, strict=True)])


def least_squares(m: Moments, r: np.ndarray | None = None) -> tuple[list[tuple], dict]:
    """Coefficients and fit from the moments, or from a triangular factor ``r``, which keeps the
    digits of nearly dependent columns. Exactly dependent ones get the shortest solution."""
    p, n = len(m.terms), m.n
    spread_y, shift = m.std[p], 0.0
    total = (n - 1) * spread_y**2
    if r is None:
        corr, to_y = m.corr[:p, :p], np.nan_to_num(m.corr[:p, p])
        inverse = _inverse(corr)
        rank = int(np.linalg.matrix_rank(corr, tol=SINGULAR * max(p, 1), hermitian=True)) if p else 0
        scaled = inverse @ to_y
        r2 = float(np.clip(scaled @ to_y, 0.0, 1.0))
    else:
        inner, to_y = r[1 : p + 1, 1 : p + 1], r[1 : p + 1, p + 1]
        back = np.linalg.pinv(inner, rcond=DEPENDENT)
        rank = int(np.linalg.matrix_rank(inner, tol=DEPENDENT * np.linalg.norm(inner, 2)))
        scaled, inverse = back @ to_y, back @ back.T
        missed, whole = inner @ scaled - to_y, to_y @ to_y + r[p + 1, p + 1] ** 2
        r2 = float(np.clip(1.0 - (missed @ missed + r[p + 1, p + 1] ** 2) / whole, 0.0, 1.0)) if whole else 0.0
        # what the means, taken in another pass, were off by
        shift = (r[0, p + 1] - r[0, 1 : p + 1] @ scaled) / r[0, 0] * spread_y * math.sqrt(max(n - 1, 1)) if r[0, 0] else 0.0
    slopes = scaled * spread_y / m.std[:p]
    intercept = m.mean[p] - slopes @ m.mean[:p] + shift
    rest = total * (1.0 - r2)
    free = n - rank - 1
    noise = rest / free if free > 0 else math.nan
    # (X'X)^-1 of the centred columns, in the units of the columns
    cov = inverse / np.outer(m.std[:p], m.std[:p]) / (n - 1)
    errors = np.sqrt(noise * np.diag(cov))
    first = math.sqrt(noise * (1.0 / n + m.mean[:p] @ cov @ m.mean[:p]))
    rows = []
    terms = [(INTERCEPT, intercept, first), *zip(m.terms, slopes, errors)]
    for place, (term, b, se) in enumerate(terms):
        t = float(b / se) if se and not math.isnan(se) else None
        p_value = None if t is None or free <= 0 else t_two_sided(t, free)
        rows.append((place, term, float(b), None if math.isnan(se) else float(se), t, p_value))
    fit = {"n_obs": n, "r2": r2}
    if free > 0 and rank and rest > 0:
        f = (r2 / rank) / ((1.0 - r2) / free)
        likelihood = -n / 2.0 * (math.log(2.0 * math.pi) + math.log(rest / n) + 1.0)
        fit |= {
            "r2_adj": 1.0 - (1.0 - r2) * (n - 1) / free,
            "f_statistic": f, "f_p_value": f_upper(f, rank, free),
            "log_likelihood": likelihood,
            "aic": 2.0 * (rank + 1) - 2.0 * likelihood,
            "bic": math.log(n) * (rank + 1) - 2.0 * likelihood,
        }
    return rows, fit


def _inverse(matrix: np.ndarray) -> np.ndarray:
    if matrix.size and np.linalg.eigvalsh(matrix)[0] > SINGULAR:
        return np.linalg.inv(matrix)
    return np.linalg.pinv(matrix, rcond=SINGULAR, hermitian=True)


def inflation(m: Moments) -> list[tuple[str, float]]:
    """VIF of each column on the others without a constant, largest first."""
    p = len(m.terms)
    if p < 2:
        return []
    mean, std = m.mean[:p], m.std[:p]
    gram = (m.n - 1) * m.corr[:p, :p] * np.outer(std, std) + m.n * np.outer(mean, mean)
    size = np.sqrt(np.diag(gram))
    unit = gram / np.outer(size, size)
    found = []
    for i, term in enumerate(m.terms):
        others = [j for j in range(p) if j != i]
        along = unit[others, i]
        left = 1.0 - along @ _inverse(unit[np.ix_(others, others)]) @ along
        found.append((term, float(1.0 / left) if left > SINGULAR else math.inf))
    return sorted(found, key=lambda item: -item[1])
