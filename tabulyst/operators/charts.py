"""The data behind the charts: histograms, correlations, category bars."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulyst.config import AnalysisConfig
from tabulyst.functions import names
from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col
from tabulyst.operators import profile as P
from tabulyst.operators import roles as R
from tabulyst.operators.gram import masked_correlations
from tabulyst.operators.selection import distinct_up_to

# Bins of a histogram, the share of values a correlated column needs.
BINS = 40
FILLED_SHARE = 0.95
# Above this many columns the pairs are computed as one matrix product.
PAIRWISE_COLUMNS = 16


def _number(df: DataFrame, name: str) -> Column:
    return S.to_number(col(name), df.schema[name].dataType)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(name, bin, low, high, count): equal-width bins over each column's range.

    One aggregation finds the ranges, one counts the bins of every column. Empty
    bins are listed with count 0, the last bin includes the maximum.
    """
    columns = list(columns)
    numbers = [_number(df, c) for c in columns]
    ends = df.agg(
        *[agg.alias(f"{n}{i}") for i, x in enumerate(numbers)
          for n, agg in (("lo", F.min(x)), ("hi", F.max(x)))]
    ).first()
    items, frames = [], []
    for i, (c, x) in enumerate(zip(columns, numbers)):
        low, high = ends[f"lo{i}"], ends[f"hi{i}"]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        width = (high - low) / bins
        place = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        items.append(F.struct(F.lit(c).alias("name"), place.alias("bin")))
        frames += [(c, b, low + b * width, low + (b + 1) * width, 0) for b in range(bins)]
    schema = "name string, bin int, low double, high double, count long"
    empty = df.sparkSession.createDataFrame(frames, schema)
    if not items:
        return empty
    seen = (
        df.select(F.inline(F.array(*items))).where(F.col("bin").isNotNull())
        .groupBy("name", "bin").agg(F.count("*").alias("seen"))
    )
    # both sides hold bins x columns rows at most
    return empty.join(seen, ["name", "bin"], "left").select(
        "name", "bin", "low", "high", F.coalesce("seen", "count").alias("count")
    )


def histogram_columns(df: DataFrame, roles: dict[str, str], k: int) -> list[str]:
    numbers = R.with_role(roles, R.NUMERIC, df)
    if not numbers:
        return []
    ordered = P.variances(df, numbers).orderBy(F.desc_nulls_last("variance"), "name").limit(k)
    return [r["name"] for r in ordered.collect()]


def correlation_columns(
    df: DataFrame, roles: dict[str, str], k: int = AnalysisConfig.corr_max_features
) -> list[str]:
    """Numeric columns worth correlating: well filled, no codes, most variance."""
    candidates = [
        c for c in R.with_role(roles, R.NUMERIC, df)
        if not names.is_coordinate_name(c) and not names.is_code_like(c)
    ]
    if len(candidates) < 2:
        return []
    seen = df.agg(
        F.count("*").alias("rows"),
        *[agg.alias(f"{n}{i}") for i, c in enumerate(candidates)
          for n, agg in (("n", F.count(_number(df, c))), ("s", F.var_samp(_number(df, c))))],
    ).first()
    spread = {
        c: seen[f"s{i}"] for i, c in enumerate(candidates)
        if seen["rows"] and seen[f"n{i}"] / seen["rows"] >= FILLED_SHARE
        and seen[f"s{i}"] is not None and 0 < seen[f"s{i}"] < float("inf")
    }
    return sorted(spread, key=lambda c: (-spread[c], c))[:k]


def pair_correlations(
    df: DataFrame, columns: Sequence[str], target: str | None = None
) -> DataFrame:
    """(i, j, x, y, n, r) for column pairs i < j, Pearson over complete pairs.

    With a ``target`` only its pairs are computed. One pass finds counts and
    means, the next sums the products of the distances from the means: plain
    sums, which Spark compiles, where a covariance aggregate per pair is not. A
    constant column gives a null, not an error. Wide tables use matrix products, with
    masks where columns have gaps.
    """
    columns = list(columns)
    numbers = [_number(df, c) for c in columns]
    pairs = [
        (i, j) for i, j in combinations(range(len(columns)), 2)
        if target is None or target in (columns[i], columns[j])
    ]
    seen = df.agg(
        F.count("*").alias("rows"),
        *[agg.alias(f"{n}{i}") for i, x in enumerate(numbers)
          for n, agg in (("n", F.count(x)), ("m", F.avg(x)), ("lo", F.min(x)), ("hi", F.max(x)))],
    ).first()
    full = [seen[f"n{i}"] == seen["rows"] for i in range(len(columns))]
    varies = [seen[f"n{i}"] > 1 and seen[f"lo{i}"] < seen[f"hi{i}"] for i in range(len(columns))]
    if target is None and len(columns) > PAIRWISE_COLUMNS:
        if all(full) and seen["rows"] > 1:
            return _matrix_correlations(df, columns, numbers, seen["rows"])
        return masked_correlations(df, columns, numbers, [seen[f"m{i}"] for i in range(len(columns))], varies)
    off = [x - F.lit(seen[f"m{i}"]) for i, x in enumerate(numbers)]
    aggs = [F.sum(off[i] * off[i]).alias(f"s{i}") for i in range(len(columns)) if varies[i]]
    records = []
    for i, j in pairs:
        n, r = F.lit(seen["rows"]), F.lit(None).cast("double")
        whole = full[i] and full[j]
        both = numbers[i].isNotNull() & numbers[j].isNotNull()
        if not whole:
            aggs.append(F.count_if(both).alias(f"n{i}_{j}"))
            n = F.col(f"n{i}_{j}")
        if varies[i] and varies[j]:
            aggs.append(F.sum(off[i] * off[j]).alias(f"p{i}_{j}"))
            product, sx, sy = F.col(f"p{i}_{j}"), F.col(f"s{i}"), F.col(f"s{j}")
            if not whole:
                # the rows of this pair have means of their own
                for name, k in (("x", i), ("y", j)):
                    part = F.when(both, off[k])
                    aggs += [F.sum(part).alias(f"{name}{i}_{j}"), F.sum(part * part).alias(f"{name * 2}{i}_{j}")]
                dx, dy = F.col(f"x{i}_{j}"), F.col(f"y{i}_{j}")
                product = product - F.try_divide(dx * dy, n)
                sx = F.col(f"xx{i}_{j}") - F.try_divide(dx * dx, n)
                sy = F.col(f"yy{i}_{j}") - F.try_divide(dy * dy, n)
            r = F.try_divide(product, F.sqrt(sx) * F.sqrt(sy))
            r = F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))
        records.append(F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"),
            F.lit(columns[i]).alias("x"), F.lit(columns[j]).alias("y"),
            n.cast("long").alias("n"), r.alias("r"),
        ))
    sums = df.agg(*aggs) if aggs else df.agg(F.count("*"))
    return sums.select(F.inline(F.array(*records)))


def _matrix_correlations(df, columns, numbers, rows) -> DataFrame:
    """The same from one matrix of columns x columns, for wide tables."""
    vectors = df.select(array_to_vector(F.array(*numbers)).alias("v"))
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    found = []
    for i, j in combinations(range(len(columns)), 2):
        r = float(matrix[i, j])
        found.append((i, j, columns[i], columns[j], rows, None if r != r else r))
    return df.sparkSession.createDataFrame(
        found, "i int, j int, x string, y string, n long, r double"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The whole matrix in long form: both triangles and the diagonal."""
    pairs = pair_correlations(df, columns).select("x", "y", "r")
    mirrored = pairs.select(
        F.inline(F.array(F.struct("x", "y", "r"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "r")))
    )
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "x string, y string, r double")
    return mirrored.unionByName(diagonal)


def lowest_cardinality(df: DataFrame, columns: Sequence[str], k: int, bound: int = 1000) -> list[str]:
    """The k columns with fewest values, ties in column order."""
    columns = list(columns)
    counts = distinct_up_to(df, columns, bound)
    if sum(v is not None for v in counts.values()) < min(k, len(columns)):
        exact = P.distinct_counts(df, [c for c in columns if counts[c] is None]).collect()
        counts.update({r["name"]: r["n_unique"] for r in exact})
    known = [c for c in columns if counts[c] is not None]
    return sorted(known, key=lambda c: (counts[c], columns.index(c)))[:k]


def category_bars(
    df: DataFrame, roles: dict[str, str], cfg: AnalysisConfig = AnalysisConfig()
) -> DataFrame:
    """Top values of the categorical columns with fewest values."""
    candidates = [c for c in R.with_role(roles, R.CATEGORICAL, df) if not names.is_code_like(c)]
    picked = lowest_cardinality(df, candidates, cfg.max_cat_plots) if candidates else []
    if not picked:
        return df.sparkSession.createDataFrame([], "name string, rank int, value string, count long")
    return P.top_values(df, picked, cfg.topk_categories, keep_missing=False)
