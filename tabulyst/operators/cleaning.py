"""Cleaning: duplicates, sparse columns, casts, gaps, and the log of it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.config import AnalysisConfig
from tabulyst.functions import names
from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col
from tabulyst.operators import roles as R
from tabulyst.operators.copies import COPIES, counted_rows, distinct_rows, row_counts
from tabulyst.operators.dates import learn_formats, read_times
from tabulyst.operators.selection import exact_quantiles

# The label of a filled category and the words of the log.
FILL_LABEL = "Missing"
FILL_CATEGORY, FILL_MEDIAN = "missing_category", "median"

LOG_SCHEMA = T.StructType([
    T.StructField("dropped_duplicates", T.LongType()),
    T.StructField("dropped_columns", T.ArrayType(
        T.StructType([T.StructField("name", T.StringType()), T.StructField("reason", T.StringType())]))),
    T.StructField("imputations", T.ArrayType(T.StructType([
        T.StructField("column", T.StringType()), T.StructField("method", T.StringType()),
        T.StructField("value", T.StringType())]))),
    T.StructField("type_conversions", T.ArrayType(
        T.StructType([T.StructField("column", T.StringType()), T.StructField("to", T.StringType())]))),
    T.StructField("added_features", T.ArrayType(T.StringType())),
])


@dataclass
class CleaningLog:
    dropped_duplicates: int = 0
    dropped_columns: list[tuple[str, str]] = field(default_factory=list)
    imputations: list[tuple[str, str, str]] = field(default_factory=list)
    type_conversions: list[tuple[str, str]] = field(default_factory=list)
    added_features: list[str] = field(default_factory=list)

    def frame(self, spark) -> DataFrame:
        row = (self.dropped_duplicates, self.dropped_columns, self.imputations,
               self.type_conversions, self.added_features)
        return spark.createDataFrame([row], LOG_SCHEMA)

    def entries(self, spark) -> DataFrame:
        """The log as (step, column, detail, value) rows."""
        rows = [("duplicates", None, "dropped", str(self.dropped_duplicates))]
        rows += [("dropped_column", c, reason, None) for c, reason in self.dropped_columns]
        rows += [("conversion", c, to, None) for c, to in self.type_conversions]
        rows += [("imputation", c, method, value) for c, method, value in self.imputations]
        rows += [("feature", c, None, None) for c in self.added_features]
        return spark.createDataFrame(rows, "step string, column string, detail string, value string")


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication; only rows that may have copies are shuffled."""
    return distinct_rows(df)


def duplicate_count(df: DataFrame) -> DataFrame:
    """(n_rows, n_distinct, dropped_duplicates)."""
    return row_counts(df).withColumn("dropped_duplicates", F.col("n_rows") - F.col("n_distinct"))


def missing_counts(df: DataFrame, *more: Column) -> tuple[Row, dict[str, int]]:
    """Missing values per column, and a row of ``rows`` and further aggregates."""
    row = df.agg(
        F.count("*").alias("rows"), *more,
        *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    ).first()
    return row, {c: row["rows"] - row[f"n{i}"] for i, c in enumerate(df.columns)}


def sparse_columns(df: DataFrame, threshold: float) -> list[str]:
    seen, gaps = missing_counts(df)
    rows = seen["rows"]
    return [c for c, n in gaps.items() if rows and n / rows >= threshold]


def drop_sparse(
    df: DataFrame, threshold: float = AnalysisConfig.missing_drop_threshold
) -> DataFrame:
    return _without(df, sparse_columns(df, threshold))


def _without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    gone = set(columns)
    return df.select(*[col(c) for c in df.columns if c not in gone])


def conversions(df: DataFrame, roles: dict[str, str]) -> dict[str, tuple[str, Column]]:
    """Casts that bring text columns to their role: column -> (kind, expression)."""
    out = {}
    formats = learn_formats(df, [f.name for f in df.schema if roles.get(f.name) == R.DATETIME and S.is_text(f.dataType)])
    for f in df.schema:
        role = roles.get(f.name)
        if role == R.DATETIME and not S.is_time(f.dataType):
            out[f.name] = ("datetime", read_times(col(f.name), f.dataType, formats.get(f.name, {})))
        elif role == R.NUMERIC and not S.is_numeric(f.dataType):
            out[f.name] = ("numeric", S.to_number(col(f.name), f.dataType))
    return out


def cast_to_roles(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    casts = {c: expr for c, (_, expr) in conversions(df, roles).items()}
    return df.withColumns(casts) if casts else df


def fills_with_label(name: str, role: str | None) -> bool:
    return names.is_code_like(name) or role in (R.CATEGORICAL, R.TEXT)


def fill_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gaps become a category of their own; codes turn into text."""
    return df.withColumns(
        {c: F.coalesce(col(c).cast("string"), F.lit(FILL_LABEL)) for c in columns}
    )


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians, 0.0 for a column without values."""
    found = exact_quantiles(
        df, {c: S.to_number(col(c), df.schema[c].dataType) for c in columns}, [0.5]
    )
    return {c: v if (v := found.get(c, 0.5)) is not None else 0.0 for c in columns}


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill_values(df, medians(df, columns))


def fill_values(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(S.to_number(col(c), df.schema[c].dataType), F.lit(v))
        for c, v in values.items()
    })


def clean(
    df: DataFrame, roles: dict[str, str], cfg: AnalysisConfig = AnalysisConfig(),
    staged: bool = True,
) -> tuple[DataFrame, dict[str, str], CleaningLog]:
    """The cleaned table, the roles left, and the log.

    The de-duplicated table is written once (``staged``): it is scanned by the
    counts, the medians and all that follows.
    """
    counted = counted_rows(df, staged)
    unique = counted.drop(COPIES)
    casts = conversions(unique, roles)
    cast = unique.withColumns({c: expr for c, (_, expr) in casts.items()}) if casts else unique
    # gaps before the casts decide which columns go, gaps after them what is filled
    seen, gaps = missing_counts(
        counted.select(*[col(c) for c in counted.columns],
                       *[expr.alias(f"{c} as {kind}") for c, (kind, expr) in casts.items()]),
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("before"),
    )
    rows = seen["rows"]
    log = CleaningLog(dropped_duplicates=seen["before"] - rows)
    limit = cfg.missing_drop_threshold
    sparse = [c for c in unique.columns if rows and gaps[c] / rows >= limit]
    log.dropped_columns = [(c, f"missing_rate>={limit}") for c in sparse]
    kept = _without(cast, sparse)
    roles = {c: r for c, r in roles.items() if c not in set(sparse)}
    log.type_conversions = [(c, kind) for c, (kind, _) in casts.items() if c not in set(sparse)]

    labelled, numeric = [], []
    for f in kept.schema:
        kind = casts.get(f.name, (None,))[0]
        if not gaps[f"{f.name} as {kind}" if kind else f.name]:
            continue
        role = roles.get(f.name)
        if role == R.UNSUPPORTED:
            continue
        if fills_with_label(f.name, role):
            labelled.append(f.name)
        elif role == R.NUMERIC or S.is_numeric(f.dataType):
            numeric.append(f.name)
    fills = medians(kept, numeric) if numeric else {}
    out = fill_values(fill_category(kept, labelled), fills)
    log.imputations = [
        (c, FILL_CATEGORY, FILL_LABEL) if c in set(labelled) else (c, FILL_MEDIAN, str(fills[c]))
        for c in kept.columns if c in set(labelled) or c in fills
    ]
    return out, roles, log
