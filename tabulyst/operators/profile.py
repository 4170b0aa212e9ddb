"""Per-column profile: missing rates, distinct counts, summaries, top values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.config import AnalysisConfig
from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col
from tabulyst.operators import roles as R
from tabulyst.operators.distinct import distinct_facts
from tabulyst.operators.heavy import proven_top
from tabulyst.operators.selection import exact_quantiles

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}
SUMMARY_FIELDS = ("mean", "std", "min", "p25", "median", "p75", "max")


def by_column(one_row: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn a one-row aggregate into a row per column.

    ``fields`` maps an output field to the prefix of its aggregates, which are
    named prefix + position.
    """
    records = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("name"),
            *[F.col(f"{prefix}{i}").alias(field) for field, prefix in fields.items()],
        )
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*records)))


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(position, name, missing_rate): one aggregation, no shuffle of rows."""
    columns = list(columns or df.columns)
    rates = df.agg(*[F.avg(S.missing(col(c))).alias(f"m{i}") for i, c in enumerate(columns)])
    return by_column(rates, columns, {"missing_rate": "m"})


def top_missing(df: DataFrame, k: int = AnalysisConfig.topk_cols) -> DataFrame:
    return missing_rates(df).orderBy(F.desc("missing_rate"), "name").limit(k)


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, name, variance) with n - 1."""
    columns = list(columns)
    spread = df.agg(
        *[F.var_samp(S.to_number(col(c), df.schema[c].dataType)).alias(f"s{i}")
          for i, c in enumerate(columns)]
    )
    return by_column(spread, columns, {"variance": "s"})


def top_variance(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The k columns that vary most; constant ones are left out."""
    kept = variances(df, columns).where(S.finite(F.col("variance")) > 0)
    return kept.orderBy(F.desc("variance"), "name").limit(k)


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, name, n, mean, std, min, p25, median, p75, max).

    The moments ride on the first quantile pass, so the table is read twice in all.
    """
    numbers = {c: S.to_number(col(c), df.schema[c].dataType) for c in columns}
    found = exact_quantiles(df, numbers, list(QUARTILES.values()), moments=True)
    rows = []
    for i, c in enumerate(numbers):
        m = found.moments[((), c)]
        quarters = [found.get(c, p) for p in QUARTILES.values()]
        rows.append((i, c, m["n"], m["mean"], m["std"], m["min"], *quarters, m["max"]))
    schema = "position int, name string, n long, " + ", ".join(f"{f} double" for f in SUMMARY_FIELDS)
    return df.sparkSession.createDataFrame(rows, schema)


def _slot(c: str, dtype: T.DataType, digest: bool) -> dict[str, Column]:
    x = col(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return {"as_long": x.cast("long")}
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return {"as_double": x.cast("double")}
    if S.is_time(dtype):
        return {"as_time": x.cast("timestamp_ntz")}
    # long texts are told apart by a 256-bit digest, so that it is not the texts that travel
    return {"as_text": F.sha2(x, 256) if digest else x.cast("string")}


_SLOTS = {"as_long": "long", "as_double": "double", "as_time": "timestamp_ntz", "as_text": "string"}


def value_counts(df: DataFrame, columns: Sequence[str], digests: Sequence[str] = ()) -> DataFrame:
    """(position, as_long, as_double, as_time, as_text, count) over all columns.

    One scan and one shuffle serve every column. The shuffle key holds the value,
    so a column or value with most of the rows merges before it travels and no
    task receives a whole column.
    """
    cells = []
    for i, c in enumerate(columns):
        own = _slot(c, df.schema[c].dataType, c in set(digests))
        cells += [F.lit(i), *[own.get(s, F.lit(None).cast(t)) for s, t in _SLOTS.items()]]
    long = df.select(F.stack(F.lit(len(columns)), *cells).alias("position", *_SLOTS))
    return long.groupBy("position", *_SLOTS).agg(F.count("*").alias("count"))


def _absent() -> Column:
    return F.coalesce(*[F.col(s).cast("string") for s in _SLOTS]).isNull()


def _named(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("position") + 1)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """(position, name, n_unique), nulls not counted; exact unless asked otherwise."""
    columns = list(columns)
    if approximate:
        found = df.agg(
            *[F.approx_count_distinct(col(c), 0.01).alias(f"d{i}") for i, c in enumerate(columns)]
        )
        return by_column(found, columns, {"n_unique": "d"})
    return distinct_facts(df, columns, _long_texts(df, columns)).select("position", "name", "n_unique")


def _long_texts(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if S.is_text(df.schema[c].dataType)]


def top_from_counts(counts: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The k most frequent values of each column; ties go by value."""
    shown = counts.select(
        "position",
        S.label(F.coalesce(*[F.col(s).cast("string") for s in ("as_text", "as_long", "as_double", "as_time")]))
        .alias("value"),
        "count",
    )
    # the rank filter also runs before this shuffle, so k rows per task and column move
    order = W.partitionBy("position").orderBy(F.desc("count"), "value")
    return (
        shown.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(_named(counts, columns).alias("name"), "rank", "value", "count")
    )


def top_values(
    df: DataFrame, columns: Sequence[str], k: int = AnalysisConfig.topk_categories,
    keep_missing: bool = True,
) -> DataFrame:
    """(name, rank, value, count); missing values count as a value unless left out."""
    columns = list(columns)
    proven, rest = proven_top(df, columns, k, keep_missing)
    rows = [(c, i + 1, v, n) for c, first in proven.items() for i, (v, n) in enumerate(first)]
    known = df.sparkSession.createDataFrame(rows, "name string, rank int, value string, count long")
    if not rest:
        return known
    counts = value_counts(df, rest)
    if not keep_missing:
        counts = counts.where(~_absent())
    return known.unionByName(top_from_counts(counts, rest, k))


def dataset_profile(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols, memory_mb) from one aggregation."""
    used = [F.coalesce(F.sum(_bytes(col(f.name), f.dataType)), F.lit(0)) for f in df.schema]
    return df.agg(
        F.count("*").alias("n_rows"),
        (sum(used, F.lit(0)) / F.lit(1024.0 * 1024.0)).alias("memory_mb"),
    ).select("n_rows", F.lit(len(df.columns)).alias("n_cols"), "memory_mb")


def _sketched_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    seen = df.agg(
        F.count("*").alias("rows"),
        *[agg.alias(f"{n}{i}") for i, c in enumerate(columns)
          for n, agg in (("m", F.count_if(col(c).isNull())), ("d", F.approx_count_distinct(col(c), 0.01)))],
    )
    seen = seen.withColumns({f"rows{i}": F.col("rows") for i in range(len(columns))})
    return by_column(seen, columns, {"n_rows": "rows", "n_missing": "m", "n_unique": "d"})


def column_profile(
    df: DataFrame, roles: dict[str, str], cfg: AnalysisConfig = AnalysisConfig()
) -> DataFrame:
    """One row per column, as the analysis document lists them."""
    columns = [c for c in df.columns if roles.get(c) != R.UNSUPPORTED]
    texts = [c for c in columns if roles.get(c) == R.TEXT and S.is_text(df.schema[c].dataType)]
    categories = [c for c in columns if roles.get(c) == R.CATEGORICAL]
    numbers = [c for c in columns if roles.get(c) == R.NUMERIC]
    if cfg.approximate_distinct:
        base = _sketched_counts(df, columns)
    else:
        base = distinct_facts(df, columns, texts)
    dtypes = dict(df.dtypes)
    facts = F.element_at(
        F.array(*[
            F.struct(F.lit(roles.get(c, "unknown")).alias("role"), F.lit(dtypes[c]).alias("dtype"))
            for c in columns
        ]),
        F.col("position") + 1,
    )
    # read again, but only the categorical columns: ranking the values of every
    # numeric column to save this scan would cost a sort of all of them
    tops = categories and (
        top_values(df, categories, cfg.topk_categories)
        .groupBy("name")
        .agg(
            # at most topk_categories entries per column
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "value", "count"))),
                lambda v: F.struct(v["value"].alias("value"), v["count"].alias("count")),
            ).alias("top_values")
        )
    )
    summary = None
    if numbers:
        summary = numeric_summary(df, numbers).select(
            "name", F.struct(*SUMMARY_FIELDS).alias("summary")
        )
    if categories:
        out = base.join(tops, "name", "left")
    else:
        none = F.lit(None).cast("array<struct<value:string,count:bigint>>")
        out = base.withColumn("top_values", none)
    if summary is None:
        empty = ",".join(f"{f}:double" for f in SUMMARY_FIELDS)
        out = out.withColumn("summary", F.lit(None).cast(f"struct<{empty}>"))
    else:
        out = out.join(summary, "name", "left")
    return out.select(
        "position", "name", facts["role"].alias("role"), facts["dtype"].alias("dtype"),
        F.try_divide(F.col("n_missing"), F.col("n_rows")).alias("missing_rate"),
        "n_unique", "summary", "top_values",
    )


def footprint(df: DataFrame) -> DataFrame:
    """(position, name, bytes): the data bytes of each column's values."""
    aggs = [F.sum(_bytes(col(f.name), f.dataType)).cast("long").alias(f"b{i}")
            for i, f in enumerate(df.schema)]
    return by_column(df.agg(*aggs), df.columns, {"bytes": "b"})


def _bytes(x: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.octet_length(x)
    if isinstance(dtype, T.ArrayType):
        inner = _width(dtype.elementType)
        if inner is None:
            return F.octet_length(F.to_json(x))
        return F.size(x) * F.lit(inner)
    width = _width(dtype)
    if width is None:
        return F.octet_length(F.to_json(x))
    return F.when(x.isNotNull(), F.lit(width))


def _width(dtype: T.DataType) -> int | None:
    # Bytes per value of the fixed-width types.
    widths = {
        T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
        T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
        T.DecimalType: 16,
    }
    return widths.get(type(dtype))

