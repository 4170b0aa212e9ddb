"""Sources: CSV with type inference, parquet, and a saved analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col
from tabulyst.sources.positions import Reread, first_rows

# The spellings a CSV column of truth values may use.
TRUTH_WORDS = ("True", "TRUE", "true", "False", "FALSE", "false")


def read_parquet(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    again = spark.read.schema(df.schema).option("basePath", path)
    return _capped(S.nan_to_null(df), max_rows, lambda files: S.nan_to_null(again.parquet(*files)))


def read_csv(
    spark: SparkSession, path: str, max_rows: int | None = None, multiline: bool = False
) -> DataFrame:
    """A CSV with a header; types are inferred from the whole column.

    Every cell is read as text, missing-value spellings become null, and one
    aggregation finds the narrowest type each column fits. ``multiline`` is for
    quoted line breaks and makes a file unsplittable, so it is off by default.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    raw = reader.csv(path)
    again = reader.schema(raw.schema).option("basePath", path)
    # a cap comes before inference: the capped rows are the table
    text = _capped(null_tokens(raw), max_rows, lambda files: null_tokens(again.csv(files)))
    return S.nan_to_null(infer_types(text))


def _capped(df: DataFrame, max_rows: int | None, reread: Reread) -> DataFrame:
    """The whole table, or its first rows in file order."""
    return df if max_rows is None else first_rows(df, max_rows, reread)


def null_tokens(df: DataFrame) -> DataFrame:
    strings = [f.name for f in df.schema if S.is_text(f.dataType)]
    return df.withColumns({c: F.when(~col(c).isin(*S.NA_TOKENS), col(c)) for c in strings})


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns whose every value fits a number or a truth value."""
    strings = [f.name for f in df.schema if S.is_text(f.dataType)]
    if not strings:
        return df
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(strings):
        x = col(c)
        whole = F.when(x.rlike(S.INTEGER_PATTERN), F.trim(x).try_cast("bigint"))
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.count(whole).alias(f"long{i}"),
            F.count(S.to_number(x, T.StringType())).alias(f"double{i}"),
            F.count_if(x.isin(*TRUTH_WORDS)).alias(f"bool{i}"),
        ]
    seen = df.agg(*aggs).first()
    casts = {}
    for i, c in enumerate(strings):
        n, x = seen[f"n{i}"], col(c)
        if n == seen[f"long{i}"] and n:
            casts[c] = F.trim(x).try_cast("bigint")
        elif n == seen[f"double{i}"]:
            # a column without any value is numeric too
            casts[c] = F.trim(x).try_cast("double")
        elif n == seen[f"bool{i}"] and n == seen["rows"]:
            # truth values with gaps stay text
            casts[c] = x.try_cast("boolean")
    return df.withColumns(casts) if casts else df


def load_metadata(files: DataFrame) -> DataFrame:
    """(filename, loaded_rows, loaded_cols) of a table just read from files."""
    return files.groupBy(F.col("_metadata.file_name").alias("filename")).agg(
        F.count("*").alias("loaded_rows")
    ).withColumn("loaded_cols", F.lit(len(files.columns)))


def read_part(spark: SparkSession, folder: str, part: str, schema: T.StructType) -> DataFrame:
    """One part of a saved analysis."""
    return spark.read.schema(schema).json(f"{folder}/{part}")
