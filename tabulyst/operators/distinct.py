"""Exact distinct counts from one scan and one shuffle of bitmaps.

A whole number is a bit in a word of 64 neighbours; words merge by bitwise or before and after
the shuffle, so that a row that travels stands for up to 64 values, and never for less than
one. Numbers with two decimals count as hundredths, value by value: a double that its
hundredths give back exactly is told apart by these, any other by itself. Times and texts
are told apart as they are, long texts by digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col

#: Doubles up to here have exact hundredths.
EXACT = 2.0**46
_KEY = {"word": "long", "as_double": "double", "as_time": "timestamp_ntz", "as_text": "string"}


def is_whole(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _bit(number: Column) -> dict[str, Column]:
    """A whole number's word and its bit there."""
    return {"word": F.shiftright(number, 6), "bit": F.when(number.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int")))}


def _cell(df: DataFrame, c: str, digest: bool) -> dict[str, Column]:
    kind, x = df.schema[c].dataType, col(c)
    if is_whole(df, c):
        return _bit(x.cast("long"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        x = x.cast("double")
        hundredths = F.rint(x * 100)
        whole = (F.abs(x) < EXACT) & (hundredths / 100 == x)
        return {**_bit(F.when(whole, hundredths).cast("long")), "as_double": F.when(~whole | F.isnan(x), x)}
    if S.is_time(kind):
        return {"as_time": x.cast("timestamp_ntz")}
    return {"as_text": F.sha2(x, 256) if digest else x.cast("string")}


def distinct_facts(df: DataFrame, columns: Sequence[str], digests: Sequence[str] = ()) -> DataFrame:
    """(position, name, n_rows, n_missing, n_unique); nulls are no values.

    The shuffle key holds the word or value, so neither a column nor a value with most of the
    rows lands in one task.
    """
    columns, cells = list(columns), []
    for i, c in enumerate(columns):
        own = _cell(df, c, c in set(digests))
        cells += [F.lit(i), *[own.get(k, F.lit(None).cast(t)) for k, t in _KEY.items()], own.get("bit", F.lit(None).cast("long"))]
    long = df.select(F.stack(F.lit(len(columns)), *cells).alias("position", *_KEY, "bit"))
    words = long.groupBy("position", *_KEY).agg(F.count("*").alias("n"), F.bit_or("bit").alias("bits"))
    absent = F.coalesce(*[F.col(k).cast("string") for k in _KEY]).isNull()
    values = F.when(F.col("word").isNotNull(), F.bit_count("bits")).when(~absent, 1).otherwise(0)
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("position") + 1)
    return words.groupBy("position").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(absent, F.col("n")).otherwise(0)).alias("n_missing"),
        F.sum(values).cast("long").alias("n_unique"),
    ).select("position", name.alias("name"), "n_rows", "n_missing", "n_unique")
