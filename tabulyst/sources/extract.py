"""Bounded extracts of a large table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.functions.scalars import col
from tabulyst.sources.pages import ordered_page
from tabulyst.sources.positions import first_rows

#: Rows up to which a page is cheaper to order than to look for: each task keeps so many.
SHALLOW = 5_000


def year_rows(df: DataFrame, time_column: str, year: int) -> DataFrame:
    """Rows of one year; a half-open range that the scan can use to skip files."""
    ts = col(time_column)
    start, stop = (F.lit(datetime(y, 1, 1)).cast("timestamp_ntz") for y in (year, year + 1))
    return df.where((ts >= start) & (ts < stop))


def newest_page(
    df: DataFrame, time_column: str, tie_break: Sequence[str], limit: int, offset: int = 0,
    year: int | None = None,
) -> DataFrame:
    """A page of the table, newest first, optionally of one year. A deep page costs no more
    than one near the front."""
    rows = df if year is None else year_rows(df, time_column, year)
    order = [(time_column, True), *[(c, False) for c in tie_break]]
    if offset + limit <= SHALLOW:
        return rows.orderBy(*[col(c).desc() if falling else col(c) for c, falling in order]).offset(offset).limit(limit)
    return ordered_page(rows, order, limit, offset)


def first_n(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The first n rows that are not blank, by key when an order is given, else in file order."""
    filled = df.where(F.coalesce(*[col(c).cast("string") for c in df.columns]).isNotNull())
    return filled.orderBy(*[col(c) for c in order]).limit(n) if order else first_rows(filled, n)
