"""Pages deep in an ordered table, without ordering what lies before them.

A histogram of the order column and its prefix sums tell which values hold the page. The
range is narrowed, bin by bin and then by the next order column where one value holds more, until
at most ENOUGH rows are left; only these are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col

#: Bins of a histogram, and rows that are ordered at most where values tell them apart.
BINS, ENOUGH = 1024, 100_000


def _place(df: DataFrame, c: str) -> Column | None:
    """An order column as a number that orders alike, or null if there is none. Doubles only
    pick rows, so what rounding does to wide numbers is that a bin holds its neighbours too."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', {S.quoted(c)})").cast("double")
    if isinstance(kind, T.DateType):
        return F.datediff(col(c), F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col(c)).cast("double")
    return col(c).cast("double") if S.is_numeric(kind) and not isinstance(kind, T.DecimalType) else None


def _narrowed(rows: DataFrame, place: Column, falling: bool, need: int, limit: int) -> tuple[DataFrame, int, int, bool]:
    """The rows with a place in the page's range, the rows to skip there, how many there are, and
    whether one place is left."""
    while True:
        seen = rows.agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("n"), F.count(place).alias("known")).first()
        low, high, n = seen["low"], seen["high"], seen["n"]
        if n <= ENOUGH or seen["known"] < n or not float("-inf") < low <= high < float("inf") or low == high:
            return rows, need, n, low is not None and low == high and seen["known"] == n
        width = (high - low) / BINS
        bin_ = F.least(F.floor((place - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        counts = {r["bin"]: r["n"] for r in rows.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n")).collect()}
        before, first, last, skipped = 0, None, None, 0
        for b in sorted(counts, reverse=falling):
            if first is None and before + counts[b] > need:
                first, skipped = b, before
            before += counts[b]
            last = b
            if first is not None and before >= need + limit:
                break
        if first is None:
            return rows.filter("false"), 0, 0, False
        kept = sum(counts[b] for b in counts if min(first, last) <= b <= max(first, last))
        if kept == n:
            return rows, need, n, False
        rows, need = rows.filter(bin_.between(min(first, last), max(first, last))), need - skipped


def ordered_page(df: DataFrame, order: Sequence[tuple[str, bool]], limit: int, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of ``df`` ordered by (column, falling) pairs; nulls
    come last in falling and first in rising columns. ``df`` must give the same rows each time.

    Ends with all ties of one value if no further column tells them apart.
    """
    rows, need = df, offset
    for c, falling in order:
        place = _place(df, c)
        if place is None:
            break
        rows, need, n, single = _narrowed(rows, place, falling, need, limit)
        if n <= ENOUGH or not single:
            break
    return rows.orderBy(*[col(c).desc() if falling else col(c).asc() for c, falling in order]).offset(need).limit(limit)
