"""The most frequent values of columns, without a shuffle row for each distinct value.

1. One pass keeps a mergeable heavy-hitter summary of each column (``approx_top_k``). Where
   its counts add up to all rows it has dropped nothing and is exact.
2. Else the values that can still be among the first are candidates, and a second pass counts
   these exactly. A value that the summary left out has a bounded share of the rows, and at
   most what the candidates leave; if the last rank wanted has more, the ranks are proven.
3. Columns without proof: if all values differ, as the bitmaps of ``distinct`` tell, the
   first are the smallest; the rest are left to a count of every value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions.scalars import MISSING_LABEL, col, is_text
from tabulyst.operators.distinct import distinct_facts

#: Values that a summary tracks, and that are asked of it.
TRACKED, ASKED = 10_000, 256
Counts = dict[str | None, int]


def overstated(tracked: int) -> float:
    """The share of all rows by which a summary overstates a count at most; values that it
    leaves out have at most twice that. It has a power of two of places, three quarters used."""
    return 3.5 / (1 << (-(-4 * tracked // 3) - 1).bit_length())


def shown(df: DataFrame, c: str) -> Column:
    """A column's values as texts; equal values have one text."""
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return (col(c).cast("double") + F.lit(0.0)).cast("string")
    return col(c).cast("string")


def _ranked(found: Counts, k: int) -> list[tuple[str, int]]:
    """The first ``k`` labels with their counts; ties go by label."""
    rows = [(MISSING_LABEL if v is None else v, n) for v, n in found.items()]
    return sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:k]


def _candidates(items: list[tuple[str | None, int]], over: float, k: int, asked: int) -> set | None:
    """The values that may be among the first ``k``, from counts in falling order that are at
    most ``over`` too large; null if there may be more than were asked for."""
    last = items[k - 1][1] - over if len(items) >= k else 0
    some = {v for v, n in items if n >= last}
    return some if len(items) < asked or len(some) < len(items) else None


def _recounted(df: DataFrame, wanted: dict[str, set]) -> dict[str, Counts]:
    """Exact counts of the wanted texts of each column, from one pass."""
    columns = list(wanted)
    rows = [(i, v) for i, c in enumerate(columns) for v in sorted(wanted[c] - {None})]
    # as many rows as were asked of the summaries, at most
    sought = F.broadcast(df.sparkSession.createDataFrame(rows, "position int, value string"))
    cells = [x for i, c in enumerate(columns) for x in (F.lit(i), shown(df, c))]
    stacked = df.select(F.stack(F.lit(len(columns)), *cells).alias("position", "value"))
    found: dict[str, Counts] = {c: {} for c in columns}
    for r in stacked.join(sought, ["position", "value"]).groupBy("position", "value").agg(F.count("*").alias("n")).collect():
        found[columns[r["position"]]][r["value"]] = r["n"]
    return found


def proven_top(
    df: DataFrame, columns: Sequence[str], k: int, keep_missing: bool, tracked: int = TRACKED, asked: int = ASKED,
) -> tuple[dict[str, list[tuple[str, int]]], list[str]]:
    """The first ``k`` (label, count) of the columns where they are proven, and the other
    columns. Missing values count as one, or not at all."""
    columns, asked = list(columns), max(asked, 4 * k)
    tracked = max(tracked, asked)
    views = df.select(*[shown(df, c).alias(f"x{i}") for i, c in enumerate(columns)])
    seen = views.agg(F.count("*").alias("rows"), *[
        agg for i in range(len(columns))
        for agg in (F.count(f"x{i}").alias(f"n{i}"), F.expr(f"approx_top_k(x{i}, {asked}, {tracked})").alias(f"t{i}"))
    ]).first()
    rows, done, wanted = seen["rows"], {}, {}
    over = overstated(tracked) * rows
    gaps = {c: rows - seen[f"n{i}"] for i, c in enumerate(columns)}

    def own(found: Counts, c: str) -> Counts:
        """With the missing values as they are wanted."""
        known = {v: n for v, n in found.items() if v is not None}
        return {**known, None: gaps[c]} if keep_missing and gaps[c] else known

    for i, c in enumerate(columns):
        items = [(r["item"], r["count"]) for r in seen[f"t{i}"] or []]
        if len(items) < asked and sum(n for _, n in items) == rows:
            done[c] = _ranked(own(dict(items), c), k)
        elif (some := _candidates(items, over, k + 1, asked)):
            wanted[c] = some
    if wanted:
        for c, found in _recounted(df, wanted).items():
            left = min(2 * over, rows - gaps[c] - sum(found.values()))
            first = _ranked(own(found, c), k)
            if left <= 0 or (len(first) == k and first[-1][1] > left):
                done[c] = first
    open_ = [c for c in columns if c not in done]
    if open_:
        texts = [c for c in open_ if is_text(df.schema[c].dataType)]
        facts = {r["name"]: r for r in distinct_facts(df, open_, texts).collect()}
        for c in open_:
            if facts[c]["n_unique"] == rows - gaps[c]:
                first = df.filter(col(c).isNotNull()).select(shown(df, c).alias("value")).orderBy("value").limit(k).collect()
                done[c] = _ranked(own({r["value"]: 1 for r in first}, c), k)
    return done, [c for c in columns if c not in done]
