"""Exact quantiles and bounded distinct counts that hold at any size.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, and
a window over a group sends it to one task; both break when a key holds a third
of the rows. Here a sketch of fixed size brackets each wanted rank, the bracket
is narrowed until few values are left in it, and only those are ordered. No
pass shuffles more than sketches or value counts, and the answer is exact: the
last pass counts every row below the bracket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions.scalars import col

GRID = 1000
ACCURACY = 10000
ORDERED_ROWS = 1_000_000
MAX_GROUPS = 64
HLL_ERROR = 0.03

# one literal that folds to an array; a thousand literals would slow the planner
_GRID_POINTS = ",".join(str(i / GRID) for i in range(GRID + 1))

_MOMENTS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


@dataclass
class _Bracket:
    """Where one wanted quantile of one group lies."""

    rank_low: int
    rank_high: int
    low: float
    high: float
    # upper estimate of the rows strictly between low and high
    between: float
    # how far the wanted quantile lies between the two ranks
    share: float
    value: float | None = None


@dataclass
class Quantiles:
    """Quantiles by (group key tuple, column, probability), moments by (key, column)."""

    values: dict[tuple, float | None] = field(default_factory=dict)
    moments: dict[tuple, dict] = field(default_factory=dict)

    def get(self, column: str, prob: float, key: tuple = ()) -> float | None:
        return self.values.get((key, column, prob))


def _sketch(c: Column) -> Column:
    grid = F.split(F.lit(_GRID_POINTS), ",").cast("array<double>")
    return F.percentile_approx(c, grid, ACCURACY)


def _narrow(grid: Sequence[float], rank_low: int, rank_high: int, n: int, slack: int):
    """Grid values that enclose both ranks, and how many rows may lie between."""
    step = max(n - 1, 1) / GRID
    first = math.floor(rank_low / step) - slack
    last = math.ceil(rank_high / step) + slack
    low = grid[first] if first > 0 else grid[0]
    high = grid[last] if last < GRID else grid[GRID]
    between = 0.0 if low == high else (last - first) * step + 4.0 * n / ACCURACY
    return low, high, between


def exact_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    ordered_rows: int = ORDERED_ROWS,
    slack: int = 3,
    moments: bool = False,
) -> Quantiles:
    """Linearly interpolated quantiles of numeric expressions, per group.

    The number of groups must be bounded by the caller (a top-k, the classes of
    a model); more than ``MAX_GROUPS`` is refused. Rows are never dropped.
    """
    if not columns or not probs:
        return Quantiles()
    named = {f"v{i}": name for i, name in enumerate(columns)}
    base = df.select(
        *[col(k).alias(f"k{i}") for i, k in enumerate(keys)],
        *[columns[name].cast("double").alias(v) for v, name in named.items()],
    )
    key_cols = [f"k{i}" for i in range(len(keys))]
    found = Quantiles()
    brackets: dict[tuple, _Bracket] = {}

    first = (
        base.groupBy(*key_cols)
        .agg(
            *[F.count(v).alias(f"n_{v}") for v in named],
            *[_sketch(F.col(v)).alias(f"g_{v}") for v in named],
            *[fn(v).alias(f"{m}_{v}") for m, fn in (_MOMENTS if moments else {}).items() for v in named],
        )
        .take(MAX_GROUPS + 1)
    )
    if len(first) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups: choose the groups first")
    for row in first:
        key = tuple(row[k] for k in key_cols)
        for v, name in named.items():
            n = row[f"n_{v}"]
            found.moments[(key, name)] = {"n": n} | {
                m: row[f"{m}_{v}"] for m in (_MOMENTS if moments else {})
            }
            for prob in probs:
                if n == 0:
                    found.values[(key, name, prob)] = None
                    continue
                rank = prob * (n - 1)
                low_rank, high_rank = math.floor(rank), math.ceil(rank)
                low, high, between = _narrow(row[f"g_{v}"], low_rank, high_rank, n, slack)
                brackets[(key, v, prob)] = _Bracket(
                    low_rank, high_rank, low, high, between, rank - low_rank
                )

    while any(b.between > ordered_rows for b in brackets.values()):
        _refine(base, key_cols, brackets, slack, ordered_rows)

    failed = _order(base, key_cols, brackets) if brackets else []
    for (key, v, prob), b in brackets.items():
        if b.value is not None:
            found.values[(key, named[v], prob)] = b.value
    if failed:
        # a sketch missed its error bound: start again with wider brackets
        if slack >= GRID // 4:
            raise RuntimeError(f"no exact quantile found for {failed}")
        wider = exact_quantiles(df, columns, probs, keys, ordered_rows, min(slack * 8, GRID // 4))
        found.values.update(wider.values)
    return found


def _long(base: DataFrame, key_cols: list[str], columns: list[str]) -> DataFrame:
    """(keys, place, x): what follows is one small expression for any number of columns."""
    cells = [cell for place, v in enumerate(columns) for cell in (F.lit(place), F.col(v))]
    long = base.select(*key_cols, F.stack(F.lit(len(columns)), *cells).alias("place", "x"))
    return long.where(F.col("x").isNotNull())


def _on(key_cols: list[str]) -> list[Column]:
    on = [F.col(k).eqNullSafe(F.col(f"b_{k}")) for k in key_cols]
    return [*on, F.col("place") == F.col("b_place")]


def _refine(base, key_cols, ids, slack, ordered_rows) -> None:
    """Sketch only the rows inside each bracket and tighten it."""
    columns = list(dict.fromkeys(v for _, v, _ in ids))
    probs = sorted({prob for _, _, prob in ids})
    side = F.broadcast(_bracket_table(base, key_cols, ids, columns, probs, ascending=False))
    x, aggs = F.col("x"), []
    for k in range(len(probs)):
        low, high = F.col(f"low{k}"), F.col(f"high{k}")
        inside = (x > low) & (x < high)
        aggs += [
            F.count_if(x < low).alias(f"below{k}"), F.count_if(x == low).alias(f"at{k}"),
            F.count_if(inside).alias(f"in{k}"), _sketch(F.when(inside, x)).alias(f"g{k}"),
        ]
    seen = _long(base, key_cols, columns).join(side, _on(key_cols)).groupBy(*key_cols, "place").agg(*aggs)
    for row in seen.collect():
        key, v = tuple(row[k] for k in key_cols), columns[row["place"]]
        for s, prob in enumerate(probs):
            b = ids.get((key, v, prob))
            if b is None or b.between <= ordered_rows:
                continue
            n, start = row[f"in{s}"], row[f"below{s}"] + row[f"at{s}"]
            low_rank, high_rank = b.rank_low - start, b.rank_high - start
            if high_rank < 0:
                b.high, b.between = b.low, 0.0
            elif low_rank >= n:
                b.low, b.between = b.high, 0.0
            elif n == 0:
                # one rank at each end, nothing between
                b.between = 0.0
            else:
                first, last = max(low_rank, 0), min(high_rank, n - 1)
                low, high, b.between = _narrow(row[f"g{s}"], first, last, n, slack)
                b.low = low if low_rank >= 0 else b.low
                b.high = high if high_rank < n else b.high


def _order(base, key_cols, ids) -> list[tuple]:
    """Count the rows outside the brackets, order the values inside, pick the ranks."""
    columns = list(dict.fromkeys(v for _, v, _ in ids))
    probs = sorted({prob for _, _, prob in ids})
    side = F.broadcast(_bracket_table(base, key_cols, ids, columns, probs))
    x = F.col("x")
    band = F.when(x >= F.col(f"low{len(probs) - 1}"), F.struct(x.alias("x"), F.lit(0).alias("gap")))
    for k in reversed(range(len(probs) - 1)):
        # rows between two brackets all stand at the end of the lower one, after its
        # values, and so merge into one row before the shuffle
        end = F.col(f"high{k}")
        band = band.when(x > end, F.struct(end.alias("x"), F.lit(1).alias("gap")))
        band = band.when(x >= F.col(f"low{k}"), F.struct(x.alias("x"), F.lit(0).alias("gap")))
    band = band.otherwise(F.struct(F.lit(float("-inf")).alias("x"), F.lit(1).alias("gap")))
    counted = (
        _long(base, key_cols, columns).join(side, _on(key_cols))
        .where(x <= F.col(f"high{len(probs) - 1}"))
        .select(*key_cols, "place", band.alias("band"))
        .groupBy(*key_cols, "place", "band.x", "band.gap")
        .agg(F.count("*").alias("c"))
    )
    upto = W.partitionBy(*key_cols, "place").orderBy("x", "gap")
    upto = upto.rowsBetween(W.unboundedPreceding, 0)
    ranked = counted.withColumn("end", F.sum("c").over(upto)).where(F.col("gap") == 0)
    ranked = ranked.join(side, _on(key_cols))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("end")) & (rank >= F.col("end") - F.col("c")), x))

    picked = ranked.groupBy(*key_cols, "place").agg(
        *[at(F.col(f"{r}{k}")).alias(f"{r}{k}") for k in range(len(probs)) for r in ("first", "second")]
    )
    rows = {(tuple(r[k] for k in key_cols), columns[r["place"]]): r for r in picked.collect()}
    failed = []
    for i, b in ids.items():
        r, k = rows.get(i[:2]), probs.index(i[2])
        low, high = (r[f"first{k}"], r[f"second{k}"]) if r else (None, None)
        if low is None or high is None:
            failed.append(i)
        else:
            b.value = low + (high - low) * b.share
    return failed


def _bracket_table(base, key_cols, ids, columns, probs, ascending=True) -> DataFrame:
    """Brackets and ranks per group and column, a missing one left null.

    With ``ascending`` the ends are made to ascend with the quantile, so that a
    value finds its place by comparing from the top. At most ``MAX_GROUPS`` rows
    per column, so it is safe to broadcast.
    """
    fields = [T.StructField(f"b_{k}", base.schema[k].dataType) for k in key_cols]
    fields.append(T.StructField("b_place", T.IntegerType()))
    for name, dtype in (("low", T.DoubleType()), ("high", T.DoubleType()),
                        ("first", T.LongType()), ("second", T.LongType())):
        fields += [T.StructField(f"{name}{k}", dtype) for k in range(len(probs))]
    rows = []
    for key, v in dict.fromkeys(i[:2] for i in ids):
        own = [ids.get((key, v, p)) for p in probs]
        known = [b for b in own if b is not None]
        lows, highs = [], []
        for k, b in enumerate(own):
            if not ascending:
                lows.append(None if b is None else float(b.low))
                highs.append(None if b is None else float(b.high))
                continue
            before = [c for c in own[: k + 1] if c is not None] or known[:1]
            after = [c for c in own[k:] if c is not None] or known[-1:]
            lows.append(float(min(c.low for c in after)))
            highs.append(float(max(c.high for c in before)))
        ranks = [[None if b is None else getattr(b, r) for b in own] for r in ("rank_low", "rank_high")]
        rows.append((*key, columns.index(v), *lows, *highs, *ranks[0], *ranks[1]))
    return base.sparkSession.createDataFrame(rows, T.StructType(fields))


def distinct_up_to(
    df: DataFrame, columns: Sequence[str], bound: int | Mapping[str, int]
) -> dict[str, int | None]:
    """Exact distinct counts of columns with at most ``bound`` values, else None.

    A sketch settles columns far above the bound; only the rest, whose values
    are few and merge before the shuffle, are counted exactly.
    """
    columns = list(columns)
    if not columns:
        return {}
    bounds = bound if isinstance(bound, Mapping) else dict.fromkeys(columns, bound)
    guess = df.agg(
        *[F.approx_count_distinct(col(c), HLL_ERROR).alias(f"d{i}") for i, c in enumerate(columns)]
    ).first()
    near = [c for i, c in enumerate(columns) if guess[f"d{i}"] <= 2 * bounds[c] + 10]
    out: dict[str, int | None] = dict.fromkeys(columns)
    if near:
        exact = df.agg(
            *[F.count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(near)]
        ).first()
        out.update({c: exact[f"d{i}"] for i, c in enumerate(near) if exact[f"d{i}"] <= bounds[c]})
    return out
