"""Pearson correlations of all pairs of many columns with gaps, as blocked matrix products.

A gap counts as 0 next to a mask of 0 and 1. Four products over all rows (values by values,
values by masks, squares by masks, masks by masks) hold all sums over the rows that a pair
of columns has complete. Each task multiplies its batches and sends the products in tiles of TILE columns;
tiles of one place are added as they come, one at a time, so that neither a task nor the driver holds a matrix
of all columns but the tasks that multiply (four of them).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = 64
#: Of a sum of squares, what rounding may leave of a column that is constant in a pair's rows.
ROUNDING = 1e-13

PAIRS = "i int, j int, x string, y string, n long, r double"


def _products(width: int, tile: int):
    """Tiles (a, b, sums) of a partition, a <= b: for each pair of columns its rows, the
    product, both sums and both sums of squares over them."""

    def multiply(batches):
        xx, xm, qm, mm = (np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in part.columns], axis=1)
                present = ~np.isnan(x)
                x, m = np.where(present, x, 0.0), present.astype(np.float64)
                xx += x.T @ x
                xm += x.T @ m
                qm += (x * x).T @ m
                mm += m.T @ m
        a, b, sums = [], [], []
        for i in range(0, width, tile):
            for j in range(i, width, tile):
                s, t = slice(i, i + tile), slice(j, j + tile)
                six = [mm[s, t], xx[s, t], xm[s, t], xm[t, s].T, qm[s, t], qm[t, s].T]
                a.append(i)
                b.append(j)
                sums.append(np.stack(six).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(sums, pa.binary())], ["a", "b", "sums"])

    return multiply


def _pairs(names: Sequence[str], varies: Sequence[bool], tile: int, rounding: float):
    """(i, j, x, y, n, r) of ordered tiles."""
    width = len(names)

    def finish(a: int, b: int, total: np.ndarray):
        rows, cols = min(tile, width - a), min(tile, width - b)
        n, xy, sx, sy, qx, qy = total.reshape(6, rows, cols)
        with np.errstate(all="ignore"):
            left, right = qx - sx * sx / n, qy - sy * sy / n
            r = (xy - sx * sy / n) / (np.sqrt(left) * np.sqrt(right))
        known = (left > rounding * qx) & (right > rounding * qy) & np.isfinite(r)
        i, j = np.meshgrid(np.arange(a, a + rows), np.arange(b, b + cols), indexing="ij")
        known &= np.array(varies)[i] & np.array(varies)[j]
        some = i < j
        i, j, known = i[some], j[some], known[some]
        r = pa.array(np.clip(np.where(known, r[some], 0.0), -1.0, 1.0), mask=~known)
        labels = pa.array(list(names), pa.string())
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), labels.take(pa.array(i)), labels.take(pa.array(j)),
                   pa.array(np.rint(n[some]).astype(np.int64)), r]
        return pa.RecordBatch.from_arrays(columns, ["i", "j", "x", "y", "n", "r"])

    def add(batches):
        place, total = None, None
        for batch in batches:
            for a, b, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != (a, b):
                    if place:
                        yield finish(*place, total)
                    place, total = (a, b), np.frombuffer(sums).copy()
                else:
                    total += np.frombuffer(sums)
        if place:
            yield finish(*place, total)

    return add


def masked_correlations(
    df: DataFrame, names: Sequence[str], numbers: Sequence[Column], centres: Sequence[float | None],
    varies: Sequence[bool], tile: int = TILE,
) -> DataFrame:
    """(i, j, x, y, n, r) of all pairs i < j over their complete rows.

    ``centres`` are near the columns' means (null for a column without values) and keep the
    sums small; ``varies`` names the columns that aren't constant. NaN counts as a gap. A pair
    with a constant column in its rows has no r.
    """
    off = [(x - F.lit(c if c is not None else 0.0)).cast("double").alias(f"c{i}") for i, (x, c) in enumerate(zip(numbers, centres, strict=True))]
    # a row of gaps adds nothing, but gives an empty table its pairs
    gaps = df.sparkSession.range(1).select(*(F.lit(None).cast("double").alias(f"c{i}") for i in range(len(names))))
    parts = df.select(*off).unionByName(gaps).mapInArrow(_products(len(names), tile), "a int, b int, sums binary")
    places = (-(-len(names) // tile)) * (-(-len(names) // tile) + 1) // 2
    ordered = parts.repartition(places, "a", "b").sortWithinPartitions("a", "b")
    return ordered.mapInArrow(_pairs(names, varies, tile, ROUNDING), PAIRS)
