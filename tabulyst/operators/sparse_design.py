"""Moments of a design with many category levels, without its dummy columns.

A dummy is 1 in the rows of its level. So the products of two dummies are the rows that hold
both levels, and its products with a number are the number's sum over its level. One pass
counts levels by pairs of columns and sums numbers by level; a task sends one block of sums
for each pair of columns, and blocks of one place are added as they come. The driver holds the
correlations of all terms: 8 bytes for each pair, 5 MB for 40 columns of 20 levels.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blocks(numbers: int, sizes: Sequence[int]):
    """(a, b, sums): a = b = -1 the products of 1 and the numbers; a = -1 their sums by level of
    column b; else the rows by level of a and of b."""

    def count(batches):
        inner = np.zeros((numbers + 1, numbers + 1))
        by_level = [np.zeros((numbers + 1, n)) for n in sizes]
        both = {(i, j): np.zeros(sizes[i] * sizes[j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes))}
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            x = np.stack([np.ones(batch.num_rows), *columns[:numbers]])
            codes = [c.astype(np.int64) for c in columns[numbers:]]
            inner += x @ x.T
            for i, code in enumerate(codes):
                for k in range(numbers + 1):
                    by_level[i][k] += np.bincount(code, weights=x[k], minlength=sizes[i])
            for i, j in both:
                both[i, j] += np.bincount(codes[i] * sizes[j] + codes[j], minlength=sizes[i] * sizes[j])
        rows = [(-1, -1, inner), *((-1, i, v) for i, v in enumerate(by_level)), *((i, j, v) for (i, j), v in both.items())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2].tobytes() for r in rows], pa.binary())], ["a", "b", "sums"])

    return count


def _merger():
    """Adds the blocks of each place, which come one after the other."""

    def add(batches):
        place, total, out = None, None, []
        for batch in batches:
            for a, b, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != (a, b):
                    if place:
                        out.append((*place, total.tobytes()))
                    place, total = (a, b), np.frombuffer(sums).copy()
                else:
                    total += np.frombuffer(sums)
        if place:
            out.append((*place, total.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary())], ["a", "b", "sums"])

    return add


def sparse_moments(
    df: DataFrame, numbers: Sequence[Column], categories: Sequence[tuple[Column, Sequence[str]]],
) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, means, standard deviations and correlations of ``numbers`` (without gaps) and of
    the dummies of all levels but the first of each category. The last number comes last, as
    the target; the dummies come between it and the others. Each value is one of its levels."""
    means = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(numbers)], F.count("*").alias("n")).first()
    centre = [means[f"m{i}"] or 0.0 for i in range(len(numbers))]
    cells = [(x.cast("double") - F.lit(c)).alias(f"x{i}") for i, (x, c) in enumerate(zip(numbers, centre, strict=True))]
    cells += [(F.array_position(F.array(*[F.lit(v) for v in levels]), x) - 1).cast("int").alias(f"k{i}") for i, (x, levels) in enumerate(categories)]
    q, sizes = len(numbers), [len(levels) for _, levels in categories]
    places = 1 + len(sizes) * (len(sizes) + 1) // 2
    parts = df.select(*cells).mapInArrow(_blocks(q, sizes), "a int, b int, sums binary")
    merged = parts.repartition(min(places, 64), "a", "b").sortWithinPartitions("a", "b").mapInArrow(_merger(), "a int, b int, sums binary")
    starts = np.concatenate([[0], np.cumsum([n - 1 for n in sizes])]).astype(int) + q - 1
    terms = q + int(sum(n - 1 for n in sizes))
    cross, sums, n = np.zeros((terms, terms)), np.zeros(terms), means["n"]
    of_number = [*range(q - 1), terms - 1]
    for r in merged.collect():  # one block for each pair of columns
        block = np.frombuffer(r["sums"])
        if r["b"] < 0:
            block = block.reshape(q + 1, q + 1)
            cross[np.ix_(of_number, of_number)], sums[of_number] = block[1:, 1:], block[0, 1:]
        elif r["a"] < 0:
            block = block.reshape(q + 1, sizes[r["b"]])[:, 1:]
            mine = np.arange(starts[r["b"]], starts[r["b"] + 1])
            cross[np.ix_(of_number, mine)], cross[np.ix_(mine, of_number)] = block[1:], block[1:].T
            cross[mine, mine], sums[mine] = block[0], block[0]
        else:
            block = block.reshape(sizes[r["a"]], sizes[r["b"]])[1:, 1:]
            one, two = (np.arange(starts[k], starts[k + 1]) for k in (r["a"], r["b"]))
            cross[np.ix_(one, two)], cross[np.ix_(two, one)] = block, block.T
    if n:
        cross -= np.outer(sums, sums) / n
    size = np.sqrt(np.maximum(np.diag(cross), 0))
    with np.errstate(all="ignore"):
        corr = np.clip(cross / np.outer(size, size), -1, 1)
    np.fill_diagonal(corr, 1.0)
    mean = sums / max(n, 1)
    mean[of_number] += centre
    return n, mean, size / np.sqrt(max(n - 1, 1)), corr

