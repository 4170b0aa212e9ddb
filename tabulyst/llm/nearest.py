"""Approximate nearest neighbours by cross-polytope hashing.

A fast pseudo-random rotation (sign flips and Hadamard transforms, three times) turns a
unit vector; its hash is the nearest signed axis. A table's bucket joins as many such
hashes as the number of vectors asks for, so that buckets keep their size as the data
grow. A query probes the buckets of its nearest axes in each table; what it meets there is
ranked by the exact inner product. Buckets are split into blocks of bounded size. How many
buckets a query probes is learned from the data: some queries are answered exactly, and
probes are added until these meet ENOUGH of their true neighbours. Vectors of uneven norms
are dealt to ranges of norm, each with an index and probes of its own; a query asks all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulyst.llm.common import numbers
from tabulyst.llm.vectors import matrix, valid
from tabulyst.session import stage

#: Tables, and the fewest probes in each.
TABLES, PROBES = 16, 6
#: Queries that are answered exactly, and the share of their neighbours that has to be met.
CHECKED, ENOUGH = 128, 0.95
#: Ranges of norm per doubling; neighbouring ranges are joined while they hold BUCKET vectors or less.
RANGES = 4
#: Vectors that a bucket holds on average, and at most in one block.
BUCKET, BLOCK = 512, 1024


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Rows (of a length that is a power of two) under one pseudo-random rotation."""
    n, d = x.shape
    for k in range(3):
        signs = 1.0 - 2.0 * (numbers(d, 100 + 3 * seed + k) >> np.uint64(63)).astype(np.float64)
        x = x * signs
        h = 1
        while h < d:
            x = x.reshape(n, d // (2 * h), 2, h)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
            h *= 2
        x = x / math.sqrt(d)
    return x


def axes_of(count: int, width: int) -> list[int]:
    """The axes each polytope of a table may use, so that buckets hold BUCKET vectors."""
    need, out = max(1.0, count / BUCKET), []
    while need > 1 or not out:
        out.append(max(1, min(width, math.ceil(need / 2))))
        need /= 2 * out[-1]
        if len(out) == 8:
            break
    return out


def buckets(x: np.ndarray, table: int, axes: list[int], probes: int) -> np.ndarray:
    """For each row the numbers of its ``probes`` nearest buckets, best first; -1 if fewer."""
    n = len(x)
    rows = np.arange(n)[:, None]
    loss, key = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
    for j, a in enumerate(axes):
        y = rotated(x, table * 8 + j)[:, :a]
        both = np.concatenate([y, -y], axis=1)
        m = min(probes, 2 * a)
        best = np.argpartition(-both, m - 1, axis=1)[:, :m] if m < 2 * a else np.broadcast_to(np.arange(2 * a), (n, 2 * a))
        fall = (both.max(axis=1, keepdims=True) - both[rows, best]) ** 2
        loss = (loss[:, :, None] + fall[:, None, :]).reshape(n, -1)
        key = (key[:, :, None] * (2 * a) + best[:, None, :]).reshape(n, -1)
        keep = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        loss, key = loss[rows, keep], key[rows, keep]
    out = np.full((n, probes), -1, np.int64)
    out[:, : key.shape[1]] = key
    return out


class Index:
    """How the vectors of a range of norm are hashed: the longest norm, whether all norms are
    equal, the axes, and how many tables and probes it takes."""

    def __init__(self, count: int, longest: float, shortest: float, width: int):
        self.longest, self.shortest, self.even = longest, shortest, shortest > 0.999 * longest
        self.axes = axes_of(count, 1 << max(0, (width + (not self.even) - 1).bit_length()))
        self.all = math.prod(2 * a for a in self.axes)
        self.take(PROBES, PROBES >= self.all)

    def take(self, probes: int, whole: bool) -> None:
        """``whole``: one table, all of whose buckets are probed, meets all there is."""
        self.tables, self.probes = (1, self.all) if whole else (TABLES, probes)

    def units(self, v: np.ndarray, query: bool) -> np.ndarray:
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        unit = v / (norm if query or self.even else self.longest)
        if not self.even:  # one more component makes largest products nearest directions
            unit = np.concatenate([unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1, keepdims=True)))], axis=1)
        size = 1 << max(0, (unit.shape[1] - 1).bit_length())
        return np.pad(unit, ((0, 0), (0, size - unit.shape[1])))

    def hashes(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Bucket numbers of each row, over all tables and probes; -1 if fewer."""
        unit, probes = self.units(v, query), self.probes if query else 1
        return np.concatenate([np.where((b := buckets(unit, t, self.axes, probes)) < 0, -1, b * TABLES + t) for t in range(self.tables)], axis=1)

    def learn(self, queries: np.ndarray, found: np.ndarray, of: np.ndarray) -> None:
        """Takes the fewest probes with which ``queries`` meet ENOUGH of their neighbours
        ``found``; ``of`` has the query of each of these."""
        if not len(found) or self.tables == 1:
            return
        asked, home = self.units(queries, True), self.units(found, False)
        at = [buckets(home, t, self.axes, 1)[:, 0] for t in range(TABLES)]
        probes = PROBES
        while True:
            met = np.full(len(found), probes)
            for t in range(TABLES):
                same = buckets(asked, t, self.axes, probes)[of] == at[t][:, None]
                met = np.minimum(met, np.where(same.any(axis=1), same.argmax(axis=1), probes))
            last = int(np.sort(met)[math.ceil(ENOUGH * len(met)) - 1])
            if last < probes:
                return self.take(max(PROBES, last + 1), False)
            probes *= 2
            if TABLES * probes >= self.all:  # one whole table is less work
                return self.take(probes, True)


def ranges(cells: list[tuple[int, float, float]], width: int) -> list[Index]:
    """Indexes from the longest norms to the shortest, for (count, longest, shortest) of
    cells in that order: small neighbours together, where one bucket holds them all."""
    joined: list[list] = []
    for n, longest, shortest in cells:
        if joined and joined[-1][0] + n <= BUCKET:
            joined[-1][0] += n
            joined[-1][2] = shortest
        else:
            joined.append([n, longest, shortest])
    return [Index(n, longest, shortest, width) for n, longest, shortest in joined]


def range_of(v: np.ndarray, indexes: list[Index]) -> np.ndarray:
    """The range of each row: the first whose shortest norm it reaches."""
    norm = np.sqrt((v * v).sum(axis=1))
    least = np.array([x.shortest for x in indexes[:-1]]) * (1 - 1e-9)
    return np.searchsorted(-least, -norm)


def _hashed(rows: DataFrame, indexes: list[Index], query: bool, width: int) -> DataFrame:
    """``vec_id, v, bucket``: a row for each table and probe, in the row's own range or, of a
    query, in all."""
    kind, many = rows.schema["v"].dataType.simpleString(), len(indexes)

    def hash_(batches):
        for batch in batches:
            v = matrix(batch.column("v"), width).astype(np.float64)
            if query:
                found = np.concatenate([np.where((b := x.hashes(v, True)) < 0, -1, b * many + r) for r, x in enumerate(indexes)], axis=1)
            else:
                mine = range_of(v, indexes)
                found = np.full((len(v), TABLES), -1, np.int64)
                for r in np.unique(mine):
                    at = np.flatnonzero(mine == r)
                    found[at, : indexes[r].tables] = indexes[r].hashes(v[at], False) * many + r
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))],
                ["vec_id", "v", "buckets"])

    out = rows.mapInArrow(hash_, f"vec_id long, v {kind}, buckets array<long>")
    return out.select("vec_id", "v", F.explode("buckets").alias("bucket")).filter("bucket >= 0")


def _once(cid: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns ordered by id, and their products: of columns that repeat an id only the first
    with the largest product counts in a row, the others fall to -inf."""
    order = np.argsort(cid, kind="stable")
    score, ids = score[:, order], cid[order]
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    sizes = np.diff(np.r_[starts, len(ids)])
    best = np.repeat(np.maximum.reduceat(score, starts, axis=1), sizes, axis=1)
    at = np.where(score == best, np.arange(len(ids)), len(ids))
    first = np.repeat(np.minimum.reduceat(at, starts, axis=1), sizes, axis=1)
    return order, np.where(at == first, score, -np.inf)


def top(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``q`` the ``k`` largest products with rows of ``c`` of other ids, ties
    to the smaller id: places in ``q``, places in ``c``, products. Rows of ``c`` that repeat an
    id are one, with the largest product."""
    score, back = q @ c.T, None
    score[qid[:, None] == cid[None, :]] = -np.inf
    if len(np.unique(cid)) < len(cid):
        back, score = _once(cid, score)
        cid = cid[back]
    least = np.partition(score, -k, axis=1)[:, -k, None] if score.shape[1] > k else -np.inf
    row, col = np.nonzero((score >= least) & (score > -np.inf))
    best = score[row, col]
    order = np.lexsort((cid[col], -best, row))
    row, col, best = row[order], col[order], best[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], col[keep] if back is None else back[col[keep]], best[keep]


def _exact(rows: DataFrame, qid: np.ndarray, q: np.ndarray, k: int, width: int) -> DataFrame:
    """``place, vec_id, score, v``: the ``k`` best rows for each of a few queries, by their
    products with all rows, a batch at a time."""

    def best(batches):
        place, ids, score, v = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, width))
        for batch in batches:
            cid, cv = batch.column("vec_id").to_numpy(), matrix(batch.column("v"), width).astype(np.float64)
            row, col, some = top(qid, q, cid, cv, k)
            place, ids, score, v = np.r_[place, row], np.r_[ids, cid[col]], np.r_[score, some], np.concatenate([v, cv[col]])
            order = np.lexsort((-score, ids, place))
            order = order[np.r_[True, (np.diff(place[order]) != 0) | (np.diff(ids[order]) != 0)][: len(order)]]
            order = order[np.lexsort((ids[order], -score[order], place[order]))]
            place, ids, score, v = place[order], ids[order], score[order], v[order]
            keep = np.arange(len(place)) - np.searchsorted(place, place) < k
            place, ids, score, v = place[keep], ids[keep], score[keep], v[keep]
        if len(place):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * width, pa.int32()), pa.array(v.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(ids), pa.array(score), lists], ["place", "vec_id", "score", "v"])

    near = rows.mapInArrow(best, "place long, vec_id long, score double, v array<double>")
    near = near.groupBy("place", "vec_id").agg(F.max(F.struct("score", "v")).alias("x")).select("place", "vec_id", "x.score", "x.v")
    order = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def _learn(indexes: list[Index], rows: DataFrame, asked: DataFrame, k: int, width: int) -> None:
    """Sets the probes of the indexes by the exact answers of CHECKED queries."""
    if all(x.tables == 1 for x in indexes):
        return
    some = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CHECKED).collect()
    if not some:
        return
    qid = np.array([r["vec_id"] for r in some], np.int64)
    q = np.array([list(r["v"]) + [0.0] * (width - len(r["v"])) for r in some], np.float64)
    near = _exact(rows, qid, q, k, width).collect()
    v, place = np.array([r["v"] for r in near], np.float64).reshape(len(near), width), np.array([r["place"] for r in near], np.int64)
    mine = range_of(v, indexes)
    for r, index in enumerate(indexes):
        index.learn(q, v[mine == r], place[mine == r])


def nearest(table: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by ``every``
    the ``k`` largest inner products among those met in its buckets, ties to the smaller id.

    Null, zero and empty vectors and those that hold null or a non-finite number take no
    part; short vectors end in zeros. A row never answers its own id; other rows with equal
    vectors do. With fewer than ``k`` others, all that were met are returned. Repeated ids
    count as one, with their largest product.
    """
    rows = valid(table, zero=False)
    size = F.least(F.greatest(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-300)), F.lit(1e300))
    whole = rows.agg(F.max(size).alias("longest"), F.max(F.size("v")).alias("width")).first()
    width = whole["width"] or 1
    # norms that differ by rounding alone share the first cell
    cell = F.floor(RANGES * (F.log2(F.lit(1.001 * (whole["longest"] or 1.0))) - F.log2(size))).alias("cell")
    cells = rows.groupBy(cell).agg(F.count("*").alias("n"), F.max(size).alias("longest"), F.min(size).alias("shortest")).orderBy("cell").collect()
    if table.schema["embedding"].dataType.simpleString() == "array<float>":
        rows = rows.withColumn("v", F.col("v").cast("array<float>"))  # as it came: half the bytes of each copy
    indexes = ranges([(r["n"], r["longest"], r["shortest"]) for r in cells] or [(0, 1.0, 1.0)], width)
    queries = rows.filter(F.col("vec_id") % every == 0)
    _learn(indexes, rows, queries, k, width)
    data = _hashed(rows, indexes, False, width)
    sizes = data.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    large = stage(sizes.filter("blocks > 1"), "buckets")
    blocks = F.coalesce("blocks", F.lit(1))
    held = data.join(large, "bucket", "left").select("bucket", F.pmod(F.xxhash64("vec_id"), blocks).alias("block"), "vec_id", "v")
    asked = _hashed(queries, indexes, True, width).join(large, "bucket", "left")
    asked = asked.select("bucket", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.col("vec_id").alias("query_id"), "v")

    def rank(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        qid, cid = q.column("query_id").to_numpy(), c.column("vec_id").to_numpy()
        qv, cv = matrix(q.column("v"), width).astype(np.float64), matrix(c.column("v"), width).astype(np.float64)
        out = []
        for a in range(0, len(qid), 256):
            row, col, score = top(qid[a : a + 256], qv[a : a + 256], cid, cv, k)
            out.append((qid[a + row], cid[col], score))
        return pa.table({n: np.concatenate([x[j] for x in out]) for j, n in enumerate(("query_id", "vec_id", "score"))})

    met = asked.groupBy("bucket", "block").cogroup(held.groupBy("bucket", "block")).applyInArrow(rank, "query_id long, vec_id long, score double")
    once = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
