"""Exact top-k inner products of whole numbers with a bit-sliced index.

Vectors become whole numbers floor(1024 * x). A block of rows keeps, for each component,
its values less the block's smallest, cut to SLICES bits, as bitmaps over the rows: one for
each bit. A query multiplies a component by adding its bitmaps, shifted, for each set bit
of its own number; all queries of a group do so at once. From the sum's most significant
bitmap downward the k-th largest value is found. What was cut off can change a sum by a
known bound only, so just the rows within it of the k-th are resolved with full numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulyst.llm.vectors import matrix, valid
from tabulyst.session import stage

SCALE = 1024
SLICES = 6
#: Rows of an index block; queries that share a task; queries whose bitmaps are added at once.
BLOCK, GROUP, AT_ONCE = 8192, 4096, 64
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def whole_numbers(v: np.ndarray) -> np.ndarray:
    """floor(1024 * x); beyond 2^62 cut to that."""
    return np.clip(np.floor(v * SCALE), -(2.0**62), 2.0**62).astype(np.int64)


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words, padded with zeros."""
    packed = np.packbits(flags, axis=-1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, -packed.shape[-1] % 8)])).view(np.uint64)


def sliced(numbers: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """Bitmaps by component and bit, the bits cut off, and the components' smallest values."""
    low = numbers.min(axis=0)
    spread = int((numbers.max(axis=0).astype(object) - low.astype(object)).max()) if numbers.size else 0
    cut = max(0, spread.bit_length() - SLICES)
    top = (numbers.astype(object) - low.astype(object) if spread >= 2**63 else numbers - low) >> cut
    top = top.astype(np.int64)
    return np.stack([_bits(((top >> j) & 1).astype(bool).T) for j in range(SLICES)], axis=1), cut, low


def _plus(total: list[np.ndarray], at: int, addend: list[np.ndarray]) -> None:
    """Adds the bitmaps of a number, shifted by ``at`` bits, to those of ``total``."""
    carry = None
    for j, x in enumerate(addend):
        if at + j == len(total):
            total.append(np.zeros_like(x))
        t = total[at + j]
        both = t ^ x
        if carry is None:
            total[at + j], carry = both, t & x
        else:
            total[at + j], carry = both ^ carry, (t & x) | (both & carry)
    j = at + len(addend)
    while carry.any():
        if j == len(total):
            total.append(np.zeros_like(carry))
        total[j], carry = total[j] ^ carry, total[j] & carry
        j += 1


def candidates(bitmaps: np.ndarray, cut: int, rows: int, q: np.ndarray, k: int) -> np.ndarray:
    """For each query (row of ``q``) a flag for each of the block's rows: a superset of its
    ``k`` best."""
    words = bitmaps.shape[2]
    valid_rows = np.broadcast_to(_bits(np.ones((1, rows), bool)), (len(q), words))
    if rows <= k:
        return np.ones((len(q), rows), bool)
    size, negative = np.abs(q), np.where(q < 0, _ALL, np.uint64(0))
    total: list[np.ndarray] = [np.zeros((len(q), words), np.uint64)]
    for d in range(q.shape[1]):
        # a negative factor takes the complement, which adds the same to every row
        mine = [bitmaps[d, j][None, :] ^ negative[:, d, None] for j in range(SLICES)]
        for b in range(int(size[:, d].max()).bit_length()):
            on = np.where((size[:, d] >> b) & 1, _ALL, np.uint64(0))[:, None]
            _plus(total, b, [x & on for x in mine])
    # the k-th largest sum, from the most significant bitmap downward
    sure, equal = np.zeros_like(valid_rows), valid_rows.copy()
    kth = np.zeros(len(q), object)
    for i in range(len(total) - 1, -1, -1):
        more = sure | (equal & total[i])
        enough = np.bitwise_count(more).sum(axis=1) >= k
        kth += np.where(enough, 1 << i, 0).astype(object)
        sure = np.where(enough[:, None], sure, more)
        equal = np.where(enough[:, None], equal & total[i], equal & ~total[i])
    # what was cut off from each component is under 2^cut
    slack = size.astype(object).sum(axis=1) * ((1 << cut) - 1)
    least = [max(0, int(t) - (int(s) >> cut) - 1) for t, s in zip(kth, slack, strict=True)]
    above, equal = np.zeros_like(valid_rows), valid_rows.copy()
    for i in range(len(total) - 1, -1, -1):
        one = np.array([(x >> i) & 1 for x in least], bool)[:, None]
        above = np.where(one, above, above | (equal & total[i]))
        equal = np.where(one, equal & total[i], equal & ~total[i])
    return np.unpackbits((above | equal).view(np.uint8), axis=1, bitorder="little")[:, :rows].astype(bool)


def _scores(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact products; numbers that could overflow are multiplied without bound and cut to
    the range of a long."""
    if rows.size and float(np.abs(rows).max()) * float(np.abs(q).max()) * max(1, len(q)) >= 2.0**62:
        exact = (rows.astype(object) * q.astype(object)).sum(axis=1)
        return np.array([max(-(2**63), min(2**63 - 1, x)) for x in exact], np.int64)
    return rows @ q


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """``block, ids, width, numbers``: consecutive rows, up to ``most`` together."""

    def gather(batches):
        from pyspark import TaskContext

        block, held, count = TaskContext.get().partitionId() << 32, [], 0

        def out():
            ids = np.concatenate([i for i, _ in held])
            width = max(v.shape[1] for _, v in held)
            v = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for _, v in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([ids.tobytes()], pa.binary()), pa.array([width], pa.int32()), pa.array([whole_numbers(v).tobytes()], pa.binary())],
                ["block", "ids", "width", "numbers"])

        for batch in batches:
            ids, v = batch.column("vec_id").to_numpy(), matrix(batch.column("v"))
            at = 0
            while at < len(ids):
                take = min(most - count, len(ids) - at)
                held.append((ids[at : at + take], v[at : at + take]))
                count, at = count + take, at + take
                if count == most:
                    yield out()
                    block, held, count = block + 1, [], 0
        if held:
            yield out()

    return rows.mapInArrow(gather, "block long, ids binary, width int, numbers binary")


def top_products(table: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by ``every``
    the ``k`` largest products with other rows, exactly; ties to the smaller id.

    Null vectors and those that hold null or a non-finite number take no part; zero and empty
    vectors do. Short vectors end in zeros. Components are cut to 2^62, scores to a long. A row never answers its own id; with fewer than
    ``k`` others, all are returned. Repeated ids count as one, with their largest score. The
    query set meets all rows block by block; nothing is capped.
    """
    rows = valid(table, zero=True)
    index = stage(_blocks(rows, BLOCK), "slices")
    asked = stage(_blocks(rows.filter(F.col("vec_id") % every == 0), AT_ONCE), "queries")
    groups = max(1, -(-asked.count() * AT_ONCE // GROUP))
    spread = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    asked = asked.select(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"), F.col("ids").alias("q_ids"), F.col("width").alias("q_width"), F.col("numbers").alias("q_numbers"))
    asked = index.select("block", spread).join(asked, "group")
    held = index.select(F.col("block").alias("b"), spread, "ids", "width", "numbers").withColumnRenamed("group", "g")

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        for b in block.to_pylist():
            ids = np.frombuffer(b["ids"], np.int64)
            numbers = np.frombuffer(b["numbers"], np.int64).reshape(len(ids), b["width"])
            bitmaps, cut, _ = sliced(numbers)
            for r in queries.select(["q_ids", "q_width", "q_numbers"]).to_pylist():
                q_ids = np.frombuffer(r["q_ids"], np.int64)
                q = np.frombuffer(r["q_numbers"], np.int64).reshape(len(q_ids), r["q_width"])
                width = min(b["width"], r["q_width"])
                # its own id may hold repeated rows: one more place for each row that has it
                own = int((ids[:, None] == q_ids[None, :]).sum(axis=0).max(initial=0))
                again = len(ids) - len(np.unique(ids))
                flags = candidates(bitmaps[:width], cut, len(ids), q[:, :width], k + own + again)
                for i in range(len(q_ids)):
                    at = np.flatnonzero(flags[i] & (ids != q_ids[i]))
                    score = _scores(numbers[at, :width], q[i, :width])
                    best = np.lexsort((ids[at], -score if len(score) == 0 or score.min() > -(2**63) else ~score))[: k + again]
                    out.append((np.full(len(best), q_ids[i]), ids[at][best], score[best]))
        return pa.table({n: np.concatenate([x[j] for x in out]).astype(np.int64) for j, n in enumerate(("query_id", "vec_id", "score"))})

    met = asked.groupBy("block", "group").cogroup(held.groupBy("b", "g")).applyInArrow(search, "query_id long, vec_id long, score long")
    once = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
