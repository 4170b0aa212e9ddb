"""Runs of repeated words by string synchronising sets.

The words of a batch of texts become one sequence of numbers, a number of its own after each
text. A run is a longest stretch with a smallest period q and at least three periods.

- At scale t (4, 8, 16, ...) position i is in the synchronising set if the least hash of
  the blocks of t words that begin in i to i + t is that of the first or of the last. Whether i is in depends
  on the 2 t words from i alone, so the set is the same in every repetition of a period.
- Blocks of a period of t / 3 or less are left out of the sets: these lie in runs that
  smaller scales have found. The sets then have some n / t members.
- Neighbouring members with the same context of 2 t or 3 t words propose their distance
  as a period. Any run with 1.5 t <= q <= 3 t has such a pair: outside the left-out regions
  t positions side by side hold a member, and a context of q words or more doesn't recur
  within a period. Scales overlap, so that every q from 6 on belongs to one.
- Periods under 6 are found on their own, by comparing the words q apart.

A proposal counts only after its words are compared, from the pair outwards; hashes choose
candidates and decide nothing. All of it is linear in the words but for the sorts by context.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.common import mixed, numbers, spans_of

#: A run that is reported has so many words at least, and so many periods.
LEAST, PERIODS = 24, 3
#: Periods that are found without a synchronising set: all below 1.5 times the first scale.
SMALL, FIRST_SCALE = 6, 4
#: Characters of the texts worked on at once; a longer text is worked on alone.
BLOCK = 1 << 21
_FOLD = np.uint64(0x9FB21C651E98DF25)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)

RUN = "struct<start:long,length:long,period:long>"

Runs = list[tuple[int, int, int]]


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
    return edges[::2], edges[1::2]


class _Found(dict):
    """Runs by (begin, end): the smallest period that was seen. Periods come in rising order
    within a scale, so a multiple of a period never replaces it."""

    def add(self, begin: int, end: int, period: int) -> None:
        if end - begin >= PERIODS * period and period < self.get((begin, end), period + 1):
            self[begin, end] = period

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bounds = np.array(list(self), np.int64).reshape(-1, 2)
        return bounds[:, 0], bounds[:, 1], np.fromiter(self.values(), np.int64, len(self))


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values of two equally long views are the same; looks at parts that grow."""
    at, step, size = 0, 32, min(len(a), len(b))
    while at < size:
        wrong = np.flatnonzero(a[at : at + step] != b[at : at + step])
        if len(wrong):
            return at + int(wrong[0])
        at, step = at + step, step * 2
    return size


def _least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values side by side (the tail counts as never)."""
    size = -(-len(x) // width) * width
    padded = np.full(size + width, _NEVER)
    padded[: len(x)] = x
    parts = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(parts, axis=1).ravel()
    behind = np.minimum.accumulate(parts[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(x)], ahead[width - 1 : width - 1 + len(x)])


def _members(blocks: np.ndarray, scale: int, found: _Found) -> np.ndarray:
    """The synchronising set of a scale, from the hashes of its blocks."""
    n = len(blocks)
    begin, end, period = found.arrays()
    dull = (period * 3 <= scale) & (end - begin >= scale) & (end - scale < n)
    if dull.any():
        depth = np.zeros(n + 1, np.int64)
        np.add.at(depth, begin[dull], 1)
        np.add.at(depth, end[dull] - scale + 1, -1)
        blocks = np.where(np.cumsum(depth[:-1]) > 0, _NEVER, blocks)
    later = np.full(n, _NEVER)
    later[: n - scale] = blocks[scale:]
    least = np.minimum(_least_of(blocks, scale), later)
    return np.flatnonzero((least != _NEVER) & ((blocks == least) | (later == least)))


def _proposals(members: np.ndarray, context: np.ndarray, low: float, high: int) -> np.ndarray:
    """(period, position) of neighbouring members with one context, in order."""
    members = members[members < len(context)]
    key = context[members]
    order = np.argsort(key, kind="stable")
    key, at = key[order], members[order]
    gap = at[1:] - at[:-1]
    good = np.flatnonzero((key[1:] == key[:-1]) & (gap >= low) & (gap <= high))
    return np.stack([gap[good], at[good]], axis=1)


def _verified(words: np.ndarray, pairs: np.ndarray, found: _Found) -> None:
    """Adds the runs that hold proposed pairs; one comparison for all pairs of a run."""
    last, done = 0, -1
    for q, i in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
        if q == last and i < done:
            continue
        back = _agree(words[:i][::-1], words[q : i + q][::-1])
        ahead = _agree(words[i : len(words) - q], words[i + q :])
        last, done = q, i + max(ahead, 1)
        found.add(i - back, i + ahead + q, q)


def runs_of(words: np.ndarray, longest: int) -> _Found:
    """All runs of three periods or more in a sequence of word numbers (from 0), in which no
    run is longer than ``longest``."""
    found = _Found()
    for q in range(1, min(SMALL, longest // PERIODS + 1)):
        for begin, end in zip(*(x.tolist() for x in _stretches(words[:-q] == words[q:])), strict=True):
            found.add(begin, end + q, q)
    hashes = mixed(words.astype(np.uint64) + numbers(1, 11))
    width, scale = 1, FIRST_SCALE
    while 4.5 * scale - 1.5 <= longest:
        while width < scale:
            hashes = _doubled(hashes, width)
            width *= 2
        members = _members(hashes, scale, found)
        twice = _doubled(hashes, scale)
        thrice = mixed(twice[: max(len(hashes) - 2 * scale, 0)] * _FOLD + hashes[2 * scale :])
        low, high = 1.5 * scale - 0.5, PERIODS * scale
        pairs = np.concatenate([_proposals(members, twice, low, high), _proposals(members, thrice, low, high)])
        _verified(words, pairs, found)
        hashes, width, scale = twice, 2 * scale, 2 * scale
    return found


def _doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hashes of stretches twice as wide."""
    return mixed(hashes[: max(len(hashes) - width, 0)] * _FOLD + hashes[width:])


def split_words(text: str) -> list[bytes]:
    """Runs of characters other than space and \\x09-\\x0D: what bytes.split goes by."""
    return text.encode().split()


def _batch_runs(texts: list[list[bytes]]) -> list[Runs]:
    """The runs of each text, as (start, length, period) in order."""
    sizes = [len(t) for t in texts]
    number: dict[bytes, int] = {}
    flat = np.empty(sum(sizes) + len(sizes), np.int64)
    at, begins = 0, []
    for t in texts:
        begins.append(at)
        flat[at : at + len(t)] = [number.setdefault(w, len(number)) for w in t]
        flat[at + len(t)] = -1 - len(begins)
        at += len(t) + 1
    flat += len(sizes) + 1
    out: list[Runs] = [[] for _ in texts]
    if not sum(sizes):
        return out
    begin, end, period = runs_of(flat, max(sizes)).arrays()
    good = end - begin >= LEAST
    begin, end, period = begin[good], end[good], period[good]
    owner = np.searchsorted(begins, begin, "right") - 1
    for k, b, e, q in sorted(zip(owner.tolist(), begin.tolist(), end.tolist(), period.tolist(), strict=True), key=lambda r: (r[1], r[3])):
        out[k].append((b - begins[k], e - b, q))
    return out


def collapsed(words: list[bytes], runs: Runs) -> bytes:
    """The words joined by a space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each row of ``docs``: all runs of its whole text
    of LEAST words or more, as (start, length, period) by start and period, and the text
    with one period of each run kept.

    Null and empty texts have no words and no runs. Repeated and null doc_ids are rows like others; further columns
    are left out. ``edit`` may change the words of a document first.
    """
    def find(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("collapsed", pa.string()),
                            ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))])
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in spans_of(texts, BLOCK):
                words = [split_words(t) for t in texts[lo:hi]]
                if edit:
                    words = [edit(i, w) for i, w in zip(ids[lo:hi], words, strict=True)]
                runs = _batch_runs(words)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[lo:hi], pa.int64()), pa.array([len(w) for w in words], pa.int64()),
                    pa.array([collapsed(w, r).decode() for w, r in zip(words, runs, strict=True)], pa.string()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], schema.field("runs").type),
                ], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(find, f"doc_id long, n_words long, collapsed string, runs array<{RUN}>")


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by a check sum of its id, repeats a stretch of its words to its end.
    A null id changes nothing."""
    import zlib

    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * (-(-(n - a) // p)))[: n - a]


def run_digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli`` (of the run with the most
    periods; ties: least start, then period), ``runs_sha256, collapsed_sha256``."""
    # exponents are compared as fractions: length * other period, exactly
    def stronger(a, b):
        left, right = b["length"] * a["period"], a["length"] * b["period"]
        return F.when(left > right, b).otherwise(a)

    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.try_element_at("runs", F.lit(1)), stronger)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("best.length * 1000 div best.period").cast("long").alias("exponent_milli")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli,
                       "runs_sha256", "collapsed_sha256")
