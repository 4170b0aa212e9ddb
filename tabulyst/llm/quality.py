"""Quality by ordinal cumulative-link regression on graded ratings.

Grades are ordered: 0 toxic, 1 poor, 2 good. One weight per hashed text feature is shared
by all grades, P(grade >= k) = sigmoid(weights * features + bias_k), with falling biases.
Features are the words of a text and their beginnings (present or not), the shapes of its
blank-separated parts (square root of their share, scaled), the share of parts with symbols, and
steps of its repetition and length. Buckets that too few
training texts have get no weight.

The fit takes a bounded sample of the rated documents; SAMPLE states the bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm import shingles
from tabulyst.llm.common import mixed, utf8_of

GRADES = 3
#: Rated documents that the fit takes, those with the smallest hash of their id.
SAMPLE = 12_000
#: Hash buckets, and the training texts that must have one.
BUCKETS, SUPPORT = 1 << 20, 20
STEPS, RATE, PENALTY = 200, 0.1, 1e-3
#: Entries of the sample that are worked on at once.
CHUNK = 1 << 20
#: Bytes of a word's beginning; the scale of shapes against words.
BEGINNING, SCALE = 5, 3.0
#: Documents whose probability of a good grade is lower are not selected.
SELECT = 0.5

#: Words: letters and bytes beyond ASCII; all else parts them.
_WORDS = np.arange(256, dtype=np.uint8)
_WORDS[:128] = 32
_WORDS[65:91], _WORDS[97:123] = np.arange(97, 123), np.arange(97, 123)
#: Shapes: small letters, capitals and digits as one byte each; runs count once.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = 1
_SHAPE[65:91], _SHAPE[48:58] = 2, 3
#: Bytes that plain text has; others make a part one with symbols.
_SYMBOL = np.ones(256, bool)
_SYMBOL[[*range(33), *b".,;:'\"()-?!", *range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _bucket(value: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(value + np.uint64(kind)) % np.uint64(BUCKETS)).astype(np.int64)


def _counted(row: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    return key // BUCKETS, key % BUCKETS, count


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of the features of a column of texts, ordered by row."""
    data, offsets = utf8_of(column)
    rows, buckets, values = [], [], []

    def add(row, bucket, value):
        rows.append(row), buckets.append(bucket), values.append(value.astype(np.float32))

    def kept(some: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return some[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]

    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    plain = _WORDS[data]
    place = np.arange(len(plain))
    begins = (plain != 32) & (np.concatenate([[True], plain[:-1] == 32]) | first) if len(plain) else first
    place -= np.maximum.accumulate(np.where(begins | (plain == 32), place, 0)) if len(plain) else 0
    for kind, keep in ((1, np.ones(len(plain), bool)), (5, place < BEGINNING)):
        for a, _, hashes, row in shingles.words(*kept(plain, keep)):
            r, b, _ = _counted(row + a, _bucket(hashes, kind))
            add(r, b, np.ones(len(r)))
    shape = _SHAPE[data]
    keep = first | (shape == 32)
    keep[1:] |= shape[1:] != shape[:-1]
    for a, b, hashes, row in shingles.words(*kept(shape, keep)):
        r, k, count = _counted(row + a, _bucket(hashes, 2))
        total = np.bincount(row + a, minlength=b)
        add(r, k, SCALE * np.sqrt(count / total[r]))
    for a, b, hashes, row in shingles.words(data, offsets):
        total = np.bincount(row, minlength=b - a)
        repeats = row[1:][(row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])]
        again = np.bincount(repeats, minlength=b - a)
        step = np.ceil(np.log2(1 + 64 * again / np.maximum(total, 1))).astype(np.uint64)
        add(np.arange(a, b), _bucket(step, 3), np.ones(b - a))
        strange = np.diff(np.concatenate([[0], np.cumsum(_SYMBOL[data])])[offsets[a : b + 1]])
        share = np.minimum(strange / np.maximum(total, 1), 1)
        add(np.arange(a, b), _bucket(np.zeros(b - a, np.uint64), 6), SCALE * share)
        add(np.arange(a, b), _bucket(np.minimum(np.log2(1 + total), 6).astype(np.uint64), 4), np.ones(b - a))
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    order = np.argsort(row, kind="stable")
    return row[order], np.concatenate(buckets)[order] if rows else row, np.concatenate(values)[order] if rows else row.astype(np.float32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of each bucket
    biases: np.ndarray  # of each grade from 1 on, falling


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _summed(place: np.ndarray, size: int, weights) -> np.ndarray:
    """Sums of ``weights(part)`` by place, for parts of CHUNK entries."""
    out = np.zeros(size)
    for a in range(0, len(place), CHUNK):
        part = slice(a, a + CHUNK)
        out += np.bincount(place[part], weights=weights(part), minlength=size)
    return out


def fit(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, grade: np.ndarray) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam over the whole sample. Entries are
    kept in 12 bytes each and widened part by part."""
    n, top = len(grade), GRADES - 1
    support = _summed(bucket, BUCKETS, lambda part: None)
    used = np.flatnonzero(support >= SUPPORT)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    col = place[bucket]
    keep = col >= 0
    row, col, value = row[keep].astype(np.int32), col[keep], value[keep].astype(np.float32)
    share = np.array([np.clip((grade >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, GRADES)])
    start = np.log(share / (1 - share))
    # the first bias, and the logarithms of the falls to the next ones
    p = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(start[:-1] - start[1:], 0.05))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, STEPS + 1):
        w, b0, falls = p[: len(used)], p[len(used)], np.exp(p[len(used) + 1 :])
        biases = b0 - np.concatenate([[0], np.cumsum(falls)])
        eta = _summed(row, n, lambda part: value[part] * w[col[part]])
        tail = np.concatenate([np.ones((n, 1)), _sigmoid(eta[:, None] + biases), np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        low, high = tail[at, grade], tail[at, grade + 1]
        slope_low, slope_high = low * (1 - low), high * (1 - high)
        chance = np.maximum(low - high, 1e-12)
        g_eta = -(slope_low - slope_high) / chance / n
        g_bias = np.zeros(top)
        np.add.at(g_bias, grade[grade > 0] - 1, (-slope_low / chance / n)[grade > 0])
        np.add.at(g_bias, grade[grade < top], (slope_high / chance / n)[grade < top])
        g = np.concatenate([
            _summed(col, len(used), lambda part: value[part] * g_eta[row[part]]) + PENALTY * w,
            [g_bias.sum()], -falls * np.cumsum(g_bias[::-1])[::-1][1:],
        ])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (1 - t / (STEPS + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = p[: len(used)]
    falls = np.exp(p[len(used) + 1 :])
    return Model(weights, p[len(used)] - np.concatenate([[0], np.cumsum(falls)]))


def grades(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` of the rated documents: 0 if toxic, else 1 plus the quality. Rows
    with a null are left out; of several ratings the lowest counts."""
    toxic, quality = F.col("toxic").cast("int"), F.col("quality").cast("int")
    rated = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    grade = F.when(toxic > 0, 0).otherwise(F.when(quality > 0, 2).otherwise(1))
    return rated.select(F.col("doc_id").cast("long"), grade.alias("grade")).groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, rated: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from at most ``sample`` documents of ``rated`` (``doc_id, grade``). None
    without any, or if all have one grade."""
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def extract(batches):
        for batch in batches:
            for a, b in _slices(batch.column("text")):
                row, bucket, value = features(batch.column("text").slice(a, b - a))
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b - a))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grade").slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value))], ["grade", "buckets", "values"])

    texts = docs.filter("text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # the sample's ids have a stated bound; the limit keeps repeated documents within it too,
    # after the features are taken where the texts are read
    some = texts.join(F.broadcast(chosen), "doc_id").select("grade", "text")
    got = some.mapInArrow(extract, "grade int, buckets array<int>, values array<float>").limit(sample).toArrow()
    if not got.num_rows or len(set(got.column("grade").to_pylist())) < 2:
        return None
    grade = got.column("grade").to_numpy().astype(np.int64)
    size = np.concatenate([c.value_lengths().to_numpy() for c in got.column("buckets").chunks])
    row = np.repeat(np.arange(len(size), dtype=np.int32), size)
    bucket = np.concatenate([c.flatten().to_numpy() for c in got.column("buckets").chunks])
    value = np.concatenate([c.flatten().to_numpy() for c in got.column("values").chunks])
    del got
    return fit(row, bucket, value, grade)


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with a bounded number of bytes (or one row)."""
    a, size = 0, utf8_of(column)[1]
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(size, size[a] + (1 << 19), "right")) - 1)
        yield a, b
        a = b


def _tails(column: pa.Array, model: Model) -> np.ndarray:
    """P(grade >= k) for k = 1 and up of each text."""
    eta = np.zeros(len(column))
    for a, b in _slices(column):
        row, bucket, value = features(column.slice(a, b - a))
        eta[a:b] = np.bincount(row, weights=value * model.weights[bucket], minlength=b - a)
    return _sigmoid(eta[:, None] + model.biases)


def rate(docs: DataFrame, model: Model | None, select: float = SELECT) -> DataFrame:
    """``doc_id, expected_grade, p_not_toxic, p_good, selected`` of each row of ``docs``.

    Null and empty texts are rated by the biases and their empty features. Without a model
    the numbers are null and every document is selected.
    """
    names = ["doc_id", "expected_grade", "p_not_toxic", "p_good", "selected"]
    schema = "doc_id long, expected_grade double, p_not_toxic double, p_good double, selected boolean"
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if model is None:
        nothing = F.lit(None).cast("double")
        return docs.select("doc_id", *(nothing.alias(n) for n in names[1:4]), F.lit(True).alias("selected"))

    def score(batches):
        for batch in batches:
            tail = _tails(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(tail.sum(axis=1)), pa.array(tail[:, 0]), pa.array(tail[:, -1]), pa.array(tail[:, -1] >= select)], names)

    return docs.mapInArrow(score, schema)


def selected(docs: DataFrame, model: Model | None, select: float = SELECT) -> DataFrame:
    """The selected rows of ``docs``, with all columns; without a model all of them."""
    at = docs.columns.index("text")
    if model is None:
        return docs

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(_tails(batch.column(at), model)[:, -1] >= select))

    return docs.mapInArrow(keep, docs.schema)


def rate_by_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return rate(docs, train(docs, grades(labels)))
