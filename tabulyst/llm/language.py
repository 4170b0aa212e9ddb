"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A trigram's vector binds (multiplies)
its letters' vectors, permuted (rolled) by their places; a document's vector bundles (adds)
its trigrams' vectors and is scaled to length 1. The bundle of a language's training
documents is its prototype, and a document gets the language of the nearest prototype by
cosine. Letters are lower-cased; other characters between them count as one blank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.common import loaded, mixed, spans_of, texts_of

WIDTH = 512
UNKNOWN = "und"
#: A text whose cosine is lower than this, or than texts with as many trigrams in a known
#: language have by so many deviations, whichever is less, is in no known language.
LEAST_SCORE, DEVIATIONS = 0.25, 5.0
#: Training documents that a deviation is taken from, at least.
TAUGHT = 30
#: Characters worked on at once.
BLOCK = 300_000
#: Training vectors are summed as whole numbers of this fraction, in any order alike.
UNIT = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Documents kept for testing: crc32 of the id's decimal text is 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _alphabet() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def letter_vectors(letters: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The vectors of code points; 0 is the blank between words."""
    words = np.arange(1, width // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = mixed(mixed(letters.astype(np.uint64) + np.uint64(1))[:, None] + words[None, :])
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) << 1) - 1


def _numbered(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the place of each key among them."""
    if size > 1 << 22:
        return np.unique(keys, return_inverse=True)
    there = np.zeros(size, bool)
    there[keys] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[keys]


def _trigrams(texts: list[str], alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of a block of texts, and the trigrams as (text, key) pairs."""
    texts = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    symbol = np.where(alphabet[points], points, 0)
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] != 0) | (symbol[:-1] != 0) | (owner[1:] != owner[:-1])
    symbol, owner = symbol[keep], owner[keep]
    letters, place = _numbered(symbol, 0x110000)
    same = (owner[2:] == owner[:-2]) & (symbol[1:-1] != 0)  # a text has blanks at both ends
    size = len(letters)
    key = (place[:-2] * size + place[1:-1]) * size + place[2:]
    return letters, owner[:-2][same], key[same]


def document_vectors(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """A unit vector for each text (zero if it has no letter), and whether it has one."""
    out, many = counted_vectors(texts, width)
    return out, many > 0


def counted_vectors(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """A unit vector for each text (zero if it has no letter), and its number of trigrams."""
    alphabet = loaded("alphabet", _alphabet)
    out, many = np.zeros((len(texts), width), np.float32), np.zeros(len(texts), np.int64)
    if not texts:
        return out, many
    letters, owner, key = _trigrams(texts, alphabet)
    if not len(key):
        return out, many
    many = np.bincount(owner, minlength=len(texts))
    size, vectors = len(letters), letter_vectors(letters, width)
    grams, place = _numbered(key, size**3)
    first, second = np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1)
    step = max(1, 16_000_000 // max(width, len(texts)))
    for a in range(0, len(grams), step):  # a bounded number of trigrams at a time
        g = grams[a : a + step]
        bound = first[g // (size * size)] * second[g // size % size] * vectors[g % size]
        mine = (place >= a) & (place < a + len(g))
        counts = np.bincount(owner[mine] * len(g) + place[mine] - a, minlength=len(texts) * len(g))
        out += counts.reshape(len(texts), len(g)).astype(np.float32) @ bound.astype(np.float32)
    length = np.linalg.norm(out.astype(np.float64), axis=1)
    return (out / np.where(length > 0, length, 1)[:, None]).astype(np.float32), many


def _blocks(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for a, b in spans_of(texts, BLOCK):
        yield a, b, *document_vectors(texts[a:b])


def _counted(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for a, b in spans_of(texts, BLOCK):
        yield a, b, *counted_vectors(texts[a:b])


def _size(many: np.ndarray) -> np.ndarray:
    """Texts of one size have as many trigrams to within a factor of two."""
    return np.where(many > 0, np.log2(np.maximum(many, 1)).astype(np.int64), -1)


def prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """A unit vector for each language, from rows ``text, lang``; rows without a language
    or letters teach nothing. Each task sends one sum per language."""

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = texts_of(batch), np.array(batch.column("lang").to_pylist(), object)
            for a, b, vectors, some in _blocks(texts):
                whole = np.rint(vectors * UNIT).astype(np.int64)
                for lang in sorted(set(langs[a:b][some])):
                    mine = whole[some & (langs[a:b] == lang)].sum(axis=0)
                    sums[lang] = sums.get(lang, 0) + mine
        rows = [{"lang": lang, "sums": v.tolist()} for lang, v in sums.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("lang", pa.string()), ("sums", pa.list_(pa.int64()))]))

    parts = docs.filter("text is not null and lang is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    parts = parts.mapInArrow(bundle, "lang string, sums array<long>")
    summed = parts.select("lang", F.posexplode("sums").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():  # languages times the fixed width
        out.setdefault(r["lang"], np.zeros(WIDTH))[r["i"]] = r["x"]
    return {k: v / n for k, v in sorted(out.items()) if (n := np.linalg.norm(v)) > 0}


def classified(docs: DataFrame, known: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id, lang_pred, score``: the nearest language (the alphabetically first of
    equals) and its cosine, not under 0. Texts that are null or without letters, and all
    texts if no language is known, are ``und`` with score 0."""
    names = sorted(known)
    table = np.array([known[n] for n in names], np.float32).reshape(len(names), WIDTH)

    def classify(batches):
        for batch in batches:
            langs, scores = [], []
            for _, _, vectors, some in _blocks(texts_of(batch)):
                cosines = vectors @ table.T if names else np.zeros((len(vectors), 1))
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(len(best)), best], 0, 1).astype(np.float64)
                ok = some & bool(names)
                langs += [names[k] if y else UNKNOWN for k, y in zip(best, ok, strict=True)]
                scores += np.where(ok, score, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(classify, "doc_id long, lang_pred string, score double")


def _table(known: dict[str, np.ndarray]) -> np.ndarray:
    return np.array([known[n] for n in sorted(known)], np.float32).reshape(len(known), WIDTH)


def least_scores(docs: DataFrame, known: dict[str, np.ndarray], least: float = LEAST_SCORE) -> np.ndarray:
    """The least cosine of a text in a known language, by its size: the mean of the documents
    with a language less DEVIATIONS times their deviation, and not over ``least``. A size with too few documents
    takes the bar of the next larger one, lower by the root of two for each halving; sizes above
    all that have enough take ``least``. Each task sends three sums per size."""
    table = _table(known)

    def measure(batches):
        sums = np.zeros((3, 64))
        for batch in batches:
            for _, _, vectors, many in _counted(texts_of(batch)):
                best, size = (vectors @ table.T).max(axis=1).astype(np.float64), _size(many)
                some = size >= 0
                for k in range(3):
                    sums[k] += np.bincount(size[some], weights=best[some] ** k, minlength=64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(64, dtype=np.int32)), *(pa.array(x) for x in sums)], ["size", "n", "s", "q"])

    out = np.full(64, least)
    if not known:
        return out
    taught = docs.filter("text is not null and lang is not null").select(F.col("text").cast("string"))
    # a task sends a row for each of 64 sizes
    parts = taught.mapInArrow(measure, "size int, n double, s double, q double").groupBy("size").agg(*(F.sum(c).alias(c) for c in "nsq"))
    found = {r["size"]: r for r in parts.collect()}
    bar = None
    for size in range(63, -1, -1):
        r = found.get(size)
        if r and r["n"] >= TAUGHT:
            mean = r["s"] / r["n"]
            bar = mean - DEVIATIONS * max(0.0, r["q"] / r["n"] - mean * mean) ** 0.5
        elif bar is not None:
            bar /= 2**0.5
        out[size] = least if bar is None else min(least, bar)
    return out


def accepted(docs: DataFrame, known: dict[str, np.ndarray], bars: np.ndarray | None = None) -> DataFrame:
    """The rows of ``docs``, with all columns, that are in a known language: those without
    letters go, and texts whose cosine is under the bar of their size (``least_scores``, of
    ``docs`` if none are given)."""
    bars = least_scores(docs, known) if bars is None else bars
    at, table = docs.columns.index("text"), _table(known)

    def accept(batches):
        for batch in batches:
            texts, keep = texts_of(batch.rename_columns([f"c{i}" for i in range(batch.num_columns)]), f"c{at}"), []
            for a, b, vectors, many in _counted(texts):
                best = (vectors @ table.T).max(axis=1) if len(table) else np.ones(b - a)
                keep += ((many > 0) & (best >= bars[_size(many)])).tolist()
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(accept, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each row of ``docs``; what is not held out
    and has a language teaches. Null doc_ids neither teach nor are held out. Repeated
    rows are taken as they are."""
    training = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("text", "lang")
    found = classified(docs, prototypes(training))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
