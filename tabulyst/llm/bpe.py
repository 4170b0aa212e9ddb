"""Byte-level BPE by a global shuffle of distinct words.

1. The texts are cut into pre-tokens where they are read. A chunk of documents keeps its
   distinct words once, dealt to buckets by a hash, and the places of the words in its
   documents as numbers into that list. Both are written to the shared folder.
2. The words, not the documents, are shuffled by bucket. All chunks' lists of a bucket meet in
   one task, which keeps a table of the bucket's distinct words and merges each word's bytes
   once; the table goes when the bucket ends.
3. The ids return to their chunk, where documents are put together by place. The places were written
   bucketed by chunk, so they stay where they are.

Decoding looks ids up in the token-byte table, whose size is that of the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.common import BLANKS, DIGITS, LETTERS, file_bytes, is_latin, loaded, texts_of
from tabulyst.session import staging_dir

#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same with plain classes, for texts in Latin-1: twice as fast.
LATIN = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{BLANKS}{LETTERS}{DIGITS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
#: Pre-tokens of a chunk; a longer document is a chunk of its own.
CHUNK = 1_000_000
#: Pre-tokens whose places are packed into one row.
SLICE = 250_000

CHUNKS = "chunk long, bucket int, words binary, lengths binary, slice int, doc_ids array<long>, counts array<int>, places binary, dealt binary"


def ranks_of(data: bytes) -> dict[bytes, int]:
    """The ranks of a vocabulary file: one base64 token and its rank on each line."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


def _encoding(data: bytes):
    """The merges of a vocabulary for one word at a time: its pattern takes words whole."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str="(?s:.+)", mergeable_ranks=ranks_of(data), special_tokens={})


class _Index(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as byte planes, compressed."""
    import zstandard

    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _numbers(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return planes.T.copy().view("<u4").ravel()


def _chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of two kinds: with a bucket (a chunk's words in it) or with a slice (the places
    of some documents; the first also says to which bucket each word went)."""
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()), ("slice", pa.int32()),
                        ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("places", pa.binary()), ("dealt", pa.binary())])

    def rows_of(chunk: int, index: _Index, ids: list, places: list[np.ndarray]):
        import zstandard

        words = [w.encode() for w in index]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        dealt = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(dealt, kind="stable")
        out = []
        ends = np.cumsum(np.bincount(dealt, minlength=buckets))
        for b, (lo, hi) in enumerate(zip(ends - np.diff(ends, prepend=0), ends, strict=True)):
            if lo < hi:
                some = b"".join([words[i] for i in order[lo:hi]])
                out.append({"chunk": chunk, "bucket": b, "words": zstandard.ZstdCompressor(level=3).compress(some), "lengths": _squeezed(lengths[order[lo:hi]])})
        at = size = number = 0
        for i, p in enumerate(places):
            size += len(p)
            if size >= SLICE or i == len(places) - 1:
                some = places[at : i + 1]
                out.append({"chunk": chunk, "slice": number, "doc_ids": ids[at : i + 1], "counts": [len(x) for x in some],
                            "places": _squeezed(np.concatenate(some)), "dealt": _squeezed(dealt) if not number else None})
                at, size, number = i + 1, 0, number + 1
        return pa.RecordBatch.from_pylist(out, schema)

    def cut(batches):
        import regex
        from pyspark import TaskContext

        find, quick = regex.compile(PATTERN).findall, re.compile(LATIN).findall
        chunk = TaskContext.get().partitionId() << 32
        index, ids, places, size = _Index(), [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                found = quick(text) if is_latin(text) else find(text)
                if places and size + len(found) > CHUNK:
                    yield rows_of(chunk, index, ids, places)
                    chunk, index, ids, places, size = chunk + 1, _Index(), [], [], 0
                places.append(np.fromiter(map(index.__getitem__, found), np.uint32, len(found)))
                ids.append(doc)
                size += len(found)
        if places:
            yield rows_of(chunk, index, ids, places)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, CHUNKS)


def _encoded_words(words: DataFrame, vocabulary: bytes) -> DataFrame:
    """``chunk, bucket, ids, many``: the ids of a chunk's words and how many each has. ``words``
    are in order of bucket, and all of a bucket in one partition."""
    key = zlib.crc32(vocabulary)

    def encode(batches):
        import zstandard

        encoding = loaded(("bpe", key), lambda: _encoding(vocabulary))
        bucket, table = None, {}  # the distinct words of the bucket: where their ids begin, and how many
        for batch in batches:
            ids, many = [], []
            columns = (batch.column(c).to_pylist() for c in ("bucket", "words", "lengths"))
            for own, blob, sizes in zip(*columns, strict=True):
                if own != bucket:
                    bucket, table = own, {}
                data, ends = zstandard.ZstdDecompressor().decompress(blob), np.cumsum(_numbers(sizes)).tolist()
                got, at = [], 0
                for end in ends:
                    word = data[at:end]
                    if (some := table.get(word)) is None:
                        some = table[word] = np.array(encoding.encode_ordinary(word.decode()), "<u4").tobytes()
                    got.append(some)
                    at = end
                many.append(_squeezed(np.fromiter(map(len, got), np.uint32, len(got)) // 4))
                ids.append(_squeezed(np.frombuffer(b"".join(got), "<u4")))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("bucket"), pa.array(ids, pa.binary()), pa.array(many, pa.binary())],
                                             ["chunk", "bucket", "ids", "many"])

    return words.mapInArrow(encode, "chunk long, bucket int, ids binary, many binary")


def _bucketed(cut: DataFrame, buckets: int) -> DataFrame:
    """``cut`` written once to the shared folder, in files by chunk: a join by chunk then
    reads it in place. The table's name lasts as long as the session's catalog does."""
    spark = cut.sparkSession
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    cut.write.bucketBy(buckets, "chunk").format("parquet").option("path", f"{staging_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def _together(slices: pa.Table, coded: pa.Table) -> pa.Table:
    """The documents of one chunk."""
    slices = slices.sort_by("slice")
    dealt = _numbers(slices.column("dealt")[0].as_py()) if slices.num_rows else np.zeros(0, np.uint32)
    order = np.argsort(dealt, kind="stable")
    coded = coded.sort_by("bucket")
    flat = [_numbers(x) for x in coded.column("ids").to_pylist()]
    many = [_numbers(x) for x in coded.column("many").to_pylist()]
    flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
    by_bucket = np.concatenate(many).astype(np.int64) if many else np.zeros(0, np.int64)
    size, begin = np.empty_like(by_bucket), np.empty_like(by_bucket)
    size[order], begin[order] = by_bucket, np.cumsum(by_bucket) - by_bucket
    out = []
    for s in slices.select(["doc_ids", "counts", "places"]).to_pylist():
        places = _numbers(s["places"])
        sizes = size[places]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin[places] - (ends - sizes), sizes)
        stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(s["counts"])])]
        ids = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(flat[at].astype(np.int32)))
        out.append(pa.table({"doc_id": pa.array(s["doc_ids"], pa.int64()), "ids": ids}))
    empty = pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})
    return pa.concat_tables([empty, *out])


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, ids`` of each row of ``docs``: its whole text in ids of the rank file.

    Null and empty texts have no ids. Each row is taken as it is, with repeated and null
    doc_ids. A word common to all documents is one entry of each chunk's list.
    """
    spark = docs.sparkSession
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = _bucketed(_chunks(docs, buckets), buckets)
    words = cut.filter("bucket is not null").select("chunk", "bucket", "words", "lengths")
    coded = _encoded_words(words.repartition(buckets, "bucket").sortWithinPartitions("bucket"), file_bytes(vocabulary_path))
    slices = cut.filter("slice is not null").select("chunk", "slice", "doc_ids", "counts", "places", "dealt")
    return slices.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(_together, "doc_id long, ids array<int>")


def _table(vocabulary: bytes) -> tuple[np.ndarray, list[bytes]]:
    ranks = ranks_of(vocabulary)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table, [str(i) for i in range(len(table))]


def _each(batch: pa.RecordBatch) -> list[list[int]]:
    return [ids or [] for ids in batch.column("ids").to_pylist()]


def decode(coded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, bytes`` of a table ``doc_id, ids``; null ids give no bytes. An id that the
    table lacks fails."""
    vocabulary = file_bytes(vocabulary_path)

    def join(batches):
        table, _ = loaded(("table", zlib.crc32(vocabulary)), lambda: _table(vocabulary))
        for batch in batches:
            data = [b"".join([table[i] for i in ids]) for ids in _each(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "bytes"])

    return coded.select("doc_id", "ids").mapInArrow(join, "doc_id long, bytes binary")


def digests(coded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of a table ``doc_id, ids``: the
    ids as decimals joined by commas, and the bytes that they decode to."""
    vocabulary = file_bytes(vocabulary_path)

    def digest(batches):
        table, names = loaded(("table", zlib.crc32(vocabulary)), lambda: _table(vocabulary))
        for batch in batches:
            column = batch.column("ids")
            count, first, second = [], [], []
            for k in range(batch.num_rows):
                ids = column[k].values.to_pylist() if column[k].is_valid else []
                count.append(len(ids))
                first.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                second.append(hashlib.sha256(b"".join([table[i] for i in ids])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return coded.select("doc_id", "ids").mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
