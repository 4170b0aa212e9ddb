"""Best-fit packing of documents into token sequences, certified by lower bounds.

Documents are encoded where they are read; only piece lengths and checksums travel.
Pieces are dealt to partitions of bounded size by a row number's hash. Each partition
runs best-fit decreasing, and a family of dual feasible functions bounds from below how
many sequences all pieces need. While there are more, all partitions keep their full
sequences and put the pieces of those with gaps into a pool, which is dealt anew to fewer
partitions and packed again, as long as this saves sequences. The bound certifies the result.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.common import BLANKS, DIGITS, LETTERS, Memo, file_bytes, is_latin, loaded, spans_of, texts_of
from tabulyst.session import stage

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs at a time.
PER_PART = 4096
#: Free places over which a sequence gives its pieces to the pool: first those with much room, then all.
FLOORS = (8, 0)
#: Words whose ids a Python worker remembers.
MEMO_WORDS = 300_000
#: Characters whose words are told apart at once.
BLOCK = 2_000_000
#: Words that are merged in one call.
TOGETHER = 1000
#: Kinds of characters in Latin-1.
BLANK, LETTER, DIGIT, OTHER = range(4)
#: What follows an apostrophe to make a word with it.
SINGLE, DOUBLE = [ord(c) for c in "stmd"], [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _blocks(text: str, most: int = BLOCK) -> Iterator[str]:
    """``text`` cut after spaces into blocks of up to ``most`` characters, or of one part."""
    at = 0
    while len(text) - at > most:
        end = text.rfind(" ", at, at + most) + 1 or text.find(" ", at + most) + 1 or len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class WordEncoder:
    """Ids of texts by a vocabulary that drops white space before it merges, as a lower-cased
    word vocabulary with byte letters does. No token then crosses a space or a line end, so
    the parts between them are encoded on their own. Parts in Latin-1 are a byte a character: they
    are lowered and cut into words by tables, and only a block's distinct words are merged by the
    library, each one once. All other parts, and those with special strings, pass through it whole."""

    def __init__(self, vocabulary: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        #: by word (bytes) or whole part (text)
        self.memo = Memo(MEMO_WORDS)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        latin = [chr(b) for b in range(256)]
        self.lower = "".join(latin).lower().encode("latin-1")
        kinds = {BLANK: BLANKS, LETTER: LETTERS, DIGIT: DIGITS}
        self.kind = np.array([next((k for k, some in kinds.items() if re.fullmatch(f"[{some}]", c)), OTHER) for c in latin], np.uint8)
        # byte letters: bytes that print stand for themselves, the others follow 255 in order
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letter = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}
        #: whether the words below give what the library gives, on a text that tries them
        trial = "It's a naïve Café, ÀÉÎ 12½ __x__ 'S'll don't\x01 a'b'dd ''s'retry \xad£9²"
        self.merge = self.tokenizer.model.tokenize
        #: the merges alone, of words between spaces, and whether a token ends a word
        self.joined = Tokenizer(self.tokenizer.model)
        self.joined.pre_tokenizer = CharDelimiterSplit(" ")
        names, end = self.joined.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(names.values(), default=0) + 1, bool)
        self.last[[i for name, i in names.items() if end and name.endswith(end)]] = True
        self.apart = True
        self.apart = self([trial])[0] == _packed(self._whole(trial))

    def _whole(self, part: str) -> list[int]:
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def _letters(self, word: bytes) -> str:
        letters = word.decode("latin-1")
        if not letters.isascii() or not letters.isprintable():
            letters = "".join([self.letter[b] for b in letters.encode()])
        return letters

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word. Many are merged in one call, where the tokens that end a word tell
        them apart; if they don't, one at a time."""
        letters = [self._letters(w) for w in words]
        ids = np.array(self.joined.encode(" ".join(letters), add_special_tokens=False).ids, "<u4")
        stops = np.flatnonzero(self.last[ids]) + 1
        if len(stops) != len(words) or stops[-1:].tolist() != [len(ids)]:
            return [_packed([t.id for t in self.merge(w)]) for w in letters]
        blob, stops = ids.tobytes(), (4 * stops).tolist()
        return [blob[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def _plain(self, part: str) -> bool:
        return self.apart and is_latin(part) and not any(t in part for t in self.special)

    def _words(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words and blanks of texts in Latin-1, in order, and where each text's begin."""
        texts = [t.encode("latin-1") + b"\n" for t in texts]
        starts = np.cumsum([0, *map(len, texts)])
        data = b"".join(texts).translate(self.lower)
        points = np.frombuffer(data, np.uint8)
        kind = self.kind[points]
        first = np.ones(len(kind) + 1, bool)  # whether a word begins here
        first[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        first[starts] = True
        # 's, 't, 're, 've, 'm, 'll and 'd are words, where a word begins; a text ends with a blank
        at = np.flatnonzero((points == ord("'")) & first[:-1])
        one, two = points[at + 1], points[np.minimum(at + 2, len(points) - 1)]
        single, double = np.isin(one, SINGLE), reduce(np.logical_or, [(one == a) & (two == b) for a, b in DOUBLE])
        first[at[single | double] + 1] = False
        first[at[single] + 2] = True
        first[at[double] + 3] = True
        ends = np.flatnonzero(first)
        buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
        words = pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)
        return words.dictionary_encode(), np.searchsorted(ends, starts)

    def _latin(self, texts: list[str]) -> list[bytes]:
        words, starts = self._words(texts)
        distinct, memo = words.dictionary.to_pylist(), self.memo
        new = memo.missing(set(distinct))
        for a in range(0, len(new), TOGETHER):
            some = [w for w in new[a : a + TOGETHER] if self.kind[w[0]] != BLANK]
            memo.update(zip(some, self._merged(some), strict=True))
        # blanks have no ids
        coded = pa.array([memo.get(w, b"") for w in distinct], pa.large_binary()).take(words.indices)
        _, ends, ids = coded.buffers()
        stops = np.frombuffer(ends, np.int64)[starts].tolist()
        ids = memoryview(ids)
        return [ids[a:b].tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        plain, places = [], []  # blocks in Latin-1; for each text the places of its blocks, and its other parts
        for t in texts:
            mine = []
            for is_plain, parts in [(True, [t])] if self._plain(t) else groupby(t.replace("\n", " ").split(" "), self._plain):
                if is_plain:
                    some = list(_blocks(" ".join(parts)))
                    mine += range(len(plain), len(plain) + len(some))
                    plain += some
                else:
                    mine += parts
            places.append(mine)
        coded = [ids for a, b in spans_of(plain, BLOCK) for ids in self._latin(plain[a:b])]
        memo = self.memo
        for p in memo.missing({x for mine in places for x in mine if isinstance(x, str)}):
            memo[p] = _packed(self._whole(p))
        return [b"".join([memo[x] if isinstance(x, str) else coded[x] for x in mine]) for mine in places]


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents: ``doc_id, piece, start, length, ids_crc32``.

    A document is its ids and the end id. Null and empty texts are the end id alone. A
    document over ``capacity`` is cut into pieces of that length and a rest. Rows are taken
    as they are: a repeated row or null doc_id gives pieces of its own.
    """
    vocabulary = file_bytes(vocabulary_path)
    key, end = zlib.crc32(vocabulary), np.array([END_ID], "<u4").tobytes()

    def cut(batches):
        encoder = loaded(("packing", key), lambda: WordEncoder(vocabulary))
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc_id")
            for a, b in spans_of(texts, BLOCK):
                row, piece, start, length, crc = [], [], [], [], []
                for i, blob in enumerate(encoder(texts[a:b]), a):
                    blob += end
                    for k, at in enumerate(range(0, len(blob), 4 * capacity)):
                        part = blob[at : at + 4 * capacity]
                        row.append(i), piece.append(k), start.append(at // 4)
                        length.append(len(part) // 4), crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length under best-fit decreasing: the fullest bin with room."""
    order = np.argsort(-lengths, kind="stable")
    bins, free = np.empty(len(lengths), np.int64), []
    of: dict[int, list[int]] = {}
    count = 0
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        k = bisect.bisect_left(free, n)
        if k == len(free):
            b, left = count, capacity - n
            count += 1
        else:
            room = free[k]
            b = of[room].pop()
            if not of[room]:
                del of[room], free[k]
            left = room - n
        bins[i] = b
        if left:
            if left not in of:
                bisect.insort(free, left)
                of[left] = []
            of[left].append(b)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the largest sum over two families of dual feasible
    functions. The first rounds lengths over ``capacity - e`` up and those under e down to
    nothing, for every e to half the capacity; the second rounds to multiples of 1/k."""
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of_counts(counts: np.ndarray, capacity: int) -> int:
    """The bound from how many pieces have each length from 0 to ``capacity``."""
    x = np.arange(capacity + 1, dtype=np.int64)
    total, many = np.cumsum(counts * x), np.cumsum(counts)
    e = np.arange(0, capacity // 2 + 1)
    least = np.where(e > 0, total[np.maximum(e - 1, 0)], 0)
    first = capacity * (many[-1] - many[capacity - e]) + total[capacity - e] - least
    best = -(-int(first.max()) // capacity)
    for k in range(1, 33):
        whole, rest = np.divmod(x * (k + 1), capacity)
        value = np.where(rest == 0, x * k, whole * capacity)  # times k, to stay whole
        best = max(best, -(-int((value * counts).sum()) // (capacity * k)))
    return best


def least_sequences(lengths: DataFrame, capacity: int = CAPACITY) -> int:
    """The dual feasible bound over all pieces, from one count for each length."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in lengths.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[r["length"]] = r["n"]
    return bound_of_counts(counts, capacity)


def pack(lengths: DataFrame, capacity: int = CAPACITY, per_part: int = PER_PART) -> DataFrame:
    """``lengths`` (a column ``length`` of 1 to ``capacity``, any others) with
    ``sequence_id`` and ``offset``. Each sequence is filled without gaps from offset 0.
    An empty table gives an empty result. Ties break by row number, so a packing of the
    same staged rows repeats."""
    names = lengths.columns
    rows = stage(lengths.withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    schema = f"{rows.schema.simpleString()[7:-1].replace(':', ' ')}, sequence_id long, offset long, _free long, _first boolean"

    def packing(number: int):
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("_uid", kind="stable")
            size = part["length"].to_numpy(np.int64)
            bins = best_fit(size, capacity)
            load = np.bincount(bins, weights=size).astype(np.int64)
            order = np.lexsort((part["_uid"].to_numpy(), bins))
            out, size, bins = part.iloc[order].drop(columns="_part"), size[order], bins[order]
            new = np.r_[True, bins[1:] != bins[:-1]]
            before = np.cumsum(size) - size
            return out.assign(
                sequence_id=(number << 56) + (int(part["_part"].iloc[0]) << 24) + bins,
                offset=before - np.maximum.accumulate(np.where(new, before, 0)), _free=capacity - load[bins], _first=new,
            )

        return run

    def packed(pool: DataFrame, count: int, number: int) -> tuple[DataFrame, int]:
        dealt = pool.withColumn("_part", F.pmod(F.xxhash64("_uid", F.lit(number)), F.lit(max(1, math.ceil(count / per_part)))))
        found = stage(dealt.groupBy("_part").applyInPandas(packing(number), schema), "packed")
        return found, found.agg(F.count_if("_first").alias("n")).first()["n"]

    bound, number = least_sequences(rows, capacity), 0
    first, bins = packed(rows, rows.count(), number)
    kept = [first]
    for floor in FLOORS:
        while bins > bound:
            pool = reduce(DataFrame.unionByName, [k.filter(F.col("_free") > floor) for k in kept])
            open_ = pool.agg(F.count("*").alias("pieces"), F.count_if("_first").alias("bins")).first()
            if open_["bins"] < 2:
                break
            number += 1
            again, used = packed(pool.select(*rows.columns), open_["pieces"], number)
            if used >= open_["bins"]:
                break  # the exchange saved nothing
            kept = [k.filter(F.col("_free") <= floor) for k in kept] + [again]
            bins -= open_["bins"] - used
    return reduce(DataFrame.unionByName, kept).select(*names, "sequence_id", "offset")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: the sequences used, the pieces' total length, the dual feasible bound (no
    packing has fewer sequences than ``at_least``) and the sequences with free places."""
    bound = least_sequences(packed, capacity)
    loads = packed.groupBy("sequence_id").agg(F.sum("length").alias("load"))
    return loads.agg(
        F.count("*").alias("sequences"), F.coalesce(F.sum("load"), F.lit(0)).alias("total"),
        F.lit(bound).cast("long").alias("at_least"), F.count_if(F.col("load") < capacity).alias("with_gaps"),
    )


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, vocabulary_path, capacity), capacity)
