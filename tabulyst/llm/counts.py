"""Token counts through a digest cache.

The cache is a parquet table of (tokenizer digest, content digest, token count). Texts
are digested where they are read. One text of each digest that the cache lacks is encoded,
the new counts are appended, and every document gets its count by a join on the digest.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulyst.llm.common import Memo, file_bytes, loaded, spans_of, texts_of
from tabulyst.session import stage, staging_dir

LIMIT = 4096
MEMO_WORDS = 400_000
CACHE = "tokenizer string, digest string, n_tokens long"


def _pieces(model: bytes):
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor(model_proto=model)
    names = [made.id_to_piece(i) for i in range(made.get_piece_size())]
    # word by word is exact where spaces only begin pieces and line ends are in none
    apart = not any("▁" in n.lstrip("▁") or "\n" in n for n in names)
    apart = apart and made.encode("a  b") == made.encode("a") + made.encode(" b") and len(made.encode("\n")) == 2
    return made, Memo(MEMO_WORDS), apart


def _json(vocabulary: bytes):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary.decode())


def piece_counts(texts: list[str], model, memo: Memo, apart: bool) -> list[int]:
    """Tokens of each text. The words between single spaces and the words that begin a
    line are counted once each; a text with runs of spaces or NUL is encoded whole."""
    counts, some = [0] * len(texts), []
    for i, t in enumerate(texts):
        if not t or not apart or "  " in t or " \n" in t or "\n " in t or t[0] == " " or t[-1] == " " or "\x00" in t or "▁" in t:
            counts[i] = len(model.encode(t, num_threads=1)) if t else 0
        else:
            some.append((i, t.replace("\n", " \n").split(" ")))
    seen = {w for _, words in some for w in words}
    new = memo.missing(seen)
    # a word after a line end has no space before it: the one put there is not counted,
    # but at the very start of a text, where the model puts one itself
    for w, ids in zip(new, model.encode(new, num_threads=1), strict=True):
        memo[w] = len(ids) - (w[:1] == "\n")
    for i, words in some:
        counts[i] = sum(map(memo.__getitem__, words)) + (not words[0])
    return counts


def counted(texts: DataFrame, vocabulary_path: str) -> DataFrame:
    """``digest, n_tokens`` of a table ``digest, text``, as the tokenizer's library counts."""
    vocabulary = file_bytes(vocabulary_path)
    key, pieced = hashlib.sha256(vocabulary).hexdigest(), vocabulary_path.endswith(".model")

    def count(batches):
        if pieced:
            model, memo, apart = loaded(("counts", key), lambda: _pieces(vocabulary))
        else:
            tokenizer = loaded(("counts", key), lambda: _json(vocabulary))
        for batch in batches:
            some = texts_of(batch)
            numbers: list[int] = []
            for a, b in spans_of(some, 1_000_000):
                if pieced:
                    numbers += piece_counts(some[a:b], model, memo, apart)
                else:
                    numbers += [len(e.ids) for e in tokenizer.encode_batch(some[a:b], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(numbers, pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(count, "digest string, n_tokens long")


def _cached(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    try:
        found = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return None
    return found.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, vocabulary_path: str, cache_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row of ``docs``.

    ``cache_path`` names a cache that later calls share; without one a new cache is made
    in the shared folder. Null and empty texts have 0 bytes and 0 tokens. Rows with one
    text share a count; repeated rows and null doc_ids are kept as they are.
    """
    spark = docs.sparkSession
    path = cache_path or f"{staging_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    version = hashlib.sha256(file_bytes(vocabulary_path)).hexdigest()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digested = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"))
    keyed = stage(digested.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "digests")
    known, misses = _cached(spark, path, version), digested.select("digest", "text")
    if known is not None:
        missing = stage(keyed.select("digest").distinct().join(known, "digest", "left_anti"), "missing")
        misses = misses.join(missing, "digest", "left_semi")
    once = misses.groupBy("digest").agg(F.first("text").alias("text"))
    new = counted(once, vocabulary_path).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
    new.write.mode("append").parquet(path)
    counts = stage(_cached(spark, path, version), "counts")
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
