"""The registered queries of the operators, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabulyst.llm import (
    bitslices, bpe, conversations, counts, language, nearest, neardup, packing, periods, privacy, quality, sharding, warc,
)
from tabulyst.llm.common import ship, table, tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]


def _on(name: str, apply: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return apply(table(spark, folder, name))

    return query


def _rated(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return quality.rate_by_labels(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _digested(docs: DataFrame) -> DataFrame:
    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode(docs, ranks), ranks)


def registered() -> dict[str, Query]:
    return {
        "op1_language_profiles": _on("documents", language.identify),
        "op2_warc_chains": _on("pages", warc.round_trip),
        "op3_ordinal_quality": _rated,
        "op4_certified_packing": _on("documents", lambda d: packing.pack_documents(d, tokenizer_file("word_bpe_49k.json"))),
        "op5_byte_bpe": _on("documents", _digested),
        "op6_odd_sketches": _on("documents", lambda d: neardup.near_duplicates(d, size=2)),
        "op7_token_counts": _on("documents", lambda d: counts.token_counts(d, tokenizer_file("piece_bpe_32k.model"))),
        "op8_sanitisation": _on("documents", lambda d: privacy.summary(privacy.find(d))),
        "op9_cross_polytope": _on("embeddings", nearest.nearest),
        "op10_bit_slices": _on("embeddings", bitslices.top_products),
        "op11_synchronised_runs": _on("documents", lambda d: periods.run_digests(periods.periodic_runs(d, periods.repeat_tail))),
        "op12_hirschberg_repair": _on("conversations", conversations.damage_and_repair),
        "op13_feistel_shards": _on("documents", lambda d: sharding.places_by_law(d.select("doc_id", "text"))),
    }


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

OP2_SQL = f"""
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
d as (
  select page_id, cast(strlen(html) as bigint) as payload_bytes,
    array_to_string(list_transform(range(32), lambda i:
      substr({_LETTERS}, cast(((cast('0x' || substr(h, 1 + 10 * (i // 8), 10) as ubigint)
        >> cast(35 - 5 * (i % 8) as ubigint)) & 31) as bigint) + 1, 1)), '') as payload_digest
  from p),
f as (select payload_digest, min(page_id) as first from d group by payload_digest)
select page_id, payload_bytes, payload_digest,
  case when page_id <> first then 'revisit' else 'response' end as record_type,
  case when page_id <> first then first end as refers_to
from d join f using (payload_digest)
"""

OP10_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
    cast(coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
    vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""


def oracle_queries() -> dict[str, str]:
    return {"op2_warc_chains": OP2_SQL, "op10_bit_slices": OP10_SQL}
