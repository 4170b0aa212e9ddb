"""The corpus pipeline: five of the operators, one after the other, over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run``
writes what it returns to the shared folder and reads it again. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulyst.llm import language, neardup, packing, privacy, quality
from tabulyst.llm.common import ship, table, tokenizer_file
from tabulyst.session import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches; others go."""
    ship(spark)
    return language.accepted(docs, language.prototypes(docs.select("text", "lang")))


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably good, by the ratings in ``labels``; toxic and poor ones go."""
    ship(spark)
    return quality.selected(docs, quality.train(docs, quality.grades(table(spark, sf_dir, "labels"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, similarity 0.8. Rows are
    told apart by a number of their own, as doc_ids may be null or repeat; rows repeated as
    a whole are copies. Texts without words stay."""
    ship(spark)
    row = next(name for i in range(len(docs.columns) + 1) if (name := f"row_{i}") not in docs.columns)
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = neardup.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    gone = stage(found.filter("not kept").select(F.col("doc_id").alias(row)), "gone")
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data and disclosing terms replaced in its text. Null
    texts become empty; ``n_chars`` is that of the new text."""
    ship(spark)
    found = privacy.find(docs).withColumn("text", privacy.sanitised())
    own = {"n_chars": F.char_length("text").cast("long")}
    return privacy.rows_of(found, docs.columns, own)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("quality", select_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", remove_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express none of the learned and iterative stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
