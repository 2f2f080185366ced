"""A corpus from raw documents to tokens: five stages, each written and read by the next one.

1. language: documents without letters and those whose best language scores low go; where no
   document has a known language to learn from, all with letters stay.
2. near_duplicates: one document of each group of near copies stays, the one of smallest id.
3. passages: bytes covered by a passage of 100 bytes that occurs earlier are cut out.
4. decontaminate: documents that hold a benchmark item go.
5. tokens: ids of each remaining text, with digests that prove the way back to its bytes.

Defined cases, stage by stage; those of the operators hold besides. A null, empty or blank text has no
letter and goes in the first stage; a null doc_id takes part in no match and stays until the last
stage; rows that repeat (same id and text) are kept or dropped together; columns beyond those of
documents pass through all stages but the last, whatever their names; an empty table gives no rows.
Every stage's output is a written table of the driver's scratch folder, removed when the driver ends;
tables that only a stage needs go when it ends.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.llm import bpe, decontaminate, language, minhash, passages
from touchtrail.llm.common import importable, read_table, written

RANKS = "byte_bpe_50k.tiktoken"
# Documents whose best language scores less are rejected.
LEAST_LANGUAGE_SCORE = 0.3
# Bytes of rows that a task hands to its Python worker at once; without, 64 MB of texts lie in both.
BATCH_BYTES = 4 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """Lets workers find the package, and bounds what they get at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return importable(spark)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents at hand; keeps their columns."""
    prepared(spark)
    model = language.fit(docs)
    if model is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    texts = docs.select(
        *(F.col(name).alias(f"_{n}") for n, name in enumerate(docs.columns)),
        F.col("text").cast("string").alias("text"),
    )
    judged = language.with_language(texts, model)
    kept = judged.where(
        (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    )
    return kept.select(*(F.col(f"_{n}").alias(name) for n, name in enumerate(docs.columns)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id; ids that repeat go along."""
    prepared(spark)
    gone = minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeat; a text may become empty and stays."""
    prepared(spark)
    return passages.remove_passages(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, read_table(prepared(spark), sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and digests of every remaining text; the columns are those of the encoder."""
    prepared(spark)
    return bpe.encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language", by_language),
    ("near_duplicates", near_duplicates),
    ("passages", cut_passages),
    ("decontaminate", without_benchmark),
    ("tokens", tokens),
]

# No SQL expresses the learned and iterative stages; tests hold them against plain definitions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
