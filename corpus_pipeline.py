"""A training-corpus pipeline over ``documents``: five stages, each written to
the shared folder and read again as the next one's input.

1. language: documents whose language cannot be told go.
2. near_duplicates: one document of each SimHash group stays.
3. decontamination: documents that hold a benchmark item go.
4. personal_data: personal data in texts is replaced by its kind.
5. tokens: texts are encoded; doc_id, n_tokens, ids and the decoded text.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotcover.llm import chunks, decontaminate, langid, pii, simhash
from plotcover.llm.bpe import default_tokenizer
from plotcover.llm.common import materialize, read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs.where(~langid.held_out()))
    return langid.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask(docs, pii.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunks.encode_documents(docs, default_tokenizer())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Stages 1 to 4 have no SQL form; the run is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
