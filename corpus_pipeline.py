"""From raw documents to token files: reject, deduplicate, decontaminate, mix, encode.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns the columns of
documents; the last returns what it reads back from the token files. `run` writes each stage's result to the shared
folder and rereads it, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brookhouse.llm.decontaminate import clean_documents
from brookhouse.llm.minhash import distinct_documents
from brookhouse.llm.mixing import mixed_documents
from brookhouse.llm.quality import good_documents
from brookhouse.llm.scratch import keep
from brookhouse.llm.tokens import token_table

#: Part of all tokens that the mixture may take; as no document is repeated, large sources give up the rest.
BUDGET, REPETITION = 0.9, 1.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, BUDGET, REPETITION)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_table(docs)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("tokens", tokens),
]

#: The classifier and the signatures have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = keep(docs)
    return docs
