"""The corpus pipeline: five stages of the llm subpackage over documents, in a fixed order.

Each stage takes (spark, docs, sf_dir), works on every row of docs and returns a DataFrame; the result is written as
Parquet and read again as the next stage's docs.  All but the last return the columns of documents.

1 toxicity: documents that the grammar learned from labels marks toxic go.
2 near_duplicates: of each class of linked or equal texts the document that is first by doc_id and text stays.
3 secrets: every secret found in a text is replaced by a mark of its kind.
4 mixing: every document is repeated as often as the mix takes it; documents are kept whole.
5 bpe: doc_id, n_tokens, ids and decoded text of each row.

Null texts are empty texts from the third stage on.  Different texts with one doc_id, or none, are different documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.llm import bpe, mixing, nearjoin, secretscan, toxicity
from helicase.llm.common import discard, shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    grammar = toxicity.learned(labelled, labels)
    found = toxicity.scored(docs, grammar, docs.columns, names=("_toxicity", "_toxic"))
    return found.where("_toxic = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearjoin.representatives(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secretscan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(bpe.VOCABULARY), ("n_tokens", "ids", "decoded"), keep=["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can express neither the learned grammar nor guess costs and merges; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS), None
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            discard(spark, last)
        last = path
    return docs
