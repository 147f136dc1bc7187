"""The training-data pipeline over documents: toxicity, quality rules, near-duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; docs has the columns of
documents. The stages but the last return these columns; the last returns the token ids' digests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import bpe, minhash, mixing, rules, toxicity
from loamline.llm.common import crc_of_id, read, shared_dir
from loamline.llm.queries import TOKENIZERS

#: Share of the tokens that reach the mixing stage and stay, in expectation.
SHARE = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3, by a model that learns from the labels with crc32(doc_id) mod 4 other than 2."""
    lexicon, forest = toxicity.train(docs, read(spark, sf_dir, "labels"), crc_of_id(F.col("doc_id")) % 4 != 2)
    return toxicity.score(docs, lexicon, forest).where("predicted = 0").select(docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass policy v1 of the rule ledger."""
    return rules.apply_policy(rules.ledger(docs), "v1").where("kept").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each class of near-duplicates (5-word shingles, 0.8)."""
    return minhash.drop_near_duplicates(docs, minhash.Settings(shingle=5, percent=80)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected source, language and topic marginals meet the targets as far as SHARE leaves them reachable."""
    return mixing.mix(docs, SHARE, capped=True).where("kept").select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of every document."""
    path = f"{TOKENIZERS}/byte_bpe_50k.json"
    encoded = bpe.encode(docs, path, keep=["doc_id"], decoded="decoded")
    return bpe.digests(encoded.withColumn("token_ids", F.col("ids"))).select("doc_id", "n_tokens", F.col("token_ids").alias("ids"), "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: Trees, minima and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; what each stage keeps is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/loamline/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
