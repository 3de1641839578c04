"""A corpus made ready for training, stage by stage.

Every stage takes what the one before kept, reads it from Parquet and decides on its own rows:
the classifier drops poor documents, exact copies keep their owner, near copies keep one
document per component, documents with benchmark passages go, and the rest is packed.

Odd rows, in every stage but the last: a null text is an empty one; rows with equal id and text
share one decision of the classifier and of the benchmark stage, while copies of a row go like
copies of any text; a null id is an id like any other and comes last in ties; further columns
stay as they are, whatever their names; an empty table gives an empty one. Packing cuts every
text that is left, an empty one being its end id alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from boxoffice.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from boxoffice.session import scratch_path


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.3 or more, learnt from the labels of the folder."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the one with the most characters."""
    return exact_dedup.drop_copies(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by n-gram similarity of 0.8 or more, directly or through others, one."""
    return jaccard_join.drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, cut into sequences of at most 2048 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1)


STAGES = [
    ("quality classifier", good),
    ("exact dedup", unique),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", clean),
    ("packing", packed),
]

#: Not expressible in SQL: a trained classifier and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
