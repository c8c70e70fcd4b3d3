"""The training-data pipeline: toxicity, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; between stages documents are written and read again. All but
the last return the columns of documents.

* toxicity: documents scored 0.5 or more go.
* near_dedup: of each group of linked fingerprints the smallest doc_id stays.
* decontaminate: documents with a region of a benchmark item go.
* mix: each document as often as the mix takes it (it may go, or repeat up to
  three times), so that sources come near their target weights.
* shard: the rows with their shard and slot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wattline.llm import decontaminate, mix, shard, simhash, toxicity
from wattline.llm.common import shared_dir, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, width=3, radius=3)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mixed_documents(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard.digest(shard.shard(docs, carry=["doc_id"]))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("shard", shard_stage),
]

#: The toxicity model and the fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    out = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(f"{out}/{name}")
        docs = spark.read.schema(kept.schema).parquet(f"{out}/{name}")
    return docs
