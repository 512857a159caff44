"""Corpus pipeline: the documents table through the training-data stages, in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents.  ``run`` writes every stage's result as Parquet in the shared
checkpoint folder and rereads it for the next one, so a lost executor costs no finished stage.
The last stage adds ``repeats``: how often the mix reads the document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import decontaminate, mixing, near_dedup, pii, toxicity
from cohortlens.llm.common import documents
from cohortlens.session import ensure_checkpoint_dir
from cohortlens.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents predicted toxic go; the models are trained on this stage's documents and the labels."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near-duplicates the smallest doc_id stays."""
    return near_dedup.keep_one_per_component(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go."""
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: personal data becomes its kind in brackets."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the documents that the mix takes, with their repeats."""
    return mixing.mixed_documents(docs, read_table(spark, sf_dir, "labels"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_leaked),
          ("pii", redact_pii), ("mixing", mix_sources)]
ORACLE_SQL = None  # the toxicity model can't be expressed; tests compare run() with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    at = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        out.write.parquet(f"{at}/{k}-{name}")
        docs = spark.read.parquet(f"{at}/{k}-{name}")
