"""Corpus preparation: toxic documents go, repeated lines go, one of each group of near-duplicates
stays, contaminated documents go, and what is left is packed into training sequences.

Every stage takes (spark, docs, sf_dir) and gets what its predecessor kept; all but the last
return the columns of documents. Each stage's operator states how it treats nulls, empty and
repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenflow.llm import decontaminate, line_dedup, packing, simhash, toxicity
from lumenflow.llm._common import store, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", line_dedup_stage), ("near dedup", near_dedup), ("decontamination", decontaminate_stage), ("packing", pack)]

#: The toxicity stage is a trained network, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what each hands on is written once, as later stages read it several times."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else store(docs), sf_dir)
    return docs
