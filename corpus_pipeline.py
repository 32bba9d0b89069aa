"""From raw documents to a training mix: every stage is one operator, written and read again.

All decisions of a stage take effect for the next one. The stages but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fadecast.llm import common, decontaminate, linededup, mixing, neardup, quality

STAGES = [
    ("quality rules", quality.stage),
    ("line dedup", linededup.stage),
    ("minhash near-dedup", neardup.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("mixing to target weights", mixing.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.written(docs, f"stage{k}")
    return docs
