"""The corpus pipeline: five stages over ``documents``.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept
and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lagjoin.llm import bpe, decontaminate, jaccard, langid, secrets
from lagjoin.llm.shared import table, written

STAGES = [
    ("language_id", langid.stage),
    ("near_duplicates", jaccard.stage),
    ("decontamination", decontaminate.stage),
    ("secret_scan", secrets.stage),
    ("bpe", bpe.stage),
]

#: No SQL: language inference, MinHash and BPE are not expressible in it; the
#: stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
