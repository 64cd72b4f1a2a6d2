"""A corpus pipeline: quality, toxicity, near-duplicates, personal data, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result is written as
Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import table, written
from ledgerline.llm.packing import packing_stage
from ledgerline.llm.pii import pii_stage
from ledgerline.llm.quality import quality_stage
from ledgerline.llm.simhash import dedup_stage
from ledgerline.llm.toxicity import toxicity_stage

STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", dedup_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

#: The forests, the dictionaries and the LSTM are fitted, and SimHash and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
