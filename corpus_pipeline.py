"""Corpus pipeline: stages applied to ``documents``, each written and reread by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchspark.llm import queries
from matchspark.llm.common import written
from matchspark.sources.tables import table

STAGES = [
    ("language ID", queries.stage_language),
    ("MinHash near-dedup", queries.stage_near_dedup),
    ("benchmark decontamination", queries.stage_decontamination),
    ("secret scans", queries.stage_secrets),
    ("best-fit packing", queries.stage_packing),
]
#: Learnt language and secret models, minhashes and the tokenizer are outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table; each one's rows are written and
    read again as the next one's input, so none is computed twice."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
