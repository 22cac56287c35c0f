"""A training corpus from documents: language, line dedup, near copies, mix, packed sequences."""

from pyspark.sql import DataFrame, SparkSession

from docflow.llm import stages
from docflow.llm.common import bounded, stage_scratch, table
from docflow.session import written

def _stage(work):
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded(spark, wide=True)
        # What the stage before wrote on its way goes: its result is written.
        with stage_scratch(spark):
            return work(docs)

    return stage

STAGES = [
    ("language_id", _stage(stages.in_a_language)),
    ("line_dedup", _stage(stages.without_common_lines)),
    ("ngram_jaccard_join", _stage(stages.one_of_each_class)),
    ("mix_sources", _stage(stages.mixed)),
    ("best_fit_packing", _stage(stages.packed)),
]

# Tokenizers and n-gram profiles are nothing that SQL can say; the stages are tested against brute force.
ORACLE_SQL = None

def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each stage's result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
