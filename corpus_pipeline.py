"""A corpus pipeline over `documents`: each stage keeps or rewrites what the one before it kept.

Defined cases are those of the stages (caudal/llm/stages.py) and their operators: rows with null or repeated ids, null and empty
texts, repeated rows and ties are decided row by row, very long texts as a whole, extra columns are handed on up to the last
stage, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caudal.llm.shared import prepare, scope, staged, table
from caudal.llm.stages import exact, near, packed, repeats, toxic

STAGES = [
    ("toxicity", toxic),
    ("exact dedup", exact),
    ("near dedup", near),
    ("suffix dedup", repeats),
    ("packing", packed),
]

# A trained classifier and a genetic algorithm are beyond SQL; tests/llm/test_pipeline.py compares
# each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written and read back, and deleted once the next one is."""
    docs = table(prepare(spark), sf_dir, "documents")
    with scope() as work:
        for _, stage in STAGES[:-1]:
            before, docs = docs, staged(stage(spark, docs, sf_dir), "zstd")
            work.drop(before)
        return work.result(STAGES[-1][1](spark, docs, sf_dir), "zstd")
