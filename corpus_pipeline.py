"""From raw documents to packed training sequences, in five stages.

``STAGES`` names them in order; each takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next stage's ``docs``.  All but the last
keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnweave.llm.common import read, scratch
from turnweave.llm.exact_dedup import dedup_stage
from turnweave.llm.mixing import mix_stage
from turnweave.llm.near_dedup import near_stage
from turnweave.llm.packing import pack_stage
from turnweave.llm.toxicity import toxicity_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", dedup_stage),
    ("near_dedup", near_stage),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

#: SQL can't express the trained classifier, so the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
