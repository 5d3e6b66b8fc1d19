"""The corpus pipeline: documents through five operators.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir)
and returns the documents it keeps; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import saved, table
from tidemark.llm.jaccard import deduplicated
from tidemark.llm.mixing import mixed
from tidemark.llm.packing import packed
from tidemark.llm.quality import kept_rows
from tidemark.llm.secrets import redacted

STAGES = [
    ("quality rules", kept_rows),
    ("n-gram Jaccard join", deduplicated),
    ("secret scans", redacted),
    ("mixing to target weights", mixed),
    ("packing", packed),
]

# Isolation forests, MinHash, random forests and balanced sampling have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
