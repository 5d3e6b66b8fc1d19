"""Pages of the run history by an index of page bounds.

``offset`` walks all rows before a page through one task. Here the history is
written once, newest first, with the position of every run among all runs, the
runs of its status, of its pipeline, and of both. A small index tells between
which times a page lies: a page reads that range, however far back it is.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.runs import PAGE_SIZE
from tidemark.operators.windows import range_row_number, ranged
from tidemark.plans.layout import _micros

SCOPES = {"all": [], "status": ["status"], "pipeline": ["pipeline_id"], "both": ["pipeline_id", "status"]}
LATEST = 2**63 - 1
AT = "_at"  # started_at in microseconds; runs without a start are listed first


def _position(scope: str) -> str:
    return f"_pos_{scope}"


def _scope(pipeline_id, status) -> str:
    return {(False, False): "all", (False, True): "status", (True, False): "pipeline",
            (True, True): "both"}[pipeline_id is not None, status is not None]


class RunPages:
    """Pages of ``size`` runs at ``path``. ``build`` writes them anew from the
    whole history; pages show it as it was then, unlike ``offset``, whose pages
    shift while runs arrive."""

    def __init__(self, spark: SparkSession, path: str, size: int = PAGE_SIZE):
        self.spark, self.path, self.size = spark, path, size

    def build(self, runs: DataFrame, partitions: int | None = None) -> None:
        """Runs equal in start and id come in any order, each on one page.
        Runs without a pipeline or status are in the scopes that do not ask
        for it."""
        at = F.coalesce(_micros(F.col("started_at").cast("timestamp_ntz")), F.lit(LATEST))
        order = [F.col(AT).desc(), F.col("run_id").desc_nulls_first()]
        rows = ranged(runs.withColumn(AT, at), order, partitions)
        for scope, by in SCOPES.items():
            rows = range_row_number(rows, by, order, _position(scope))
        # the ranges are kept: a file per range, sorted, so that its footer bounds the times
        parts = partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (rows.repartition(parts, "_part").sortWithinPartitions("_part", *order).drop("_part")
         .write.mode("overwrite").parquet(self._rows))
        stored = self.spark.read.parquet(self._rows)
        facts = [self._facts(stored, scope, by) for scope, by in SCOPES.items()]
        index = facts[0].unionByName(facts[1]).unionByName(facts[2]).unionByName(facts[3])
        index.repartitionByRange("scope", "pipeline_id", "status", "page").sortWithinPartitions(
            "scope", "pipeline_id", "status", "page").write.mode("overwrite").parquet(self._index)

    @property
    def _rows(self) -> str:
        return os.path.join(self.path, "rows")

    @property
    def _index(self) -> str:
        return os.path.join(self.path, "index")

    def _facts(self, rows: DataFrame, scope: str, by: list[str]) -> DataFrame:
        page = F.floor(F.col(_position(scope)) / self.size).alias("page")
        own = {"pipeline_id": F.lit(None).cast(rows.schema["pipeline_id"].dataType),
               "status": F.lit(None).cast("string")} | {b: F.col(b) for b in by}
        found = rows
        for b in by:
            found = found.where(F.col(b).isNotNull())
        return (found.groupBy(*by, page)
                .agg(F.count(F.lit(1)).alias("n_runs"), F.max(AT).alias("newest_us"), F.min(AT).alias("oldest_us"))
                .select(F.lit(scope).alias("scope"), *[c.alias(n) for n, c in own.items()], "page", "n_runs",
                        "newest_us", "oldest_us"))

    def index(self) -> DataFrame:
        """Every page of every scope: its runs and between which times they lie."""
        return self.spark.read.parquet(self._index)

    def _of(self, pipeline_id, status) -> Column:
        cond = F.col("scope") == _scope(pipeline_id, status)
        for name, value in (("pipeline_id", pipeline_id), ("status", status)):
            cond = cond if value is None else cond & (F.col(name) == F.lit(value))
        return cond

    def page(self, page: int, pipeline_id=None, status: str | None = None) -> DataFrame:
        """Page ``page`` (0-based) of the filtered runs, newest first. The driver
        reads the page's one row of the index; its times go to the scan."""
        bound = self.index().where(self._of(pipeline_id, status) & (F.col("page") == page)).first()
        rows, pos = self.spark.read.parquet(self._rows), F.col(_position(_scope(pipeline_id, status)))
        helpers = [AT, *map(_position, SCOPES)]
        if bound is None:
            return rows.where(F.lit(False)).drop(*helpers)
        rows = rows.where(F.col(AT).between(bound["oldest_us"], bound["newest_us"])
                          & pos.between(page * self.size, (page + 1) * self.size - 1))
        for name, value in (("pipeline_id", pipeline_id), ("status", status)):
            rows = rows if value is None else rows.where(F.col(name) == F.lit(value))
        return rows.orderBy(pos).drop(*helpers)

    def page_count(self, pipeline_id=None, status: str | None = None) -> DataFrame:
        """``total_pages`` of the filtered runs, from the index."""
        last = self.index().where(self._of(pipeline_id, status)).agg(F.max("page").alias("p"))
        return last.select(F.coalesce(F.col("p") + 1, F.lit(0)).cast("bigint").alias("total_pages"))
