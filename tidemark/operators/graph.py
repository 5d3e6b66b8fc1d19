"""Pipeline dependency edges: names, lists, isolated pipelines, levels."""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import fresh_scratch, materialize


def dependency_edges(deps: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Edges with the names of both ends (inner joins: dangling ends drop)."""
    a = pipelines.select(F.col("id").alias("pipeline_id"), F.col("name").alias("pipeline_name"))
    b = pipelines.select(F.col("id").alias("depends_on_id"), F.col("name").alias("depends_on_name"))
    return (deps.select("pipeline_id", "depends_on_id")
            .join(a, "pipeline_id", "inner").join(b, "depends_on_id", "inner")
            .select("pipeline_id", "pipeline_name", "depends_on_id", "depends_on_name"))


def dependency_lists(deps: DataFrame) -> DataFrame:
    """Each pipeline's prerequisites as a sorted array (one aggregate, not a
    query per pipeline)."""
    return (deps.groupBy("pipeline_id")
            .agg(F.sort_array(F.collect_list("depends_on_id")).alias("depends_on")))


def isolated_pipelines(pipelines: DataFrame, deps: DataFrame) -> DataFrame:
    """Pipelines that appear in no edge, in either direction."""
    ends = (deps.select(F.col("pipeline_id").alias("id"))
            .union(deps.select(F.col("depends_on_id").alias("id"))).distinct())
    return pipelines.join(ends, "id", "left_anti")


def dependency_levels(pipelines: DataFrame, deps: DataFrame) -> DataFrame:
    """Level of every pipeline: 0 with no prerequisites, else one more than
    its highest prerequisite (the longest chain above it).

    An open pipeline's level is the largest of a number known so far and of
    ``level(h) + w`` over the prerequisites ``h`` it still waits for. Each
    round puts in what is known of those: one that waits for none has its
    level; one that waits for a single other is replaced by that one, further
    up, which halves chains. So a chain of any length takes about log2 of it
    rounds, branching layers one each; several ways to the same prerequisite
    become the longest. Every round settles at least the pipelines that wait
    for none, so one that settles nothing is the last: what is left lies on or
    below a cycle and comes back with a null level and ``in_cycle`` true.
    Rounds are written to the shared checkpoint folder, so the lineage never
    grows. Where no pipeline has more than one prerequisite, pointer jumping
    gives the same levels.
    """
    spark = pipelines.sparkSession
    nodes = pipelines.select(F.col("id").alias("pipeline_id"))
    # edges whose either end is not a pipeline are ignored
    edges = (deps.select("pipeline_id", "depends_on_id").distinct()
             .join(nodes, "pipeline_id", "left_semi")
             .join(nodes.withColumnRenamed("pipeline_id", "depends_on_id"),
                   "depends_on_id", "left_semi"))
    edges = materialize(edges, fresh_scratch(spark, "edges"))
    widest = edges.groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("m")).first()["m"]
    if widest is None or widest <= 1:
        return _forest_levels(nodes, edges)
    path = fresh_scratch(spark, "levels")
    none = F.lit(None).cast(edges.schema["depends_on_id"].dataType)
    # what a pipeline waits for (h, w) and, with a null h, what it knows
    open_ = (edges.select("pipeline_id", F.col("depends_on_id").alias("h"), F.lit(1).cast("bigint").alias("w"))
             .union(nodes.distinct().select("pipeline_id", none.alias("h"), F.lit(0).cast("bigint").alias("w"))))
    rounds = 0
    while True:
        at = os.path.join(path, f"round={rounds}")
        settled = Observation()
        # of each open pipeline: how many it waits for, what it knows, and the one if there is one
        (open_.groupBy("pipeline_id").agg(F.count("h").alias("k"), F.max(F.when(F.col("h").isNull(), F.col("w"))).alias("known"),
                                          F.max("h").alias("up"), F.max(F.when(F.col("h").isNotNull(), F.col("w"))).alias("dist"))
         .observe(settled, F.count_if(F.col("k") == 0).alias("n")).write.mode("overwrite").parquet(at))
        if not settled.get.get("n"):
            break
        info = spark.read.parquet(at)
        # one that waits for a single settled one is as good as settled: no edge leads to a settled pipeline
        done = info.where("k = 0").select(F.col("pipeline_id").alias("up"), F.col("known").alias("top"))
        of = info.where("k < 2").join(done, "up", "left").select(
            F.col("pipeline_id").alias("h"), F.when(F.col("top").isNotNull(), 0).otherwise(F.col("k")).alias("k"),
            F.greatest("known", F.col("top") + F.col("dist")).alias("known"), "up", "dist")
        still = open_.join(info.where("k = 0").select("pipeline_id"), "pipeline_id", "left_anti")
        moved = still.join(of, "h", "left").select(
            "pipeline_id", F.explode(F.when(F.col("k").isNull(), F.array(F.struct("h", "w"))).otherwise(F.array_compact(F.array(
                F.struct(none.alias("h"), (F.col("w") + F.col("known")).alias("w")),
                F.when(F.col("k") == 1, F.struct(F.col("up").alias("h"), (F.col("w") + F.col("dist")).alias("w"))))))).alias("e"))
        open_ = materialize(moved.select("pipeline_id", "e.h", "e.w").groupBy("pipeline_id", "h").agg(F.max("w").alias("w")),
                            fresh_scratch(spark, "open"))
        rounds += 1
    levels = (spark.read.parquet(*[os.path.join(path, f"round={k}") for k in range(rounds + 1)])
              .where("k = 0").select("pipeline_id", F.col("known").cast("int").alias("level")))
    return (nodes.join(levels, "pipeline_id", "left")
            .withColumn("in_cycle", F.col("level").isNull()))


def _forest_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Levels when every pipeline has at most one prerequisite, by pointer
    jumping: each round replaces a pointer by its target's pointer and adds
    up the distance, so a chain of depth d needs about log2(d) rounds (one
    self-join each) instead of d. Pointers on or below a cycle never reach a
    root and come back with a null level and ``in_cycle``."""
    spark = nodes.sparkSession
    state = (nodes.join(edges, "pipeline_id", "left")
             .select("pipeline_id", F.col("depends_on_id").alias("ptr"),
                     F.when(F.col("depends_on_id").isNotNull(), 1).otherwise(0).alias("dist")))
    path = fresh_scratch(spark, "jump")
    state, n = materialize(state.withColumn("_open", F.col("ptr").isNotNull()), path, count=True)
    # an acyclic forest of n nodes closes every pointer within log2(n) + 1
    # rounds; pointers still open after that are on or below a cycle
    rounds = max(1, math.ceil(math.log2(n + 1))) + 1
    for i in range(rounds):
        hop = state.select(F.col("pipeline_id").alias("ptr"), F.col("ptr").alias("_next"),
                           F.col("dist").alias("_d"))
        nxt = (state.join(hop, "ptr", "left")
               .select("pipeline_id",
                       F.when(F.col("ptr").isNull(), F.lit(None)).otherwise(F.col("_next"))
                       .cast(state.schema["ptr"].dataType).alias("ptr"),
                       (F.col("dist") + F.coalesce(F.col("_d"), F.lit(0))).alias("dist")))
        obs = Observation(f"jump-{os.path.basename(path)}-{i}")
        step = fresh_scratch(spark, "jump")
        (nxt.withColumn("_open", F.col("ptr").isNotNull())
         .observe(obs, F.count_if(F.col("_open")).alias("open"))
         .write.mode("overwrite").parquet(step))
        state = spark.read.parquet(step)
        if int(obs.get.get("open", 0)) == 0:
            break
    # a pointer still open after the rounds sits on or below a cycle
    return state.select("pipeline_id",
                        F.when(F.col("_open"), F.lit(None).cast("int"))
                        .otherwise(F.col("dist").cast("int")).alias("level"),
                        F.col("_open").alias("in_cycle"))
