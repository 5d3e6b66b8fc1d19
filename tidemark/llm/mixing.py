"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source has the same expected number of copies
``e = target / source size`` (at most ``max_copies``). It is taken
``floor(e)`` times for sure; one more copy is drawn with probability
``frac(e)`` by the cube method (Deville and Tille): inclusion probabilities
move along the null space of the balancing constraints - documents and
tokens of the source - until at most two per group are undecided. Groups of
bounded size run in parallel, their undecided rows are gathered and flown
again, and the last few are landed by the rounding whose totals are nearest.
"""

from __future__ import annotations

import math
import zlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WORD_PATTERN, saved, table, text_or_empty

WEIGHTS = (3.0, 1.0, 2.0)
GROUP_ROWS = 20_000  # rows flown together in one group


def word_count(text: str | Column) -> Column:
    """Number of words of the word rule (0 for null)."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD_PATTERN)).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(_p, _source_size), one row per source -> the same with ``_rank`` (long,
    from 0, by code point, null last). Ranges of names are numbered apart and
    shifted by the counts of the ranges before, so sources may be many."""
    by_name = F.col("_p").asc_nulls_last()
    placed = saved(sizes.repartitionByRange(by_name).withColumn("_part", F.spark_partition_id()),
                   "mix-sources")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
              .select(F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(by_name)) - 1
    return (placed.withColumn("_nth", nth).join(starts, F.col("_part") == F.col("_of"))
            .select("_p", "_source_size", (F.col("_start") + F.col("_nth")).cast("long").alias("_rank")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """(_p, _source_size) -> the same with ``_target``: ``budget`` times all
    sizes shared by weight; what exceeds ``max_copies`` times a source's size
    is shared again by weight among the others until none is above. Sources
    are ordered by code point, null last; weights repeat. An empty table gives
    an empty result; sources of size 0 have target 0.

    What a unit of weight is worth only rises from round to round, so that
    number says which sources are at their most; each round sums the sources
    of each weight in one aggregate and nothing else reaches the driver.
    """
    which = F.pmod("_rank", F.lit(len(weights))).cast("int")
    ranked = saved(ranked_sources(sizes).withColumn("_which", which), "mix-ranked")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_which") + 1)
    most = F.lit(max_copies) * F.col("_source_size")
    worth, full = 0.0, -1
    while True:
        over = weight * F.lit(worth) > most if worth else F.lit(False)
        sums = (ranked.groupBy("_which")
                .agg(F.sum("_source_size").alias("all"), F.sum(F.when(over, F.col("_source_size"))).alias("full"),
                     F.count_if(over).alias("n_full"), F.count_if(~over).alias("n_free"))
                .orderBy("_which").collect())  # one row per weight
        rest = budget * sum(r["all"] for r in sums) - max_copies * sum(r["full"] or 0 for r in sums)
        share = sum(weights[r["_which"]] * r["n_free"] for r in sums)
        now = sum(r["n_full"] for r in sums)
        if now == full or not share:
            break
        full, worth = now, max(worth, rest / share)
    part = F.lit(rest) * weight / F.lit(share) if share else most
    return ranked.select("_p", "_source_size", F.when(over, most).otherwise(F.least(part, most)).alias("_target"))


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase with the two constraints sum(x) and sum(x * size).

    Three undecided rows at a time: the direction that keeps both totals moves
    them until one reaches 0 or 1; random signs keep each expectation. At most
    two rows stay undecided.
    """
    x = pi.astype(float).copy()
    open_: list[int] = []
    u = rng.random(2 * len(x) + 8)
    k = 0
    for i in range(len(x)):
        if not 0.0 < x[i] < 1.0:
            continue
        open_.append(i)
        while len(open_) == 3:
            a, b, c = open_
            sa, sb, sc = size[a], size[b], size[c]
            d = (sb - sc, sc - sa, sa - sb)  # orthogonal to (1,1,1) and (sa,sb,sc)
            if d[0] == 0 and d[1] == 0:
                d = (1.0, -1.0, 0.0)
            up = down = math.inf
            for j, dj in zip(open_, d):
                if dj > 0:
                    up, down = min(up, (1 - x[j]) / dj), min(down, x[j] / dj)
                elif dj < 0:
                    up, down = min(up, x[j] / -dj), min(down, (1 - x[j]) / -dj)
            step = up if u[k % len(u)] * (up + down) < down else -down
            k += 1
            left = []
            for j, dj in zip(open_, d):
                v = x[j] + step * dj
                x[j] = 0.0 if v < 1e-9 else 1.0 if v > 1 - 1e-9 else v
                if 0.0 < x[j] < 1.0:
                    left.append(j)
            if len(left) == 3:  # rounding: the row nearest an end goes there
                j = min(left, key=lambda r: min(x[r], 1 - x[r]))
                x[j] = round(x[j])
                left.remove(j)
            open_ = left
    return x


def land(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the last undecided rows (two at most) so that the token total is
    nearest to what they stand for."""
    x = x.copy()
    open_ = [i for i in range(len(x)) if 0.0 < x[i] < 1.0]
    want = sum(x[i] * size[i] for i in open_)
    best = None
    for bits in range(1 << len(open_)):
        took = sum(size[i] for j, i in enumerate(open_) if bits >> j & 1)
        if best is None or abs(took - want) < best[0]:
            best = (abs(took - want), bits)
    for j, i in enumerate(open_):
        x[i] = float(best[1] >> j & 1)
    return x


_FLOWN = T.StructType([T.StructField("_key", T.LongType()), T.StructField("_src", T.StringType()),
                       T.StructField("_size", T.LongType()), T.StructField("_x", T.DoubleType())])


def _fly(last: bool, seed: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", "_key", "_size"], kind="stable").reset_index(drop=True)
        name = -1 if key[0] is None else zlib.crc32(key[0].encode("utf-8", "surrogatepass"))
        rng = np.random.default_rng([seed, name + 1, int(key[1])])
        size = pdf["_size"].to_numpy(float)
        x = flight(pdf["_x"].to_numpy(), size, rng)
        if last:
            x = land(x, size)
        return pd.DataFrame({"_key": pdf["_key"], "_src": pdf["_src"], "_size": pdf["_size"],
                             "_x": x})
    return run


def draw(units: DataFrame, seed: int, group_rows: int) -> DataFrame:
    """(_key, _src, _size, _x) with _x between 0 and 1 -> the same, _x 0 or 1.

    Each round deals a source's undecided rows into groups of about
    ``group_rows`` by a hash of the key; a group leaves two undecided at most,
    so the next round is thousands of times smaller. Once every source fits
    one group it is flown and landed. Runs agree: order and random numbers
    come from keys, not from partitions.
    """
    done: list[DataFrame] = []
    level = 0
    while True:
        counts = saved(units.groupBy("_src").agg(F.count(F.lit(1)).alias("_n")), "mix-counts")
        most = counts.agg(F.max("_n")).first()[0] or 0
        last = most <= group_rows
        group = F.pmod(F.xxhash64(units["_key"], F.lit(seed - 1 - level)),
                       F.ceil(F.col("_n") / F.lit(group_rows))).cast("int")
        dealt = (units.join(counts, units["_src"].eqNullSafe(counts["_src"]))
                 .select(units["*"], group.alias("_g"),
                         F.xxhash64(units["_key"], units["_size"], F.lit(seed + level)).alias("_order")))
        flown = saved(dealt.groupBy("_src", "_g").applyInPandas(_fly(last, seed + level), _FLOWN),
                      "mix-flown")
        done.append(flown.filter("_x = 0.0 or _x = 1.0"))
        if last:
            return reduce(DataFrame.union, done)
        units = flown.filter("_x > 0.0 and _x < 1.0")
        level += 1


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, budget: float = 1.5, max_copies: float = 2.0, seed: int = 11,
        group_rows: int = GROUP_ROWS, carry: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` as struct ``_row`` of its columns (or of ``carry``),
    with ``_size`` (words), ``_source_size``, ``_target`` and ``_copies``
    (times the mix takes it).

    Null text has size 0; a null source is a source of its own, the last. Rows
    of size 0 count as documents and take no words. Repeated rows are separate
    documents, numbered by a streaming window over their key. An empty table
    gives an empty result. Other columns, whatever their names, travel inside
    ``_row``. Sources may be as many as the rows.
    """
    ids = [F.col(f"`{c}`") for c in (id_col, source_col, text_col)]
    key = F.xxhash64(*[v for c in ids for v in (c.isNull(), c)])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("_row"),
                       key.alias("_key"), ids[1].cast("string").alias("_src"),
                       word_count(ids[2]).alias("_size"))
    if carry and text_col not in carry:  # narrow rows: read the texts only once
        rows = saved(rows, "mix-rows")
    narrow = saved(rows.select("_key", "_src", "_size"), "mix-sizes") if not carry else rows
    sizes = narrow.groupBy(F.col("_src").alias("_p")).agg(F.sum("_size").alias("_source_size"))
    often = F.least(F.lit(float(max_copies)), F.col("_target") / F.col("_source_size"))
    plan = saved(source_targets(sizes, weights, budget, max_copies)
                 .withColumn("_e", F.when(F.col("_source_size") > 0, often).otherwise(F.lit(0.0))),
                 "mix-plan")
    whole = F.floor(F.col("_e") + F.lit(1e-9))
    units = (narrow.join(plan, F.col("_src").eqNullSafe(F.col("_p")))
             .select("_key", "_src", "_size", (F.col("_e") - whole).alias("_x"))
             .filter("_x > 1e-9"))
    hits = (draw(units, seed, group_rows).filter("_x = 1.0")
            .groupBy(F.col("_key").alias("_k"), F.col("_size").alias("_s"))
            .agg(F.count(F.lit(1)).alias("_hits")))
    nth = F.row_number().over(Window.partitionBy("_key", "_size").orderBy(F.xxhash64("_row")))
    return (rows.join(hits, (F.col("_key") == F.col("_k")) & (F.col("_size") == F.col("_s")), "left")
            .withColumn("_nth", nth)
            .join(plan, F.col("_src").eqNullSafe(F.col("_p")))
            .select("_row", "_size", "_source_size", "_target",
                    (whole + F.when(F.col("_nth") <= F.col("_hits"), 1).otherwise(0))
                    .cast("int").alias("_copies")))


def op9_cube_mix(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken from each."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, carry=["doc_id"]).select(F.col("_row.doc_id").alias("doc_id"), F.col("_size").alias("size"),
                            F.col("_source_size").alias("source_size"),
                            F.col("_target").alias("target"),
                            (F.col("_copies") * F.col("_size")).cast("long").alias("taken"))


def mixed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it."""
    return (mix(docs).filter("_copies > 0")
            .select("_row", F.explode(F.expr("sequence(1, _copies)")).alias("_copy"))
            .select("_row.*"))
