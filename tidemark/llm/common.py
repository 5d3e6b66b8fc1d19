"""Helpers shared by the corpus operators: tables, class ids, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import tidemark.llm
from tidemark.session import fresh_scratch

# Functions of this package travel to Python workers by value: executors need
# not have it installed.
cloudpickle.register_pickle_by_value(tidemark.llm)

# White space of the word rule: words are runs of anything else.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: computed
    once, and its lineage does not depend on any executor's disk."""
    path = fresh_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def counted(df: DataFrame, name: str, what: Column | None = None) -> tuple[DataFrame, int]:
    """``saved``, and how many of its rows there are (or fulfil ``what``)."""
    seen = Observation()
    count = F.count(F.lit(1)) if what is None else F.count_if(what)
    out = saved(df.observe(seen, count.alias("n")), name)
    return out, int(seen.get.get("n") or 0)


def partitions_for(spark: SparkSession, at_least: int = 1) -> int:
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hashed_sample(df: DataFrame, key: Column, rows: int, order: list[str] | None = None) -> DataFrame:
    """At most ``rows`` rows of ``df``, those of the smallest hash ``key``
    (then ``order``), as column ``_hash``. Rows above a share of the hash's
    range that holds half as many again are left out before the sort, so what
    meets in one task does not grow with the number of partitions."""
    total = df.count()
    share = min(1.0, 1.5 * rows / total) if total else 1.0
    low = F.col("_hash") / F.lit(2.0 ** 64) + F.lit(0.5)
    return (df.withColumn("_hash", key).filter(low <= F.lit(share))
            .orderBy("_hash", *(order or [])).limit(rows))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: str) -> list[bytes]:
    """Words of the word rule; ``bytes.split`` splits on exactly its white space."""
    return text.encode("utf-8", "surrogatepass").split()


def worker_state(name: str, make: Callable):
    """A value made once per Python worker process and kept between tasks."""
    held = sys.modules.setdefault("tidemark_worker_state", types.ModuleType("tidemark_worker_state"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``limit`` distinct words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit
        from xxhash import xxh3_64_intdigest
        self._digest = xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        h = self._digest(word)
        if len(self) < self.limit:
            self[word] = h
        return h


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles_of(text: str, width: int, hashes: WordHashes) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of ``width`` words. A text of fewer
    words is one shingle of all of them; a text without words has none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    acc = np.zeros(n, np.uint64)
    for k in range(min(width, len(h))):
        acc = mix64(acc + h[k:k + n] + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(acc)


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups, many to a frame, from batches sorted by ``keys``: what
    follows the last change of key waits for the next batch."""
    rest: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = b[keys]
        first, last = k.iloc[0], k.iloc[-1]
        if rest and not (rest[-1][keys].iloc[-1] == first).all():
            yield pd.concat(rest, ignore_index=True)
            rest = []
        if (first == last).all():
            rest.append(b)
            continue
        same = (k == last).all(axis=1).to_numpy()
        cut = len(b) - int(np.argmin(same[::-1]))
        head, tail = b.iloc[:cut], b.iloc[cut:]
        yield pd.concat([*rest, head], ignore_index=True)
        rest = [tail]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def bounds_of(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Start of each group in a frame sorted by ``keys``, and its length."""
    k = frame[keys].to_numpy()
    return np.r_[0, np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1, len(k)]


def with_class(df: DataFrame, id_col: str, key_cols: list[str], name: str) -> DataFrame:
    """Rows of ``df`` with ``class_id`` (smallest id of rows with an equal key)
    and ``class_size``.

    The keys are counted with map-side partial sums. Only keys of two or more
    rows are written and joined back; both sides of that join are plain scans
    behind an exchange, so Spark splits a hot key's partition.
    """
    many = saved(df.groupBy(*key_cols)
                 .agg(F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("class_size"))
                 .filter("class_size > 1"), f"{name}-classes")
    on = [df[c].eqNullSafe(many[c]) if df.schema[c].nullable else df[c] == many[c]
          for c in key_cols]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return (df.join(many, cond, "left")
            .select(*[df[c] for c in df.columns],
                    F.coalesce(many["class_id"], df[id_col]).alias("class_id"),
                    F.coalesce(many["class_size"], F.lit(1)).cast("long").alias("class_size")))


def in_blocks(rows: DataFrame, key: str, id_col: str, block: int, name: str, once: bool = False) -> DataFrame:
    """Spread each key's rows over pairs of blocks.

    ``rows`` is (key, id). Keys of one row go. A key of at most ``block`` rows
    is one group (key, 0, 0). A larger one is dealt into blocks by a hash of
    the id, and each row goes to every pair of blocks with its own, so any two
    rows of the key meet in some group of at most about ``2 * block`` rows.
    ``own`` is the row's block; rows of one block meet in the group (b, b).

    With ``once`` keys that hold the same ids (by a 128-bit digest; each id is
    in a key once) are compared once, under the smallest of them: what meets
    under the others meets there.
    """
    rows = saved(rows, f"{name}-rows")
    ids = [F.bit_xor(F.xxhash64(F.col(id_col), F.lit(salt))).alias(f"_x{salt}") for salt in (11, 13)]
    sizes = saved(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *(ids if once else [])).filter("n > 1"),
                  f"{name}-sizes")
    if once:
        sizes = saved(sizes.groupBy("n", "_x11", "_x13").agg(F.min(key).alias(key)).select(key, "n"),
                      f"{name}-sets")
    nb = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), nb).cast("int")
    return (rows.join(sizes, key)
            .select(key, id_col, nb.alias("nb"), own.alias("own"))
            .select(key, id_col, "own",
                    F.explode(F.expr("sequence(0, nb - 1)")).alias("other"))
            .select(key, id_col, "own", F.least("own", "other").alias("bi"),
                    F.greatest("own", "other").alias("bj")))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of an undirected graph: (node, label) for each node
    of an edge, the label being the smallest node reachable.

    ``edges`` has two long columns. Each round every node points to its
    smallest neighbour (or itself), pointers are followed to their roots, and
    edges are redrawn between roots: at least half of the nodes of each
    component go, until no edge is left. Minima are summed up map-side; joins
    are between scans of written tables, so a hot node's partition is split;
    counts alone go to the driver.
    """
    a, b = (F.col(c) for c in edges.columns)
    left, n = counted(edges.filter(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                      .distinct(), f"{name}-edges")
    labels: DataFrame | None = None
    while n:
        near = left.select(F.col("a").alias("node"), F.col("a").alias("up")).union(
            left.select(F.col("b"), F.col("a")))
        roots = saved(near.groupBy("node").agg(F.min("up").alias("up")), f"{name}-roots")
        while True:
            far = roots.select(F.col("node").alias("up"), F.col("up").alias("far"))
            roots, moved = counted(roots.join(far, "up").select("node", "far", (F.col("far") != F.col("up")).alias("m")),
                                   f"{name}-roots", F.col("m"))
            roots = roots.select("node", F.col("far").alias("up"))
            if not moved:
                break
        x, y = (roots.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        moved_edges = left.join(x, "a").join(y, "b").filter("a_up <> b_up")
        left, n = counted(moved_edges.select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b"))
                          .distinct(), f"{name}-edges")
        if labels is None:
            labels = roots.withColumnRenamed("up", "label")
        else:
            to = roots.select(F.col("node").alias("label"), "up")
            labels = saved(labels.join(to, "label", "left")
                           .select("node", F.coalesce("up", "label").alias("label")), f"{name}-labels")
    if labels is None:
        return edges.sparkSession.createDataFrame([], "node long, label long")
    return labels


def links_of(members: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Adds ``n_links``, ``component_id`` and ``kept`` to class members.

    ``members`` (``_id``, ``class_id``, ``class_size``, ``_linkable``) is a
    written table. ``found`` (a, b, w): w is not null - class a links to w rows
    of other classes; else - an edge between classes a and b. Rows that are
    not linkable stand alone. The last join is keyed by class and joins two
    scans, so a class that holds a third of all rows is split.
    """
    counts = found.filter("w is not null").groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("more"))
    labels = components(found.filter("w is null").select("a", "b"), f"{name}-groups")
    per_class = saved(counts.join(labels, "node", "full"), f"{name}-links")
    can = F.col("_linkable")
    return (members.join(per_class, members["class_id"] == per_class["node"], "left")
            .select(*[members[c] for c in members.columns],
                    F.when(can, F.col("class_size") - 1 + F.coalesce("more", F.lit(0)))
                    .otherwise(0).cast("long").alias("n_links"),
                    F.when(can, F.coalesce("label", "class_id")).otherwise(F.col("_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("_id").isNull() | (F.col("_id") == F.col("component_id"))))


def spanning(links: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of a boolean adjacency matrix."""
    fresh = np.ones(len(links), bool)
    for s in np.flatnonzero(links.any(axis=1)):
        if not fresh[s]:
            continue
        fresh[s] = False
        todo = [int(s)]
        while todo:
            i = todo.pop()
            near = np.flatnonzero(links[i] & fresh)
            fresh[near] = False
            for j in near.tolist():
                yield i, j
            todo.extend(near.tolist())
