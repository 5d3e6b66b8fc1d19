"""Near-duplicate texts: n-gram Jaccard join by a MinHash LSH forest.

Every text has a MinHash signature of ``TREES`` times ``DEPTH`` values; a tree
is the sorted trie of its ``DEPTH`` values. Texts meet where they share a
prefix in some tree. Matching starts with whole prefixes and shortens them,
one value at a time, until the estimated recall of links at the threshold
reaches the target. Texts that meet and whose signatures nearly agree form
clusters; within a cluster every pair is verified by exact Jaccard similarity
of its shingle sets.

Texts with equal shingle sets are one class throughout: their copies are
counted, never paired. Pairs inside a cluster are compared in blocks and only
counts and spanning edges leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (WordHashes, bounds_of, components, in_blocks, links_of, mix64, saved,
                                 shingles_of, sorted_groups, spanning, table, with_class)

WIDTH = 5  # words of a shingle
SIMILARITY = 0.8
TREES, DEPTH = 32, 8
RECALL = 0.999
BLOCK = 256  # rows of a block; two blocks meet in one task
SEED = 20

GROUP = ["_key", "bi", "bj"]


def minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """16 bits of the smallest of each of the hash functions (odd a) * x + b."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 256):
        x = shingles[lo:lo + 256, None] * a + b
        np.minimum(low, x.min(axis=0), out=low)
    return (mix64(low) >> np.uint64(48)).astype("<u2")


def coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    full = np.iinfo(np.uint64).max
    return (rng.integers(0, full, n, np.uint64) | np.uint64(1), rng.integers(0, full, n, np.uint64))


SIGNED = "_id long, _null boolean, _c1 long, _c2 long, _n int, _sig binary"


def _sign(width: int, trees: int, depth: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = coefficients(trees * depth, seed)
        hashes = WordHashes()
        for frame in batches:
            out = []
            for text in frame["_text"]:
                s = shingles_of(text or "", width, hashes)
                if not len(s):
                    out.append((0, 0, 0, None))
                    continue
                m = mix64(s + np.uint64(seed))
                c1, c2 = m.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(m))
                out.append((c1.astype(np.int64), c2.astype(np.int64), len(s), minhash(s, a, b).tobytes()))
            got = pd.DataFrame(out, columns=["_c1", "_c2", "_n", "_sig"])
            got.insert(0, "_id", frame["_id"].to_numpy())
            got.insert(1, "_null", frame["_null"].to_numpy())
            yield got
    return run


def _candidates(floor: float):
    """Edges that connect the rows of each group whose signatures agree in a
    share ``floor`` of values, with that share. Pairs already connected inside
    the group are not compared. Rows come by id, so a crowd that meets in many
    trees gives the same edges, to its smallest id, in each."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sorted_groups(batches, GROUP):
            edge = bounds_of(f, GROUP)
            ids, own = f["_id"].to_numpy(), f["own"].to_numpy()
            cross = (f["bi"] != f["bj"]).to_numpy()
            sig = np.frombuffer(b"".join(f["_sig"]), "<u2").reshape(len(f), -1)
            starts, sizes = edge[:-1], np.diff(edge)
            out = []
            for lo in range(0, len(starts), 8192):
                two = starts[lo:lo + 8192][sizes[lo:lo + 8192] == 2]
                two = two[~cross[two] | (own[two] != own[two + 1])]
                share = (sig[two] == sig[two + 1]).mean(axis=1)
                hit = share >= floor
                out.append((ids[two[hit]], ids[two[hit] + 1], share[hit]))
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                g, o, comp = sig[s:s + n], own[s:s + n], np.arange(n)
                for p in range(n - 1):
                    c = np.flatnonzero(comp[p + 1:] != comp[p]) + p + 1
                    if cross[s]:
                        c = c[o[c] != o[p]]
                    if not len(c):
                        continue
                    share = (g[c] == g[p]).mean(axis=1)
                    hit = share >= floor
                    if not hit.any():
                        continue
                    joined, first = np.unique(comp[c[hit]], return_index=True)
                    at = c[hit][first]
                    out.append((np.full(len(at), ids[s + p]), ids[s + at], share[hit][first]))
                    comp[np.isin(comp, joined)] = comp[p]
            if out:
                a, b, share = map(np.concatenate, zip(*out))
                yield pd.DataFrame({"a": a, "b": b, "share": share})
    return run


def _shingled(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for f in batches:
            sets = [shingles_of(t, width, hashes).tobytes() for t in f["_text"]]
            yield pd.DataFrame({"_id": f["_id"], "_key": f["_key"], "_w": f["_w"], "_set": sets})
    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over
    the shingles that occur twice or more."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, inv, cnt = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.cumsum(cnt > 1) - 1
    use = cnt[inv] > 1
    row, col = row[use], often[inv[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    inter = np.zeros((n, n), np.float32)
    step = 4096
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, step):
        a, b = np.searchsorted(col, [lo, lo + step])
        m = np.zeros((n, step), np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        inter += m @ m.T
    return inter.astype(np.int64)


def _verified(similarity: float):
    """Exact links of each group: (a, null, w) - a links to w rows; (a, b,
    null) - edges that connect what the group links."""
    part = Fraction(similarity).limit_denominator(10_000)
    num, den = part.numerator, part.denominator

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sorted_groups(batches, GROUP):
            edge = bounds_of(f, GROUP)
            got = []
            for s, e in zip(edge[:-1], edge[1:]):
                g = f.iloc[s:e].drop_duplicates("_id")
                if len(g) < 2:
                    continue
                sets = [np.frombuffer(x, np.uint64) for x in g["_set"]]
                inter = shared_counts(sets)
                n = np.array([len(x) for x in sets])
                union = n[:, None] + n[None, :] - inter
                link = inter * den >= union * num
                np.fill_diagonal(link, False)
                own = g["own"].to_numpy()
                if g["bi"].iloc[0] != g["bj"].iloc[0]:
                    link &= own[:, None] != own[None, :]
                ids, w = g["_id"].tolist(), link @ g["_w"].to_numpy()
                got.extend((ids[i], None, int(w[i])) for i in np.flatnonzero(w))
                got.extend((ids[i], ids[j], None) for i, j in spanning(link))
            yield pd.DataFrame(got, columns=["a", "b", "w"], dtype=object).astype("Int64")
    return run


def recall_of(share: float, trees: int, depth: int) -> float:
    """Probability that two texts of similarity ``share`` meet in some tree."""
    return 1 - (1 - share ** depth) ** trees


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
            width: int = WIDTH, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL,
            block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``class_id`` (smallest id with an
    equal shingle set), ``class_size``, ``n_links`` (other rows at or above
    ``similarity``), ``component_id`` (smallest id reachable by links), ``kept``.

    Shingles are runs of ``width`` words; a shorter text is one shingle of all
    its words. Texts without words, null texts and null ids link with nothing.
    Rows that share an id are one document: copies if their texts are alike.
    An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    own_id = F.col(f"`{id_col}`").cast("long")
    texts = docs.select(F.coalesce(own_id, F.lit(0)).alias("_id"), own_id.isNull().alias("_null"),
                        F.col(f"`{text_col}`").alias("_text"))
    signed = saved(texts.mapInPandas(_sign(width, trees, depth, seed), SIGNED), "jaccard-signed")
    can = ~F.col("_null") & (F.col("_n") > 0)
    # rows that cannot link get keys of their own and so are classes of one
    lone = F.when(~can, F.xxhash64(F.col("_id"), F.lit(seed)))
    keyed = signed.select(F.when(~F.col("_null"), F.col("_id")).alias("_id"), F.coalesce(lone, "_c1").alias("_c1"), F.coalesce(lone, "_c2").alias("_c2"),
                          F.col("_n"), can.alias("_linkable"), "_sig")
    members = saved(with_class(keyed, "_id", ["_c1", "_c2"], "jaccard"), "jaccard-members")
    reps = saved(members.filter("_linkable and _id = class_id")
                 .dropDuplicates(["_id"]).select("_id", "_sig", "class_size"), "jaccard-reps")

    floor = similarity - 4 * (similarity * (1 - similarity) / (trees * depth)) ** 0.5
    for used in range(depth, 0, -1):
        key = F.expr(f"transform(sequence(0, {trees - 1}), t -> "
                     f"xxhash64(t, substring(_sig, t * {2 * depth} + 1, {2 * used})))")
        met = in_blocks(reps.select("_id", F.explode(key).alias("_key")), "_key", "_id", block, "jaccard-met",
                        once=True)
        edges = saved(met.join(reps.select("_id", "_sig"), "_id").repartition(*GROUP)
                      .sortWithinPartitions(*GROUP, "_id")
                      .mapInPandas(_candidates(floor), "a long, b long, share double"),
                      "jaccard-edges")
        # each link found, counted once, stands for 1 / (probability to be found) links
        p = 1 - F.pow(1 - F.pow(F.col("share"), F.lit(used)), F.lit(trees))
        n, all_n = (edges.filter(F.col("share") >= similarity)
                    .groupBy("a", "b").agg(F.max("share").alias("share"))
                    .agg(F.count(F.lit(1)), F.sum(1 / p)).first())
        # without any link, prefixes are shortened until one at the threshold would be found
        if (n / all_n if n else recall_of(similarity, trees, used)) >= recall:
            break

    clusters = components(edges.select("a", "b"), "jaccard-clusters")
    weights = reps.select(F.col("_id").alias("node"), F.col("class_size").alias("_w"))
    todo = saved(clusters.join(weights, "node").select("node", F.col("label").alias("_key"), "_w"),
                 "jaccard-todo")
    sets = saved(texts.filter("not _null").join(todo, texts["_id"] == todo["node"]).select("_id", "_text", "_key", "_w")
                 .mapInPandas(_shingled(width), "_id long, _key long, _w long, _set binary"), "jaccard-sets")
    pairs = in_blocks(sets.select("_key", "_id").distinct(), "_key", "_id", block, "jaccard-pairs")
    found = saved(pairs.join(sets.select("_id", "_w", "_set"), "_id").repartition(*GROUP)
                  .sortWithinPartitions(*GROUP, "_id", F.length("_set"))
                  .mapInPandas(_verified(similarity), "a long, b long, w long"), "jaccard-found")
    return links_of(members.drop("_sig", "_c1", "_c2"), found, "jaccard")


def op7_lsh_forest(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes, links and components of all documents."""
    return similar(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), "class_id", "class_size", "n_links", "component_id", "kept")


def deduplicated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component. Of rows that share an
    id one stays; rows without an id all stay."""
    kept = (similar(docs).filter("kept and _id is not null").select(F.col("_id").alias("_kept")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col("doc_id").cast("long").alias("_id"))
    one = Window.partitionBy("_id").orderBy(F.xxhash64("_row"))
    some = (rows.join(kept, rows["_id"] == kept["_kept"], "left_semi")
            .withColumn("_nth", F.row_number().over(one)).filter("_nth = 1").select("_row.*"))
    return some.union(docs.filter("doc_id is null"))
