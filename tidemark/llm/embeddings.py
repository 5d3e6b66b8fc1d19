"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by pseudo-random rotations (three rounds of random signs
and a fast Hadamard transform); the nearest signed axis is its hash, and a
bucket of a table is made of several. Besides its own bucket a vector probes
those where the least certain axis is replaced by the second nearest. Vectors
that share a bucket are compared by exact cosine in double precision.

Equal vectors are one class throughout: copies are counted, never paired.
A bucket is compared in blocks; only counts and spanning edges leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (bounds_of, in_blocks, links_of, mix64, saved, sorted_groups, spanning,
                                 table, with_class)

COSINE = 0.95
RECALL = 0.9999  # of pairs at the threshold
PROBES = 2  # buckets probed besides a vector's own, per table
BLOCK = 256
SEED = 3

GROUP = ["_key", "bi", "bj"]


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
        x = x.reshape(n, d)
    return x / math.sqrt(d)


def bucket_keys(x: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """64-bit keys of the buckets of unit rows: for each table its own, then
    the probed ones; shape (rows, tables * (1 + probes))."""
    n, dim = x.shape
    d = max(2, 1 << (dim - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - dim)))
    rng = np.random.default_rng([seed, dim])
    probes = min(probes, hashes)
    out = np.empty((n, tables, 1 + probes), np.uint64)
    rows = np.arange(n)
    for t in range(tables):
        best, second, gap = [], [], []
        for _ in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            size = np.abs(y)
            two = np.argpartition(size, d - 2, axis=1)[:, d - 2:]
            swap = size[rows, two[:, 0]] > size[rows, two[:, 1]]
            one = np.where(swap, two[:, 0], two[:, 1])
            nxt = np.where(swap, two[:, 1], two[:, 0])
            best.append(2 * one + (y[rows, one] < 0))
            second.append(2 * nxt + (y[rows, nxt] < 0))
            gap.append(size[rows, one] - size[rows, nxt])
        best, second = np.array(best, np.uint64), np.array(second, np.uint64)
        weakest = np.argsort(np.array(gap), axis=0, kind="stable")
        for p in range(1 + probes):
            axes = best.copy()
            if p:
                axes[weakest[p - 1], rows] = second[weakest[p - 1], rows]
            key = np.full(n, (dim << 32) + t, np.uint64)
            for a in axes:
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + a)
            out[:, t, p] = key
    return out.reshape(n, -1)


def plan(dim: int, rows: int, cosine: float, recall: float, probes: int, seed: int) -> tuple[int, int]:
    """Tables and hashes per table: enough hashes that unrelated vectors hardly
    share a bucket, and, measured on random pairs at exactly the threshold,
    enough tables for the recall."""
    d = max(2, 1 << (dim - 1).bit_length())
    hashes = max(1, math.ceil(math.log(max(2, 20 * rows)) / math.log(2 * d)))
    rng = np.random.default_rng([seed, dim, 1])
    n, trial = 1000, 4
    a, b = rng.normal(size=(n, dim)), rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    length = np.linalg.norm(b, axis=1, keepdims=True)
    b = np.divide(b, length, out=np.zeros_like(b), where=length > 1e-12)
    b = cosine * a + math.sqrt(1 - cosine * cosine) * b
    while True:
        ka = bucket_keys(a, trial, hashes, probes, seed + 1).reshape(n, trial, -1)
        kb = bucket_keys(b, trial, hashes, probes, seed + 1).reshape(n, trial, -1)
        met = (ka[:, :, :, None] == kb[:, :, None, :]).any(axis=(2, 3)).mean()
        if met > 0.2 or hashes == 1:
            met = min(max(met, 0.01), 1 - 1e-9)
            return max(2, math.ceil(math.log(1 - recall) / math.log(1 - met))), hashes
        hashes -= 1  # buckets too narrow for pairs at the threshold


HASHED = "_id long, _null boolean, _c1 long, _c2 long, _linkable boolean, _vec binary, _keys array<long>"


def unit(v) -> np.ndarray | None:
    """The vector scaled to length 1, in double precision; None if it is null,
    empty, zero or holds null or non-finite components."""
    if v is None or len(v) == 0:
        return None
    x = np.array([np.nan if c is None else c for c in v] if getattr(v, "dtype", None) == object else v, float)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return x / np.linalg.norm(x)


def _hash(tables: int, hashes: int, probes: int, seed: int, stored: type):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for f in batches:
            units = [None if null else unit(v) for null, v in zip(f["_null"], f["_vec"])]
            raw = [None if u is None else u.tobytes() for u in units]
            same = [xxhash.xxh3_128_intdigest(r) if r else 0 for r in raw]
            keys: list = [None] * len(f)
            for dim in {len(u) for u in units if u is not None}:
                at = [i for i, u in enumerate(units) if u is not None and len(u) == dim]
                got = bucket_keys(np.array([units[i] for i in at]), tables, hashes, probes, seed)
                for i, k in zip(at, got.view(np.int64)):
                    keys[i] = np.unique(k)
            yield pd.DataFrame({
                "_id": f["_id"].to_numpy(), "_null": f["_null"].to_numpy(),
                "_c1": np.array([c & (2 ** 64 - 1) for c in same], np.uint64).view(np.int64),
                "_c2": np.array([c >> 64 for c in same], np.uint64).view(np.int64),
                "_linkable": [r is not None for r in raw],
                "_vec": [None if u is None else np.asarray(v, stored).tobytes() for u, v in zip(units, f["_vec"])],
                "_keys": keys})
    return run


def _linked(cosine: float, stored: type):
    """Links of each group, as (a, null, w) and edges (a, b, null). A pair that
    shares several buckets is counted in that of the smallest key."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sorted_groups(batches, GROUP):
            edge = bounds_of(f, GROUP)
            got = []
            for s, e in zip(edge[:-1], edge[1:]):
                g = f.iloc[s:e]
                x = np.array([unit(np.frombuffer(v, stored)) for v in g["_vec"]])
                link = np.triu(x @ x.T >= cosine, 1)
                own = g["own"].to_numpy()
                if g["bi"].iloc[0] != g["bj"].iloc[0]:
                    link &= own[:, None] != own[None, :]
                i, j = np.nonzero(link)
                if not len(i):
                    continue
                keys = [np.asarray(k) for k in g["_keys"]]
                wide = max(map(len, keys))
                k = np.full((len(g), wide), np.iinfo(np.int64).max)
                for r, v in enumerate(keys):
                    k[r, :len(v)] = v
                here, first = g["_key"].iloc[0], np.ones(len(i), bool)
                before = k < here
                for lo in range(0, len(i), 4096):
                    a, b = i[lo:lo + 4096], j[lo:lo + 4096]
                    both = (k[a][:, :, None] == k[b][:, None, :]) & before[a][:, :, None]
                    first[lo:lo + 4096] = ~both.any(axis=(1, 2))
                ids, w = g["_id"].to_numpy(), g["_w"].to_numpy()
                more = np.zeros(len(g), np.int64)
                np.add.at(more, i[first], w[j[first]])
                np.add.at(more, j[first], w[i[first]])
                got.extend((int(ids[r]), None, int(more[r])) for r in np.flatnonzero(more))
                got.extend((int(ids[p]), int(ids[q]), None) for p, q in spanning(link | link.T))
            if got:
                yield pd.DataFrame(got, columns=["a", "b", "w"], dtype=object).astype("Int64")
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 cosine: float = COSINE, recall: float = RECALL, probes: int = PROBES, block: int = BLOCK,
                 seed: int = SEED) -> DataFrame:
    """One row per row of ``vectors``: ``_id``, ``class_id``, ``class_size``,
    ``n_links``, ``component_id``, ``kept``.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do rows without an id, nor vectors of different
    length with each other. Repeated rows are copies: they link. An empty
    table gives an empty result. Other columns are not read.
    """
    own_id = F.col(f"`{id_col}`").cast("long")
    rows = vectors.select(F.coalesce(own_id, F.lit(0)).alias("_id"), own_id.isNull().alias("_null"),
                          F.col(f"`{vec_col}`").alias("_vec"))
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("_vec"))).first()
    # single precision is kept as given: half the bytes, and the same unit vector
    kind = vectors.schema[vec_col].dataType
    stored = np.float32 if isinstance(kind, T.ArrayType) and kind.elementType == T.FloatType() else np.float64
    tables, hashes = plan(max(1, dim or 1), max(1, n), cosine, recall, probes, seed)
    hashed = rows.mapInPandas(_hash(tables, hashes, probes, seed, stored), HASHED)
    lone = F.when(~F.col("_linkable"), F.xxhash64(F.col("_id"), F.lit(seed)))
    hashed = saved(hashed.select(F.when(~F.col("_null"), F.col("_id")).alias("_id"),
                                 F.coalesce(lone, "_c1").alias("_c1"), F.coalesce(lone, "_c2").alias("_c2"),
                                 "_linkable", "_vec", "_keys"), "vectors-hashed")
    members = saved(with_class(hashed.drop("_vec", "_keys"), "_id", ["_c1", "_c2"], "vectors"), "vectors-members")
    # a vector of each class: ids, digests and weights are found first, then joined to the vectors once
    first = (members.filter("_linkable and _id = class_id").dropDuplicates(["_id"])
             .select("_id", "_c1", "_c2", F.col("class_size").alias("_w")))
    reps = saved(hashed.filter("_linkable").join(first, ["_id", "_c1", "_c2"]).dropDuplicates(["_id"])
                 .select("_id", "_vec", "_keys", "_w"), "vectors-reps")
    met = in_blocks(reps.select("_id", F.explode("_keys").alias("_key")), "_key", "_id", block, "vectors-met",
                    once=True)
    found = saved(met.join(reps, "_id").repartition(*GROUP).sortWithinPartitions(*GROUP, "_id")
                  .mapInPandas(_linked(cosine, stored), "a long, b long, w long"), "vectors-found")
    return links_of(members.drop("_c1", "_c2"), found, "vectors")


def op3_cross_polytope(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings")).select(
        F.col("_id").alias("vec_id"), "n_links", "component_id", "kept")
