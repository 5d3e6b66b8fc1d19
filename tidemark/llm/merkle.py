"""Merkle manifest of a dataset, in blocks of van Emde Boas layout.

Rows are leaves, in order of their key within a group; every ``FAN``
consecutive nodes of a level become the hash of their digests. The tree is
kept in blocks: aligned subtrees of ``HEIGHT`` levels above ``FAN ** HEIGHT``
leaves, each an array of digests in van Emde Boas order (a tree is cut at half
its height; the top comes first, then the bottom trees, each laid out alike),
so that any path touches few places of memory at every scale. The address of
a node is arithmetic; construction and siblings use nothing else. The roots of
blocks are the leaves of the next tier of blocks, until one is left; the roots
of the groups, in order, make a last tree of the same kind.

A proof is the sibling digests from a leaf to the root. Siblings above a block
are the same for all its leaves: they are found once a block, from the top
tier down, and joined to the leaves' blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions_for, saved, table

FAN = 8
HEIGHT = 4  # levels above the leaves of a block: 4096 leaves
DIGEST = 32  # bytes


def nodes_of(levels: int) -> int:
    """Nodes of a whole tree of so many levels."""
    return (FAN ** levels - 1) // (FAN - 1)


@cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Place in van Emde Boas order of each node, level by level from the top."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    bottom = levels - top
    above, below = addresses(top), addresses(bottom)
    first = nodes_of(top) + nodes_of(bottom) * np.arange(FAN ** top)  # where each bottom tree starts
    return (*above, *((first[:, None] + a[None, :]).ravel() for a in below))


def height_of(leaves: int) -> int:
    """Levels above ``leaves`` until one node is left."""
    h = 0
    while leaves > 1:
        leaves, h = -(-leaves // FAN), h + 1
    return h


class Block:
    """A subtree: digests in van Emde Boas order. Nodes that a last, shorter
    run does not have are absent; ``width`` tells how many a level has."""

    def __init__(self, height: int, leaves: int, data: bytearray | bytes):
        self.at = addresses(height + 1)
        self.height, self.data = height, data
        self.width = [leaves]
        for _ in range(height):
            self.width.append(-(-self.width[-1] // FAN))

    def digest(self, level: int, i: int) -> bytes:
        """Node ``i`` of a level; leaves are level 0."""
        a = int(self.at[self.height - level][i]) * DIGEST
        return bytes(self.data[a:a + DIGEST])

    def _put(self, level: int, i: int, digest: bytes) -> None:
        a = int(self.at[self.height - level][i]) * DIGEST
        self.data[a:a + DIGEST] = digest

    @classmethod
    def build(cls, height: int, leaves: list[bytes]) -> Block:
        block = cls(height, len(leaves), bytearray(nodes_of(height + 1) * DIGEST))
        for i, d in enumerate(leaves):
            block._put(0, i, d)
        for level in range(height):
            for run in range(block.width[level + 1]):
                text = "".join([block.digest(level, i).hex() for i in block.run(level, run * FAN)])
                block._put(level + 1, run, hashlib.sha256(text.encode()).digest())
        return block

    def run(self, level: int, i: int) -> range:
        """The run of nodes that node ``i`` is hashed with."""
        lo = i // FAN * FAN
        return range(lo, min(lo + FAN, self.width[level]))

    def siblings(self, i: int) -> list[tuple[str, str]]:
        """Digests before and after the node on the way from leaf ``i`` to the
        block's root, as hex text, level by level."""
        out = []
        for level in range(self.height):
            run = self.run(level, i)
            out.append(("".join([self.digest(level, j).hex() for j in run if j < i]),
                        "".join([self.digest(level, j).hex() for j in run if j > i])))
            i //= FAN
        return out


def folded(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf's digest and its siblings lead to."""
    for before, after in path:
        digest = hashlib.sha256((before + digest + after).encode()).hexdigest()
    return digest


def leaf_text(cols: list[Column]) -> Column:
    """Values one after the other: ``-`` for null, else bytes, ``:``, value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.concat(*[one(c) for c in cols])


def ranked(nodes: DataFrame, group: str, order: list[str], count: str, name: str) -> DataFrame:
    """Adds ``_lo`` and ``_total``: rows before this one within its group, and
    rows of the group, a row standing for ``count`` equal ones.

    Rows are sorted by ranges of (group, order), so no group is one task; a
    range's start comes from the counts per range."""
    keys = [group, *order]
    spread = saved(nodes.repartitionByRange(partitions_for(nodes.sparkSession), *keys)
                   .withColumn("_part", F.spark_partition_id()), f"{name}-ranges")
    sums = spread.groupBy(group, "_part").agg(F.sum(count).alias("_n"))
    in_group = Window.partitionBy(group)
    starts = saved(sums.select(group, F.col("_part"), F.coalesce(F.sum("_n").over(
        in_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_n").over(in_group).alias("_total")), f"{name}-starts")
    before = F.sum(count).over(Window.partitionBy("_part", group).orderBy(*order)
                               .rowsBetween(Window.unboundedPreceding, -1))
    return (spread.withColumn("_before", F.coalesce(before, F.lit(0)))
            .join(starts, (spread["_part"] == starts["_part"]) & spread[group].eqNullSafe(starts[group]))
            .select(*[spread[c] for c in nodes.columns], (F.col("_start") + F.col("_before")).alias("_lo"), "_total"))


_BUILT = "tree string, is_null boolean, tier int, block long, height int, leaves int, total long, data binary, root string"


def _build(tier: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo", kind="stable")
        total = int(pdf["total"].iloc[0])
        size = FAN ** HEIGHT
        leaves = [bytes.fromhex(d) for d, lo, hi in zip(pdf["digest"], pdf["lo"], pdf["hi"]) for _ in range(hi - lo)]
        block = Block.build(HEIGHT if total > size else height_of(total), leaves)
        return pd.DataFrame({"tree": [key[0]], "is_null": [bool(key[1])], "tier": [tier], "block": [key[2]],
                             "height": [block.height], "leaves": [len(leaves)], "total": [total],
                             "data": [bytes(block.data)], "root": [block.digest(block.height, 0).hex()]})
    return run


def _cut(nodes: DataFrame) -> DataFrame:
    """Rows that stand for the leaves from ``lo`` to ``hi`` -> the same by
    ``block``. A row of very many equal leaves is cut in all its blocks."""
    size = FAN ** HEIGHT
    first, last = F.expr(f"lo div {size}L"), F.expr(f"(hi - 1) div {size}L")
    start = F.col("block") * size
    return (nodes.withColumn("block", F.explode(F.sequence(first, last)))
            .withColumn("lo", F.greatest(F.col("lo"), start))
            .withColumn("hi", F.least(F.col("hi"), start + size)))


def _tiers(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of each tier, from leaves cut by ``_cut`` (tree, is_null, lo, hi,
    total, digest, block). Every tier has 4096 times fewer nodes."""
    out, nodes = [], leaves
    while True:
        blocks = saved(nodes.select("tree", "is_null", "block", "lo", "hi", "total", "digest")
                       .groupBy("tree", "is_null", "block").applyInPandas(_build(len(out)), _BUILT), f"{name}-blocks")
        out.append(blocks)
        size = FAN ** HEIGHT
        above = blocks.filter(F.col("total") > size)
        if above.limit(1).count() == 0:
            return out
        total = F.expr(f"(total + {size - 1}L) div {size}L")
        nodes = _cut(above.select("tree", "is_null", F.col("block").alias("lo"), (F.col("block") + 1).alias("hi"),
                                  total.alias("total"), F.col("root").alias("digest")))


_PATHS = "tree string, is_null boolean, block long, root string, before array<string>, after array<string>"


def _paths_in(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The way from each block's root to the root of all, from the block of
    the tier above that holds it and that block's own way."""
    for b in batches:
        out = []
        for r in b.itertuples(index=False):
            block = Block(int(r.height), int(r.leaves), r.data)
            for i in range(block.width[0]):
                path = block.siblings(i)
                out.append((r.tree, bool(r.is_null), int(r.block) * FAN ** HEIGHT + i, r.root,
                            [x for x, _ in path] + list(r.before), [y for _, y in path] + list(r.after)))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _PATHS.split(", ")])


def _joined(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    way = paths.select("tree", "is_null", "block", F.col("root").alias("top"), "before", "after")
    return (blocks.join(way, ["tree", "is_null", "block"])
            .select("tree", "is_null", "block", "height", "leaves", "data", F.col("top").alias("root"), "before", "after"))


def _ways(tiers: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """For each block of the lowest tier: (tree, is_null, block, root, before,
    after), the siblings above it up to the root. ``tops`` has the same for
    the top block of each tree. Each tier is joined with the one above it."""
    paths = tops
    for blocks in reversed(tiers[1:]):
        under = saved(_joined(blocks, paths).mapInPandas(_paths_in, _PATHS), f"{name}-ways")
        # a tree whose top is here has its way from ``tops``, others from the tier above
        paths = under.unionByName(tops.join(under.select("tree", "is_null").distinct(), ["tree", "is_null"], "anti"))
    return paths


_PROOFS = ("key string, leaf string, lo long, hi long, subroot string, root string, proof_sha256 string, "
           "folded_root string")


def _prove(key: tuple, leaves: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
    """Proof of every leaf of a block, and the root that its given digest
    leads to. ``data`` is the block, the way above it the same for all."""
    b = blocks.iloc[0]
    block = Block(int(b["height"]), int(b["leaves"]), b["data"])
    above = list(zip(b["before"], b["after"]))
    tail = "".join([x + y for x, y in above]).encode()
    start = int(key[2]) * FAN ** HEIGHT
    out = []
    for k, leaf, given, lo, hi in zip(*(leaves[c].tolist() for c in ("key", "digest", "given", "lo", "hi"))):
        for i in range(lo, hi):
            path = block.siblings(i - start)
            proof = hashlib.sha256("".join([x + y for x, y in path]).encode())
            proof.update(tail)
            out.append((k, leaf, i, i + 1, b["subroot"], b["root"], proof.hexdigest(), folded(given, path + above)))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _PROOFS.split(", ")])


def manifest(leaves: DataFrame, group: str, order: list[str], name: str = "merkle") -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The tree over ``leaves`` (columns ``group``, ``order`` and ``_digest``,
    a lower-case hex sha256): the leaves cut by blocks, the tiers of blocks,
    and the ways of the groups' trees to the root of all.

    Groups are ordered by their name's bytes, null first; leaves by ``order``,
    null first, then by digest. Equal rows are counted, not sorted: the same
    leaf many times is one row until its blocks are built. An empty table has
    no block.
    """
    keys = [c for c in leaves.columns if c != "_count"]
    rows = saved(leaves.groupBy(*keys).agg(F.count(F.lit(1)).alias("_count")), f"{name}-leaves")
    at = ranked(rows, group, [*order, "_digest"], "_count", name)
    cut = saved(_cut(at.select(F.coalesce(F.col(group), F.lit("")).alias("tree"), F.col(group).isNull().alias("is_null"),
                               F.col("_lo").alias("lo"), (F.col("_lo") + F.col("_count")).alias("hi"),
                               F.col("_total").alias("total"), F.col("_digest").alias("digest"),
                               *[c for c in keys if c not in (group, "_digest")])), f"{name}-cut")
    tiers = _tiers(cut, name)
    size = FAN ** HEIGHT
    tops = [t.filter(F.col("total") <= size) for t in tiers]
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    roots = saved(roots.select("tree", "is_null", F.col("root").alias("_digest"), F.lit(1).cast("long").alias("_count"),
                               F.lit("").alias("_all"), (~F.col("is_null")).alias("_named")), f"{name}-roots")
    over = ranked(roots, "_all", ["_named", "tree"], "_count", f"{name}-groups")
    ends = saved(over.select(F.col("tree").alias("of"), F.col("is_null").alias("of_null"), F.col("_lo").alias("at"),
                             F.col("_digest").alias("digest"), F.col("_total").alias("total")), f"{name}-ends")
    whole = _tiers(_cut(ends.select(F.lit("").alias("tree"), F.lit(False).alias("is_null"), F.col("at").alias("lo"),
                                    (F.col("at") + 1).alias("hi"), "total", "digest")), f"{name}-over")
    top = whole[-1].select("tree", "is_null", "block", "root", F.expr("cast(array() as array<string>)").alias("before"),
                           F.expr("cast(array() as array<string>)").alias("after"))
    under = _joined(whole[0], _ways(whole, top, f"{name}-over")).mapInPandas(_paths_in, _PATHS)
    ways = saved(ends.join(under.withColumnRenamed("block", "at").drop("tree", "is_null"), "at")
                 .select(F.col("of").alias("tree"), F.col("of_null").alias("is_null"), F.lit(0).cast("long").alias("block"),
                         F.col("digest").alias("subroot"), "root", "before", "after"), f"{name}-tops")
    return cut, tiers, ways


def proofs(cut: DataFrame, tiers: list[DataFrame], tops: DataFrame, key: str, given: str,
           name: str = "merkle") -> DataFrame:
    """For each leaf: ``_PROOFS``. ``key`` names it in the result, ``given``
    is the digest that is folded with the original siblings."""
    ways = _ways(tiers, tops.drop("subroot"), name)
    base = (_joined(tiers[0], ways).join(tops.select("tree", "is_null", "subroot"), ["tree", "is_null"]))
    base = saved(base, f"{name}-base")
    rows = cut.select("tree", "is_null", "block", "lo", "hi", "digest", F.col(key).cast("string").alias("key"),
                      F.col(given).alias("given"))
    by = ("tree", "is_null", "block")
    return rows.groupBy(*by).cogroup(base.groupBy(*by)).applyInPandas(_prove, _PROOFS)


def verify(docs: DataFrame, tampered: dict[str, Column], key_col: str = "doc_id", group_col: str = "lang",
           cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Manifest of ``docs`` and a check of each row as it is with the columns
    of ``tampered`` in place: (doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified).

    Nulls are values of their own in a leaf; a null key comes first, a null
    group is the first one. Equal keys are ordered by leaf; repeated rows are
    leaves each, with a proof each. Texts of any length are hashed whole, in
    the JVM. Other columns are not read. An empty table gives an empty result.
    """
    of = {c: F.col(f"`{c}`") for c in cols}
    digest = F.sha2(leaf_text([of[c] for c in cols]), 256)
    given = F.sha2(leaf_text([tampered.get(c, of[c]) for c in cols]), 256)
    leaves = docs.select(F.col(f"`{group_col}`").cast("string").alias("_group"),
                         F.col(f"`{key_col}`").cast("long").alias("_key"), digest.alias("_digest"), given.alias("_given"))
    cut, tiers, tops = manifest(leaves, "_group", ["_key"])
    out = proofs(cut, tiers, tops, "_key", "_given")
    return out.select(F.col("key").cast("long").alias(key_col), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """All documents as leaves, a third of them checked in lower case."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.when(third, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return verify(table(spark, sf_dir, "documents"), {"text": lowered})


def _sql_leaf(text: str) -> str:
    def one(c: str) -> str:
        return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    return f"sha256({' || '.join(one(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


# crc32 of the decimal id, bit by bit: the polynomial is the fixed value of CRC-32
_SQL_CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] "
            "for c in string_split(doc_id::VARCHAR, '')])), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) "
            "WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))")

ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT *, {_sql_leaf('text')} AS leaf,
         CASE WHEN {_SQL_CRC} % 3 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")}
              ELSE {_sql_leaf('text')} END AS given FROM documents),
p AS (SELECT doc_id, lang, leaf, given, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
t AS (SELECT lang, 0 AS lvl, pos AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM p
      UNION ALL
      SELECT lang, lvl + 1, i // {FAN}, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + {FAN - 1}) // {FAN}
      FROM t WHERE n > 1 GROUP BY lang, lvl, i // {FAN}),
sub AS (SELECT lang, h, lvl AS height, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS pos FROM t WHERE n = 1),
g AS (SELECT 0 AS lvl, pos AS i, h, count(*) OVER () AS n FROM sub
      UNION ALL
      SELECT lvl + 1, i // {FAN}, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + {FAN - 1}) // {FAN}
      FROM g WHERE n > 1 GROUP BY lvl, i // {FAN}),
nodes AS (SELECT lang, false AS over, lvl, i, h, n FROM t UNION ALL SELECT NULL, true, lvl, i, h, n FROM g),
steps AS (SELECT p.doc_id, p.leaf, p.lang, p.pos, x.lvl + CASE WHEN x.over THEN 1000 ELSE 0 END AS step,
                 string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < (CASE WHEN x.over THEN s.pos ELSE p.pos END) // ({FAN} ** x.lvl)::BIGINT) AS before,
                 string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > (CASE WHEN x.over THEN s.pos ELSE p.pos END) // ({FAN} ** x.lvl)::BIGINT) AS after
          FROM p JOIN sub s ON s.lang IS NOT DISTINCT FROM p.lang
          JOIN nodes x ON x.n > 1 AND (x.over OR x.lang IS NOT DISTINCT FROM p.lang)
               AND x.i // {FAN} = (CASE WHEN x.over THEN s.pos ELSE p.pos END) // ({FAN} ** (x.lvl + 1))::BIGINT
          GROUP BY ALL),
paths AS (SELECT p.doc_id, p.lang, p.pos, p.leaf, any_value(p.given) AS given, any_value(sub.h) AS subroot, (SELECT h FROM g WHERE n = 1) AS root,
                 sha256(coalesce(string_agg(coalesce(before, '') || coalesce(after, ''), '' ORDER BY step), '')) AS proof_sha256,
                 list(coalesce(before, '') ORDER BY step) FILTER (step IS NOT NULL) AS b,
                 list(coalesce(after, '') ORDER BY step) FILTER (step IS NOT NULL) AS a
          FROM p JOIN sub ON sub.lang IS NOT DISTINCT FROM p.lang
          LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM p.lang AND s.pos = p.pos
          GROUP BY p.doc_id, p.lang, p.pos, p.leaf),
fold AS (SELECT lang, pos, 0 AS k, given AS h FROM paths
         UNION ALL
         SELECT f.lang, f.pos, k + 1, sha256(q.b[k + 1] || f.h || q.a[k + 1])
         FROM fold f JOIN paths q ON q.lang IS NOT DISTINCT FROM f.lang AND q.pos = f.pos WHERE k < coalesce(len(q.b), 0))
SELECT q.doc_id, leaf, subroot, root, proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM paths q JOIN fold f ON f.lang IS NOT DISTINCT FROM q.lang AND f.pos = q.pos AND f.k = coalesce(len(q.b), 0)
"""
