"""Merkle manifest against a plain recursive tree."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

from .cases import DOCS, docs, empty, texts

UP = str.maketrans(merkle.UPPER, merkle.LOWER)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(level):
    """Levels of a tree, leaves first."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(levels, i):
    out = []
    for level in levels[:-1]:
        lo = i // 8 * 8
        out.append(("".join(level[lo:i]), "".join(level[i + 1:lo + 8])))
        i //= 8
    return out


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    def order(v):
        return (v is not None, v.encode() if isinstance(v, str) else v or 0)
    trees = {}
    for lang in sorted({r[2] for r in rows}, key=order):
        mine = sorted(((order(r[0]), leaf(*r), r) for r in rows if r[2] == lang), key=lambda x: x[:2])
        trees[lang] = (mine, climb([x[1] for x in mine]))
    over = climb([t[-1][0] for _, t in trees.values()])
    out = Counter()
    for g, (mine, tree) in enumerate(trees.values()):
        for i, (_, h, r) in enumerate(mine):
            steps = path(tree, i) + path(over, g)
            given = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                given = leaf(*r[:4], None if r[4] is None else r[4].translate(UP))
            for before, after in steps:
                given = sha(before, given, after)
            out[r[0], h, tree[-1][0], over[-1][0], sha(*[b + a for b, a in steps]), given, given == over[-1][0]] += 1
    return out


def got(df):
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    low = F.when(third, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    return Counter(tuple(r) for r in merkle.verify(df, {"text": low}).collect())


def many(spark, n, langs, seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(langs)
        rows.append((r.choice([i, -i, 7, None]), r.choice(["s", None, "é"]), lang, r.choice([None, i]), r.choice([None, "", "Ab", f"t{i}"])))
    rows += [(3, "s", langs[0], 1, "SAME")] * 70
    full = [(i, t, la, s, n, 5, "x", 1, 0.5, "clash", "k") for i, s, la, n, t in rows]
    return rows, spark.createDataFrame(full, DOCS)


@pytest.mark.parametrize("height, n, langs", [
    (4, 200, ["en", None, "de", ""]), (1, 700, ["en", None]), (2, 150, [f"l{i}" for i in range(30)] + [None]), (1, 0, ["x"])])
def test_manifest_matches_brute_force(spark, monkeypatch, height, n, langs):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows, df = many(spark, n, langs)
    assert got(df) == brute(rows)


def test_manifest_of_awkward_documents(spark):
    rows = [(i, s, "en", None if t is None else len(t), t) for i, t, s in texts()]
    assert got(docs(spark)) == brute(rows)
    assert got(empty(spark)) == Counter()


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_are_places_of_all_nodes(levels):
    at = merkle.addresses(levels)
    assert [len(a) for a in at] == [8 ** k for k in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range(merkle.nodes_of(levels)))
    if levels == 4:  # a bottom tree lies in one piece
        low = np.concatenate([at[2][:8], at[3][:64]])
        assert sorted(low.tolist())[0] == merkle.nodes_of(2) and np.ptp(at[3][:8]) == 7


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 600])
def test_blocks_hold_the_whole_tree(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    block = merkle.Block.build(merkle.height_of(n), leaves)
    tree = climb([x.hex() for x in leaves])
    assert block.digest(block.height, 0).hex() == tree[-1][0]
    for i in {0, n // 2, n - 1}:
        assert block.siblings(i) == path(tree, i)
        assert merkle.folded(leaves[i].hex(), block.siblings(i)) == tree[-1][0]
