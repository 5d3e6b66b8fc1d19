"""Phrase collocations from one FM-index per shard of the corpus.

Documents of a language are dealt into shards of word ids. A shard's words in
order (0 between pieces) are indexed forwards and backwards: rows are the
positions sorted by their next ``DEPTH`` words, the BWT is the word before
each row. An interval of rows in either index stands for a phrase; extending
it by a word to the left (forward index) or right (backward index) gives the
intervals of all longer phrases at once, in both indexes, with their counts.
Rows of a sort by ``DEPTH`` words are enough: no phrase is longer.

Counts are summed over shards level by level. Words below the least count
become piece ends before a shard is indexed, pairs below it are not extended
further, so what leaves a shard is near to what can still be a candidate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, table
from tidemark.session import fresh_scratch

DEPTH = 4  # words of the longest phrase
LEAST = 30  # occurrences of a candidate
TOP = 2000  # phrases reported per language
INSIDE = (80, 100)  # a candidate goes if a longer one has this share of its occurrences
SHARD_WORDS = 2_000_000  # words and piece ends of a shard, about
RANK_PARTS = 64  # parts in which a language's phrases are ranked before all are
SLICE_BYTES = 4 << 20  # bytes of a text that are split at a time

_END = 0xFF  # no byte of UTF-8: stands for an end of a piece
# lower-cases A-Z; . , ; : ! ? and line ends end a piece
_BYTES = bytes(b + 32 if 65 <= b <= 90 else _END if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_GAP = re.compile(rb"[ \t\xff]")

LEFT, RIGHT = 0, 1


class _Ids(dict):
    """Ids of words in the order of their first use; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


class _Shard:
    """Words of one language that one task has read and not yet given out."""

    def __init__(self):
        self.ids = _Ids({bytes([_END]): 0})
        self.parts: list[np.ndarray] = [np.zeros(1, np.int32)]
        self.size = 1
        self.skip = 0  # words at the start that the shard before has counted

    def add(self, text: bytes) -> None:
        words = text.replace(b"\xff", b" \xff ").split()
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def end(self) -> None:
        self.parts.append(np.zeros(1, np.int32))
        self.size += 1


def _slices(text: str) -> Iterator[bytes]:
    """A text's bytes after lower-casing, in slices that break no word."""
    data = text.encode("utf-8", "surrogatepass").translate(_BYTES)
    lo = 0
    while len(data) - lo > SLICE_BYTES:
        gap = _GAP.search(data, lo + SLICE_BYTES)
        if gap is None:
            break
        yield data[lo:gap.start()]
        lo = gap.start()
    yield data[lo:] if lo else data


_SHARDS = "kind string, shard long, lang string, ids binary, skip int, word string, id int, uid long, n long"


def _deal(shard_words: int, part: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shards of one partition's documents: a row of kind ``ids`` with the word
    ids in order, rows of kind ``word`` with each word and its count (``uid``
    is unlike any other). Shards of several languages are open at a time."""
    open_: dict[str, _Shard] = {}
    seq, uid = part << 32, part << 40

    def give(lang: str, inside: bool) -> Iterator[pd.DataFrame]:
        """Gives out a shard. If a piece goes on, its last words are
        repeated at the start of the next shard, which does not count them."""
        nonlocal seq, uid
        shard = open_.pop(lang)
        ids = np.concatenate(shard.parts)
        if inside:
            tail = ids[-(DEPTH - 1):]
            tail = tail[np.flatnonzero(tail == 0)[-1] + 1:] if (tail == 0).any() else tail
            names = {i: w for w, i in shard.ids.items() if i in set(tail.tolist())}
            rest = open_[lang] = _Shard()
            rest.parts.append(np.array([rest.ids[names[i]] for i in tail.tolist()], np.int32))
            rest.size += len(tail)
            rest.skip = len(tail)
            ids = np.append(ids, np.int32(0))
        counted = np.bincount(ids[1 + shard.skip:], minlength=len(shard.ids))
        counted[0] = 0
        yield pd.DataFrame({"kind": ["ids"], "shard": [seq], "lang": [lang],
                            "ids": [ids.astype("<i4").tobytes()], "skip": [shard.skip], "word": [None],
                            "id": [0], "uid": [0], "n": [int(counted.sum())]})
        words = [w.decode("utf-8", "replace") for w in shard.ids]
        for lo in range(1, len(words), 100_000):
            got = words[lo:lo + 100_000]
            yield pd.DataFrame({"kind": "word", "shard": seq, "lang": lang, "ids": None, "skip": 0, "word": got,
                                "id": np.arange(lo, lo + len(got), dtype=np.int32), "uid": uid + np.arange(lo, lo + len(got)),
                                "n": counted[lo:lo + len(got)]})
        seq += 1
        uid += len(words)

    for b in batches:
        for lang, text in zip(b["lang"].tolist(), b["text"].tolist()):
            for part_of in _slices(text):
                shard = open_.setdefault(lang, _Shard())
                shard.add(part_of)
                if shard.size >= shard_words:
                    yield from give(lang, True)
            open_.setdefault(lang, _Shard()).end()
            if sum(s.size for s in open_.values()) >= 3 * shard_words:
                yield from give(max(open_, key=lambda k: open_[k].size), False)
    for lang in sorted(open_):
        yield from give(lang, False)


class BiIndex:
    """FM-indexes of a sequence of word ids and of its reverse, to ``DEPTH`` words.

    ``bwt[LEFT]`` holds the word before each row of the forward index,
    ``bwt[RIGHT]`` the word after each row of the backward one. An interval is
    a column of ``lo`` (2 x K: its first row in both) with its length ``n``.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.bwt = (left, right)
        self.counts = np.bincount(left) if len(left) else np.zeros(1, np.int64)
        self.first = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)
        self._from: list[np.ndarray | None] = [None, None]

    @staticmethod
    def order(seq: np.ndarray) -> np.ndarray:
        """Positions of a cyclic sequence sorted by their next ``DEPTH`` words."""
        m = int(seq.max(initial=0)) + 1
        if m ** DEPTH < 1 << 63:
            key = seq.astype(np.int64)
            for k in range(1, DEPTH):
                key *= m
                key += np.roll(seq, -k)
            return np.argsort(key).astype(np.int32)
        return np.lexsort([np.roll(seq, -k) for k in range(DEPTH - 1, -1, -1)]).astype(np.int32)

    @classmethod
    def build(cls, seq: np.ndarray) -> tuple[BiIndex, np.ndarray]:
        """The index, and the forward order."""
        seq = np.ascontiguousarray(seq)
        kind = np.uint16 if seq.max(initial=0) < 1 << 16 else np.uint32
        rows = cls.order(seq)
        left = seq[rows - 1].astype(kind)
        back = np.ascontiguousarray(seq[::-1])
        right = back[cls.order(back) - 1].astype(kind)
        return cls(left, right), rows

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of the single words: (word, lo, n)."""
        start = np.concatenate([[0], np.cumsum(self.counts)])[:-1]
        word = np.flatnonzero(self.counts[1:]) + 1
        return word, np.stack([start[word], start[word]]), self.counts[word]

    def extend(self, side: int, lo: np.ndarray, n: np.ndarray):
        """All one-word extensions, to the side, of intervals (apart from each
        other) whose other part is among them too: (parent, word, lo, n).

        Row j of the sorted words came from row i = from[j] of the BWT, so a
        run of equal (word, interval of i) is the interval of an extension. In
        the other index an extension starts after those by smaller words.
        """
        if self._from[side] is None:
            self._from[side] = np.argsort(self.bwt[side], kind="stable").astype(np.int32)
        at = np.arange(int(n.sum()), dtype=np.int32)
        at += np.repeat((lo[side] - np.cumsum(n) + n).astype(np.int32), n)
        mark = np.full(len(self.first), -1, np.int32)
        mark[at] = np.repeat(np.arange(len(n), dtype=np.int32), n)
        del at
        parent = mark[self._from[side]]
        rows = np.flatnonzero(parent >= 0).astype(np.int32)
        parent, word = parent[rows], self.first[rows]
        new = np.flatnonzero(np.r_[True, (parent[1:] != parent[:-1]) | (word[1:] != word[:-1])]) if len(rows) \
            else np.empty(0, np.int64)
        parent, word, here, count = parent[new], word[new], rows[new], np.diff(np.r_[new, len(rows)])
        by = np.argsort(parent, kind="stable")  # words rise within a parent
        before = np.cumsum(count[by]) - count[by]
        starts = np.flatnonzero(np.r_[True, np.diff(parent[by]) != 0]) if len(by) else by
        before -= np.repeat(before[starts], np.diff(np.r_[starts, len(by)]))
        there = np.empty(len(by), np.int64)
        there[by] = lo[1 - side][parent[by]] + before
        keep = (word > 0) & (mark[here] >= 0)
        both = np.empty((2, int(keep.sum())), np.int64)
        both[side], both[1 - side] = here[keep], there[keep]
        return parent[keep], word[keep], both, count[keep]


def _less_repeated(count: np.ndarray, lo: np.ndarray, heads: np.ndarray, depth: int) -> np.ndarray:
    """Counts without the phrases that lie whole in a shard's repeated words.
    ``heads``: rows of the forward index at which these words start."""
    out = count.copy()
    by = np.argsort(lo[LEFT])
    for row in heads[:max(0, len(heads) - depth + 1)].tolist():
        k = int(np.searchsorted(lo[LEFT][by], row, "right")) - 1
        if k >= 0 and row < lo[LEFT][by[k]] + count[by[k]]:
            out[by[k]] -= 1
    return out


def _reduced(ids: np.ndarray, skip: int, kept: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with kept words alone, numbered from 1, piece ends (0)
    elsewhere, never two in a row; and where the repeated words are now."""
    number = np.zeros(size, np.int32)
    number[kept] = np.arange(1, len(kept) + 1)
    seq = number[ids]
    stay = np.r_[True, (seq[1:] > 0) | (seq[:-1] > 0)]
    place = np.cumsum(stay) - 1
    return seq[stay], place[1:1 + skip]


_INDEX = ("kind string, shard long, left binary, right binary, gids binary, heads binary, "
          "k int, g1 long, g2 long, n long")


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Indexes shards: a row of kind ``index`` each, rows of kind ``pair``."""
    for b in batches:
        for shard, ids, skip, kept, gids in zip(*(b[c].tolist() for c in ("shard", "ids", "skip", "kept", "gids"))):
            ids = np.frombuffer(ids, "<i4")
            kept, gids = np.asarray(kept, np.int64), np.asarray(gids, np.int64)
            by = np.argsort(kept)
            kept, gids = kept[by], gids[by]
            seq, heads = _reduced(ids, skip, kept, int(ids.max()) + 1)
            index, rows = BiIndex.build(seq)
            heads = np.array([int(np.flatnonzero(rows == p)[0]) for p in heads.tolist()], np.int64)
            word, lo, n = index.words()
            parent, first, lo, n = index.extend(LEFT, lo, n)
            yield pd.DataFrame({"kind": ["index"], "shard": [shard], "left": [index.bwt[LEFT].astype("<u4").tobytes()
                                if index.bwt[LEFT].dtype != np.uint16 else index.bwt[LEFT].astype("<u2").tobytes()],
                                "right": [index.bwt[RIGHT].astype("<u4").tobytes()
                                          if index.bwt[RIGHT].dtype != np.uint16
                                          else index.bwt[RIGHT].astype("<u2").tobytes()],
                                "gids": [gids.astype("<i8").tobytes()], "heads": [heads.astype("<i8").tobytes()],
                                "k": [len(seq)], "g1": [0], "g2": [0], "n": [0]})
            n = _less_repeated(n, lo, heads, 2)
            k = np.flatnonzero(n)
            for at in range(0, len(k), 100_000):
                c = k[at:at + 100_000]
                yield pd.DataFrame({"kind": "pair", "shard": shard, "left": None, "right": None, "gids": None,
                                    "heads": None, "k": c.astype(np.int32), "g1": gids[first[c] - 1],
                                    "g2": gids[word[parent[c]] - 1], "n": n[c]})


_PHRASES = "g1 long, g2 long, g3 long, g4 long, n long"


def _longer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Phrases of three and four words all of whose pairs are frequent: pairs
    extended to the right, then to the left."""
    for b in batches:
        for size, left, right, gids, heads, pairs in zip(*(b[c].tolist() for c in (
                "size", "left", "right", "gids", "heads", "pairs"))):
            kind = "<u2" if len(left) == 2 * size else "<u4"
            index = BiIndex(np.frombuffer(left, kind), np.frombuffer(right, kind))
            gids, heads = np.frombuffer(gids, "<i8"), np.frombuffer(heads, "<i8")
            word, lo, n = index.words()
            parent, first, lo, n = index.extend(LEFT, lo, n)
            some = np.sort(np.asarray(pairs, np.int64))
            phrase = np.stack([first[some], word[parent[some]]])
            lo, n = lo[:, some], n[some]
            for side in (RIGHT, LEFT):
                parent, more, lo, n = index.extend(side, lo, n)
                old = phrase[:, parent]
                phrase = np.vstack([old, more] if side == RIGHT else [more, old])
                seen = _less_repeated(n, lo, heads, len(phrase))
                out = np.full((DEPTH, len(n)), -1, np.int64)
                out[:len(phrase)] = gids[phrase - 1]
                k = np.flatnonzero(seen)
                yield pd.DataFrame({**{f"g{i + 1}": out[i][k] for i in range(DEPTH)}, "n": seen[k]})


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
           shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """Occurrences of all phrases of one to ``DEPTH`` words that occur ``least``
    times in their language: (lang, words, phrase, n); and (lang, n), the words
    of each language.

    Null text is empty, a null language is ``und``. A text of any length is
    split in slices and may span shards; phrases over the border are counted
    once. Repeated rows count each. Languages without words have no row; an
    empty table gives none. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def deal(batches):
        from pyspark import TaskContext
        return _deal(shard_words, TaskContext.get().partitionId(), batches)

    path = fresh_scratch(spark, "phrase-shards")
    rows.mapInPandas(deal, _SHARDS).write.option("compression", "zstd").parquet(path)
    kinds = spark.read.schema(_SHARDS).parquet(path)
    shards = kinds.filter("kind = 'ids'").select("shard", "lang", "ids", "skip", "n")
    words = kinds.filter("kind = 'word'").select("shard", "lang", "word", "id", "uid", "n")
    totals = saved(shards.groupBy("lang").agg(F.sum("n").alias("n")).filter("n > 0"), "phrase-totals")

    # a word has a row a shard; one shuffle gives each row the word's total
    # and one uid for all of them
    same = Window.partitionBy("lang", "word")
    frequent = saved(words.select("*", F.sum("n").over(same).alias("total"), F.min("uid").over(same).alias("gid"))
                     .filter(F.col("total") >= least).drop("uid", "n"), "phrase-words")
    known = saved(frequent.groupBy("gid").agg(F.first("lang").alias("lang"), F.first("word").alias("word"),
                                              F.first("total").alias("n")), "phrase-known")
    marks = saved(frequent.groupBy("shard").agg(F.collect_list("id").alias("kept"), F.collect_list("gid").alias("gids")),
                  "phrase-marks")
    path = fresh_scratch(spark, "phrase-indexes")
    (shards.join(marks, "shard").select("shard", "ids", "skip", "kept", "gids")
     .mapInPandas(_index, _INDEX).write.option("compression", "zstd").parquet(path))
    kinds = spark.read.schema(_INDEX).parquet(path)
    indexes = kinds.filter("kind = 'index'").select("shard", F.col("k").alias("size"), "left", "right", "gids", "heads")
    seen = kinds.filter("kind = 'pair'").select("shard", "k", "g1", "g2", "n")

    of_pair = Window.partitionBy("g1", "g2")
    frequent = saved(seen.withColumn("total", F.sum("n").over(of_pair)).filter(F.col("total") >= least).drop("n"),
                     "phrase-pairs")
    pairs = frequent.groupBy("g1", "g2").agg(F.first("total").alias("n"))
    marks = saved(frequent.groupBy("shard").agg(F.collect_list("k").alias("pairs")), "phrase-marks")
    longer = saved(indexes.join(marks, "shard").select("size", "left", "right", "gids", "heads", "pairs")
                   .mapInPandas(_longer, _PHRASES).groupBy("g1", "g2", "g3", "g4").agg(F.sum("n").alias("n"))
                   .filter(F.col("n") >= least), "phrase-longer")
    # names of the words, joined once for all places
    many = longer.unionByName(pairs.select("g1", "g2", F.lit(-1).cast("long").alias("g3"),
                                           F.lit(-1).cast("long").alias("g4"), "n"))
    gs = [f"g{i + 1}" for i in range(DEPTH)]
    placed = (many.select(*gs, "n", F.posexplode(F.array(*gs)).alias("at", "gid")).filter("gid >= 0")
              .join(known.select("gid", "lang", "word"), "gid")
              .groupBy(*gs, "n").agg(F.first("lang").alias("lang"),
                                     F.sort_array(F.collect_list(F.struct("at", "word"))).alias("_w")))
    named = placed.select("lang", F.col("_w.word").alias("words"), "n").unionByName(
        known.select("lang", F.array("word").alias("words"), "n"))
    return saved(named.withColumn("phrase", F.concat_ws(" ", "words")), "phrase-counts"), totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 top: int | None = TOP, inside: tuple[int, int] = INSIDE,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """The best phrases of two or more words of each language: (lang, rank,
    phrase, a, l, r, n, score, left, right).

    The score of the weakest cut counts: ``floor(2000000 a / (l + r))``, ``l``
    and ``r`` the occurrences of the parts. ``left`` and ``right`` are the
    occurrences of the commonest phrase one word longer on that side (0: none
    reaches ``least``); a phrase of which one of these has the share
    ``inside`` is dropped. A longer phrase that held it with that share would
    hold it by one of these too. Cases as of ``counts``; ``top`` None: all.
    """
    seen, totals = counts(docs, text_col, lang_col, least, shard_words)
    size = F.size("words")
    found = seen.filter(size > 1).select("lang", "phrase", "words", F.col("n").alias("a"))
    # one row for each phrase inside a longer one, by the side that has the other word
    grown = (found.filter(size > 2).select("lang", "a", F.explode(F.array(
        F.struct(F.slice("words", F.lit(2), size - 1).alias("w"), F.col("a").alias("left"), F.lit(0).cast("long").alias("right")),
        F.struct(F.slice("words", F.lit(1), size - 1).alias("w"), F.lit(0).cast("long").alias("left"), F.col("a").alias("right")),
    )).alias("_e")).groupBy("lang", F.concat_ws(" ", "_e.w").alias("phrase"))
        .agg(F.max("_e.left").alias("left"), F.max("_e.right").alias("right")))
    none = F.lit(0).cast("long")
    rows = found.join(grown, ["lang", "phrase"], "left").select(
        "lang", "phrase", "words", "a", F.coalesce("left", none).alias("left"), F.coalesce("right", none).alias("right"))
    whole = F.col("a").cast("decimal(20,0)")
    rows = rows.filter(F.greatest("left", "right").cast("decimal(20,0)") * inside[1] < whole * inside[0])
    parts = rows.select("lang", "phrase", "a", "left", "right", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), size - 1), lambda k: F.array(
            F.struct(k.alias("k"), F.lit(0).alias("rest"), F.concat_ws(" ", F.slice("words", F.lit(1), k)).alias("part")),
            F.struct(k.alias("k"), F.lit(1).alias("rest"),
                     F.concat_ws(" ", F.slice("words", k + 1, size - k)).alias("part")))))).alias("_p"))
    of = seen.select("lang", F.col("phrase").alias("part"), F.col("n").alias("_n"))
    cuts = (parts.select("lang", "phrase", "a", "left", "right", "_p.*").join(of, ["lang", "part"])
            .groupBy("lang", "phrase", "a", "left", "right", "k")
            .agg(F.max(F.expr("if(rest = 0, _n, 0)")).alias("l"), F.max(F.expr("if(rest = 1, _n, 0)")).alias("r")))
    score = F.expr("cast((cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r) as long)")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "left", "right")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("_c")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = best.select("lang", "phrase", "a", "left", "right", "_c.*")
    if top is not None:  # the best of each of many parts of a language first
        parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
        ranked = ranked.withColumn("rank", F.row_number().over(parted)).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "left", "right")


def op13_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM t),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM p),
f AS (SELECT lang, w, array_to_string(w, ' ') AS phrase, count(*)::BIGINT AS n FROM (
      {" UNION ALL ".join(f"SELECT lang, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: w[i:i + {k - 1}])) AS w FROM w WHERE len(w) >= {k}" for k in range(1, DEPTH + 1))})
      GROUP BY lang, w),
n AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE len(w) = 1 GROUP BY lang),
c AS (SELECT lang, w, phrase, n AS a FROM f WHERE len(w) > 1 AND n >= {LEAST}),
e AS (SELECT lang, array_to_string(w[2:], ' ') AS phrase, a AS l, 0 AS r FROM c WHERE len(w) > 2
      UNION ALL SELECT lang, array_to_string(w[:len(w) - 1], ' '), 0, a FROM c WHERE len(w) > 2),
g AS (SELECT lang, phrase, max(l)::BIGINT AS "left", max(r)::BIGINT AS "right" FROM e GROUP BY lang, phrase),
-- inside any longer candidate, at any place
x AS (SELECT DISTINCT s.lang, s.phrase FROM c s JOIN (
        SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
          SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (
            SELECT lang, a, w, unnest(range(2, len(w))) AS m FROM c))) b
      ON s.lang = b.lang AND s.phrase = b.phrase AND {INSIDE[1]}::HUGEINT * b.a >= {INSIDE[0]}::HUGEINT * s.a),
k AS (SELECT c.*, unnest(range(1, len(w))) AS k FROM c ANTI JOIN x ON c.lang = x.lang AND c.phrase = x.phrase),
s AS (SELECT k.lang, k.phrase, k.a, fl.n AS l, fr.n AS r, ((2000000::HUGEINT * k.a) // (fl.n + fr.n))::BIGINT AS score
      FROM k JOIN f fl ON fl.lang = k.lang AND fl.phrase = array_to_string(k.w[:k.k], ' ')
             JOIN f fr ON fr.lang = k.lang AND fr.phrase = array_to_string(k.w[k.k + 1:], ' ')
      QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k.k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM s)
SELECT o.lang, rank, o.phrase, a, l, r, n.n, score, coalesce("left", 0) AS "left", coalesce("right", 0) AS "right"
FROM o JOIN n ON o.lang = n.lang LEFT JOIN g ON o.lang = g.lang AND o.phrase = g.phrase WHERE rank <= {TOP}
"""
