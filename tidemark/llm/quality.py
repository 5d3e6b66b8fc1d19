"""Quality rules judged together by an isolation forest.

Each text yields rule statistics. Rows that fail the base rules go at once.
For the others an isolation forest over the statistics tells how quickly
random splits isolate a row: short paths mean an unusual combination. The
score's threshold is calibrated on all labelled rows.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_sample, saved, table

STATS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
FIT_ROWS = 20_000  # labelled rows the trees are grown on, at most
TREES = 100
TREE_ROWS = 256
MAX_CLEAN_LOSS = 0.001  # share of good labelled rows that a threshold may reject
MIN_PRECISION = 0.9  # share of bad ones among the labelled rows that it rejects
SCORE_STEPS = 4096

_SYMBOLS = re.compile(r"[#*$%&|<>]")


def text_statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Statistics of one whole text (null: none), in the order of ``STATS``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    spaces = sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    lines = [x for x in raw.split(b"\n") if x.split()] if n else []
    repeat = 0
    if n >= WINDOW:
        first: dict[tuple, int] = {}
        again: list[int] = []
        for i, w in enumerate(zip(*[islice(words, k, None) for k in range(WINDOW)])):
            j = first.setdefault(w, i)
            if j != i:
                again.append(j)
                again.append(i)
        if again:
            mark = np.zeros(n + 1, np.int64)
            at = np.unique(np.array(again))
            mark[at] += 1
            np.subtract.at(mark, np.minimum(at + WINDOW, n), 1)
            repeat = int((np.cumsum(mark[:n]) > 0).sum())
    return (n, len(text) - spaces, len(_SYMBOLS.findall(text)), len(lines),
            len(lines) - len(set(lines)), repeat)


NAMES = [c.split()[0] for c in STATS.split(", ")]


def _statistics_of(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_statistics(t) for t in texts], columns=NAMES, dtype=np.int64)


def statistics(text: Column) -> Column:
    """Struct of rule statistics of a text column."""
    return F.pandas_udf(_statistics_of, STATS)(text)


def base_failed(s: Column) -> Column:
    return ((s["n_words"] < MIN_WORDS)
            | (s["n_repeat_words"] * 100 > s["n_words"] * MAX_REPEAT_PERCENT))


def features(s: pd.DataFrame) -> dict[str, np.ndarray]:
    """Size-free rule statistics by family, so that a long clean text is not
    unusual. Each family has a forest of its own: in one forest for all, the
    many harmless ways to be unusual would hide the telling ones."""
    n = np.maximum(s["n_words"].to_numpy(float), 1)
    chars = np.maximum(s["word_chars"].to_numpy(float), 1)
    symbols = s["n_symbols"].to_numpy(float)
    return {
        "symbols": np.sqrt(np.column_stack([np.minimum(symbols / n, 1.0), symbols / chars])),
        "word length": np.log(chars / n)[:, None],
        "repetition": np.column_stack([
            s["n_dup_lines"].to_numpy(float) / np.maximum(s["n_lines"].to_numpy(float), 1),
            s["n_repeat_words"].to_numpy(float) / n]),
    }


def path_norm(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int, rows: int, seed: int) -> list[tuple[np.ndarray, ...]]:
    """Isolation trees as arrays (feature, split, left, right, path): a leaf has
    feature -1 and the path length it stands for."""
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(2, rows))))
    forest = []
    for _ in range(trees):
        sample = x[rng.choice(len(x), min(rows, len(x)), replace=False)] if len(x) else x
        feat, split, left, right, path = [], [], [], [], []

        def node(part: np.ndarray, depth: int) -> int:
            at = len(feat)
            feat.append(-1), split.append(0.0), left.append(at), right.append(at)
            path.append(depth + path_norm(len(part)))
            if depth < limit and len(part) > 1:
                lo, hi = part.min(axis=0), part.max(axis=0)
                usable = np.flatnonzero(hi > lo)
                if len(usable):
                    f = int(rng.choice(usable))
                    v = lo[f] + (hi[f] - lo[f]) * (1 - rng.random())  # in (lo, hi]
                    feat[at], split[at] = f, v
                    below = part[:, f] < v
                    left[at] = node(part[below], depth + 1)
                    right[at] = node(part[~below], depth + 1)
            return at

        node(sample, 0)
        forest.append((np.array(feat), np.array(split), np.array(left), np.array(right), np.array(path)))
    return forest


def anomaly(forest: list[tuple[np.ndarray, ...]], x: np.ndarray, rows: int) -> np.ndarray:
    """Score in (0, 1): near 1 is isolated early, 0.5 and less is ordinary."""
    if not len(x):
        return np.zeros(0)
    total = np.zeros(len(x))
    for feat, split, left, right, path in forest:
        at = np.zeros(len(x), np.int64)
        while True:
            f = feat[at]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                break
            k = at[inner]
            below = x[inner, f[inner]] < split[k]
            at[inner] = np.where(below, left[k], right[k])
        total += path[at]
    return 2.0 ** (-total / len(forest) / max(path_norm(rows), 1.0))


class QualityModel:
    """A forest per family of statistics, and the score above which each
    rejects a row."""

    def __init__(self, forests: dict[str, list], rows: int, thresholds: dict[str, float]):
        self.forests, self.rows, self.thresholds = forests, rows, thresholds

    def scores(self, stats: Column) -> Column:
        """Struct of a score for each family (``f0``, ``f1``, ...)."""
        forests, rows, run, feats = self.forests, self.rows, anomaly, features

        def scored(s: pd.DataFrame) -> pd.DataFrame:
            x = feats(s)
            return pd.DataFrame({f"f{i}": run(f, x[k], rows) for i, (k, f) in enumerate(forests.items())})

        kind = ", ".join(f"f{i} double" for i in range(len(forests)))
        return F.pandas_udf(scored, kind)(stats)

    def kept(self, stats: Column, scores: Column) -> Column:
        ok = ~base_failed(stats)
        for i, k in enumerate(self.forests):
            ok = ok & (scores[f"f{i}"] <= F.lit(self.thresholds[k]))
        return ok


def fit(labelled: DataFrame, id_col: str, seed: int = 5, fit_rows: int = FIT_ROWS, trees: int = TREES,
        tree_rows: int = TREE_ROWS, max_clean_loss: float = MAX_CLEAN_LOSS,
        min_precision: float = MIN_PRECISION) -> QualityModel:
    """``labelled``: (id, ``stats`` struct, ``quality`` 0/1), rows that pass the
    base rules. The trees are grown on at most ``fit_rows`` of them, picked by
    a hash of the id; the thresholds come from the scores of all of them.

    Threshold of a family: of the scores at which at most ``max_clean_loss``
    of the good rows are rejected and ``min_precision`` of the rejected rows
    are bad, the one that rejects most bad rows; 1 (nothing) if there is none.
    Rows that one family rejects do not count for the next.
    """
    sample = hashed_sample(labelled.select(id_col, "stats.*"), F.xxhash64(F.col(id_col), F.lit(seed)), fit_rows,
                           NAMES).toPandas()
    forests = {k: grow(x, trees, tree_rows, seed + i) for i, (k, x) in enumerate(features(sample).items())}
    model = QualityModel(forests, min(tree_rows, len(sample)), dict.fromkeys(forests, 1.0))
    if not len(sample):
        return model
    scored = saved(labelled.select("quality", model.scores(F.col("stats")).alias("s"))
                   .select("quality", "s.*"), "quality-scores")
    for i, k in enumerate(forests):
        # scores as steps: one row of counts for each step, whatever the input
        steps = (scored.groupBy(F.floor(F.col(f"f{i}") * SCORE_STEPS).alias("step"))
                 .agg(F.count_if(F.col("quality") == 1).alias("good"),
                      F.count_if(F.col("quality") == 0).alias("bad"))
                 .toPandas().sort_values("step", ascending=False))
        good, bad = steps["good"].cumsum().to_numpy(), steps["bad"].cumsum().to_numpy()
        ok = np.flatnonzero((good <= max_clean_loss * good[-1]) & (bad > 0)
                            & (bad >= min_precision * (good + bad)))
        if len(ok):
            best = ok[int(np.argmax(bad[ok]))]
            model.thresholds[k] = float(steps["step"].to_numpy()[best]) / SCORE_STEPS - 1e-12
            # the next family is calibrated on what this one leaves
            scored = scored.filter(F.col(f"f{i}") <= model.thresholds[k])
    return model


def with_statistics(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` as struct ``_row`` beside the struct ``stats``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       statistics(F.col(f"`{text_col}`")).alias("stats"))


def fit_on(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
           **params) -> QualityModel:
    """Fit on the rows of ``stats`` (id, stats) that ``labels`` covers. Labels
    that are null, or of no row, are left out."""
    lab = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("quality"))
    both = (stats.join(lab.filter("quality is not null"), F.col(id_col) == F.col("_id"))
            .filter(~base_failed(F.col("stats"))).select(id_col, "stats", "quality"))
    return fit(saved(both, "quality-labelled"), id_col, **params)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats, ``base_failed``, ``scores``, ``kept``) for each row of ``docs``.

    Null and empty texts have no words and fail the base rules. Repeated rows
    are judged alike, each for itself. Null ids are judged, but never join a
    label. Without usable labels only the base rules reject. An empty table
    gives an empty result. Other columns are not read.
    """
    stats = saved(docs.select(F.col(f"`{id_col}`").alias(id_col),
                              statistics(F.col(f"`{text_col}`")).alias("stats")), "quality-stats")
    model = fit_on(stats, labels, id_col)
    s = F.col("stats")
    return (stats.withColumn("scores", model.scores(s))
            .select(id_col, "stats", base_failed(s).alias("base_failed"), "scores",
                    model.kept(s, F.col("scores")).alias("kept")))


def op6_isolation_rules(spark, sf_dir: str) -> DataFrame:
    """Rule statistics and verdict for every document."""
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *[f"stats.{c}" for c in
                                  ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      "base_failed", "kept", F.col("scores.f0").alias("symbol_score"))


def kept_rows(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents the rules keep. Statistics are computed
    once to fit and once, row by row, to decide: no text is shuffled."""
    stats = saved(docs.select("doc_id", statistics(F.col("text")).alias("stats")), "quality-stats")
    model = fit_on(stats, table(spark, sf_dir, "labels"))
    s = F.col("stats")
    return (with_statistics(docs, "text").withColumn("_scores", model.scores(s))
            .filter(model.kept(s, F.col("_scores"))).select("_row.*"))
