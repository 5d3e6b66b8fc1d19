"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows of ``WINDOW``; in each, one gated
recurrent layer reads forwards and one backwards, and the two states at a byte
give the probability of each language there. A document's probabilities are
the mean over all of its bytes.

The network is trained in numpy by backpropagation through time, on windows
of a bounded sample of labelled documents; every byte of a window is labelled
with its document's language.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, table

HIDDEN = 8  # states of each direction
WINDOW = 96  # bytes
PAD = 256  # stands after a text's last byte; empties the state
FIT_DOCS = 1000  # documents of a language that are learnt from, at most; Spark limits such groups before the shuffle
FIT_TOTAL = 24_000  # of all languages
FIT_CHARS = 480  # characters taken from each, at a random place
BATCH, STEPS, RATE = 384, 150, 0.02
UNKNOWN = "und"
AT_ONCE = 2048  # windows labelled together


def windows_of(text: bytes, size: int = WINDOW) -> np.ndarray:
    """A text's bytes as rows of ``size``, the last one padded."""
    n = -(-len(text) // size)
    out = np.full(n * size, PAD, np.int16)
    out[:len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, size)


def start(languages: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    """Random weights: for each direction the gates' inputs ``w`` (update,
    reset, new; a column per byte), recurrence ``u`` and its bias ``b``; and
    the output ``v`` with bias ``c``."""
    rng = np.random.default_rng(seed)
    p: dict[str, np.ndarray] = {}
    for d in "fb":
        p["w" + d] = rng.normal(0, 0.3, (3 * hidden, PAD + 1))
        p["w" + d][:2 * hidden] *= 0.25
        p["w" + d][:hidden] += 0.7  # states last a few bytes at first
        p["w" + d][hidden:2 * hidden] += 0.5
        p["u" + d] = rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden))
        p["u" + d][:2 * hidden] *= 0.25
        p["b" + d] = np.zeros((hidden, 1))
    p["v"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (languages, 2 * hidden))
    p["c"] = np.zeros((languages, 1))
    return {k: _padless(k, v).astype(np.float32) for k, v in p.items()}


def _padless(name: str, v: np.ndarray) -> np.ndarray:
    """The padding's inputs shut the update and reset gates, so the state
    after it is that of an empty text."""
    if name[0] == "w":
        h = len(v) // 3
        v[:2 * h, PAD], v[2 * h:, PAD] = -1000.0, 0.0
    return v


def read(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each byte, (steps, hidden, windows), of bytes ``x``
    (steps, windows). Gates are linear between 0 and 1, the new state is
    ``y / (1 + |y|)``: both are far cheaper than exponentials. ``keep`` gets
    what backpropagation needs of each step."""
    hidden = len(b)
    out = np.empty((len(x), hidden, x.shape[1]), w.dtype)
    h = np.zeros((hidden, x.shape[1]), w.dtype)
    size = np.empty_like(h)
    for t in range(len(x)):
        g = np.take(w, x[t], axis=1, mode="clip")
        a = u @ h
        zr = g[:2 * hidden]
        zr += a[:2 * hidden]
        np.clip(zr, 0.0, 1.0, out=zr)
        z, r = zr[:hidden], zr[hidden:]
        back = a[2 * hidden:]
        back += b
        n = g[2 * hidden:]
        n += r * back
        np.abs(n, out=size)
        size += 1.0
        n /= size
        if keep is not None:
            keep.append((z, r, n, h, back))
        np.subtract(h, n, out=out[t])
        out[t] *= z
        out[t] += n
        h = out[t]
    return out


def unread(x: np.ndarray, grad: np.ndarray, u: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of ``w``, ``u`` and ``b``, from those of the states: the way
    back through time of ``read``."""
    hidden = u.shape[1]
    gates = np.empty((3 * hidden, *x.shape), u.dtype)
    du, db = np.zeros_like(u), np.zeros((hidden, 1), u.dtype)
    dh = np.zeros_like(grad[0])
    for t in range(len(x) - 1, -1, -1):
        z, r, n, h, back = keep[t]
        dh = dh + grad[t]
        dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
        dz = dh * (h - n) * ((z > 0) & (z < 1))
        dr = dn * back * ((r > 0) & (r < 1))
        gates[:, t] = np.concatenate([dz, dr, dn])
        through = np.concatenate([dz, dr, dn * r])
        du += through @ h.T
        db += (dn * r).sum(axis=1, keepdims=True)
        dh = dh * z + u.T @ through
    at = x.ravel()
    dw = np.stack([np.bincount(at, g.ravel(), PAD + 1) for g in gates]).astype(u.dtype)
    return dw, du, db


def _shares(p: dict[str, np.ndarray], forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Probabilities of each language from the states at each byte. States
    stay between -1 and 1, so the exponentials are safe."""
    hidden = forward.shape[1]
    out = np.matmul(p["v"][:, :hidden], forward)
    out += np.matmul(p["v"][:, hidden:], backward)
    out += p["c"]
    np.exp(out, out=out)
    out /= out.sum(axis=1, keepdims=True)
    return out


def label(p: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Probabilities of each language at each byte: (steps, languages, windows)."""
    return _shares(p, read(x, p["wf"], p["uf"], p["bf"]), read(x[::-1], p["wb"], p["ub"], p["bb"])[::-1])


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all bytes of windows ``x`` (steps, windows) of
    languages ``y``, and its gradient."""
    kf: list = []
    kb: list = []
    forward = read(x, p["wf"], p["uf"], p["bf"], kf)
    backward = read(x[::-1], p["wb"], p["ub"], p["bb"], kb)[::-1]
    share = _shares(p, forward, backward)
    real = (x != PAD)[:, None, :]
    total = max(1, int(real.sum()))
    mine = share[:, y, np.arange(len(y))]
    loss = float(-(np.log(mine + 1e-20) * real[:, 0, :]).sum() / total)
    d = share.copy()
    d[:, y, np.arange(len(y))] -= 1
    d *= real / np.array(total, d.dtype)
    hidden = forward.shape[1]
    out = {"v": np.concatenate([np.matmul(d, s.transpose(0, 2, 1)).sum(axis=0) for s in (forward, backward)], axis=1),
           "c": d.sum(axis=(0, 2))[:, None]}
    out["wf"], out["uf"], out["bf"] = unread(x, np.matmul(p["v"][:, :hidden].T, d), p["uf"], kf)
    out["wb"], out["ub"], out["bb"] = unread(x[::-1], np.matmul(p["v"][:, hidden:].T, d)[::-1], p["ub"], kb)
    return loss, out


def train(texts: list[bytes], langs: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH,
          rate: float = RATE, seed: int = 5) -> tuple[list[str], dict[str, np.ndarray]]:
    """Languages and weights, by Adam with a falling rate; each step draws
    windows of all languages alike."""
    names = sorted(set(langs), key=lambda s: s.encode("utf-8", "surrogatepass"))
    rng = np.random.default_rng(seed)
    p = start(len(names), hidden, seed)
    number = {s: i for i, s in enumerate(names)}
    cut = [(number[la], w) for t, la in zip(texts, langs) for w in windows_of(t)]
    if len(names) < 2 or not cut:
        return names, p
    x = np.stack([w for _, w in cut])
    y = np.array([i for i, _ in cut])
    of = [np.flatnonzero(y == i) for i in range(len(names))]
    of = [o for o in of if len(o)]
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        pick = [of[i] for i in rng.integers(0, len(of), batch)]
        rows = np.array([o[int(r * len(o))] for o, r in zip(pick, rng.random(batch))])
        _, g = gradients(p, np.ascontiguousarray(x[rows].T), y[rows])
        norm = float(np.sqrt(sum(float((v.astype(np.float64) ** 2).sum()) for v in g.values())))
        lr = rate * (1 - step / (steps + 1)) * min(1.0, step / 20)
        for k, v in g.items():
            v = v * np.float32(min(1.0, 1.0 / max(norm, 1e-12)))
            m[k] += 0.1 * (v - m[k])
            s[k] += 0.01 * (v * v - s[k])
            p[k] -= (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)).astype(p[k].dtype)
            _padless(k, p[k])
    return names, p


def pooled(p: dict[str, np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Mean probabilities of each text over all its bytes, a row each (of
    zeros for no byte). Texts are labelled ``AT_ONCE`` windows at a time."""
    total = np.zeros((len(texts), len(p["c"])))
    held: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    n = 0

    def flush() -> None:
        nonlocal held, owner, n
        if held:
            x, who = np.concatenate(held), np.concatenate(owner)
            for lo in range(0, len(x), AT_ONCE):
                part = np.ascontiguousarray(x[lo:lo + AT_ONCE].T)
                share = label(p, part)
                padded = np.flatnonzero(part[-1] == PAD)
                if len(padded):
                    share[:, :, padded] *= (part[:, padded] != PAD)[:, None, :]
                np.add.at(total, who[lo:lo + AT_ONCE], share.sum(axis=0, dtype=np.float64).T)
        held, owner, n = [], [], 0

    step = AT_ONCE * WINDOW
    for k, t in enumerate(texts):
        for lo in range(0, len(t), step):
            w = windows_of(t[lo:lo + step])
            held.append(w)
            owner.append(np.full(len(w), k))
            n += len(w)
            if n >= AT_ONCE:
                flush()
    flush()
    sizes = np.array([max(1, len(t)) for t in texts], float)
    return total / sizes[:, None]


def _pack(p: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **p)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as f:
        return {k: f[k] for k in f.files}


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key: list[str] | None = None,
        fit_docs: int = FIT_DOCS, fit_total: int = FIT_TOTAL) -> tuple[list[str], bytes]:
    """Languages and weights learnt from rows of ``docs`` with a language and a
    letter in their text: ``fit_docs`` of each language, ``fit_total`` in all,
    those of the smallest hash of ``key`` columns; of each ``FIT_CHARS``
    characters at a place that the hash gives. One task trains on these.
    Null languages and texts are left out; without any row nothing is learnt.
    """
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")
    h = F.xxhash64(F.lit(23), *[F.col(f"`{c}`") for c in key or [lang_col, text_col]])
    at = F.pmod(h, F.greatest(F.length(text) - FIT_CHARS, F.lit(0)) + 1) + 1
    rows = (docs.filter(lang.isNotNull() & has_letter(text))
            .select(lang.alias("lang"), h.alias("h"), text.substr(at.cast("int"), F.lit(FIT_CHARS)).alias("text")))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    some = (rows.withColumn("nth", nth).filter(F.col("nth") <= fit_docs)
            .orderBy("nth", "h", "lang").limit(fit_total).select("lang", "text"))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([b for b in batches] or [pd.DataFrame({"lang": [], "text": []})], ignore_index=True)
        rows = rows.sort_values(["lang", "text"], kind="stable")
        names, p = train([t.encode("utf-8", "surrogatepass") for t in rows["text"]], rows["lang"].tolist())
        yield pd.DataFrame({"langs": [names], "weights": [_pack(p)]})

    got = saved(some.coalesce(1).mapInPandas(learn, "langs array<string>, weights binary"), "language-model").collect()
    full = [r for r in got if r["langs"]]
    return (list(full[0]["langs"]), bytes(full[0]["weights"])) if full else ([], b"")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: tuple[list[str], bytes], text_col: str = "text") -> Column:
    """Struct of ``lang`` and ``score`` for a text column: the language with
    the largest mean probability over all bytes of the whole text, ties to the
    first by code point, and that probability. Null texts, texts without a
    letter, and all texts if no language was learnt: ``und``, 0. The texts
    alone decide; repeated rows get the same.
    """
    names, weights = model

    @F.pandas_udf("lang string, score double")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = _unpack(weights) if names else {}
        for texts in batches:
            data = ["" if t is None else t for t in texts.tolist()]
            if not names:
                yield pd.DataFrame({"lang": [UNKNOWN] * len(data), "score": 0.0})
                continue
            share = pooled(p, [t.encode("utf-8", "surrogatepass") for t in data])
            top = share.argmax(axis=1)
            yield pd.DataFrame({"lang": [names[i] for i in top], "score": np.clip(share.max(axis=1), 0.0, 1.0)})

    text = F.col(f"`{text_col}`")
    none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    return F.when(has_letter(text), best(F.when(has_letter(text), text))).otherwise(none)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each row's predicted language: (id, held_out, lang_pred, score).

    Rows whose id's crc32 leaves 2 by 4 are held out of the training; so are
    rows without an id, whose ``held_out`` is false. An empty table gives an
    empty result. Other columns are not read.
    """
    rest = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4
    model = fit(docs.filter(rest != 2), text_col, lang_col, [id_col])
    got = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(rest == 2, F.lit(False)).alias("held_out"),
                      predict(docs, model, text_col).alias("_p"))
    return got.select(id_col, "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))


def op11_byte_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, sf_dir, "documents"))
