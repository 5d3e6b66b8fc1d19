"""Small documents with every awkward case."""

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "_id long, _size string, _row int, stats double, _text string, _key string")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    stems = ["ban", "kor", "lim", "nes", "tor", "vel", "dra", "mi", "sul", "pe"]
    return " ".join("".join(r.choice(stems) for _ in range(r.randint(1, 3))) + (". " if r.random() < 0.1 else "")
                    for _ in range(n)).strip()


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join(f"x{r.random():.6f}" if r.random() < share else w for w in text.split(" "))


def texts() -> list[tuple]:
    """(doc_id, text, source): nulls, empty, very long, ties, repeats, copies."""
    base = prose(1, 120)
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", "b"), (4, "one", None), (5, "one two three", "b"),
        (6, prose(2, 30_000), "c"), (7, base, "a"), (8, base, "b"), (9, base, "a"), (10, edited(base, 3, 0.01), "c"),
        (11, edited(base, 4, 0.5), "c"), (12, "spam " * 200, "a"), (13, "same line here now ok\n" * 30, "b"),
        (14, "\U0001f600 café naïve ΣΤΟΣ <|endoftext|>  x", "a"), (None, prose(5, 50), "a"), (None, None, None),
        (15, prose(6, 40), "z"), (15, prose(6, 40), "z"),
    ]
    rows += [(100 + i, prose(100 + i, 20 + 7 * i), "abc"[i % 3]) for i in range(40)]
    return rows


def docs(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en", s, None if t is None else len(t), 5, "x", 1, 0.5, "clash", "k") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def empty(spark):
    return docs(spark, [])


def shared_targets(sizes, weights=(3.0, 1.0, 2.0), budget=1.5, most=2.0):
    """Targets by the definition: share by weight, hold sources at their most,
    share what is left among the others, until none is above."""
    size = dict(sorted(sizes, key=lambda s: (s[0] is None, s[0] or "")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(size)}
    held = {}
    while True:
        free = [s for s in size if s not in held]
        left, share = budget * sum(size.values()) - sum(held.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / share > most * size[s]]
        if not over:
            return held | {s: left * weight[s] / share for s in free}
        held |= {s: most * size[s] for s in over}
