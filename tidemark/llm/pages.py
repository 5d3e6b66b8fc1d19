"""Main text of web pages by minimum-cut labelling of blocks.

A page is cut into blocks of text. A classifier gives each block the
probability of being content; the costs of either label become capacities to
two terminals. Neighbouring blocks, and consecutive blocks of one parent or
one section, are tied by smoothness edges. The minimum cut labels all blocks
together: a short paragraph inside an article stays, a long notice inside a
footer goes.

The classifier is a logistic regression over a block's shape, trained on
blocks of a bounded sample of pages whose place in the page says what they
are. What a block's ancestors say (their tags and names) is a cost besides.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_sample, saved, table

FIT_PAGES = 2000  # pages the classifier is trained on, at most
FIT_BLOCKS = 64  # blocks of each that are used
PLACE_COST = 12.0  # what an ancestor's tag says
FORM_COST = 11.0  # what a form says: an article inside one is an article again
NAME_COST = 6.0  # what its name says: classifier and ties together can outweigh it
INNER_NAME_COST, PART_COST = 2.5, 1.5  # a boilerplate name inside an article; one that is part of another name
WRAPPER_SHARE = 0.5  # of a page's text: a form or a name around more of it says nothing
NEXT_TIE, PARENT_TIE, SECTION_TIE = 0.6, 0.8, 0.4
MAX_SHAPE_COST = 4.0

_ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_TOKEN = re.compile(
    r"<!--(?:>|->|[\s\S]*?(?:--!?>|\Z))"
    rf"|<((?i:script|style|textarea|title|iframe|xmp|noembed|noframes))(?=[\s/>]){_ATTRIBUTES}>"
    r"[\s\S]*?(?:</(?i:\1)(?=[\s/>])[^>]*+>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>"
    r"|<[!?/][^>]*>?"
    r"|<[a-zA-Z][^>]*>?")
_NAMED = re.compile(r"""(?<![\w-])(class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

# Elements that do not end a block, and elements without an end tag.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var wbr object "
             "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts "
             "mstyle mspace mpadded mphantom menclose mtable mtr mtd semantics".split())
# Elements whose text is no text of the page. They stand inside a block as inline elements do.
HIDDEN = set("svg select button noscript template annotation annotation-xml".split())
_HIDDEN = re.compile(rf"<(/?)({'|'.join(sorted(HIDDEN))})(?=[\s/>])", re.I)
# a start tag of these ends a hidden element that has no end tag of its own
BREAKOUT = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer "
               "form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tr ul".split())
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
CLOSED_BY_SAME = set("p li dt dd option tr td th".split())
AWAY_TAGS = set("nav footer aside menu dialog".split())
SECTIONS = set("article main section div body nav footer aside header form table ul ol".split())
AWAY_WORDS = re.compile(
    r"(?<![a-z])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side-bar|menu|navbar|nav|navigation|"
    r"breadcrumbs?|footer|masthead|cookie\w*|consent|gdpr|notice|popup|modal|overlay|newsletter|subscri\w*|signup|"
    r"login|share|sharing|social|related|recommend\w*|comments?|commentlist|discussion|disqus|replies|reply|widget|"
    r"toolbar|pagination|pager|search|skip-link|copyright|legal|disclaimer|alert|toc)(?![a-z])", re.I)
ARTICLE_WORDS = re.compile(r"(?<![a-z])(?:article|articlebody|article-body|post-content|entry-content|main|content|"
                           r"story|post|entry|post-body)(?![a-z])", re.I)
OWN_WORDS = set("h1 h2 h3 h4 h5 h6 p".split())  # elements whose ids are made from their text
NOT_OWN = re.compile(r"(?:has|with|no|without|hide|show)[-_][a-z-]+", re.I)  # of a page with or without the part


# Parts of a name that leave the meaning of the others as it is.
FILLERS = set("area bar body block bottom box card col column container content form header inner item items left link links "
              "list main message outer panel right row section site text title top wrap wrapper".split())


class Block:
    __slots__ = ("text", "linked", "place", "pull", "parent", "section", "heading")

    def __init__(self, text, linked, place, pull, parent, section, heading):
        self.text, self.linked, self.place, self.pull = text, linked, place, pull
        self.parent, self.section, self.heading = parent, section, heading


def away_name(names: str) -> str:
    """Whether a class, id or role speaks of boilerplate: "" no, "part" if one
    does in part (``login-page``), "whole" if nothing else is said but
    ``FILLERS`` (``cookie-box``)."""
    out = ""
    for name in names.split():
        if AWAY_WORDS.search(name) is None:
            continue
        if AWAY_WORDS.fullmatch(name):
            return "whole"
        if all(x.lower() in FILLERS or not x or x.isdigit() or AWAY_WORDS.fullmatch(x) for x in re.split("[-_]+", name)):
            return "whole"
        out = "part"
    return out


def place_of(tag: str, attributes: str, place: int, pull: float, wrapper: bool = False) -> tuple[int, float]:
    """Place and pull of an element inside one of ``place`` and ``pull``.
    ``wrapper``: it holds most of the page's text, so a form or a name that
    speaks of boilerplate says nothing."""
    article = tag in ("article", "main")
    if place < 0 and pull <= -PLACE_COST:
        return place, pull
    if tag in AWAY_TAGS or tag == "header" and place < 1 and pull >= 0:
        return -1, -PLACE_COST
    if tag == "form" and not wrapper:
        return -1, -FORM_COST
    names = ""
    if attributes and tag not in ("html", "body", "main"):
        # generated ids of headings and paragraphs say what they are about
        own = tag in OWN_WORDS
        names = NOT_OWN.sub("", " ".join(v.strip("\"'") for k, v in _NAMED.findall(attributes)
                                        if not (own and k.lower() == "id")))
    away = "" if wrapper or not names else away_name(names)
    wanted = bool(names) and ARTICLE_WORDS.search(names) is not None
    if article and place < 0 and away != "whole" and (pull == -FORM_COST or pull >= -PART_COST):
        return 1, PLACE_COST
    if away == "whole" or away and not wanted:
        if article and away != "whole" and place >= 0 and pull >= 0:
            return 1, PLACE_COST
        if place > 0:
            return 0, -INNER_NAME_COST if away == "whole" else -PART_COST
        if place == 0 and pull < 0:
            return 0, min(pull, -INNER_NAME_COST if away == "whole" else -PART_COST)
        return -1, min(pull, -NAME_COST if away == "whole" else -PART_COST)
    if place >= 0 and pull >= 0:
        if article:
            return 1, PLACE_COST
        if wanted and not away:
            return 1, max(pull, NAME_COST)
    return place, pull


def settle(blocks: list[Block], elements: list[tuple[str, str, int]]) -> None:
    """Place and pull of each block, from its elements inwards. ``elements``:
    (tag, attributes, parent) by number; parents come first."""
    held = [0] * len(elements)
    for b in blocks:
        held[b.parent] += len(b.text)
    first = [e[0] in ("h1", "article", "main") for e in elements]  # where an article begins, if the page tells
    told = any(first)
    for k in range(len(elements) - 1, 0, -1):
        held[elements[k][2]] += held[k]
        first[elements[k][2]] |= first[k]
    places = [(0, 0.0)] * len(elements)
    for k in range(1, len(elements)):
        tag, attributes, parent = elements[k]
        wrapper = held[k] > WRAPPER_SHARE * held[0] and (first[k] or not told)
        places[k] = place_of(tag, attributes, *places[parent], wrapper)
    for b in blocks:
        b.place, b.pull = places[b.parent]


def closed_starts(page: str) -> set[int]:
    """Where hidden elements start that end before the next of their kind."""
    open_: dict[str, int] = {}
    out = set()
    for m in _HIDDEN.finditer(page):
        tag = m[2].lower()
        if not m[1]:
            open_[tag] = m.start()
        elif tag in open_:
            out.add(open_.pop(tag))
    return out


def blocks_of(page: str) -> list[Block]:
    """Blocks in page order. ``place``: -1 inside a boilerplate element, 1
    inside an article or main element, else 0; the innermost decides, but
    nothing inside boilerplate other than a form is an article again. ``pull``: what that adds
    to the log odds of being content; below 0 at place 0 for what has a
    boilerplate name inside an article. The text of ``HIDDEN``
    elements is left out; one without an end tag ends with its parent or at
    the next block."""
    out: list[Block] = []
    # open elements: (tag, number, block element, section number, in a link,
    # heading, hidden: 2 up to an end tag, 1 without one)
    stack = [("", 0, 0, 0, False, False, 0)]
    elements = [("", "", 0)]  # block elements by number: (tag, attributes, parent)
    closed = closed_starts(page)
    parts: list[str] = []
    linked = number = at = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, _, element, section, _, heading, _ = stack[-1]
                out.append(Block(text, min(linked, len(text)), 0, 0.0, element, section, heading))
            parts.clear()
            linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at and not stack[-1][6]:
            piece = page[at:m.start()]
            parts.append(piece)
            if stack[-1][4]:
                linked += len(piece)
        at = m.end()
        if m[1]:
            continue
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if m[2]:  # an end tag closes back to its start tag, if there is one
            k = len(stack) - 1
            while k and stack[k][0] != tag:
                # nothing ends from inside a hidden element that has an end tag
                if inline and stack[k][0] not in INLINE or stack[k][6] == 2 and stack[k - 1][6] != 2:
                    k = 0
                    break
                k -= 1
            if not inline and tag not in HIDDEN and stack[-1][6] < 2 and (k or not stack[-1][6]):
                while stack[-1][6] and len(stack) > k + 1:
                    stack.pop()
                if not stack[-1][6]:
                    flush()
            if k:
                del stack[k:]
            continue
        if stack[-1][6] == 1 and (tag in BREAKOUT or tag in ("select", "button")):
            while stack[-1][6]:
                stack.pop()
        inside = inline or tag in HIDDEN or stack[-1][6] > 0
        if not inside:
            flush()
        if tag in VOID:
            continue
        if not inside:
            while stack[-1][0] in INLINE:  # inline elements left open end with their block
                stack.pop()
            if stack[-1][0] == tag and tag in CLOSED_BY_SAME or stack[-1][0] == "p":
                stack.pop()
        number += 1
        _, _, element, section, link, heading, hidden = stack[-1]
        if not inside:
            elements.append((tag, m[4], element))
            element = len(elements) - 1
            if tag in SECTIONS:
                section = number
        if m[4].endswith("/") and not inline:
            continue
        if tag in HIDDEN and not hidden:
            hidden = 2 if m.start() in closed else 1
        stack.append((tag, number, element, section, link or tag == "a", heading or tag in ("h1", "h2", "h3", "h4"),
                      hidden))
    if at < len(page) and not stack[-1][6]:
        parts.append(page[at:])
    flush()
    settle(out, elements)
    return out


def shape(blocks: list[Block]) -> np.ndarray:
    """Shape features of blocks, without what their place says."""
    n = len(blocks)
    words = np.array([b.text.count(" ") + 1 for b in blocks], float)
    chars = np.array([len(b.text) for b in blocks], float)
    stops = np.array([b.text.count(".") + b.text.count("!") + b.text.count("?") for b in blocks], float)
    linked = np.array([b.linked for b in blocks], float) / chars
    size = np.log1p(words)
    mean = size.copy()  # of a block's neighbours, half of one at either end of the page
    if n > 1:
        mean = np.r_[0.0, size[:-1]] / 2 + np.r_[size[1:], 0.0] / 2
    return np.column_stack([np.ones(n), size, linked, np.minimum(stops / words, 1.0), mean,
                            np.array([b.text[-1] in ".!?:;\"'" for b in blocks], float),
                            np.array([b.heading for b in blocks], float)])


PRIOR = (-1.5, 0.8, -4.0, 1.0, 0.3, 0.5, 0.5)  # weights without any trained page; the pull of the training


def train(x: np.ndarray, y: np.ndarray, pull: float = 0.1, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, pulled towards ``PRIOR`` with the
    weight of ``pull`` times the rows: one site's habits do not rule."""
    prior = np.array(PRIOR)
    w = prior.copy()
    pull = pull * max(1, len(x))
    for _ in range(steps if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + pull * (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def minimum_cut(gain: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise the cost: labelling i true costs ``-gain[i]``
    relative to false, a tie between different labels its weight. Nodes of
    positive gain are sources of as much, the others sinks; what sources still
    reach under the largest flow is true.

    A node whose gain outweighs all of its ties is decided, and its ties are
    gains of their other ends from then on; flow is sought for what is left.
    """
    n = len(gain)
    left = list(gain)
    around: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    bound = [0.0] * n
    for a, b, w in ties:
        around[a].append((b, w))
        around[b].append((a, w))
        bound[a] += w
        bound[b] += w
    label: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:
        i = todo.pop()
        if label[i] is not None or not (left[i] > bound[i] + 1e-9 or left[i] <= -bound[i]):
            continue
        label[i] = left[i] > 0
        for j, w in around[i]:
            if label[j] is None:
                left[j] += w if label[i] else -w
                bound[j] -= w
                todo.append(j)
    open_ = [i for i in range(n) if label[i] is None]
    if open_:
        at = {i: k for k, i in enumerate(open_)}
        inner = [(at[a], at[b], w) for a, b, w in ties if a in at and b in at]
        for i, seen in zip(open_, reached([left[i] for i in open_], inner)):
            label[i] = seen
    return [bool(x) for x in label]


def reached(left: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """What sources reach under the largest flow, found level by level: flow
    is pushed along all shortest paths before distances are measured anew."""
    n, least = len(left), 1e-12
    near: list[list[list]] = [[] for _ in range(n)]  # [node, residual, place of the reverse]
    for a, b, w in ties:
        near[a].append([b, w, len(near[b])])
        near[b].append([a, w, len(near[a]) - 1])
    while True:
        level = [0 if g > least else -1 for g in left]
        queue = deque(i for i in range(n) if not level[i])
        ends = False
        while queue:
            i = queue.popleft()
            for j, r, _ in near[i]:
                if r > least and level[j] < 0:
                    level[j] = level[i] + 1
                    ends = ends or left[j] < -least
                    queue.append(j)
        if not ends:
            return [x >= 0 for x in level]
        arc = [0] * n
        for s in range(n):
            while not level[s] and left[s] > least:
                path: list[tuple[int, list]] = []
                i = s
                while i >= 0 and left[i] >= -least:  # on to a node that takes flow, or back
                    if arc[i] < len(near[i]):
                        edge = near[i][arc[i]]
                        if edge[1] > least and level[edge[0]] == level[i] + 1:
                            path.append((i, edge))
                            i = edge[0]
                        else:
                            arc[i] += 1
                    elif path:
                        i = path.pop()[0]
                        arc[i] += 1
                    else:
                        i = -1
                if i < 0:
                    break
                push = min(left[s], -left[i], *(e[1] for _, e in path))
                left[s] -= push
                left[i] += push
                for _, e in path:
                    e[1] -= push
                    near[e[0]][e[2]][1] += push


def labels_of(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """Whether each block is content."""
    score = np.clip(shape(blocks) @ weights, -MAX_SHAPE_COST, MAX_SHAPE_COST)  # log odds: the difference of costs
    has_article = any(b.place > 0 for b in blocks)
    gain = []
    for b, s in zip(blocks, score.tolist()):
        # a page that marks its article says the rest is not
        outside = has_article and (b.place < 0 or b.place == 0 and b.pull == 0)
        gain.append(s + b.pull - (PLACE_COST / 2 if outside else 0.0))
    ties: dict[tuple[int, int], float] = {}
    last_parent: dict[int, int] = {}
    last_section: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            ties[i - 1, i] = ties.get((i - 1, i), 0.0) + NEXT_TIE
        for last, key, w in ((last_parent, b.parent, PARENT_TIE), (last_section, b.section, SECTION_TIE)):
            j = last.get(key)
            if j is not None:
                ties[j, i] = ties.get((j, i), 0.0) + w
            last[key] = i
    return minimum_cut(gain, [(a, b, w) for (a, b), w in ties.items()])


def main_text(page: str | None, weights: np.ndarray) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return " ".join(b.text for b, keep in zip(blocks, labels_of(blocks, weights)) if keep)


N_SHAPE = len(PRIOR)


def _training_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in batches:
        xs, ys = [np.empty((0, N_SHAPE))], [np.empty(0)]
        for page in f["html"]:
            blocks = blocks_of(page or "")
            told = [i for i, b in enumerate(blocks) if b.place and abs(b.pull) >= NAME_COST][:FIT_BLOCKS]
            if told:
                xs.append(shape(blocks)[told])
                ys.append(np.array([blocks[i].place > 0 for i in told], float))
        x, y = np.concatenate(xs), np.concatenate(ys)
        yield pd.DataFrame({"x": pd.Series(list(x), dtype=object), "y": y})


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = FIT_PAGES,
        seed: int = 4) -> np.ndarray:
    """Weights trained on at most ``fit_pages`` pages, picked by a hash, and
    the first ``FIT_BLOCKS`` blocks of each whose place tells their label."""
    some = hashed_sample(pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("html")),
                         F.xxhash64(F.lit(seed), F.col("id")), fit_pages).select("html")
    rows = saved(some.mapInPandas(_training_rows, "x array<double>, y double"), "pages-training").toPandas()
    if not len(rows):
        return np.array(PRIOR)
    return train(np.array(rows["x"].tolist()), rows["y"].to_numpy())


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` as struct ``_row`` and the main text of each, ``_text``.

    Null and empty html give an empty text, as do pages without content
    blocks. Broken markup is read as it comes. Repeated rows are extracted
    alike; null ids do not matter. An empty table gives an empty result. Other
    columns travel inside ``_row``.
    """
    weights = fit(pages, id_col, html_col)
    run = main_text

    def texts(pages_html: pd.Series) -> pd.Series:
        return pd.Series([run(p, weights) for p in pages_html], dtype=object)

    return pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"),
                        F.pandas_udf(texts, "string")(F.col(f"`{html_col}`")).alias("_text"))


def op5_min_cut_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "_row.page_id", "_row.url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))
