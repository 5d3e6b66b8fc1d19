"""Operators on pages and embeddings."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import embeddings, pages, warc
from tidemark.session import fresh_scratch

from .cases import prose

PAGES = "page_id long, url string, html string, payload string, digest int, _text string, no_id int"


def page_rows():
    big = "<p>" + prose(1, 400) + "</p>"
    return [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://a/4", None), (5, "http://a/5", ""),
            (6, "http://a/%0D\r\nx", "small"), (7, "http://a/7", "small"), (8, "u", prose(2, 60_000)), (None, "n", big),
            (None, "n", "lone " * 400), (9, "d", "é" * 700), (9, "d", "é" * 700), (10, "x", "\r\n\r\nWARC/1.1\r\n\r\n" * 100)]


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 1, "t", 2) for i, u, h in rows], PAGES)


# archives

def test_archive_round_trip(spark):
    import hashlib
    rows = page_rows()
    folder = fresh_scratch(spark, "warc-test")
    index = warc.archive(table(spark, rows), folder)
    back = warc.read(index).collect()
    assert len(back) == len(rows)
    html = {}
    for r in back:
        if r["record_type"] == "response":
            html.setdefault(r["page_id"], []).append(bytes(r["payload"]))
    want = {i: (h or "").encode() for i, _, h in rows if i is not None}
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in back if r["page_id"]}
    assert {(1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (6, "response", None), (7, "response", None),
            (9, "response", None)} <= kinds
    for r in back:
        if r["page_id"] is not None:
            assert r["declared_digest"] == hashlib.sha1(want[r["page_id"]]).hexdigest()
            assert r["declared_bytes"] == len(want[r["page_id"]])
            if r["payload"] is not None:
                assert bytes(r["payload"]) == want[r["page_id"]]
    assert {r["url"] for r in back} == {u for _, u, _ in rows}
    some = warc.read(index.filter("page_id in (4, 8)")).collect()
    assert sorted(r["page_id"] for r in some) == [4, 8]
    none = warc.archive(table(spark, []), fresh_scratch(spark, "warc-test"))
    assert none.count() == 0 and warc.read(none).count() == 0


def test_every_member_is_a_record(spark):
    import gzip
    folder = fresh_scratch(spark, "warc-test")
    index = warc.archive(table(spark, page_rows()), folder).collect()
    for path in {r["path"] for r in index}:
        fs, at = warc.place(path)
        with fs.open_input_file(at) as f:
            assert gzip.decompress(f.read()).count(b"WARC-Record-ID: ") == sum(r["path"] == path for r in index)


# main text

def brute_cut(gain, ties):
    n = len(gain)
    best = None
    for bits in range(1 << n):
        x = [bits >> i & 1 for i in range(n)]
        cost = sum(max(g, 0) if not v else max(-g, 0) for g, v in zip(gain, x)) + sum(w for a, b, w in ties if x[a] != x[b])
        best = cost if best is None else min(best, cost)
    return best


def test_minimum_cut_is_minimal():
    r = random.Random(5)
    for _ in range(150):
        n = r.randint(1, 9)
        gain = [r.choice([r.uniform(-3, 3), 0.0, 1.0, -1.0]) for _ in range(n)]
        ties = [(a, b, r.choice([0.5, r.uniform(0, 2)])) for a in range(n) for b in range(a + 1, n) if r.random() < 0.5]
        x = pages.minimum_cut(gain, ties)
        cost = sum(max(g, 0) if not v else max(-g, 0) for g, v in zip(gain, x)) + sum(w for a, b, w in ties if x[a] != x[b])
        assert math.isclose(cost, brute_cut(gain, ties), abs_tol=1e-9)


def page(k: int, semantic: bool) -> tuple[str, str]:
    paras = [prose(50 * k + j, 12 + 5 * j) + "." for j in range(5)]
    body = f"<h1>Title {k}</h1>" + "".join(f"<p>{p} &amp; caf&eacute;</p>" for p in paras)
    want = f"Title {k} " + " ".join(f"{p} & café" for p in paras)
    main = f"<article>{body}</article>" if semantic else f'<div class="post">{body}</div>'
    return (f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
            f"<header><a href=/>Site</a></header><nav><ul><li><a href=1>Home</a><li><a href=2>About</a></ul></nav>"
            f'<div class="cookie-notice">We use cookies on this site, accept them.</div>{main}'
            f'<aside><p>Sidebar words that are long enough to look like a text, surely.</p></aside>'
            f'<section id="comments"><p>A reader says a long thing about this article. It is long.</p></section>'
            f"<form><label>Mail</label><input name=q><button>Go</button></form><footer>&copy; 2020 Site</footer></body>"), want


def test_main_text(spark):
    made = [page(k, k % 2 == 0) for k in range(30)]
    rows = [(i, "u", h) for i, (h, _) in enumerate(made)]
    out = {r["_row"]["page_id"]: r["_text"] for r in pages.extract(table(spark, rows)).collect()}
    for i, (_, want) in enumerate(made):
        assert " ".join(out[i].split()) == " ".join(want.split()), i


def test_main_text_awkward(spark):
    rows = page_rows() + [(50, "u", "<p>" * 3000 + "deep"), (51, "u", "<<<>>> &#0; &bogus; <a href='x"), (52, "u", "<!-- never ends")]
    out = pages.extract(table(spark, rows))
    got = {r["_row"]["page_id"]: r["_text"] for r in out.collect()}
    assert out.count() == len(rows) and got[4] == got[5] == got[52] == ""
    assert got[1] == " ".join(prose(1, 400).split())
    assert pages.extract(table(spark, [])).count() == 0


def test_raw_and_hidden_elements_take_nothing_else():
    def text(h):
        return " ".join(b.text for b in pages.blocks_of(f"<article><p>a</p>{h}<p>rest of article</p></article>"))
    plain = "a rest of article"
    for h in ("<script>x</SCRIPT>", "<SCRIPT>var x=1</SCRIPT>", "<STYLE>p{}</STYLE>", "<Style>p{}</style >", "<script/>x</script>",
              '<svg width="1"/>', "<svg><path d=1></svg>", "<SVG><text>t</text></svg>", "<svg width=1>", "<svg><path d=1/>",
              "<select><option>x</select>", "<select><option>x", "<button>x", "<BUTTON><div>x</div></Button>",
              "<button>x<button>y", "<noscript><p>x</p></div></noscript>", "<template><p>x</p></template>",
              "<noscript>", "<title>t</Title>", "<button/>", "</button>", "</svg>"):
        assert text(h) == plain, h
    assert text("<p>one <svg><path/></svg>two <button>go</button>three</p>") == "a one two three rest of article"
    assert text("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>") == "a so x=1 holds rest of article"
    assert text("<object data=x><p>fallback</p></object>") == "a fallback rest of article"
    assert text("<math><mi>x</mi>") == text("<object>x") == "a x rest of article"
    assert text("<script-box>kept</script-box>") == "a kept rest of article"
    assert text("<script>never ends") == "a"
    assert [b.text for b in pages.blocks_of("<div><p>a<svg><g></p>b</div>c")] == ["a", "b", "c"]


def paragraphs(n):
    return "".join(f"<p>Paragraph {i} tells a part of the story, at some length, and ends as it should.</p>" for i in range(n))


@pytest.mark.parametrize("page", [
    "<form id=aspnetForm><nav><a>Home</a></nav><article>{}</article><footer>Legal</footer></form>",
    "<form><nav><a>Home</a></nav><div>{}</div><footer>Legal</footer></form>",
    "<body><div class='page no-js login-page'><nav><a>Home</a></nav><div>{}</div><footer>Legal</footer></div></body>",
    "<body><div class='site-wrapper has_menu banner'><nav><a>Home</a></nav><div>{}</div><footer>Legal</footer></div></body>",
    "<body><nav><a>Home</a></nav><div class='search-result-detail'>{}</div><footer>Legal</footer></body>"])
def test_wrappers_keep_their_article(page):
    for body in (paragraphs(6), "<h1>The headline of it</h1>" + paragraphs(6)):
        text = pages.main_text(page.format(body), np.array(pages.PRIOR))
        assert text.count("Paragraph") == 6 and "Home" not in text and "Legal" not in text


def test_long_comments_and_boxes_go():
    comments = "".join(f"<article class='comment-body'><p>Reader {i} writes a long comment, as readers do, and on it goes.</p></article>"
                       for i in range(40))
    page = (f"<body><div class='cookie-box'><p>We use cookies here, please accept them all and read on.</p></div><div><h1>Head</h1>"
            f"{paragraphs(5)}</div><div class='comments'>{comments}</div><form class='search'><p>Search all of our long site here.</p></form></body>")
    text = pages.main_text(page, np.array(pages.PRIOR))
    assert text.count("Paragraph") == 5 and "Reader" not in text and "cookies" not in text and "Search" not in text


@pytest.mark.parametrize("n", [1, 2, 3, 4, 100_000])
def test_any_number_of_blocks(n):
    page = "".join("<p>" + "word " * (1 + i * 7919 % 23) + ("text, and so it ends." if i % 3 or n < 5 else "") + "</p>" for i in range(n))
    blocks = pages.blocks_of(page)
    assert len(blocks) == n and pages.shape(blocks).shape == (n, pages.N_SHAPE)
    text = pages.main_text(page, np.array(pages.PRIOR))
    assert text.count("ends") > 0.6 * n if n < 5 else len(text) > 1_000_000


def test_names_do_not_outweigh_shape_and_ties():
    weights = np.array(pages.PRIOR)
    say = lambda k, n=40: f"{prose(k, n)} end."
    chrome = ('<nav><a href=1>Home</a> <a href=2>About</a></nav><div class="ad">Buy this now, it is cheap.</div>',
              "<footer><p>" + say(90) + "</p></footer>")
    cookies = "<div>Cookies here</div>"

    def check(body, want, before="", after=""):
        got = pages.main_text(f"<html><body>{chrome[0]}{before}{body}{after}{chrome[1]}</body></html>", weights)
        assert got.split() == want.split(), body

    for name in ('id="related-work"', 'id="search-strategy"', 'class="social-impact"', 'id="legal-analysis"', 'id="discussion"'):
        check(f"<article><h1>Title here</h1><p>{say(1)}</p><section {name}><h2>Some heading</h2><p>{say(2)}</p><p>{say(3)}</p>"
              f"</section><p>{say(4)}</p></article>", f"Title here {say(1)} Some heading {say(2)} {say(3)} {say(4)}", cookies)
    check(f'<article class="legal-analysis"><h2 id="discussion">About it</h2><p>{say(1)}</p><h3 id="recommendations">Advice</h3>'
          f'<p id="notice">{say(2)}</p></article>', f"About it {say(1)} Advice {say(2)}", cookies)
    # still boilerplate: short or linked parts of an article, whole elements outside of it
    check(f'<article><p>{say(1)}</p><div class="share-buttons"><a href=1>Share it</a></div><div class="social"><a href=2>Like '
          f'this</a></div><p>{say(2)}</p><aside><p>{say(3)}</p></aside></article>', f"{say(1)} {say(2)}", cookies,
          f'<div class="related"><article><p>{say(5)}</p></article></div><section id="comments"><p>{say(6)}</p></section>')
    # without an article, prose among prose outweighs the name of its element, a short notice does not
    blocks = pages.blocks_of(f'<body><div id="discussion"><p>{say(1)}</p></div><div id="notice">Cookies</div></body>')
    strong = np.array([0.0, 5.0, -20.0, 0, 0, 0, 0])
    assert all(abs(b.pull) < pages.MAX_SHAPE_COST + 2 * (pages.NEXT_TIE + pages.PARENT_TIE + pages.SECTION_TIE) for b in blocks)
    ring = [pages.Block(say(k), 0, -1 if k == 1 else 0, -pages.NAME_COST if k == 1 else 0.0, 1, 1, False) for k in range(3)]
    assert pages.labels_of(ring, strong) == [True, True, True]
    assert pages.labels_of(ring, -strong) == [False, False, False]
    assert pages.main_text(f"<body><nav>a</nav><div><p>{say(1)}</p><p>{say(2)}</p></div><div><a href=3>Cookie notice</a></div></body>", weights).split() == \
        f"{say(1)} {say(2)}".split()


# embeddings

VECTORS = "vec_id long, embedding array<float>, label int, _keys string, class_id int, _w int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", 1, 2) for i, v in rows], VECTORS)


def test_vectors_match_brute_force(spark):
    r = np.random.default_rng(7)
    x = r.normal(size=(700, 48)).astype(np.float32)
    for k in range(0, 300, 3):  # near ones around the threshold and far above
        x[k + 1] = x[k] + r.normal(size=48) * r.choice([0.05, 0.25, 0.32, 0.5])
    x[600:660] = x[599] + 0.05 * r.normal(size=(60, 48))  # a crowd
    x[660:690] = x[598]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.0] * 48), (903, [float("nan")] + [1.0] * 47), (904, [None] + [1.0] * 47),
             (905, [float("inf")] * 48), (None, x[598].tolist()), (906, [1.0, 2.0])]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    got = {q["_id"]: q for q in embeddings.near_vectors(vectors(spark, rows), block=32).collect()}
    found = sum(got[i]["n_links"] for i in range(700))
    assert 0.995 * link.sum() <= found <= link.sum()
    assert all(got[i]["n_links"] <= link[i].sum() for i in range(700))
    assert all(got[i]["component_id"] == 598 for i in range(660, 690)) and got[598]["n_links"] == 30
    for i in range(900, 907):
        assert got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"]
    assert got[None]["n_links"] == 0
    assert embeddings.near_vectors(vectors(spark, [])).count() == 0


def test_hadamard_is_orthogonal():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = embeddings.hadamard(x)
    assert np.allclose(y @ y.T, x @ x.T) and np.allclose(embeddings.hadamard(y), x)
