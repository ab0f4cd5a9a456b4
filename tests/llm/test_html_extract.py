"""Extraction against pages whose main text is known."""

import random
import time
from html import escape

from strata.llm.html_extract import ExtractParams, LineParser, clusters, extract_text, main_text, smoothed

import numpy as np

WORDS = "the of and a to in is you that it he was for on are with as his they be at one have this from".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def boilerplate(rng):
    return rng.choice([
        lambda: f"<nav><ul>{''.join(f'<li><a href=/{i}>{prose(rng, 2)}</a></li>' for i in range(6))}</ul></nav>",
        lambda: f"<header><h1>{prose(rng, 4)}</h1></header>",
        lambda: f"<div class='ad-slot'><p>{prose(rng, 60)}</p></div>",
        lambda: f"<div id=cookie-notice>{prose(rng, 80)}</div>",
        lambda: f"<aside><article>{prose(rng, 50)}</article></aside>",
        lambda: f"<form><p>{prose(rng, 30)}</p><textarea>x <p> y</textarea></form>",
        lambda: f"<section class='user-comments'><article><p>{prose(rng, 90)}</p></article></section>",
        lambda: "<script>if (a < b) { s = '</p><article>no</article>' }</script><style>p > b { }</style>",
        lambda: f"<div role=complementary><p>{prose(rng, 40)}</p></div>",
        lambda: f"<ul class=sidebar><li>{prose(rng, 20)}</li></ul>",
        lambda: f"<div hidden>{prose(rng, 40)}</div><!-- {prose(rng, 20)} -->",
        lambda: f"<footer>&copy; {prose(rng, 30)}</footer>",
    ])()


def test_articles_among_boilerplate():
    rng = random.Random(1)
    for _ in range(300):
        blocks = [prose(rng, rng.choice((1, 2, 5, 40, 200))) + rng.choice(("", " <&> é 中")) for _ in range(rng.randint(1, 12))]
        close = rng.random() < 0.5
        article = "<article>"
        for i, block in enumerate(blocks):
            shown = escape(block).replace(" of ", rng.choice((" <b>of</b> ", "\n\t of  ", " <i>of</i> ")))
            tag = "h1" if not i else rng.choice(("p", "li", "blockquote"))
            article += f"<{tag}>{shown}" + (f"</{tag}>" if close or tag != "p" else "")
            if rng.random() < 0.3:
                article += boilerplate(rng).replace("<header", "<nav").replace("</header", "</nav")
        page = ("<!DOCTYPE html><html><head><title>T</title></head><body class='with-sidebar'>"
                + "".join(boilerplate(rng) for _ in range(rng.randint(0, 4))) + "<div class='page layout sidebar-right'>"
                + article + "</article></div>" + "".join(boilerplate(rng) for _ in range(rng.randint(0, 4))) + rng.choice(("</body></html>", "")))
        assert main_text(page) == "\n".join(blocks), page


def test_pages_that_name_no_article():
    rng = random.Random(2)
    for _ in range(100):
        blocks = [prose(rng, 5), *(prose(rng, rng.choice((3, 40, 80, 120))) for _ in range(rng.randint(4, 15))), prose(rng, 60)]
        links = "".join(f"<li><a href=/{i}>{prose(rng, 2)}</a></li>" for i in range(10))
        page = (f"<body><div><div><ul>{links}</ul></div><div><h2>{blocks[0]}</h2>{''.join(f'<p>{b}</p>' for b in blocks[1:])}</div>"
                f"<div><ul>{links}</ul></div></div></body>")
        assert main_text(page) == "\n".join(blocks), page


def test_clusters_follow_the_ratio():
    lines = LineParser().read("<ul>" + "<li><a>ab</a></li>" * 8 + "</ul>" + "<p>" + "x" * 200 + "</p><p>y</p><p>" + "z" * 200 + "</p>" + "<ul>" + "<li><a>ab</a></li>" * 8 + "</ul>")
    above = clusters(lines, np.ones(len(lines), dtype=bool), ExtractParams())
    texts = [line.text for line, a in zip(lines, above) if a]
    assert "y" in texts and "x" * 200 in texts and "z" * 200 in texts and len(texts) <= 5


def test_smoothing_keeps_a_constant_and_is_symmetric():
    assert np.allclose(smoothed(np.full(7, 3.0), 1.0), 3.0)
    spike = smoothed(np.array([0, 0, 0, 1.0, 0, 0, 0]), 1.0)
    assert np.allclose(spike, spike[::-1]) and spike[3] == spike.max()


def test_white_space_and_references():
    assert main_text("<article><p> a\n\t b<b>c</b>&nbsp;d<br>e </p>f&amp;amp;&lt;p&gt;&#x41;&am</article>") == "a bc d e\nf&amp;<p>A&am"
    assert main_text("<article><p><b>one.<br><p>two.<p></article>") == "one.\ntwo."


def test_defined_edge_cases():
    assert main_text(None) == main_text("") == main_text("<article></article>") == main_text("<nav>x</nav>") == ""
    assert main_text("Just text") == "Just text"
    assert main_text("<main><p>in</p></main><p>out out out</p>") == "in"
    assert main_text("<article>a<script>b") == "a" and main_text("<article>a<!-- b <p>c") == "a"
    assert main_text("<article>a<button>b</button> c<span class=ad>d</span></article>") == "a c"
    assert main_text("<![x]><?php y ?><article>a</article>") == "a"


def test_long_and_broken_pages_take_linear_time():
    began = time.time()
    main_text("<!--" * 200_000)
    main_text("<a " * 200_000)
    main_text("<div>" * 60_000 + "x" + "</p></section>" * 60_000)
    main_text("<div>x" * 20_000)
    long = main_text("<article>" + "<p>word and word" * 100_000)
    assert long.count("\n") == 99_999 and time.time() - began < 60


def test_operator_over_odd_tables(spark):
    rows = [(1, "u", "<article>a</article>", "t", 7), (1, "u", "<article>a</article>", "t", 7), (None, None, None, None, None), (2, None, "", "x", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(1, "u", "a", 1)] * 2 + [(None, None, "", 0), (2, None, "", 0)], key=str)
    assert extract_text(pages.limit(0)).count() == 0
