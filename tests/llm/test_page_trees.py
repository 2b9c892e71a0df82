"""Main text of ordinary pages, time against depth, and the site tree against brute force."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from caremart.llm import html_text

TEXT = "The text of the page goes on for more than a few words so that it counts."


@pytest.mark.parametrize(("html", "text"), [
    (f"<form id='f'><div>{TEXT}</div></form>", TEXT),
    (f"<form><article>{TEXT}</article></form><footer>f</footer>", TEXT),
    (f"<html><head><title>t</title><body><p>{TEXT}</body>", TEXT),
    (f"<head><meta charset=utf-8><title>t</title><p>{TEXT}", TEXT),
    *[(f"<div class='{c}'>{TEXT}</div><div class=ad>Buy this</div>", TEXT)
      for c in ("layout has-sidebar", "market-share", "legal", "side", "related", "no-sidebar", "post-header")],
    (f"<div class='layout has-sidebar'><article>{TEXT}</article><div class='sidebar'>s</div></div>", TEXT),
    (f"<div title='a hidden gem'>{TEXT}</div>", TEXT),
    (f"<div>{TEXT} {TEXT}</div><article>A teaser</article>", f"{TEXT} {TEXT} A teaser"),
    (f"<p>{TEXT}</p><svg><svg>X</svg>Y</svg><p>end</p>", f"{TEXT} end"),
    (f"<p>{TEXT}</p><svg>never closed <p>end</p>", f"{TEXT} never closed end"),
    # What is noise goes, also where there is more of it than of the article.
    (f"<article>{TEXT}</article><section id='comments'>{'<p>I think so too</p>' * 20}</section>", TEXT),
    (f"<div>{TEXT}</div><ol class='comment-list'>{'<li>I think so too' * 20}</ol>", TEXT),
    (f"<article>{TEXT}</article><div class='related-posts'>{'<article>More</article>' * 3}</div>", TEXT),
    (f"<article>{TEXT}<div style='color:red; display: none'>x</div><p hidden>y</p></article>", TEXT),
    (f"<main><header><h1>Title</h1></header>{TEXT}</main><header class='site-header'>s</header>", f"Title {TEXT}"),
    (f"<div id='ad-300x250'>Buy</div><aside>a</aside><p>{TEXT}</p><form>Name<input></form>", TEXT),
    (f"<div role='navigation'>n</div><div class='cookie-notice'>c</div><div>{TEXT}</div>", TEXT),
])
def test_pages_that_names_mislead_about(html, text):
    assert html_text.Page(html).text() == text


@pytest.mark.parametrize("html", [
    "<div>x" * 100_000, "<div class='ad'>x" * 100_000, "<b>x" * 100_000 + "</i>" * 100_000,
    "<i><div>" + "<b>x" * 50_000 + "</i>" * 50_000, "<li>x" * 100_000, "<p>x</section>" * 100_000,
    "<article>x" * 50_000, "<svg>" * 20_000 + "x",
])
def test_time_does_not_grow_with_depth(html):
    start = time.time()
    page = html_text.Page(html)
    page.branches()
    page.text(frozenset({1}))
    assert time.time() - start < 20


def test_branches_have_the_hash_of_their_own_words_and_tags():
    a = html_text.Page("<div><p>one two</p></div><section>x<div><p> one\n two </p></div></section>")
    b = html_text.Page("<div><p>one three</p></div>")
    (first, _, second), (other,) = sorted(a.branches(), key=lambda x: x[1] != a.branches()[0][1]), b.branches()
    divs = [x for x in a.branches() if x[2] == a.branches()[0][2]]
    assert len(divs) == 2 and divs[0][1] == divs[1][1] and divs[0][0] != divs[1][0]
    assert other[0] == first[0] and other[1] == first[1] and other[2] != first[2]
    assert second


def test_style_tree_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for k in range(60):
        host = rng.choice(["a.example", "b.example"])
        parts = [f"<div class='menu{rng.randint(0, 1)}'>{rng.choice(['Home', 'Start'])}</div>",
                 f"<section>{rng.choice(['<p>', '<ul><li>', ''])}text {rng.randint(0, 9)}</section>"]
        rows.append((k, f"https://{host}/{k}", "<body>" + "".join(parts * rng.randint(1, 2)) + "</body>"))
    rows += rows[:10]  # copies of pages count once
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen, having, done = defaultdict(list), Counter(), set()
    for _, url, html in rows:
        host = url.split("/")[2]
        if (host, html) in done:
            continue
        done.add((host, html))
        branches = html_text.Page(html).branches()
        for node, *variant in branches:
            seen[host, node].append(variant)
        having.update({(host, node) for node, *_ in branches})

    def entropy(values):
        n = len(values)
        p = [c / n for c in Counter(values).values()]
        return -sum(x * math.log(x) for x in p) / math.log(n) if n > 1 else 1.0

    want = {key: (len(v), having[key], round(max(entropy([x[0] for x in v]), entropy([x[1] for x in v])), 9))
            for key, v in seen.items()}
    tree = html_text.style_tree(pages).withColumn("importance", F.round("importance", 9) + 0.0)
    got = {(r["host"], r["node"]): (r["n"], r["pages"], r["importance"]) for r in tree.collect()}
    assert got.keys() == want.keys()
    assert all(got[k][:2] == want[k][:2] and abs(got[k][2] - want[k][2]) < 1e-8 for k in want)


def test_columns_that_look_like_the_operators_own(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x", "h", "l", "t")],
                                  "page_id long, url string, html string, host string, _low string, TEXT string")
    got = html_text.main_text(pages.withColumn("low", F.lit(1)).withColumn("_host", F.lit(2)))
    assert sorted(got.columns) == ["_host", "_low", "host", "html", "low", "page_id", "text", "url"]
    assert got.first()["text"] == "x"
