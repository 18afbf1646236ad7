"""Repeated queries, many languages, copies in training, names inside of an article."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from subtide.llm import html, langid, topk

DOCS = "doc_id long, text string, lang string, _letter string, _h int"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "z", 1) for r in rows], DOCS)


def test_a_repeated_query_is_asked_once(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(120)]
    rows += [(50, rows[50][1])] * 3 + [(100, [9.0, 9.0, 9.0]), (100, [0.0, 0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=1).collect()
    asked = {0: rows[0][1], 50: rows[50][1], 100: min([rows[100][1], [9.0, 9.0, 9.0], [0.0, 0.0, 1.0]])}
    expected = []
    for query, own in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != query)
        expected += [(query, rank, i, int(-s)) for rank, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(tuple(r) for r in found) == sorted(expected)


def alphabets(count: int) -> dict:
    """Languages of four letters of their own each."""
    return {f"l{n}": [chr(0x4E00 + 4 * n + k) for k in range(4)] for n in range(count)}


def test_every_language_is_learned(spark):
    letters = alphabets(70)
    rows = [(i, " ".join(own * (1 + i % 3)), lang) for i, (lang, own) in enumerate(sorted(letters.items()) * 3)]
    docs = documents(spark, rows)
    model = langid.train(docs, F.lit(True), many_langs=10)
    assert model.langs == sorted(letters)
    assert all(r.lang_pred == rows[r.doc_id][2] for r in langid.identify(docs, model).collect())


def test_copies_of_one_row_are_a_language_learned_once(spark):
    for key in range(4):
        rows = [(key, "abc abd abe", "one")] * 4000 + [(100 + i, f"xyz {i} zyx", "two") for i in range(50)]
        docs = documents(spark, rows)
        sample = langid.training_rows(docs, F.lit(True), 400, 1_000_000, 64)
        assert {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()} == {"one": 1, "two": 50}
    found = langid.identify(docs, langid.train(docs, F.lit(True)))
    assert {(r.doc_id == key, r.lang_pred) for r in found.collect()} == {(True, "one"), (False, "two")}


def test_recognised_documents_take_a_missing_language(spark):
    rows = [(i, "abc abd abe " * 3, "one") for i in range(9)] + [(20 + i, "xyz zyx " * 3, "two") for i in range(9)]
    rows += [(40, "abd abe abc", None), (41, "zyx xyz zyx", None), (42, "abd abe", "two"), (43, "12 34", None), (44, None, "one")]
    docs = documents(spark, rows)
    kept = langid.recognised(docs, langid.train(docs, F.col("doc_id") < 40))
    assert kept.columns == docs.columns
    found = {r.doc_id: r for r in kept.collect()}
    assert {k: found[k].lang for k in (0, 20, 40, 41, 42)} == {0: "one", 20: "two", 40: "one", 41: "two", 42: "two"}
    assert not {43, 44} & found.keys() and all(r["_letter"] == "z" and r["_h"] == 1 for r in found.values())
    empty = langid.recognised(docs, langid.Model({}))
    assert {r.doc_id: r.lang for r in empty.collect()}[40] is None


LONG = "A sentence of the article that is long enough to be text wherever it stands on a page. "

INSIDE = [
    ('<section class="discussion"><h2>Discussion</h2><p>We found less.</p></section>', "Discussion We found less."),
    ('<p class="teaser">In short.</p>', "In short."),
    ('<div class="search"><p>Results of the search.</p></div>', "Results of the search."),
    ('<h2 class="related">Related work</h2>', "Related work"),
    ('<ul class="social"><li>Ants</li></ul>', "Ants"),
    ('<p class="notice">Keep dry.</p>', "Keep dry."),
    ('<div class="recommended"><p>A dose of two.</p></div>', "A dose of two."),
    ('<section class="comments"><p>First!</p></section>', ""),
    ('<div class="advert">Buy</div>', ""),
    ('<p class="sponsored">Buy now</p>', ""),
    ('<div class="left-sidebar">More</div>', ""),
    ('<ul class="breadcrumb"><li>Home</li></ul>', ""),
    ('<div class="cookie-notice">We use cookies</div>', ""),
    ('<div class="comment-list"><p>Me too</p></div>', ""),
    ('<form class="search"><button>Go</button></form>', ""),
]


@pytest.mark.parametrize("inside, text", INSIDE)
def test_names_inside_of_an_article(inside, text):
    page = f"<html><body><nav>Home</nav><article><p>{LONG}</p>{inside}<p>{LONG}</p></article><footer>F</footer></body></html>"
    expected = " ".join(" ".join([LONG, text, LONG]).split())
    assert html.main_text(page) == expected


UNMARKED = [
    ('<div class="content"><p>{0}</p><aside>Side</aside><p>Short.</p></div>', "{0} Short."),
    ('<div id="top"><a href="/">Home</a></div><div><p>{0}</p><p>End.</p></div>', "{0} End."),
    ('<div class="sidebar"><p>Other</p></div><div class="post"><h1>Title</h1><p>{0}</p></div>', "Title {0}"),
    ('<div><h2 id="related-work">Related work</h2><p>{0}</p></div><div class="footer">F</div>', "Related work {0}"),
    ('<table class="nav"><tr><td>Menu</td></tr></table><div><p>{0}</p><ul><li>One</li><li>Two</li></ul></div>', "{0} One Two"),
    ('<div class="has-sidebar"><p>{0}</p><p>Last.</p></div><div class="comments"><p>No!</p></div>', "{0} Last."),
    ("<div><p>{0}</p><form><button>Go</button></form><p>More.</p><nav>N</nav><p>Done.</p></div>", "{0} More. Done."),
    ('<div class="cookie-banner">We use cookies</div><div><p>{0}</p><pre>x = 1</pre></div>', "{0} x = 1"),
    ('<div class="main"><p>Lead.</p><div class="ad">Buy</div><p>{0}</p></div><script>x()</script>', "Lead. {0}"),
    ('<header>Site</header><div><p>{0}</p><blockquote>Said.</blockquote></div><footer>F</footer>', "{0} Said."),
]


@pytest.mark.parametrize("page, text", UNMARKED)
def test_pages_without_marks(page, text):
    body = page.format(LONG)
    assert html.main_text(f"<html><body>{body}</body></html>") == " ".join(text.format(LONG).split())
