"""Each operator on NULLs, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import pytest
from llm_plain import components, edit_distance_within, shingles
from pyspark.sql import functions as F
from test_llm_queries import unpacked

import corpus_pipeline
from subtide.llm import chat, decontaminate, html, jaccard, langid, mixing, packing, topk, urls, warc
from subtide.llm.queries import LLM_QUERIES
from subtide.sources.scratch import scratch_root

DOCS = "doc_id long, text string, lang string, source string, size int, `_hash` string, key int"


def documents(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*row, 1, "x", 2) for row in rows], DOCS)


# --- mixing -------------------------------------------------------------------------------------


def plain_targets(sizes: dict, weights: list[int], epochs: int) -> dict:
    """Clamp and share out the excess until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in clamped)
        free = sum(weight[s] for s in order if s not in clamped)
        target = {s: epochs * sizes[s] if s in clamped else left * weight[s] / free for s in order}
        above = {s for s in order if target[s] > epochs * sizes[s]} - clamped
        if not above:
            return target
        clamped |= above


def test_mix_targets_and_sample(spark):
    rows, n = [], random.Random(5)
    for source, count in (("a", 3), ("b", 40), (None, 5), ("c", 200), ("é", 2), ("z", 0)):
        for _ in range(count):
            rows.append((len(rows), "w " * n.randint(0, 30), "en", source))
    rows += [(None, None, None, None), (1000, "", None, "z"), (1000, "", None, "z")]
    found = mixing.mix(documents(spark, rows), [5, 2, 1]).collect()
    assert len(found) == len(rows)
    sizes: dict = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    expected = plain_targets(sizes, [5, 2, 1], 3)
    taken: dict = {}
    for r in found:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source in sizes:
        assert abs(taken[source] - expected[source]) <= 15
    again = mixing.mix(documents(spark, rows).repartition(5), [5, 2, 1]).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mix_repeats_rows_with_all_columns(spark):
    rows = [(i, "a b c", "en", "s" if i % 2 else None) for i in range(20)]
    docs = documents(spark, rows)
    out = mixing.repeated(docs, [1, 1])
    assert out.columns == docs.columns and out.count() == 20
    assert mixing.repeated(docs.limit(0), [1]).count() == 0
    assert mixing.mix(docs.limit(0), [1]).count() == 0


# --- Jaccard join ---------------------------------------------------------------------------------


def edited(n: random.Random, words: list[str], edits: int) -> list[str]:
    words = list(words)
    for _ in range(edits):
        words[n.randrange(len(words))] = f"new{n.randrange(10**6)}"
    return words


def near_copies(seed: int) -> list:
    n = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = [n.choice(vocabulary) for _ in range(40)]
    texts: list = [None, "", " \t\n", "One two", "one TWO", "one two three", "É é", "é É"]
    for size in (1, 2, 3, 5, 30, 60):  # groups of near copies around the threshold
        base = [n.choice(vocabulary) for _ in range(n.randint(30, 120))] + passage
        texts += [" ".join(edited(n, base, n.randint(0, 4))) for _ in range(size)]
    texts += texts[20:24] * 10
    return [(i, text, "en", "s") for i, text in enumerate(texts)]


@pytest.mark.parametrize(("size", "similar"), [(4, (85, 100)), (5, (80, 100)), (2, (60, 100))])
def test_jaccard_equals_brute_force(spark, size, similar):
    rows = near_copies(size)
    found = jaccard.jaccard_components(documents(spark, rows).repartition(4), size, similar).collect()
    sets = {key: shingles(text, size) for key, text, _, _ in rows}
    assert {r.doc_id: r.component_id for r in found} == components(sets, *similar)
    assert {r.doc_id: r.n_shingles for r in found} == {k: len(s) for k, s in sets.items()}


def test_jaccard_in_blocks(spark, monkeypatch):
    """Cells of many blocks give the same components."""
    monkeypatch.setattr(jaccard, "BLOCK", 400)
    rows = near_copies(9)
    found = jaccard.jaccard_components(documents(spark, rows)).collect()
    sets = {key: shingles(text, 4) for key, text, _, _ in rows}
    assert {r.doc_id: r.component_id for r in found} == components(sets, 85, 100)


def test_block_join_equals_brute_force():
    import numpy as np

    n = random.Random(2)
    for _ in range(60):
        base = [n.randrange(10**9) for _ in range(60)]
        sets = []
        for _ in range(n.randint(2, 25)):
            own = {x if n.random() > 0.1 else n.randrange(10**9) for x in base}
            sets.append(np.array(sorted(own), dtype=np.uint64))
        parent = jaccard.Joined(len(sets))
        for a, b in jaccard.join_block(sets, (75, 100)):
            parent.join(a, b)
        expected = components({i: frozenset(s.tolist()) for i, s in enumerate(sets)}, 75, 100)
        assert parent.root.tolist() == [expected[i] for i in range(len(sets))]


def test_jaccard_stage_keeps_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text, "en", "s"), (5, text, "en", "s"), (9, text + " x", "en", "t"), (None, "a b", "en", "u")]
    rows += [(7, None, "en", "s"), (8, None, "en", "s")]
    docs = documents(spark, rows)
    kept = jaccard.one_of_each(docs, 5, (80, 100))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "7", "8", "None"]
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_jaccard_stage_keeps_one_row_of_each_component(spark):
    first, second, third = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(None, first), (None, first + " x"), (None, first), (3, second), (3, third), (2, third + " x")]
    rows += [(None, second + " x"), (3, None), (3, ""), (None, None), (None, None)]
    docs = documents(spark, [(key, text, "en", "s") for key, text in rows])
    kept = [(r.doc_id, r.text) for r in jaccard.one_of_each(docs, 5, (80, 100)).collect()]
    alone = [(3, None), (3, ""), (None, None)]
    assert [k for k in alone if k not in kept] == [] and (3, second) in kept and (2, third + " x") in kept
    assert len(kept) == 6 and len({(None, first), (None, first + " x")} & set(kept)) == 1


# --- top-k ----------------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    import math

    n = random.Random(4)
    vectors = [[n.uniform(-1, 1) for _ in range(6)] for _ in range(150)]
    vectors += [[0.5] * 6] * 30 + [None, [0.1, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [math.inf] * 6]
    vectors += [[1.0, 2.0], [3.0, 4.0], []]
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)]
    rows += [(3, vectors[3], 1, "x"), (None, vectors[0], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int, rank string")
    found = topk.top_k(df.repartition(3), F.col("vec_id") % 5 == 0, k=4, scale=256).collect()
    whole = [
        (i, [math.floor(256 * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    expected = []
    for q, a in whole:
        if q % 5 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b)]
            expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:4])]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted(expected)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_products_that_doubles_cannot_hold():
    import numpy as np

    big = topk.Vectors(np.arange(2), np.array([[2**40, 3], [2**40 + 1, -1]], dtype=np.int64))
    found = topk.products(big, 0, big, np.array([0, 1]))
    assert found.tolist() == [2**80 + 9, 2**40 * (2**40 + 1) - 3]


# --- HTML -----------------------------------------------------------------------------------------

PAGES = [
    (None, ""),
    ("", ""),
    ("<p>cut off <b", "cut off"),
    ("no markup &amp; no end &lt;p&gt;", "no markup & no end <p>"),
    ('<div class="ad">unclosed<article><p>x', "x"),
    ("<!-- never closed <p>no", ""),
    ("<article><p>a<b>b</b>c<br>d\n\t e</p><script>var x='</p>'</script><p>f</p></article>", "abc d e f"),
    (
        '<body class="has-sidebar"><header>Site</header><nav>menu</nav><div class="sidebar-left wrap">'
        '<article><p>main<div class="share">s</div></article><aside><article>card</article></aside>'
        "<section class=comments><article class=comment><p>no</p></article></section></div>",
        "main",
    ),
    (
        '<div class="site-header">Site name and a long slogan that goes on and on for a while, see?</div>'
        '<div class="post-header"><h1>Title</h1></div><p hidden>not shown</p><p style="display: none">nor this'
        "</p><p>One paragraph that is certainly long enough to be the text of this page, in full.</p>"
        "&am<b>p;</b>",
        "Title One paragraph that is certainly long enough to be the text of this page, in full. &amp;",
    ),
    (
        '<div id="top-nav"><a href=x>one</a></div><div class="content"><h1>T</h1><p>The first of '
        "two paragraphs has enough text to be the main text of this page &eacute;.</p><p>Short.</p></div>"
        '<div class="cookieNotice">We use cookies</div><form><p>your name</p></form>'
        "<div id=comments><p>A reader's comment, long enough to be taken for text of the page itself."
        "</p></div><footer>end</footer>",
        "T The first of two paragraphs has enough text to be the main text of this page é. Short.",
    ),
]


def test_html_cases(spark):
    rows = [(i, None, page, 1, 2) for i, (page, _) in enumerate(PAGES)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int, n_chars int")
    found = {r.page_id: r for r in html.extract(df).collect()}
    assert [found[i].text for i in range(len(PAGES))] == [text for _, text in PAGES]
    assert html.extract(df.limit(0)).count() == 0


def test_short_lines_of_unmarked_pages_stay():
    long = "A paragraph of the text " * 6 + "ends."
    for dropped in ("aside", "form", "nav", "button", "fieldset"):
        gap = f"<{dropped}>x</{dropped}>"
        page = f"<div>Site</div><div class=c><p>Lead.</p>{gap}<p>{long}</p>{gap}<p>Sh is.</p></div><div>End</div>"
        assert html.main_text(page) == f"Lead. {long} Sh is."
        page = f"<div class=c><div><p>{long}</p></div>{gap}<section><p>Sh is.</p><p>So.</p></section></div>"
        assert html.main_text(page) == f"{long} Sh is. So."
    page = f"<div class=c><p>{long}</p><p><a href=x>All of it is a link.</a></p></div><nav>x</nav><p>End</p>"
    assert html.main_text(page) == f"{long} All of it is a link."
    apart = f"<div><p>{long}</p><p>One.</p></div><nav>x</nav><div><p>{long}</p><p>Two.</p></div>"
    assert html.main_text(f"<body>{apart}</body>") == f"{long} One. {long} Two."
    assert html.main_text("<ul><li><a href=x>only links</a></ul>") == "only links"


def test_names_drop_only_what_they_name_whole():
    long = "A paragraph of the text " * 6 + "ends."
    slugs = '<h2 id="related-work">R</h2><section id="search-algorithms">S</section><p id="copyright-law">C</p>'
    slugs += '<section id="social-history">H</section><h3 id="discussion">D</h3><div class="no-sidebar">N</div>'
    boxes = '<div class="left-sidebar">x</div><div id="comment-list">x</div><div class="b shareButtons">x</div>'
    assert html.main_text(f"<article>{slugs}{boxes}<p>{long}</p></article>") == f"R S C H D N {long}"
    assert html.main_text(f"<div>{slugs}{boxes}<p>{long}</p></div>") == f"R S C H D N {long}"
    for name in ("content no-sidebar", "page has-sidebar", "with-sidebar", "sidebar", "search-page", "widget"):
        assert html.main_text(f'<div class="{name}"><p>{long}</p><p>So.</p></div><p>End</p>').startswith(long)
    most = f'<div class=comments><p>{long}{long}</p></div>'
    assert html.main_text(f"<div class=content><p>{long}</p></div>{most}") == long


def test_main_element_with_articles():
    two = "<article><p>one</p></article><article><p>two</p></article>"
    assert html.main_text(f"<main><p>A long intro.</p>{two}</main><p>End</p>") == "A long intro. one two"
    card = "<aside><article>card</article></aside><div><article>other</article></div>"
    assert html.main_text(f"<main><p>The text.</p>{card}</main>") == "The text. other"
    inner = "<main><p>path</p><article><p>The whole of the text.</p></article></main>"
    assert html.main_text(inner) == "The whole of the text."


def test_long_page_is_whole():
    body = "".join(f"<p>paragraph {i}</p>" for i in range(20_000))
    assert html.main_text(f"<article>{body}</article>").endswith("paragraph 19999")


# --- WARC -----------------------------------------------------------------------------------------


def test_warc_round_trip(spark, monkeypatch):
    long = "é" * 700
    rows = [(1, "http://a/\n x", long), (2, None, long), (3, "u", "x" * 999), (4, "u", "x" * 999)]
    rows += [(5, "u", None), (None, "u", long), (2, None, long), (6, "u", "y" * 3_000_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, digest int, payload string")
    index = warc.write_bundles(warc.with_revisits(df))
    assert index.count() == len(rows)
    found = warc.read_records(index).collect()
    whole = {r[0]: (r[2] or "").encode() for r in rows}
    assert len(found) == len(rows)
    for r in found:
        assert r.payload_digest == hashlib.sha1(whole[r.page_id]).hexdigest()
        assert r.payload_bytes == len(whole[r.page_id])
        revisit = r.page_id in (1, None)
        assert (r.record_type, r.refers_to) == (("revisit", 2) if revisit else ("response", None))
        assert r.payload is None if revisit else bytes(r.payload) == whole[r.page_id]
    one = warc.read_records(index.filter("record_id = 'urn:page:3'")).collect()
    assert [r.page_id for r in one] == [3]
    assert warc.read_records(warc.write_bundles(warc.with_revisits(df.limit(0)))).count() == 0


def test_bundles_are_plain_zstandard(spark):
    import io

    import zstandard

    df = spark.range(50).selectExpr("id page_id", "'u' url", "repeat('ab', 40000) html").coalesce(1)
    index = warc.write_bundles(warc.with_revisits(df)).collect()
    data = open(index[0].bundle.removeprefix("file:"), "rb").read()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\n") == 50


# --- URLs -----------------------------------------------------------------------------------------


def test_url_rules(spark):
    rules = [("COM", "/", "allow"), ("example.com", "/en/", "block"), ("a.example.com", "", "allow")]
    rules += [("net", "/", "allow"), ("net", "/", "block"), ("org", "/abc", "block"), ("b.org", "/a", "allow")]
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    cases = {
        "http://x.COM/": ("x.com", "/", "com/", "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "https://www.example.com/en/1?q#f": ("www.example.com", "/en/1", "example.com/en/", "block"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "//net/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "x://": ("", "", None, "allow"),
        "a://net/?://b": ("net", "/", "net/", "block"),
        "a://b.org/abcd": ("b.org", "/abcd", "b.org/a", "allow"),
        "a://É.net#/": ("É.net", "", None, "allow"),
    }
    rows = [(i, url, 1) for i, url in enumerate(cases)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int")
    for shard_rules in (2, 100):
        shards = urls.build(rules, shard_rules)
        found = sorted(urls.judge(pages, shards).collect())
        assert [tuple(r)[1:] for r in found] == list(cases.values())
    assert urls.judge(pages.limit(0), shards).count() == 0
    none = urls.judge(pages, urls.build(rules.limit(0)), default="block").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "block")}


def test_url_collisions_do_not_decide(spark, monkeypatch, tmp_path):
    """Two rules under one key: the stored string tells them apart."""
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist(
        [{"host": h, "path": "/", "verdict": "block", "key": 7} for h in ("a", "b")], urls.KEYED
    )
    made = next(urls._write_shard(iter([batch]), str(tmp_path))).to_pylist()[0]
    found = list(urls.Shard(made["file"]).find(np.array([7, 8])))
    assert found == [(0, ["a", "/", "block"]), (0, ["b", "/", "block"])]


def plain_rule(host, path, rules):
    """The rule and verdict of a URL, by trying every rule."""
    fits = [
        (len(h) + len(p), len(h), h + p, verdict)
        for h, p, verdict in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if host and fits else (None, "allow")


def test_url_rules_of_many_shards(spark):
    """Pages, some stored twice, against every rule in turn: one shard and many give the same."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    pages = pages.unionByName(pages.filter("page_id % 3 = 0"))
    hot = spark.range(300).selectExpr("CAST(NULL AS LONG) page_id", "concat('h://a.b.com/x/', id % 7) url")
    pages = pages.unionByName(hot)
    parsed = urls.judge(pages, urls.build(spark.createDataFrame([], "host string, path string, verdict string")))
    parsed = [(r.page_id, r.host, r.path) for r in parsed.collect()]
    rules = {("com", "/", "allow"), ("b.com", "/x/", "block"), ("b.com", "/x/3", "allow"), ("zz", "", "block")}
    for i, (_, host, path) in enumerate(parsed):
        if host:
            rules.add((host, path[: i % 5], "block" if i % 2 else "allow"))
            rules.add((host.partition(".")[2] or host, path[: 2 + i % 3], "block"))
    blocked = {(h, p) for h, p, verdict in rules if verdict == "block"}
    rules = sorted(r for r in rules if r[2] == "block" or r[:2] not in blocked)
    expected = sorted(((k, h, p, *plain_rule(h, p, rules)) for k, h, p in parsed), key=repr)
    assert len({r[3] for r in expected}) > 5
    stored = [(h, p, None if (verdict == "block" and len(p) % 2) else verdict) for h, p, verdict in rules]
    stored = spark.createDataFrame(stored, "host string, path string, verdict string")
    for shard_rules, most in ((5, len(rules)), (10_000, 1)):
        shards = urls.build(stored, shard_rules)
        assert shards.count() <= most and (most == 1 or shards.count() > 3)
        assert sum(s.rules for s in shards.collect()) == len(rules)
        assert sorted(map(tuple, urls.judge(pages, shards).collect()), key=repr) == expected


# --- chat -----------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    tricky = ["\\", "<|", "<\\|", "\\\\<|end|>\n", "<|turn|>assistant<|say|>x", "<", "|>", "", None, "a\n"]
    n = random.Random(1)
    rows = []
    for c in range(25):
        for t in range(12):
            role = n.choice(["user", "assistant", "assistant", "<|say|>", None, "a\nb"])
            rows.append((c, t if t % 7 else None, role, n.choice(tricky)))
    rows += [(99, 1, "user", "same")] * 3
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, segments int, formatted string")
    out = chat.format_conversations(df)
    found = out.select("conv_id", chat.read_turns("formatted").alias("t"), chat.loss_text("segments").alias("loss"), "formatted", "segments").collect()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in found:
        own = sorted((x for x in rows if x[0] == r.conv_id), key=order)
        assert [(t.role, t.text) for t in r.t] == [(x[2] or "", x[3] or "") for x in own]
        assert r.loss == "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
    assert len(found) == 26
    assert chat.format_conversations(df.limit(0)).count() == 0


# --- language -------------------------------------------------------------------------------------


def test_language_code_lengths_are_exact(spark):
    import math
    from collections import Counter, defaultdict

    learned = [("xx", "the cat sat on the mat"), ("xx", "the rat"), ("yy", "el gato está en la casa")]
    rows = [(i, text, lang, "s") for i, (lang, text) in enumerate(learned)]
    model = langid.train(documents(spark, rows), F.lit(True))
    trees = {lang: defaultdict(Counter) for lang in ("xx", "yy")}
    for lang, text in learned:
        data = langid.START + text.encode()
        for i in range(3, len(data)):
            for size in range(4):
                trees[lang][data[i - size : i]][data[i]] += 1

    def plain(lang, text):
        data, bits = langid.START + text.encode(), 0.0
        for i in range(3, len(data)):
            for size in (3, 2, 1, 0):
                follow = trees[lang].get(data[i - size : i])
                if follow:
                    total = sum(follow.values()) + len(follow)
                    if data[i] in follow:
                        bits += math.log2(total / follow[data[i]])
                        break
                    bits += math.log2(total / len(follow))
            else:
                bits += 8
        return bits

    texts = ["the cat", "gato", "", "日本語 the", "zzz\x00", "está " * 50]
    lengths = model.lengths(texts)
    for i, text in enumerate(texts):
        assert lengths[i].tolist() == pytest.approx([plain("xx", text), plain("yy", text)])
    small = langid.Model({})
    assert small.langs == []


def test_language_cases(spark):
    rows = [(i, "the cat sat on the mat " * 5, "en", "s") for i in range(8)]
    rows += [(i, "der Hund ist im Haus " * 5, "de", "s") for i in range(8, 16)]
    rows += [(20, None, "en", "s"), (21, "", "en", "s"), (22, "123 !", None, "s"), (None, "the cat", None, "s")]
    rows += [(23, "der Hund " * 400_000, None, "s"), (23, "der Hund", None, "s")]
    docs = documents(spark, rows)
    model = langid.train(docs, ~langid.held_out())
    found = langid.identify(docs, model).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, set()).add(r.lang_pred)
        assert 0 <= r.score <= 1
    assert by[20] == by[21] == by[22] == {"und"} and by[None] == {"en"} and by[23] == {"de"}
    assert langid.recognised(docs, model).count() == len(rows) - 3
    assert langid.recognised(docs, model).columns == docs.columns
    nothing = langid.train(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_unlabelled_documents_stay(spark):
    rows = [(1, "the cat sat on the mat", None, "s"), (2, "é", None, "s"), (3, "12 !", None, "s")]
    docs = documents(spark, [*rows, (4, None, None, "s"), (5, "", None, "s"), (None, "der Hund", None, "s")])
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == {1, 2, None} and kept.columns == docs.columns


# --- packing --------------------------------------------------------------------------------------


def test_packing_cases(spark):
    rows = [(1, None), (2, ""), (3, "a" * 50_000), (4, "word " * 20_000), (5, "<|endoftext|> é日本"), (6, " ")]
    docs = documents(spark, [(key, text, "en", "s") for key, text in rows])
    packed = packing.pack(docs, packing.RANKS)
    assert unpacked(packed.collect()) == {key: text for key, text in rows if text}
    read = packing.read_matrices(packing.write_matrices(packed))
    assert sorted(map(str, read.collect())) == sorted(map(str, packed.collect()))
    assert packing.pack(docs.limit(0), packing.RANKS).count() == 0
    none = packing.write_matrices(packing.pack(docs.limit(0), packing.RANKS))
    assert none.count() == 0 and packing.read_matrices(none).count() == 0
    twice = packing.pack(docs.filter("doc_id = 5").unionAll(docs.filter("doc_id = 5")), packing.RANKS)
    assert [r.doc_ids for r in twice.coalesce(1).collect()] in ([[5, 5]], [[5], [5]])
    nameless = documents(spark, [(None, "x", "en", "s")])
    row = packing.read_matrices(packing.write_matrices(packing.pack(nameless, packing.RANKS))).first()
    assert row.doc_ids == [None]


def test_query_and_stage_write_matrices(spark, tmp_path):
    docs = documents(spark, [(i, "some words " * 900 * i, "en", "s") for i in range(4)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plain = sorted(map(str, packing.pack(docs.coalesce(1), packing.RANKS).collect()))
    steps = [
        lambda: LLM_QUERIES["op9_pack_tokens"](spark, str(tmp_path)),
        lambda: corpus_pipeline.pack_tokens(spark, docs.coalesce(1), str(tmp_path)),
    ]
    root = Path(scratch_root(spark).removeprefix("file:"))
    for step in steps:
        before = set(root.glob("packed-*/*.ids.bin"))
        found = step().collect()
        made = set(root.glob("packed-*/*.ids.bin")) - before
        assert sum(file.stat().st_size for file in made) == 2 * packing.LENGTH * len(found) > 0
        assert unpacked(found) == {i: "some words " * 900 * i for i in range(1, 4)}
    assert sorted(map(str, found)) == plain


def test_best_fit_decreasing_equals_a_scan():
    n = random.Random(3)
    for _ in range(200):
        length = n.randint(1, 40)
        sizes = [n.randint(1, length) for _ in range(n.randint(0, 60))]
        room: list[int] = []
        for size in sorted(sizes, reverse=True):
            best = min((r for r in room if r >= size), default=None)
            if best is None:
                room.append(length - size)
            else:
                room[room.index(best)] -= size
        found = packing.best_fit_decreasing(sizes, length)
        assert sorted(i for s in found for i in s) == list(range(len(sizes)))
        assert sorted(length - sum(sizes[i] for i in s) for s in found) == sorted(room)


# --- decontamination ------------------------------------------------------------------------------


def test_edit_search_equals_a_table():
    n = random.Random(1)
    for _ in range(200):
        pattern = "".join(n.choice("ab ") for _ in range(n.randint(1, 70)))
        text = "".join(n.choice("ab ") for _ in range(n.randint(0, 90)))
        assert decontaminate.edit_search(pattern, text)[0] == edit_distance_within(pattern, text)


def test_no_item_within_the_budget_is_missed():
    n = random.Random(8)
    letters = "abcdefgh "
    items = [(i, "".join(n.choice(letters) for _ in range(n.randint(20, 90)))) for i in range(8)]
    items = [(i, decontaminate.normal(t)) for i, t in items]
    known = decontaminate.Items(items, 0.1)
    for _ in range(150):
        key, item = n.choice(items)
        text = list(item)
        for _ in range(n.randint(0, 9)):
            at = n.randrange(len(text))
            text[at : at + 1] = n.choice([[], [n.choice(letters)], [text[at], n.choice(letters)]])
        text = "xyz " + "".join(text) + " xyz"
        expected = {i: edit_distance_within(t, text) for i, t in items}
        found = {i: d for i, d, _, _ in known.find(text)}
        assert found == {i: d for i, d in expected.items() if d <= int(0.1 * len(dict(items)[i]))}


def test_decontamination_cases(spark):
    item = "What is the capital of the country that lies to the north of this one?"
    items = spark.createDataFrame(
        [(1, item, 0), (1, item, 0), (2, None, 0), (3, "short", 0), (None, item, 0)], "item_id long, text string, distance int"
    )
    rows = [(1, "So: WHAT is the capital, of the country that lies to the north of this one."), (2, None)]
    rows += [(3, ""), (4, "short " * 50), (5, "Who is the capital of the country that lies to the north of that one")]
    rows += [(1, rows[0][1]), (6, "filler " * 100_000 + item), (None, item)]
    docs = documents(spark, [(key, text, "en", "s") for key, text in rows])
    found = decontaminate.matches(docs, items, block_chars=60).collect()
    assert sorted((str(r.doc_id), r.item_id, r.distance) for r in found) == [
        ("1", 1, 0), ("1", 1, 0), ("6", 1, 0), ("None", 1, 0)
    ]
    loose = decontaminate.matches(docs, items, rate=0.15).collect()
    assert {r.doc_id for r in loose} == {1, 5, 6, None}
    kept = decontaminate.clean(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5] and kept.columns == docs.columns
    assert decontaminate.clean(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.matches(docs.limit(0), items).count() == 0


def test_short_and_nameless_items_are_found(spark, tmp_path):
    long = "What is the capital of the country that lies to the north of this one?"
    rows = [(1, "What is 12 times 12?"), (2, "法国的首都是哪里"), (None, long), (3, "art"), (4, "수도는 어디인가"), (5, "!")]
    rows += [(None, "Art"), (None, "art")]
    texts = ["so what is 12 times 12, then", "请问法国的首都是哪里？谢谢", "x " + long, "a party", "the art of", "what is 12 times 123"]
    texts += ["프랑스의 수도는 어디인가?", "!", None]
    spark.createDataFrame(rows, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, [(i, text, "en", "s") for i, text in enumerate(texts)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = LLM_QUERIES["op10_decontaminate"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, str(r.item_id), r.distance, r.start, r.end) for r in found) == [
        (0, "1", 0, 3, 22), (1, "2", 0, 2, 10), (2, "None", 0, 2, 71), (4, "3", 0, 4, 7), (4, "None", 0, 4, 7),
        (6, "4", 0, 5, 13),
    ]
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {3, 5, 7, 8}
