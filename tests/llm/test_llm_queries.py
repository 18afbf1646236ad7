"""The training-data queries against their SQL, and the rest against plain versions."""

from __future__ import annotations

import sys
import zlib

import duckdb
import pytest
from comparing import differences, duck
from llm_plain import WORD, components, edit_distance_within, normal_words, shingles
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from subtide.llm import decontaminate, mixing, packing
from subtide.llm.queries import LLM_ORACLES, LLM_QUERIES
from subtide.sources import written

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, FOLDER), duck(FOLDER), LLM_ORACLES[name]) == []


def test_registered():
    assert LLM_QUERIES.keys() <= entry.queries().keys()
    numbers = {name.split("_")[0] for name in LLM_QUERIES if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def documents():
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{FOLDER}/documents.parquet'").fetchall()
    return {key: (text, lang) for key, text, lang in rows}


def test_jaccard_query_equals_brute_force(spark):
    sets = {key: shingles(text, 4) for key, (text, _) in documents().items()}
    found = LLM_QUERIES["op2_jaccard_join"](spark, FOLDER).collect()
    assert {r.doc_id: r.n_shingles for r in found} == {k: len(s) for k, s in sets.items()}
    assert {r.doc_id: r.component_id for r in found} == components(sets, 85, 100)


def test_held_out_languages(spark):
    docs = documents()
    found = LLM_QUERIES["op8_language_id"](spark, FOLDER).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id][1] for r in held)
    assert right >= 0.95 * len(held)


def test_html_query_equals_a_pattern(spark):
    """On the driver's pages the article element is the main text."""
    import html
    import re

    rows = duckdb.sql(f"SELECT page_id, html FROM '{FOLDER}/pages.parquet'").fetchall()
    found = {r.page_id: r for r in LLM_QUERIES["op4_html_text"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    for page_id, page in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
        plain = re.sub(r"<(/?)(\w+)[^>]*>", lambda m: "" if m.group(2) == "b" else " ", article)
        assert found[page_id].text == " ".join(html.unescape(plain).split())
        assert found[page_id].n_chars == len(found[page_id].text)


def test_decontamination_query_finds_every_whole_item(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    found = {(r.doc_id, r.item_id): r for r in LLM_QUERIES["op10_decontaminate"](spark, FOLDER).collect()}
    for key, (text, _) in documents().items():
        for item_id, item in items:
            if f" {normal_words(item)} " in f" {normal_words(text)} ":
                assert found[(key, item_id)].distance == 0


def test_decontamination_query_finds_nothing_else(spark):
    """Every row found is an occurrence within the budget, at its place, with its distance."""
    items = dict(duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall())
    texts = {key: decontaminate.normal(text or "") for key, (text, _) in documents().items()}
    found = LLM_QUERIES["op10_decontaminate"](spark, FOLDER).collect()
    assert found and len(found) == len({(r.doc_id, r.item_id) for r in found})
    for r in found:
        item = decontaminate.normal(items[r.item_id])
        assert r.distance <= int(decontaminate.RATE * len(item))
        assert edit_distance_within(item, texts[r.doc_id][r.start : r.end]) == r.distance


def test_packing_query_gives_every_text_back(spark):
    rows = LLM_QUERIES["op9_pack_tokens"](spark, FOLDER).collect()
    texts = unpacked(rows)
    assert texts == {key: text for key, (text, _) in documents().items() if text}


def unpacked(rows) -> dict:
    import numpy as np

    decoder = packing.encoding(packing.read_ranks(packing.RANKS))
    pieces: dict = {}
    for r in rows:
        ids = np.frombuffer(r.input_ids, dtype="<u2")
        positions = np.frombuffer(r.position_ids, dtype="<u2")
        assert len(ids) == len(positions) == packing.LENGTH
        assert (ids[r.cu_seqlens[-1] :] == decoder.n_vocab).all()
        for i, (start, end) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:])):
            assert positions[start:end].tolist() == list(range(end - start))
            pieces.setdefault(r.doc_ids[i], []).append((r.doc_offsets[i], ids[start:end].tolist()))
    out = {}
    for key, found in pieces.items():
        ids = [i for _, piece in sorted(found) for i in piece]
        out[key] = decoder.decode(ids)
    return out


def test_pipeline_stages(spark):
    """Each stage against a plain version, or what it has to keep, on its own input."""
    from test_llm_edges import plain_targets

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, FOLDER))
        kept[name] = (before, docs)
        if name != "pack_tokens":
            assert docs.columns == columns

    def texts(df):
        return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}

    before, after = map(texts, kept["identify_language"])
    assert after == {k: t for k, t in before.items() if t and any(c.isalpha() for c in t)}
    before, after = map(texts, kept["drop_near_duplicates"])
    roots = components({k: shingles(t, 5) for k, t in before.items()}, 80, 100)
    assert set(after) == {k for k in before if roots[k] == k}
    before, after = map(texts, kept["drop_contaminated"])
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    known = decontaminate.Items([(i, decontaminate.normal(t)) for i, t in items], decontaminate.RATE)
    assert set(after) == {k for k, t in before.items() if not known.find(decontaminate.normal(t))}
    assert set(before) - set(after) >= {
        k for k, t in before.items() if any(normal_words(i) in normal_words(t) for _, i in items)
    }
    before, after = kept["mix_sources"]
    counts = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert max(counts.values()) <= 3 and set(counts) <= set(texts(before))
    rows = {r.doc_id: (r.source, len(WORD.findall(r.text))) for r in before.select("doc_id", "source", "text").collect()}
    sizes, taken, most = {}, {}, {}
    for key, (source, size) in rows.items():
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + size * counts.get(key, 0)
        most[source] = max(most.get(source, 0), size)
    for source, target in plain_targets(sizes, mixing.WEIGHTS, 3).items():
        assert abs(taken[source] - target) <= most[source]
    mixed, packed = kept["pack_tokens"]
    segments = packed.select(F.explode(F.arrays_zip("doc_ids", "doc_offsets")).alias("s"))
    starts = segments.filter("s.doc_offsets = 0").groupBy("s.doc_ids").count()
    assert {r[0]: r[1] for r in starts.collect()} == counts


def test_the_library_does_not_import_this_part():
    from pathlib import Path

    root = Path(entry.__file__).parent
    rest = [p for p in (root / "subtide").rglob("*.py") if "llm" not in p.parts]
    assert not [p for p in rest if "subtide.llm" in p.read_text()]
    assert "corpus_pipeline" in sys.modules
