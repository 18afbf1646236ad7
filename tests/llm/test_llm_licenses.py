"""License scans, against places found word by word and passages edited by hand."""

from __future__ import annotations

import random
import re

import pytest

from llm_plain import LOWER
from subtide.llm import licenses

DOCS = "doc_id long, text string, key int, label string, words int, place int"
PHRASES = {label: phrase.split() for label, phrase in licenses.BASE_PHRASES}


def documents(spark, rows):
    """Documents with further columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], DOCS)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_base(text):
    """(n_words, n_base, first_word, last_word, base_labels) by looking at every word."""
    words = words_of(text)
    places = [
        (i, label) for label, phrase in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase)] == phrase
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def scanned(spark, rows):
    return licenses.scan(documents(spark, rows), licenses.known_licenses(spark)).collect()


def test_places_equal_a_word_by_word_search(spark):
    dice = random.Random(4)
    some = "gnu general public license apache cc by mit nc the a 4 0 été x".split()
    rows = []
    for i in range(300):
        words = dice.choices(some, k=dice.randint(0, 60))
        rows.append((i, "".join(w.upper() + dice.choice([" ", "-", ".\n", "\t", "\x00", "_"]) for w in words)))
    rows += rows[:20] + [(None, rows[0][1]), (None, None), (5, None), (6, ""), (6, "... ---"), (7, "mit"), (8, "mit license")]
    rows += [(9, "mit license " * 5000), (10, "gnu general public " * 3000 + "license")]
    found = scanned(spark, rows)
    got = sorted(map(repr, [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found]))
    assert got == sorted(map(repr, [(key, *plain_base(text)) for key, text in rows]))
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
        assert r.score == 1 if r.n_base else True


def test_an_empty_table(spark):
    assert scanned(spark, []) == []


@pytest.mark.parametrize("label, text", [t for t in licenses.NOTICES if len(t[1].split()) >= 20])
def test_edited_notices(spark, label, text):
    """A word more, a word less and another word in the middle of a passage; half a passage is none."""
    words = text.split()
    at = len(words) // 2
    edited = {
        1: words[:at] + ["oddly"] + words[at:],
        2: words[:at] + words[at + 1 :],
        3: words[:1] + words[2:],
        4: words[: len(words) // 2],
        5: list(reversed(words)),
    }
    rows = [(key, "Some words before. " + " ".join(w) + " and after") for key, w in edited.items()]
    found = {r.doc_id: r for r in scanned(spark, rows)}
    for key in (1, 2, 3):
        assert label in found[key].labels.split(",") and licenses.SHARE <= found[key].score <= 1
        assert found[key].n_base == plain_base(rows[key - 1][1])[1]
    assert found[4].score in (0, 1) and found[5].labels == ""


def test_spans(spark):
    templates = spark.createDataFrame(
        [("a", "one two three four five six seven eight nine ten", False), ("b", "", True), ("c", "Two THREE", True)],
        licenses.TEMPLATE,
    )
    text = "x one two three four five six extra seven eight nine ten y " + "pad " * 30 + "one two three four five six seven eight nine ten"
    found = licenses.spans(documents(spark, [(1, text), (2, text)]), templates, gram=3).collect()
    spans = sorted((r.label, r.first, r.last, r.whole, round(r.share, 3)) for r in found)
    assert spans == [("a", 1, 11, False, 1.0), ("a", 43, 52, True, 1.0), ("c", 2, 3, True, 1.0), ("c", 44, 45, True, 1.0)]
    nothing = spark.createDataFrame([], licenses.TEMPLATE)
    assert [r.labels for r in licenses.scan(documents(spark, [(1, text)]), nothing).collect()] == [""]


def test_many_templates_are_shuffled(spark, monkeypatch):
    rows = [(1, "under the MIT License"), (2, "nothing"), (3, "Apache License, and CC BY-NC 4.0")]
    sent = scanned(spark, rows)
    monkeypatch.setattr(licenses, "BROADCAST_BYTES", -1)
    assert sorted(scanned(spark, rows)) == sorted(sent)
    assert [r.labels for r in sorted(sent)] == ["mit", "", "apache,cc-by,cc-by-nc"]
