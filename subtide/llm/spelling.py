"""Spelling variants of a vocabulary: neighbours at one edit, found by the frontier of a trie.

The trie is a table of edges. Each word is a path of code points; nodes where paths part or a word ends
are kept, and the code points between two kept nodes are the label of one edge (a radix trie). A state is
(word, rest of the word from its position on, node, edits). Level by level the states join the edges of
their nodes: a state without edits takes every edge of its node, whose label may hold the one edit; a
state with one edit takes the only edge that goes on with its rest. States that end with one edit at the
end of a word are neighbours.

An edit near the root would open most of the trie. A word and its neighbour agree on the first half of
the word or on its last half, so each word walks two tries, of words and of reversed words, and is
free to differ only beyond its half. States start at the word's own node there. Words of one length
are found from the smaller one, words of different lengths from the longer one.

Scale: words are counted map-side before the first shuffle, so a word's frequency does not matter; the
vocabulary is a written table. Edges are one row per node and code point, so a node has no more edges than
there are code points, however many words pass it, and no task holds the words of a node. A state
looks one code point ahead (the edge tells what may follow) before it is kept. Levels are written
tables; there are as many as the longest path has branchings. Joins on a hot node are split by adaptive
execution, as both sides are stored rows. Nodes are 64-bit hashes; a found pair is checked on its words.

Defined cases: NULL and empty texts have no words. The typo rule takes a NULL ``doc_id`` as an empty text;
repeated rows count as often as they occur. A vocabulary without words gives no row, a word without near words has
form NULL and itself as root. Equal counts: the smaller word in code-point order is the form. Extra
columns are ignored. Long words cost the square of their length once (their prefixes are hashed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from subtide.llm.common import lower_ascii
from subtide.sources import written

# Fixed value: the runs of letters that are words.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_CHARS = 6
MIN_COUNT = 5


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """Rows of (doc_id, run): the runs of letters of at least ``least`` code points, A-Z lower-cased."""
    found = F.regexp_extract_all("text", F.lit(RUN if least <= 1 else f"{RUN[:-1]}{{{least},}}"), F.lit(0))
    # The outer form: for the other Spark filters by the size of the array first, and computes it twice.
    rows = docs.select("doc_id", F.explode_outer(found).alias("run")).filter("run IS NOT NULL")
    return rows.select("doc_id", lower_ascii("run").alias("run"))


def with_typos(rows: DataFrame, every: int = 199) -> DataFrame:
    """Rows of (word): a run loses a code point where ``every`` divides the checksum of its id and itself."""
    tag = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = F.crc32(tag.cast("binary"))
    at = F.pmod(hashed, F.char_length("run").cast("long")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    return rows.select(F.when(hashed % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, chars: int = MIN_CHARS, count: int = MIN_COUNT) -> DataFrame:
    """Rows of (word, n) of the words of at least ``chars`` code points that occur ``count`` times or more.

    The search for near words needs words of three code points at least.
    """
    if chars < 3:
        raise ValueError("words need three code points at least")
    counted = words.filter(F.char_length("word") >= chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= count)


# --- the trie -------------------------------------------------------------------------------------


def _node(way: Column, prefix: Column) -> Column:
    return F.xxhash64(way, prefix)


def _from(text: str | Column, place: Column) -> Column:
    """The text from a place on, counted from 0."""
    text = F.col(text) if isinstance(text, str) else text
    return text.substr(place + 1, F.char_length(text))


def _first(text: str | Column) -> Column:
    """The number of the first code point, 0 at the end."""
    return F.ascii(text)


def _mark(point: Column) -> Column:
    """A code point's number as one bit; the end of a word is number 0."""
    bit = F.when(point == 0, 62).otherwise(F.pmod(point, F.lit(62)))
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _paths(vocabulary: DataFrame) -> DataFrame:
    """Rows of (word_id, way, path, half): each word forwards (way 0) and reversed (way 1)."""
    chars = F.char_length("word")
    half = (chars / 2).cast("int")
    ways = F.array(
        F.struct(F.lit(0).alias("way"), F.col("word").alias("path"), half.alias("half")),
        F.struct(F.lit(1).alias("way"), F.reverse("word").alias("path"), (chars - half).alias("half")),
    )
    rows = vocabulary.select(F.xxhash64("word").alias("word_id"), F.explode(ways).alias("p"))
    return rows.select("word_id", "p.*")


def _edges(paths: DataFrame) -> DataFrame:
    """Rows of (node, first, label, child, ends, follows), one per edge of the kept part of the tries.

    ``ends`` is the word that ends at the child, if any; ``follows`` has a bit for each code point that goes on from
    there. The part above every word's half is not needed.
    """
    chars = F.char_length("path")
    # A neighbour may be one code point shorter than the word whose half is the start.
    depths = F.explode(F.sequence(((chars - 1) / 2).cast("int"), chars))
    prefixes = paths.withColumn("depth", depths).select(
        "word_id",
        "way",
        "depth",
        _node(F.col("way"), F.col("path").substr(F.lit(1), F.col("depth"))).alias("node"),
        _first(_from("path", F.col("depth"))).alias("next"),
        (F.col("depth") == F.col("half")).alias("start"),
        chars.alias("chars"),
    )
    kept = prefixes.groupBy("node").agg(
        F.min("next").alias("low"),
        F.max("next").alias("high"),
        F.max("start").alias("start"),
        F.bit_or(_mark(F.col("next"))).alias("follows"),
        F.max(F.when(F.col("next") == 0, F.col("word_id"))).alias("ends"),
        # The word that gives the edge to this node: a shortest one, whose half is the nearest to the root.
        F.min_by("word_id", "chars").alias("giver"),
    )
    kept = written(kept.filter("low <> high OR low = 0 OR start").drop("low", "high", "start"))
    nodes = prefixes.select("word_id", "way", "depth", "node").join(kept, "node")
    step = F.struct("depth", "node", "follows", "ends", (F.col("giver") == F.col("word_id")).alias("gives"))
    steps = nodes.groupBy("word_id", "way").agg(F.sort_array(F.collect_list(step)).alias("s"))
    pairs = F.arrays_zip(F.slice("s", 1, F.size("s") - 1).alias("a"), F.slice("s", F.lit(2), F.size("s")).alias("b"))
    given = F.filter(pairs, lambda p: p["b"]["gives"])
    rows = paths.join(steps, ["word_id", "way"]).select("path", F.explode(given).alias("p"))
    label = F.col("path").substr(F.col("p.a.depth") + 1, F.col("p.b.depth") - F.col("p.a.depth"))
    return rows.select(
        F.col("p.a.node").alias("node"),
        _first(label).alias("first"),
        label.alias("label"),
        F.col("p.b.node").alias("child"),
        F.col("p.b.ends").alias("ends"),
        F.col("p.b.follows").alias("follows"),
    )


# --- the frontier ---------------------------------------------------------------------------------

STATE = ["word_id", "rest", "node", "edits", "found"]


def _ahead(rest: Column, follows: Column) -> Column:
    """Can a state go on: does its next code point, or its end, follow?"""
    return follows.bitwiseAND(_mark(_first(rest))) != 0


def _stepped(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: the states after one more edge; ``found`` is the neighbour of a state that ends there."""
    size = F.char_length("label")
    # With one edit: the rest has to go on with the whole label.
    exact = frontier.filter("edits = 1 AND rest <> ''").withColumn("first", _first("rest"))
    exact = exact.join(edges, ["node", "first"]).filter(F.col("rest").startswith(F.col("label")))
    exact = exact.select("word_id", _from("rest", size).alias("to"), F.lit(1).alias("after"), "child", "ends", "follows")

    # Without: the own label, or one that needs a replaced or a deleted code point.
    free = frontier.filter("edits = 0 AND rest <> ''").drop("found").join(edges, "node")
    same = F.col("rest").substr(F.lit(1), size)
    longer = F.col("rest").substr(F.lit(1), size + 1)
    options = F.array(
        F.when(same == F.col("label"), F.struct(_from("rest", size).alias("to"), F.lit(0).alias("after"))),
        F.when(
            (same < F.col("label")) & (F.levenshtein(same, "label", 1) == 1) & (F.char_length(same) == size),
            F.struct(_from("rest", size).alias("to"), F.lit(1).alias("after")),
        ),
        F.when(
            (F.char_length(longer) == size + 1) & (F.levenshtein(longer, "label", 1) == 1),
            F.struct(_from("rest", size + 1).alias("to"), F.lit(1).alias("after")),
        ),
    )
    free = free.withColumn("o", F.explode(F.array_compact(options)))
    free = free.select("word_id", "o.to", "o.after", "child", "ends", "follows")

    rest, after, ends = F.col("to"), F.col("after"), F.col("ends")
    # The end of a word: nothing is left after an edit, or one code point, to be deleted, before any.
    met = ((after == 1) & (rest == "")) | ((after == 0) & (F.char_length(rest) == 1))
    steps = exact.unionByName(free).withColumn("found", F.when(met, ends))
    goes_on = (rest != "") & ((after == 0) | _ahead(rest, F.col("follows")))
    steps = steps.withColumn("goes_on", goes_on).filter("goes_on OR found IS NOT NULL")
    return steps.select(
        "word_id",
        F.when(F.col("goes_on"), rest).otherwise("").alias("rest"),
        F.col("child").alias("node"),
        F.col("after").alias("edits"),
        "found",
    )


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Rows of (word, near, near_n), both ways: the words of a vocabulary (word, n) one edit apart."""
    paths = written(_paths(vocabulary))
    edges = written(_edges(paths))
    start = _node(F.col("way"), F.col("path").substr(F.lit(1), F.col("half")))
    frontier = paths.select(
        "word_id",
        _from("path", F.col("half")).alias("rest"),
        start.alias("node"),
        F.lit(0).alias("edits"),
        F.lit(None).cast("long").alias("found"),
    )
    links = None
    while True:
        frontier = written(_stepped(frontier, edges))
        new = frontier.filter("found IS NOT NULL").select("word_id", F.col("found").alias("near_id"))
        links = new if links is None else links.unionAll(new)
        if frontier.filter("rest <> ''").isEmpty():
            break
    named = vocabulary.select(F.xxhash64("word").alias("word_id"), "word", "n")
    pairs = links.distinct().join(named, "word_id")
    other = named.select(F.col("word_id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = pairs.join(other, "near_id").filter(F.levenshtein("word", "near", 1) == 1)
    pairs = written(pairs.select("word", "n", "near", "near_n"))
    return pairs.select("word", "near", "near_n").unionAll(
        pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """Rows of (word, root) for rows of (word, form): the last form, reached by doubling steps.

    Each form occurs more often than its word, so there is no circle.
    """
    steps = written(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(further, "root", "left")
        moved = written(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return steps


def variants(vocabulary: DataFrame, ratio: int = 5) -> DataFrame:
    """Rows of (word, n, n_near, form, form_n, root) for the words of a written vocabulary (word, n).

    The form is the most frequent near word if it occurs at least ``ratio`` times as often.
    """
    largest = F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))
    near = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), F.min(largest).alias("f"))
    rows = vocabulary.join(near, "word", "left")
    often = -F.col("f.minus") >= ratio * F.col("n")
    rows = written(
        rows.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("f.form")).alias("form"),
            F.when(often, -F.col("f.minus")).alias("form_n"),
        )
    )
    last = roots(rows.filter("form IS NOT NULL"))
    return rows.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants_of(docs: DataFrame) -> DataFrame:
    """The spelling variants among the words of documents, after the typo rule."""
    # A run one code point shorter than a word cannot give one, with or without a typo.
    words = with_typos(runs(docs, MIN_CHARS))
    return variants(written(vocabulary(words)))
