"""The training-data queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from subtide.llm import (
    chat,
    decontaminate,
    html,
    jaccard,
    langid,
    licenses,
    mixing,
    negatives,
    packing,
    spelling,
    topk,
    urls,
    warc,
)
from subtide.llm.common import ready, table

def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(ready(spark), folder, "documents")
    mixed = mixing.mix(docs, mixing.WEIGHTS, share=1.0, max_epochs=3, seed=mixing.SEED)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, md5('{mixing.SEED}:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS hash,
         CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, source_size * 3 AS cap,
         [5, 2, 1][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sources),
levels AS (
  SELECT *, (SUM(source_size) OVER () * 1.0::DOUBLE - COALESCE(SUM(cap) OVER (
               ORDER BY cap / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (SUM(weight) OVER (ORDER BY cap / weight, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighted),
targets AS (
  SELECT source, source_size,
         LEAST(cap::DOUBLE, (MAX(level) OVER ()) * weight::DOUBLE) AS target
  FROM levels),
plans AS (
  SELECT *, COALESCE(FLOOR(CASE WHEN source_size > 0 THEN target / source_size::DOUBLE END), 0)::BIGINT AS whole
  FROM targets),
placed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         p.target - (p.whole * p.source_size)::DOUBLE AS rest,
         COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.hash, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + d.size / 2 AS middle
  FROM sized d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN middle <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(ready(spark), folder, "documents")
    return jaccard.jaccard_components(docs, size=4, similar=(85, 100))


OP2_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 4 THEN list_filter([array_to_string(w, ' ')], lambda x: x <> '')
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2),
           lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s
  FROM split),
named AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(array_to_string(s, chr(10))) END AS k, s FROM sets),
classes AS MATERIALIZED (
  SELECT k, ANY_VALUE(n) AS n, ANY_VALUE(s) AS s, MIN(doc_id) AS least FROM named WHERE k IS NOT NULL GROUP BY k),
held AS MATERIALIZED (SELECT k, n, UNNEST(s) AS shingle FROM classes),
links AS MATERIALIZED (
  SELECT a.k AS a, b.k AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * COUNT(*) >= 85 * (a.n + b.n - COUNT(*))),
reached AS (
  SELECT k AS a, k AS b FROM classes
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
roots AS (SELECT r.a AS k, MIN(c.least) AS root FROM reached r JOIN classes c ON r.b = c.k GROUP BY r.a)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n AS BIGINT) AS n_shingles,
       CAST(COALESCE(root, doc_id) AS BIGINT) AS component_id
FROM named LEFT JOIN roots USING (k)
"""


def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(ready(spark), folder, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


OP3_SQL = """
WITH doubles AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
whole AS (
  SELECT vec_id, list_transform(x, lambda c: floor(256 * c)) AS v FROM doubles
  WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
asked AS (SELECT vec_id, MIN(v) AS v FROM whole WHERE vec_id % 50 = 0 GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM asked q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(ready(spark), folder, "pages"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(ready(spark), folder, "pages")
    index = warc.write_bundles(warc.with_revisits(pages))
    return warc.read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP5_SQL = """
WITH whole AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, CAST(octet_length(encode(COALESCE(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(COALESCE(html, '')) AS payload_digest
  FROM pages),
last AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
            THEN MAX(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS last
  FROM whole)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NULL OR last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS NOT DISTINCT FROM page_id THEN NULL ELSE last END AS refers_to
FROM last
"""

# Host, path and verdict of the rules that the URL query applies.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(ready(spark), folder, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(pages, urls.build(rules), default="allow")


OP6_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
parsed AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0
                  THEN substr(url, position('://' IN url) + 3) END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(COALESCE(regexp_extract(rest, '^[^/?#]*', 0), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         COALESCE(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parsed),
fits AS (
  SELECT s.page_id, r.host || r.path AS rule, r.verdict,
         ROW_NUMBER() OVER (PARTITION BY s.page_id
           ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS place
  FROM split s JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path))
SELECT s.page_id, s.host, s.path, f.rule, COALESCE(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON s.page_id = f.page_id AND f.place = 1
"""


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(ready(spark), folder, "conversations")
    turns = turns.select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    formatted = chat.format_conversations(turns.unionByName(tricky), trained="assistant")
    read = formatted.withColumn("_turns", chat.read_turns("formatted"))
    said = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.withColumn("_loss", chat.loss_text("segments")).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(ready(spark), folder, "documents")
    return langid.identify(docs, langid.train(docs, ~langid.held_out()))


def op9_pack_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_matrices(table(ready(spark), folder, "documents"), packing.RANKS)


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(ready(spark), folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.matches(docs, items, short=True)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.variants_of(table(ready(spark), folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


# CRC-32 byte by byte from its table; near words share a pattern with one code point left open or out.
OP11_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
           list_prepend(CAST(b AS BIGINT), list_transform(range(8), lambda i: CAST(0 AS BIGINT))),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
raw AS (
  SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]{6,}')) AS run
  FROM documents),
cased AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, COUNT(*) AS times
  FROM raw GROUP BY 1, 2),
summed AS (
  SELECT run, times, xor(list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT),
             list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'),
                            lambda h: CAST('0x' || h AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM cased, crc_table),
typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, times
  FROM summed),
words AS (
  SELECT word, CAST(SUM(times) AS BIGINT) AS n FROM typed WHERE length(word) >= 6
  GROUP BY word HAVING SUM(times) >= 5),
cuts AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
patterns AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM cuts),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n
  FROM patterns a JOIN patterns b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM patterns a JOIN words b ON a.head || a.tail = b.word
  UNION SELECT b.word, a.word, a.n FROM patterns a JOIN words b ON a.head || a.tail = b.word),
ranked AS (
  SELECT *, COUNT(*) OVER (PARTITION BY word) AS n_near,
         ROW_NUMBER() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place
  FROM pairs),
formed AS (
  SELECT w.word, w.n, COALESCE(r.n_near, 0) AS n_near,
         CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form,
         CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1),
chains AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chains c ON c.word = f.word JOIN formed e ON e.word = c.at AND e.form IS NULL
"""


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(ready(spark), folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH doubles AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
         CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL),
whole AS (
  SELECT DISTINCT vec_id, label, list_transform(x, lambda c: floor(256 * c)) AS v FROM doubles
  WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS own, c.vec_id,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE own
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
found AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.own
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM found WHERE rank <= 3
"""


def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(ready(spark), folder, "documents")
    return licenses.scan(docs, licenses.known_licenses(spark))


_TEMPLATES = [(*r, True) for r in licenses.BASE_PHRASES] + [(*r, False) for r in licenses.NOTICES]
_SIZES = sorted({min(len(text.split()), licenses.GRAM) for _, text, _ in _TEMPLATES})


def _gram_rows(size: int) -> str:
    """Rolling grams of one size: a word and those that follow it."""
    follow = [f"LEAD(word, {i}) OVER o" for i in range(1, size)]
    return (
        f"SELECT id, place, {size} AS size, {' || chr(32) || '.join(['word', *follow])} AS gram "
        "FROM placed WINDOW o AS (PARTITION BY id ORDER BY place)"
    )


OP13_SQL = f"""
WITH templates AS MATERIALIZED (
  SELECT row_number() OVER () AS template, label, base, string_split(phrase, ' ') AS words,
         LEAST(len(words), {licenses.GRAM}) AS size
  FROM (VALUES {", ".join(map(str, _TEMPLATES))}) v(label, phrase, base)),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
placed AS (
  SELECT row AS id, unnest(words) AS word, unnest(range(len(words))) AS place FROM docs
  UNION ALL SELECT -template, unnest(words), unnest(range(len(words))) FROM templates),
grams AS ({" UNION ALL ".join(map(_gram_rows, _SIZES))}),
votes AS (
  SELECT g.id AS row, t.template, g.place - k.place AS diagonal, list(k.place) AS ats
  FROM grams g JOIN grams k ON g.id > 0 AND k.id < 0 AND g.gram = k.gram
  JOIN templates t ON t.template = -k.id AND t.size = k.size AND t.size = g.size GROUP BY ALL),
merged AS (
  SELECT v.row, t.template, diagonal, label, base, len(t.words) AS n, len(ats) = len(t.words) - size + 1 AS whole,
         len(list_distinct(flatten(list_transform(flatten(list(ats) OVER w), lambda a: range(a, a + size))))) AS covered
  FROM votes v JOIN templates t ON v.template = t.template
  WINDOW w AS (PARTITION BY v.row, t.template ORDER BY diagonal
    RANGE BETWEEN {licenses.SHIFT} PRECEDING AND {licenses.SHIFT} FOLLOWING)),
marked AS (
  SELECT *, CASE WHEN whole THEN 1.0::DOUBLE ELSE covered::DOUBLE / n::DOUBLE END AS share,
         MAX(covered) OVER w = covered AS top
  FROM merged
  WINDOW w AS (PARTITION BY row, template ORDER BY diagonal
    RANGE BETWEEN {licenses.SHIFT} PRECEDING AND {licenses.SHIFT} FOLLOWING)),
found AS (
  SELECT row, COUNT(*) FILTER (WHERE base AND whole) AS n_base,
         CAST(MIN(diagonal) FILTER (WHERE base AND whole) AS BIGINT) AS first_word,
         CAST(MAX(diagonal) FILTER (WHERE base AND whole) AS BIGINT) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base AND whole)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, MAX(share) AS score
  FROM marked WHERE whole OR (top AND share >= {licenses.SHARE}::DOUBLE) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word,
       COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels, COALESCE(score, 0.0::DOUBLE) AS score
FROM docs LEFT JOIN found USING (row)
"""


CONTROL_TEXT = "\\### Assistant: </turn> ok"

OP7_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'),
marked AS (
  SELECT *, COALESCE(LAG(role) OVER w = role, FALSE) AS merged,
         length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) AS role_chars,
         length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS text_chars
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
              FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(text_chars + CASE WHEN merged THEN 8
                             ELSE role_chars + length('<|turn|><|say|><|end|>') + 1 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_html_text": op4_html_text,
    "op5_warc": op5_warc,
    "op6_url_filter": op6_url_filter,
    "op7_chat_format": op7_chat_format,
    "op8_language_id": op8_language_id,
    "op9_pack_tokens": op9_pack_tokens,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_license_scan": op13_license_scan,
}

LLM_ORACLES: dict[str, str] = {
    "op1_mix_sources": OP1_SQL,
    "op2_jaccard_join": OP2_SQL,
    "op3_exact_top_k": OP3_SQL,
    "op5_warc": OP5_SQL,
    "op6_url_filter": OP6_SQL,
    "op7_chat_format": OP7_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_license_scan": OP13_SQL,
}
