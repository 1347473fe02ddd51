"""One query per operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

import importlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from mergewell.llm import (
    bpe, chat, divergence, html_text, merkle, mixing, near, negatives, neighbours, quality, spans, toxicity, warc)
from mergewell.llm.rows import ship
from mergewell.llm.scratch import Scratch

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn=None, *, sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register if fn is None else register(fn)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query
def op1_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_text.extract_text(pages, html_text.fit_labeller(pages)).drop("html")


@query
def op2_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query(sql=r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS BIGINT) AS weight
  FROM d GROUP BY source),
o AS (  -- sources that reach three times their size first
  SELECT *, sum(3 * source_size) OVER up - 3 * source_size AS taken, sum(weight) OVER down AS free
  FROM s WINDOW up AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING),
    down AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (  -- the first level that is not above the next source's limit
  SELECT CAST((SELECT sum(source_size) FROM s) - taken AS DOUBLE) / CAST(free AS DOUBLE) AS level FROM o
  WHERE ((SELECT sum(source_size) FROM s) - taken) * weight <= 3 * source_size * free
  ORDER BY 3.0 * source_size / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * level) AS target,
    CASE WHEN source_size > 0 THEN least(CAST(3 * source_size AS DOUBLE), weight * level) / source_size ELSE 1.0 END AS rate
  FROM s, l),
m AS (
  SELECT doc_id, size, source_size, target, rate,
    CAST(CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM m""")
def op3_mixing(spark, sf_dir):
    sized = Scratch(spark).write(table(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        "doc_id", "source", mixing.size_in_words(F.col("text")).alias("size")), "sizes")
    return mixing.mix(sized, size=F.col("size")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op4_bpe(spark, sf_dir):
    return bpe.encode_decode(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("text")


@query(sql=r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, true AS intact
FROM p LEFT JOIN f USING (payload_digest)""")
def op5_warc(spark, sf_dir):
    scratch = Scratch(spark)
    folder = scratch.path("archives")
    pages = warc.payloads(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    manifest = warc.write_archives(pages, folder, scratch)
    return warc.read_archives(manifest, folder).drop("url")


@query
def op6_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit_severity(documents, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score_severity(documents, model).drop("text")


@query(sql=r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text,
    '\', '\5c;'), '<s>', '\3c;s>'), '</s>', '\3c;/s>'), '[INST]', '\5b;INST]'), '[/INST]', '\5b;/INST]'),
    '<<SYS>>', '\3c;<SYS>>'), '<</SYS>>', '\3c;</SYS>>'), '[ROLE]', '\5b;ROLE]'), '[/ROLE]', '\5b;/ROLE]'),
    '[:]', '\5b;:]') AS escaped,
    lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end
  FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(escaped) + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
    ELSE 20 + length(role) END) AS BIGINT) AS formatted_chars,
  bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'),
    ('user', 'assistant'), ('assistant', 'user')))
    AND bool_or(from_end = 1 AND role IN ('user', 'assistant')) AS valid
FROM e GROUP BY conv_id""")
def op7_chat(spark, sf_dir):
    extra = spark.sql("""
        SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(rows))


@query
def op8_near_duplicates(spark, sf_dir):
    return near.components(table(spark, sf_dir, "documents", "doc_id", "text")).drop("version")


@query
def op9_substring_dedup(spark, sf_dir):
    return spans.dedup_spans(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op10_quality(spark, sf_dir):
    return quality.quality_rules(
        table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"), drop_text=True).select(
        "doc_id", *quality.STATISTICS, "base_failed", "kept")


@query(sql=r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
t AS (
  SELECT r, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT f.lang, source, term, n,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (f.total + 2 * v) AS BIGINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (lang_n + 2) // (l.total + 2 * v) AS BIGINT) AS q
  FROM f JOIN l USING (lang)),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM r)
WHERE part = 'pair' OR rank <= 10""")
def op11_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents", "lang", "source", "text"))


@query(sql=r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars,
    coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS following
  FROM documents WINDOW o AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, left(text, n_chars - n_chars // 4) || left(following, n_chars // 4) AS edited FROM d),
w AS (
  SELECT doc_id, 'own' AS kind, text AS t FROM e UNION ALL SELECT doc_id, 'edited', edited FROM e
  UNION ALL SELECT doc_id, 'next', following FROM e),
p AS (
  SELECT doc_id, kind, regexp_extract_all(t, '[^\n]*\n+|[^\n]+') AS paragraphs,
    list_distinct(regexp_extract_all(t,
      '(?:[^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?][\x20\x09\x0B-\x0D]+){0,5}[^\x20\x09-\x0D]+')) AS phrases
  FROM w),
h AS (SELECT *, list_transform(paragraphs, lambda x: sha256(x)) AS leaves FROM p),
n AS (
  SELECT *, list_filter(range(1, len(leaves) + 1),
    lambda i: i = len(leaves) OR leaves[i][1] IN ('0', '1', '2', '3')) AS ends FROM h),
s AS (
  SELECT *, sha256(array_to_string(list_transform(range(1, len(ends) + 1), lambda k:
    sha256(array_to_string(leaves[CASE WHEN k = 1 THEN 1 ELSE ends[k - 1] + 1 END:ends[k]], ''))), '')) AS root FROM n),
x AS (
  SELECT o.doc_id, o.root AS a, e.root AS b, c.root AS c,
    len(o.phrases) + len(e.phrases) AS all_b, len(list_intersect(o.phrases, e.phrases)) AS both_b,
    len(o.phrases) + len(c.phrases) AS all_c, len(list_intersect(o.phrases, c.phrases)) AS both_c,
    o.paragraphs, list_filter(range(1, greatest(len(o.leaves), len(e.leaves)) + 1),
      lambda i: o.leaves[i] IS DISTINCT FROM e.leaves[i])[1] AS place
  FROM s o JOIN s e ON o.doc_id = e.doc_id AND o.kind = 'own' AND e.kind = 'edited'
  JOIN s c ON o.doc_id = c.doc_id AND c.kind = 'next')
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, a AS fingerprint, b AS edited_fingerprint,
  CASE WHEN a = b THEN 1.0 WHEN all_b = 0 THEN 0.0 ELSE CAST(2 AS DOUBLE) * both_b / all_b END AS near_edited,
  CASE WHEN a = c THEN 1.0 WHEN all_c = 0 THEN 0.0 ELSE CAST(2 AS DOUBLE) * both_c / all_c END AS near_next,
  CASE WHEN a <> b THEN CAST(coalesce(list_sum(list_transform(paragraphs[1:place - 1], lambda y: length(y))), 0)
    AS BIGINT) END AS edit_found
FROM e JOIN x USING (doc_id)""")
def op12_fingerprints(spark, sf_dir):
    return merkle.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


@query(sql=r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10""")
def op13_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), label=moved)


@query
def pipeline(spark, sf_dir):
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)
