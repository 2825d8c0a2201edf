"""One query for each operator over its whole table, and the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import audit, decontam, html, langid, lines, lm, near, packing, quality, search, topk, urls, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = urls.canonical(table(spark, folder, "pages").select("page_id", "url"))
    return urls.judge(pages.select("page_id", "host", "path"), URL_RULES)


ORACLES["op8_url_filter"] = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail FROM cut
), url AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(tail, '^[^?#]*') AS path
  FROM parts
), fits AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM url)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM fits
"""


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scanned = decontam.decontaminate(docs, table(spark, folder, "benchmark"), carry=["doc_id"])
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return scanned.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


ORACLES["op6_decontaminate"] = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram, least(13, len(w)) AS size
  FROM item, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i) WHERE len(w) > 0
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), sizes AS (SELECT DISTINCT size FROM win),
spot AS (
  SELECT r, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)
), found AS (SELECT spot.r, spot.i, spot.size, win.item_id FROM spot JOIN win ON spot.size = win.size AND spot.gram = win.gram),
hit AS (SELECT r, count(DISTINCT k) AS n FROM found, unnest(range(i, i + size)) AS t(k) GROUP BY r),
own AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(own.n, 0) AS n_items,
  sha256(coalesce(own.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN own USING (r)
"""


@query
def op2_pack(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


@query
def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_classes(table(spark, folder, "documents").select("doc_id", "text"))


def remainder(modulus: int, id: str = "doc_id"):
    """crc32 of the id as text, by a modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % modulus


def identified(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred and score, learnt from its labelled rows outside the held-out fold."""
    pieces = langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    model = langid.learn(docs.where(remainder(4) != 2), pieces)
    return langid.identify(docs, model, pieces, carry=carry)


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = identified(table(spark, folder, "documents"), ["doc_id"])
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality").where(remainder(3) != 1)
    measured = docs.withColumn("bytes", F.octet_length("text"))
    network = quality.learn(measured.join(labels, "doc_id"), size="bytes")
    scored = quality.score(docs, network, carry=["doc_id"])
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"), carry=["page_id", "url"])


@query
def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


ORACLES["op7_top_k"] = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""


@query
def op10_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"), order=3)


ORACLES["op10_lm_score"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), word AS (
  SELECT r, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS v, CASE WHEN i > 2 THEN w[i - 2] END AS u FROM doc, unnest(range(1, len(w) + 1)) AS t(i)
), one AS (SELECT w, count(*) AS c FROM word GROUP BY w),
two AS (SELECT v, w, count(*) AS c FROM word WHERE v IS NOT NULL GROUP BY v, w),
three AS (SELECT u, v, w, count(*) AS c FROM word WHERE u IS NOT NULL GROUP BY u, v, w),
total AS (SELECT count(*) AS c FROM word),
-- Every run of a text has a count of one at least, so its longest run decides; the scan of all counts leaves no word to back off.
parted AS (
  SELECT word.r,
    CASE WHEN word.v IS NULL THEN own1.c WHEN word.u IS NULL THEN own2.c ELSE own3.c END AS above,
    CASE WHEN word.v IS NULL THEN total.c WHEN word.u IS NULL THEN before1.c ELSE before2.c END AS below
  FROM word JOIN one own1 ON own1.w = word.w
    LEFT JOIN two own2 ON own2.v = word.v AND own2.w = word.w
    LEFT JOIN three own3 ON own3.u = word.u AND own3.v = word.v AND own3.w = word.w
    LEFT JOIN one before1 ON before1.w = word.v
    LEFT JOIN two before2 ON before2.v = word.u AND before2.w = word.v, total
), summed AS (
  SELECT r, CAST(sum(CAST(round_even(1e6 * ln(above), 0) AS BIGINT) - CAST(round_even(1e6 * ln(below), 0) AS BIGINT)) AS BIGINT) AS s FROM parted GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(s, 0) AS log_score, CASE WHEN len(w) > 0 THEN s / 1000000.0::DOUBLE / len(w) END AS score
FROM doc LEFT JOIN summed USING (r)
"""


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return audit.audit(docs, table(spark, folder, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH mark AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), test AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
     'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
     'D': regexp_matches(t, '[#$%&*|]'),
     'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS f
  FROM doc LEFT JOIN mark USING (doc_id)
), cell AS (
  SELECT part, good, toxic, concat(CASE WHEN f.A THEN 'A' END, CASE WHEN f.B THEN 'B' END, CASE WHEN f.C THEN 'C' END,
    CASE WHEN f.D THEN 'D' END, CASE WHEN f.E THEN 'E' END) AS fails, count(*) AS n
  FROM test GROUP BY ALL
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), step AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[1:step - 1] AS before, filter_order[step] AS own FROM orders, unnest(range(1, 6)) AS t(step)
), judged AS (
  SELECT part, filter_order, step, own, good, toxic, n, fails, contains(fails, own) AS fail,
    len([x for x in string_split(before, '') if x <> '' AND contains(fails, x)]) > 0 AS gone
  FROM cell, step
), summed AS (
  SELECT part, filter_order, step, own,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND fail), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND fail), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (fails = own), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (NOT gone AND fail AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (NOT gone AND fail AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return search.search(docs, table(spark, folder, "benchmark"))


ORACLES["op12_lexical_search"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL
), total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM doc WHERE len(w) > 0),
item AS (
  SELECT i, item_id, unnest(list_distinct(w)) AS t FROM (
    SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL)
), tf AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM doc) WHERE t IN (SELECT t FROM item) GROUP BY r, t
), weight AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY t
), scored AS (
  SELECT i, item_id, doc_id, r, CAST(sum(weight.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(doc.w) * docs) // terms)))) AS BIGINT) AS score
  FROM item JOIN tf USING (t) JOIN weight USING (t) JOIN doc USING (r), total GROUP BY i, item_id, doc_id, r
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""


@query
def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages")).drop("record_id")


ORACLES["op13_warc"] = """
WITH page AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
hashed AS (SELECT *, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS first FROM page),
-- 20 bits of the digest are five hexadecimal digits and four letters
letters AS (
  SELECT *, [CAST('0x' || h[5 * k + 1:5 * k + 5] AS INTEGER) for k in range(8)] AS chunks FROM hashed
)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
  array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((c >> s) & 31) + 1, 1) for s in [15, 10, 5, 0]], '') for c in chunks], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM letters
"""
