"""Queries of this folder's operators over the given tables, with SQL twins where SQL can say them."""

import corpus_pipeline
from pyspark.sql import functions as F

from quarry.catalog.base import Catalog, table
from quarry.llm import (
    decontamination, embedding_whitening, fill_in_middle, jaccard_join, language_id, main_text, near_duplicates, neighbours, secret_scan, sentence_pieces,
    sharding, warc, weak_quality,
)
from quarry.llm.common import new_folder

CATALOG = Catalog()

SHARDS = 32
SLOTS = sharding.next_prime(sharding.SLOTS_PER_SHARD * SHARDS)


def llm_queries():
    return CATALOG.entries


@CATALOG.add(
    "op1_sharding",
    f"""
WITH RECURSIVE names AS (SELECT i, md5('shard-' || i) AS h FROM range({SHARDS}) t(i)),
steps AS (
  SELECT i, ('0x' || substr(h, 1, 15))::BIGINT % {SLOTS} AS place,
    ('0x' || substr(h, 16, 15))::BIGINT % {SLOTS - 1} + 1 AS skip FROM names),
turns AS (SELECT i, place, skip, (SELECT min(k) FROM range({SLOTS}) r(k) WHERE k * skip % {SLOTS} = 1) AS inverse FROM steps),
fill(turn, slot, free) AS (
  SELECT -1::BIGINT, -1::BIGINT, range({SLOTS})
  UNION ALL
  SELECT turn, slot, list_filter(free, lambda s: s <> slot) FROM (
    SELECT fill.turn + 1 AS turn, free,
      (place + list_min(list_transform(free, lambda s: (s - place + {SLOTS}) * inverse % {SLOTS})) * skip) % {SLOTS} AS slot
    FROM fill JOIN turns ON turns.i = (fill.turn + 1) % {SHARDS} WHERE fill.turn + 1 < {SLOTS}))
SELECT doc_id, (turn % {SHARDS})::INTEGER AS shard
FROM documents JOIN fill ON slot = ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS}
""",
)
def _(spark, folder):
    return sharding.assign_shards(table(spark, folder, "documents").select("doc_id"), "doc_id", SHARDS)


BASE32 = (
    "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + "
    "((('0x' || substr(sha1(coalesce(html, '')), 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1)), '')"
)


@CATALOG.add(
    "op2_warc",
    f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, {BASE32} AS payload_digest FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM g
""",
)
def _(spark, folder):
    """All pages written as archives and read back; digests of responses are those of the bytes read."""
    path = new_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    read = warc.read_archives(spark, path)
    number = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("bigint")
    return read.select(
        number("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), F.col("payload_bytes")).alias("payload_bytes"),
        F.coalesce(warc.base32_sha1(F.col("payload")), F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CONTRACT_WORDS = rf"regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@CATALOG.add(
    "op4_decontamination",
    f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {CONTRACT_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, w, least(13, len(w)) AS k
  FROM (SELECT item_id, {CONTRACT_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS s FROM b)),
parts AS (SELECT r, s, k, array_to_string(w[s : s + k - 1], ' ') AS t
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM windows))),
hits AS (SELECT r, s, k, item_id FROM parts JOIN windows USING (k, t)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r),
o AS (SELECT r, unnest(w) AS t, unnest(range(len(w))) AS p FROM d),
c AS (SELECT t, count(*) AS n FROM o GROUP BY t),
rare AS (SELECT item_id, w, t, count(*) OVER (PARTITION BY item_id, w) AS need, min(n) OVER (PARTITION BY item_id, w) AS least FROM (
  SELECT item_id, w, t, coalesce(n, 0) AS n FROM (SELECT DISTINCT item_id, w, unnest(w) AS t FROM b) LEFT JOIN c USING (t)
  QUALIFY row_number() OVER (PARTITION BY item_id, w ORDER BY coalesce(n, 0), t) <= 3)),
spots AS (SELECT r, p, t, item_id, w, need FROM o JOIN rare USING (t) WHERE least > 0),
close AS (SELECT x.r, x.p, x.item_id, x.w FROM spots x JOIN spots y ON x.r = y.r AND x.item_id = y.item_id AND x.w = y.w AND y.p BETWEEN x.p AND x.p + 19
  GROUP BY x.r, x.p, x.item_id, x.w, x.need HAVING count(DISTINCT y.t) >= x.need),
near AS (SELECT r, count(DISTINCT item_id) AS n_near_items FROM close GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated,
  coalesce(n_near_items, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN n USING (r) LEFT JOIN i USING (r) LEFT JOIN near USING (r)
""",
)
def _(spark, folder):
    report = decontamination.contamination_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"), near_span=20)
    return report.drop("text_key")


@CATALOG.add("op5_near_duplicates")
def _(spark, folder):
    return near_duplicates.near_duplicate_groups(table(spark, folder, "documents"), percent=85)


@CATALOG.add("op10_secret_scan")
def _(spark, folder):
    """Owners are the sources; a source's texts of one language count as one repository."""
    repository = F.concat_ws("/", "source", "lang")
    return secret_scan.secret_report(table(spark, folder, "documents"), repository=repository, owner="source")


@CATALOG.add("op6_language_id")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@CATALOG.add("op7_sentence_pieces")
def _(spark, folder):
    return sentence_pieces.encoding_report(table(spark, folder, "documents"))


@CATALOG.add("op8_neighbours")
def _(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@CATALOG.add("op9_main_text")
def _(spark, folder):
    return main_text.extract(table(spark, folder, "pages"))


@CATALOG.add("op3_weak_quality")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return weak_quality.score(docs, weak_quality.train(docs))


@CATALOG.add(
    "op11_fill_in_middle",
    """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
e AS (
  SELECT doc_id, t, l, (len(l) - CASE WHEN l[-1] = '' THEN 1 ELSE 0 END)::BIGINT AS n,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
f AS (
  SELECT doc_id, t, l, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (
  SELECT *, CASE WHEN a = n THEN t WHEN a = 0 THEN '' ELSE array_to_string(l[1:a], chr(10)) || chr(10) END AS upto_a,
    CASE WHEN b = n THEN t WHEN b = 0 THEN '' ELSE array_to_string(l[1:b], chr(10)) || chr(10) END AS upto_b FROM f),
k AS (
  SELECT *, upto_a AS p, substr(upto_b, length(upto_a) + 1) AS m, substr(t, length(upto_b) + 1) AS s FROM g)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM k
""",
)
def _(spark, folder):
    return fill_in_middle.fill_report(table(spark, folder, "documents"))


@CATALOG.add("op12_embedding_whitening")
def _(spark, folder):
    return embedding_whitening.whitening_report(table(spark, folder, "embeddings"))


@CATALOG.add("op13_jaccard_join")
def _(spark, folder):
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


@CATALOG.add("pipeline", corpus_pipeline.ORACLE_SQL)
def _(spark, folder):
    return corpus_pipeline.run(spark, folder)
