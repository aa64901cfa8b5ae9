"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm import decontamination, jaccard, langid, licences, lm, mixing, neardup, neighbours, search, shards, toxicity, variants, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_training_shards(spark: SparkSession, folder: str) -> DataFrame:
    """What is read back from the shards: each slot's sequence, with the MD5 of its ids."""
    return shards.materialise(_table(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.read_archive(spark, warc.write_archive(_table(spark, folder, "pages")))


# SQL has no SHA-1 in base 32 of its own: the digest's 40 hexadecimal digits are rewritten 5 bits at a time.
OP2_SQL = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
digests AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM payloads),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
    [strpos('0123456789abcdef', hex[i])]), '') AS b FROM digests),
named AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first,
    array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
      CAST(b[5*i+1] AS INT) * 16 + CAST(b[5*i+2] AS INT) * 8 + CAST(b[5*i+3] AS INT) * 4
      + CAST(b[5*i+4] AS INT) * 2 + CAST(b[5*i+5] AS INT) + 1]), '') AS payload_digest FROM bits)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END
  AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM named
"""


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_groups(_table(spark, folder, "documents"))


OP3_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM parts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def op4_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.evaluate(_table(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a passage of the benchmark: the item, the overlap's length and where it starts."""
    return decontamination.find_overlaps(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(_table(spark, folder, "documents"))


def op7_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "embeddings"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.detect(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 8)
              AS BIGINT) AS u,
         md5(coalesce(text, '')) AS digest, row_number() OVER () AS place
  FROM documents),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
rest AS (
  SELECT a.source,
         (SELECT sum(source_size) FROM sums)
           - coalesce((SELECT sum(b.cap) FROM sums b WHERE b.cap * a.weight < a.cap * b.weight), 0) AS words_left,
         (SELECT sum(b.weight) FROM sums b WHERE b.cap * a.weight >= a.cap * b.weight) AS weights_left
  FROM sums a),
marked AS (
  SELECT s.*, s.cap * r.weights_left < s.weight * r.words_left AS clamped
  FROM sums s JOIN rest r ON s.source IS NOT DISTINCT FROM r.source),
shared AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight * ((SELECT sum(source_size) FROM sums)
                     - coalesce((SELECT sum(cap) FROM marked WHERE clamped), 0)) AS DOUBLE)
                   / CAST((SELECT sum(weight) FROM marked WHERE NOT clamped) AS DOUBLE) END AS target
  FROM marked),
targets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM shared),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id NULLS FIRST, d.digest, d.place) AS until
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(whole AS BIGINT) + CASE WHEN until - size < need AND until - need <= need - (until - size)
                                   THEN 1 ELSE 0 END AS copies
  FROM placed)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken FROM counted
"""

def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.rank_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


OP11_SQL = r"""
WITH parts AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sized AS (SELECT d, doc_id, len(terms) AS n FROM parts WHERE len(terms) > 0),
totals AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM sized),
tfs AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM parts) GROUP BY 1, 2),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term),
asked AS (
  SELECT i, item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
scored AS (
  SELECT i, any_value(item_id) AS item_id, d, any_value(doc_id) AS doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sized USING (d), totals GROUP BY i, d)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 20
"""

def op12_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group_spellings(_table(spark, folder, "documents"))


# SQL has no CRC-32 of its own: it is taken byte by byte, with the remainders of the 256 bytes.
OP13_SQL = r"""
WITH RECURSIVE remainders AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS r
  FROM (SELECT unnest(range(0, 256)) AS i)),
runs AS (
  SELECT doc_id, run, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[a-z\x{C0}-\x{FF}]{6,}')) AS run FROM documents) GROUP BY 1, 2),
spelled AS (
  SELECT run, tf, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS digits FROM runs),
marked AS (
  SELECT run, tf, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(0, len(digits) // 2),
             lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM spelled, remainders),
words AS (
  SELECT word, CAST(sum(tf) AS BIGINT) AS n FROM (
    SELECT tf, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT))
                                          || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word
    FROM marked) WHERE length(word) >= 6 GROUP BY word HAVING sum(tf) >= 5),
shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less
  FROM (SELECT word, n, CAST(unnest(range(0, length(word))) AS INT) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.less = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.less = w.word),
best AS (
  SELECT near.word, near, w.n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near) AS place
  FROM near JOIN words w ON w.word = near.near),
known AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 5 * w.n THEN near END AS form,
         CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND place = 1),
upward AS (
  SELECT word, form AS root, 1 AS steps FROM known WHERE form IS NOT NULL
  UNION ALL SELECT u.word, k.form, steps + 1 FROM upward u JOIN known k ON k.word = u.root WHERE k.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, steps) AS root FROM upward GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM known LEFT JOIN roots USING (word)
"""

QUERIES: dict[str, Query] = {
    "op1_training_shards": op1_training_shards,
    "op2_warc": op2_warc,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_lm_scores": op4_lm_scores,
    "op5_decontamination": op5_decontamination,
    "op6_licences": op6_licences,
    "op7_embedding_neardup": op7_embedding_neardup,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_mix_sources": op10_mix_sources,
    "op11_ranked_search": op11_ranked_search,
    "op12_nearest_vectors": op12_nearest_vectors,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op3_ngram_jaccard": OP3_SQL,
    "op10_mix_sources": OP10_SQL,
    "op11_ranked_search": OP11_SQL,
    "op13_spelling_variants": OP13_SQL,
}
