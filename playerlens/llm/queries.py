"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.scratch import with_scratch
from playerlens.llm import conversations, lm, pii, secrets, warc
from playerlens.llm.decontaminate import contamination
from playerlens.llm.language import held_out, with_language
from playerlens.llm.minhash import near_duplicates
from playerlens.llm.mixing import mix
from playerlens.llm.sharding import shard_rows
from playerlens.llm.text import fold
from playerlens.llm.urls import filter_urls
from playerlens.llm.vectors import nearest
from playerlens.llm.whitening import whitened
from playerlens.session import cut_lineage, prepare, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_scratch(prepare(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = cut_lineage(pii.scan(docs).drop("text"))
    return pii.personal_data(found, pii.learn(found))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = cut_lineage(secrets.scan(docs).drop("text"))
    return secrets.secrets(found, secrets.learn(found, docs))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(.*)>$', 1) AS BIGINT)")
    return warc.read_archives(spark, path).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
        "error",
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return with_language(docs).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "margin",
        "rejected",
    )


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, fold(F.col("doc_id"), 7) == 2)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = conversations.repair(conversations.damaged(rows))
    return conversations.repaired_digest(rows, fixed)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_rows(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_secrets": op2_secrets,
    "op3_neighbours": op3_neighbours,
    "op4_decontaminate": op4_decontaminate,
    "op5_minhash": op5_minhash,
    "op6_warc": op6_warc,
    "op7_urls": op7_urls,
    "op8_language": op8_language,
    "op9_lm": op9_lm,
    "op10_mixing": op10_mixing,
    "op11_conversations": op11_conversations,
    "op12_sharding": op12_sharding,
    "op13_whitening": op13_whitening,
}

LOWER_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"



def crc32_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, byte by byte through the table of its polynomial."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return f"""xor(list_reduce(
      list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT)),
      lambda c, b: xor(CAST({table} AS BIGINT[])[(xor(c, b) & 255) + 1], c >> 8),
      CAST(4294967295 AS BIGINT)), 4294967295)"""


ORACLE_SQL = {
    "op12_sharding": f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 8 AS size, {crc32_sql("coalesce(text, '')")} AS crc,
    coalesce('=' || text, '') AS t
  FROM documents
), grouped AS (
  SELECT t, size, crc, min(doc_id) AS first, CAST(sum(size) AS BIGINT) AS bytes FROM rows GROUP BY t, size, crc
), ranked AS (
  SELECT *, row_number() OVER big - 1 AS r, sum(bytes) OVER () - sum(bytes) OVER big + bytes AS left_bytes
  FROM grouped WINDOW big AS (ORDER BY bytes DESC, first NULLS LAST, crc, size)
), judged AS (
  SELECT *, min(CAST(r < 23 AND bytes * (24 - r) >= left_bytes AS INTEGER)) OVER (ORDER BY r) = 1 AS alone FROM ranked
), lone AS (
  SELECT count(*) AS n FROM judged WHERE alone
), ends AS (
  SELECT t, size, crc, bytes, CAST(sum(bytes) OVER (ORDER BY first NULLS LAST, crc, size) AS BIGINT) AS e FROM judged WHERE NOT alone
), best AS (
  SELECT 1 AS k, e, e AS most FROM ends
  UNION ALL
  SELECT b.k + 1, x.e, min(greatest(b.most, x.e - b.e)) FROM best b JOIN ends x ON x.e >= b.e, lone
  WHERE b.k < 24 - lone.n GROUP BY b.k, x.e
), capacity AS (
  SELECT most AS c FROM best, lone WHERE k = 24 - lone.n ORDER BY e DESC LIMIT 1
), cuts AS (
  SELECT CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS e
  UNION ALL
  SELECT u.s + 1, (SELECT max(x.e) FROM ends x, capacity WHERE x.e <= u.e + capacity.c)
  FROM cuts u WHERE u.s < 24
), dealt AS (
  SELECT t, CAST(r AS BIGINT) AS shard FROM judged WHERE alone
  UNION ALL
  SELECT t, lone.n + (SELECT count(*) FROM cuts c WHERE c.s > 0 AND c.e < x.e) FROM ends x, lone
)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, size, crc) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM rows JOIN dealt USING (t)
""",
    "op11_conversations": f"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS code
  FROM conversations
), rows AS (
  SELECT coalesce('=' || conv_id, '') AS conv, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE code WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text[1:64], md5(text), copy) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare, role[1:1] AS initial
  FROM rows
), judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN bare[-1:] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS wrong
  FROM placed
), step(p, c, q) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), added(p, q, cost, audit, made) AS (
  SELECT s, s, 0, '', CAST([] AS VARCHAR[]) FROM (VALUES (0), (1), (2), (3)) t(s)
  UNION ALL SELECT p, q, 2, 'I', [CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM step WHERE c <> 's'
  UNION ALL SELECT s, 3, 4, 'II', ['user:', 'assistant:'] FROM (VALUES (0), (1)) t(s)
), edits AS (
  SELECT conv, i, s AS p, s AS q, 3 AS cost, 'D' AS audit, CAST([] AS VARCHAR[]) AS made
  FROM judged, (VALUES (0), (1), (2), (3)) t(s)
  UNION ALL
  SELECT conv, i, p, q, CAST(fault = 'truncated' AS INTEGER), 'K', [role || ':' || text]
  FROM judged JOIN step ON c = initial WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv, i, p, q, 2 + CAST(fault = 'truncated' AS INTEGER), 'R',
    [CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
  FROM judged JOIN step ON c <> 's' WHERE fault NOT IN ('blank', 'duplicate')
), moves AS (
  SELECT conv, i, a.p, e.q, a.cost + e.cost AS cost, a.audit || e.audit AS audit, list_concat(a.made, e.made) AS made
  FROM edits e JOIN added a ON a.q = e.p
), walk AS (
  SELECT DISTINCT conv, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS made
  FROM judged
  UNION ALL
  SELECT conv, i, q, cost, audit, made FROM (
    SELECT m.conv, m.i, m.q, w.cost + m.cost AS cost, w.audit || m.audit AS audit, list_concat(w.made, m.made) AS made,
      row_number() OVER (PARTITION BY m.conv, m.q ORDER BY w.cost + m.cost, w.audit || m.audit) AS place
    FROM walk w JOIN moves m ON m.conv = w.conv AND m.i = w.i + 1 AND m.p = w.state
  ) WHERE place = 1
), ends AS (
  SELECT w.conv, w.cost + a.cost AS cost, w.audit || a.audit AS audit, list_concat(w.made, a.made) AS made,
    row_number() OVER (PARTITION BY w.conv ORDER BY w.cost + a.cost, w.audit || a.audit) AS place
  FROM walk w JOIN (SELECT conv, max(i) AS n FROM judged GROUP BY conv) x ON x.conv = w.conv AND x.n = w.i
  JOIN added a ON a.p = w.state WHERE a.q IN (0, 3)
), counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal
  FROM judged GROUP BY conv
)
SELECT e.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(x.cost, 0) AS cost,
  coalesce(x.audit, '') AS audit, sha256(coalesce(array_to_string(x.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counts c ON c.conv = coalesce('=' || e.conv_id, '')
LEFT JOIN (SELECT * FROM ends WHERE place = 1) x ON x.conv = coalesce('=' || e.conv_id, '')
""",
    "op5_minhash": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN (SELECT u, min(v) AS component_id FROM reach GROUP BY u) c ON c.u = d.doc_id
LEFT JOIN sizes s ON s.doc_id = d.doc_id
""",
    "op4_decontaminate": rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '{WORD_SQL}') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '{WORD_SQL}') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    unnest(CASE WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
      ELSE [array_to_string(w[i:i + 9], ' ') FOR i IN range(1, len(w) - 8)] END) AS s
  FROM items WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM windows
), starts AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM docs, sizes WHERE len(w) >= n
), found AS (
  SELECT t.doc_id, t.i, t.n, x.item_id
  FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM starts) t
  JOIN windows x ON x.n = t.n AND x.s = t.s
), hit AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
  sha256(coalesce(m.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id
""",
    "op10_mixing": rf"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    (CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':10')[1:12] AS BIGINT) + 0.5::DOUBLE)
      / 281474976710656::DOUBLE AS u
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM rows GROUP BY source
), weighed AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sums
), level AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS share
  FROM weighed
  WINDOW b AS (ORDER BY source_size::DOUBLE / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), first AS (
  SELECT rest, share FROM level WHERE 3 * source_size * share >= w * rest
  ORDER BY 3 * source_size::DOUBLE / w, i LIMIT 1
), plan AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size,
    (w * rest)::DOUBLE / share::DOUBLE) AS target
  FROM weighed, first
), odds AS (
  SELECT r.*, p.source_size, p.target, floor(least(3.0::DOUBLE, target / source_size)) AS whole,
    least(3.0::DOUBLE, target / source_size) - floor(least(3.0::DOUBLE, target / source_size)) AS part
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
), ranked AS (
  SELECT *, ((u / (1 - u)) / (part / (1 - part))) AS q FROM odds
), placed AS (
  SELECT *, CASE WHEN part > 0 THEN q / (1 + q) END AS v FROM ranked
), walked AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS rest,
    sum(CASE WHEN part > 0 THEN size ELSE 0 END) OVER (PARTITION BY source) AS open,
    sum(size) OVER (PARTITION BY source, part > 0 ORDER BY v, doc_id, size) AS upto
  FROM placed
)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN part > 0 AND rest > 0 AND (rest >= open OR upto - rest <= size / 2.0)
    THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM walked
""",
    "op3_neighbours": """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), usable AS (
  SELECT vec_id, v, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b)) AS n FROM rows
  WHERE vec_id IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda a, b: a + b) / (q.n * c.n) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
) WHERE rank <= 5
""",
    "op6_warc": """
WITH pages_of AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM pages_of
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to,
  CAST(NULL AS VARCHAR) AS error
FROM grouped
""",
}
