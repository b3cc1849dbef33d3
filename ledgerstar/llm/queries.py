"""The registered queries of this subpackage, with their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.llm import (
    arc, chat, collocations, decontaminate, line_dedup, neighbours, ngram_join, packing, personal, repair, secrets,
    substring_dedup, toxicity,
)
from ledgerstar.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def vocabulary_path() -> str:
    """The byte-level vocabulary, wherever the tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())


QUERIES["op9_packing"] = op9_packing


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


QUERIES["op3_line_dedup"] = op3_line_dedup
ORACLES["op3_line_dedup"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
  FROM documents
), l AS (
  SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM l
), h AS (
  SELECT line_key, max(doc_id) AS keeper
  FROM (SELECT DISTINCT r, doc_id, line_key FROM k WHERE length(line_key) >= 20)
  GROUP BY line_key HAVING count(*) >= 3
), j AS (
  SELECT k.*, h.line_key IS NOT NULL AND k.doc_id IS DISTINCT FROM h.keeper AS gone
  FROM k LEFT JOIN h ON k.line_key = h.line_key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are the sources; a source's documents of one language stand for a repository."""
    docs = table(spark, sf_dir, "documents")
    return secrets.find_secrets(docs, F.col("source"), F.concat_ws("/", "source", "lang"))


QUERIES["op8_secrets"] = op8_secrets


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES["op10_neighbours"] = op10_neighbours
ORACLES["op10_neighbours"] = """
WITH v AS (
  SELECT vec_id, max(CAST(embedding AS DOUBLE[])) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold control strings."""
    control = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), control.alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    return chat.digests(chat.format_chats(chat.log_of(rows.unionByName(extra))))


QUERIES["op7_chat"] = op7_chat
ORACLES["op7_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(r) + length(t) + 17 + len(regexp_extract_all(r || chr(10) || t,
    '[<\[]\\*(\||/?s>|/?INST\]|/?SYS>>|/?SYS>|/?INST>)')) AS width
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, sha256(t))) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, sha256(t)) FILTER (WHERE r = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(width) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op4_arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.pages_through_archives(table(spark, sf_dir, "pages"))


QUERIES["op4_arc"] = op4_arc
ORACLES["op4_arc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder
  FROM pages
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(flatten(list_transform(range(8), lambda i: list_transform([15, 10, 5, 0], lambda b:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(digest, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> b) & 31), 1)))), '')
    AS payload_digest,
  CASE WHEN holder IS NULL OR page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN holder IS NULL OR page_id = holder THEN NULL ELSE holder END AS refers_to
FROM p
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op2_toxicity"] = op2_toxicity


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).drop("set_key")


QUERIES["op1_ngram_join"] = op1_ngram_join


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["op6_decontaminate"] = op6_decontaminate


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents"))


QUERIES["op5_substring_dedup"] = op5_substring_dedup


def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digests(table(spark, sf_dir, "documents"))


QUERIES["op11_personal"] = op11_personal


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, after the damage that the checksum of a row deals."""
    rows = table(spark, sf_dir, "conversations")
    return repair.report(repair.repair(repair.damaged(rows), known=rows))


QUERIES["op12_repair"] = op12_repair
# A checksum bit by bit, then the least (cost, edits, rows) of every state, row after row. More
# than two inserts in one place lead back to a state that fewer reach.
ORACLES["op12_repair"] = r"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: CAST(ord(c) AS BIGINT))),
      lambda a, c: list_reduce(list_prepend(xor(a, c), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS kind
  FROM conversations
), e AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE r END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM d
), f AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM e
), g AS (
  SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
    NOT regexp_matches(text, '[^ 	-
]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][ 	-
]*$') AS open_end
  FROM f
), h AS (
  SELECT *, blank OR seen AS gone, NOT blank AND NOT seen AND open_end AS cut FROM g
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE seen AND NOT blank) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS size
  FROM h GROUP BY conv_id
), ins AS (
  SELECT * FROM (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 3, 'I', 'user:'), (1, 2, 3, 'I', 'user:'), (2, 3, 3, 'I', 'assistant:'), (3, 2, 3, 'I', 'user:'),
    (0, 3, 6, 'II', 'user:,assistant:'), (1, 3, 6, 'II', 'user:,assistant:'), (2, 2, 6, 'II', 'assistant:,user:'),
    (3, 3, 6, 'II', 'user:,assistant:')) AS v(p, q, price, letters, rows)
), edits AS (
  SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS v(p, i, q)
), way AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS p, {'cost': CAST(0 AS BIGINT), 'audit': '', 'out': CAST([] AS VARCHAR[])} AS best
  FROM facts
  UNION ALL
  SELECT conv_id, pos, q, min(best) FROM (
    SELECT w.conv_id, h.pos, m.q, {
      'cost': w.best.cost + n.price + m.price, 'audit': w.best.audit || n.letters || m.letter,
      'out': w.best.out || CASE WHEN n.rows = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(n.rows, ',') END || m.row} AS best
    FROM way w JOIN h ON h.conv_id IS NOT DISTINCT FROM w.conv_id AND h.pos = w.pos + 1
    JOIN ins n ON n.p = w.p
    JOIN LATERAL (
      SELECT n.q AS q, 4 AS price, 'D' AS letter, CAST([] AS VARCHAR[]) AS row
      UNION ALL SELECT e.q, CASE WHEN h.cut THEN 3 ELSE 0 END, 'K', [h.role || ':' || h.text]
        FROM edits e WHERE NOT h.gone AND e.p = n.q AND e.i = h.i
      UNION ALL SELECT CASE n.q WHEN 2 THEN 3 ELSE 2 END, CASE WHEN h.cut THEN 6 ELSE 3 END, 'R',
        [CASE n.q WHEN 2 THEN 'assistant:' ELSE 'user:' END || h.text] WHERE NOT h.gone
    ) m ON true
  ) GROUP BY conv_id, pos, q
), ended AS (
  SELECT w.conv_id, min({
    'cost': w.best.cost + n.price, 'audit': w.best.audit || n.letters,
    'out': w.best.out || CASE WHEN n.rows = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(n.rows, ',') END}) AS best
  FROM way w JOIN facts s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.size = w.pos
  JOIN ins n ON n.p = w.p WHERE n.q IN (0, 3) GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
  coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, coalesce(x.best.cost, 0) AS cost,
  coalesce(x.best.audit, '') AS audit, sha256(coalesce(array_to_string(x.best.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES["op13_collocations"] = op13_collocations
ORACLES["op13_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS ws FROM p
), s AS (
  SELECT lang, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos FROM w, range(1, 5) AS r(n)
), f AS (
  SELECT lang, n, array_to_string(ws[pos:pos + n - 1], ' ') AS phrase, count(*) AS f FROM s GROUP BY ALL
), c AS (
  SELECT lang, n AS size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE n > 1 AND f >= 30
), k AS (
  SELECT *, unnest(range(1, size)) AS k FROM c
), cuts AS (
  SELECT k.lang, k.phrase, k.a, min({'score': (CAST(2000000 AS HUGEINT) * k.a) // (x.f + y.f), 'k': k.k, 'l': x.f, 'r': y.f}) AS cut
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(ws[1:k.k], ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(ws[k.k + 1:], ' ')
  GROUP BY ALL
), inside AS (
  SELECT lang, a, ws, size, n, unnest(range(1, size - n + 2)) AS pos FROM c, range(2, 4) AS r(n) WHERE n < size
), hidden AS (
  SELECT lang, array_to_string(ws[pos:pos + n - 1], ' ') AS phrase, max(a) AS widest FROM inside GROUP BY ALL
), ranked AS (
  SELECT cuts.*, row_number() OVER (PARTITION BY cuts.lang ORDER BY cut.score DESC, a DESC, cuts.phrase) AS rank
  FROM cuts LEFT JOIN hidden h ON h.lang = cuts.lang AND h.phrase = cuts.phrase
  WHERE h.widest IS NULL OR CAST(100 AS HUGEINT) * h.widest < CAST(80 AS HUGEINT) * a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.cut.l AS l, r.cut.r AS r, t.n, CAST(r.cut.score AS BIGINT) AS score
FROM ranked r JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE n = 1 GROUP BY lang) t ON t.lang = r.lang
WHERE rank <= 2000
"""
