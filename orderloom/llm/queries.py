"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (chat, filter_audit, html_blocks, lines, lsh, mixing, quality_crf, repeats, simhash, term_tree, tiling,
                           toxicity, warc)
from orderloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, fold = table(spark, folder, "documents"), toxicity.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs, table(spark, folder, "labels"), ~fold)
    scored = toxicity.score(docs.select("doc_id", fold.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, fold = table(spark, folder, "documents"), toxicity.held_out(F.col("doc_id"), 3, 1)
    model = quality_crf.train(docs, table(spark, folder, "labels"), ~fold)
    scored = quality_crf.score(docs.select("doc_id", fold.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return lsh.nearest(table(spark, folder, "embeddings"), asks=F.col("vec_id") % 20 == 0)


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    events = chat.message_events(rows.unionByName(chat.probe(spark)))
    return chat.digests(chat.read_back(chat.render(chat.fold(events))))


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_report(table(spark, folder, "documents"))


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.main_text(table(spark, folder, "pages"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return term_tree.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_quality": op4_quality,
    "op5_nearest": op5_nearest,
    "op6_decontaminate": op6_decontaminate,
    "op7_chat_format": op7_chat_format,
    "op8_mix_sources": op8_mix_sources,
    "op9_repeats": op9_repeats,
    "op10_main_text": op10_main_text,
    "op11_filter_audit": op11_filter_audit,
    "op12_line_dedup": op12_line_dedup,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op3_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS lead FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> lead THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> lead THEN lead END AS refers_to
FROM m
""",
    "op7_chat_format": r"""
WITH rows_ AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT conv_id, turn, role AS r, t, coalesce(role, '') AS role,
         length(regexp_replace(replace(t, '\', '\\'), '([<\[])(/?s>|/?INST\])', '\1\\\2', 'g')) AS n,
         length(regexp_replace(replace(replace(coalesce(role, ''), '\', '\\'), '|', '\|'),
                               '([<\[])(/?s>|/?INST\])', '\1\\\2', 'g')) AS nr
  FROM rows_)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, t) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' THEN n + 7 ELSE n + nr + 14 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op8_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(text, '')) AS mark FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
         ([3.0, 1.0, 2.0])[1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM by_source),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY most / weight, weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(most, weight * max(level) OVER ()) AS target FROM levels),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(s.doc_id::VARCHAR, '') || ':' || s.mark), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(rate) + (u < rate - floor(rate))::INT)::BIGINT AS copies,
       (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken
FROM rated
""",
    "op11_filter_audit": r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
marked AS (
  SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
         regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first_id, false)] AS fails
  FROM words),
labelled AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
  FROM marked LEFT JOIN labelled USING (doc_id) GROUP BY part, fails),
parts AS (SELECT DISTINCT part FROM masks),
one AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o, array_to_string(list_transform([a.f, b.f, c.f, d.f, e.f], lambda x: substr('ABCDE', x, 1)), '') AS filter_order
  FROM one a, one b, one c, one d, one e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT m.part, o.filter_order, s.f AS step, o.o[s.f] AS filter, n, good, bad, fails[o.o[s.f]] AS failed,
         len(list_filter(o.o[1:s.f - 1], lambda x: fails[x])) > 0 AS earlier, len(list_filter(fails, lambda x: x)) AS failures
  FROM masks m, orders o, one s),
counts AS (
  SELECT part, filter_order, step, filter,
         coalesce(sum(n) FILTER (NOT failed AND NOT earlier), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (failed AND NOT earlier), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (failed AND earlier), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (failed AND failures = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (failed AND NOT earlier), 0)::BIGINT AS good_lost,
         coalesce(sum(bad) FILTER (failed AND NOT earlier), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM counts
""",
    "op12_line_dedup": r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (
  SELECT doc_id, text, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM cut),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT (doc_id, text)) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.key = c.key GROUP BY doc_id, text
""",
    "op13_ranked_search": r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
counted AS (
  SELECT doc_id, term, count(*) AS tf FROM found WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counted, total GROUP BY term, docs),
scored AS (
  SELECT item_id, c.doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM counted c JOIN asked USING (term) JOIN weights USING (term) JOIN sizes s ON s.doc_id = c.doc_id, total
  GROUP BY item_id, c.doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
""",
}
