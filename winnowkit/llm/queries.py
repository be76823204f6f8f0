"""The registered queries of the training-data operators and their SQL.

Each query runs its operator over the whole table and only derives the digest columns from
the operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact, interactions, langid, licenses, negatives, packing, quality, simhash, suffixes, tokenbin, warc
from .store import new_path, on_workers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def _harm(record_id: int, raw: bytes) -> bytes:
    """What befell the replica: of some records a byte was flipped, of others all are zeros."""
    if record_id % 307 == 11:
        return bytes(len(raw))
    if record_id % 101 == 7:
        at = len(raw) // 2
        return raw[:at] + bytes([raw[at] ^ 0x40]) + raw[at + 1 :]
    return raw


def op3_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores the crawl as WARC files and a replica of them with damaged bytes, audits what stands in both, and reports on every record."""
    pages = _table(spark, sf_dir, "pages")
    pages = pages.select(F.col("page_id").alias("record_id"), F.floor(F.col("page_id") / 1024).alias("file"), "url", "html")
    here, there = new_path(spark, "crawl"), new_path(spark, "replica")
    index = warc.write(pages, here)
    ours, theirs = warc.measure(index, here), warc.measure(warc.copy(index, here, there, _harm), there)
    found = warc.audit(ours, theirs).withColumnsRenamed({"file": "f", "offset": "o"})
    out = ours.join(found, ours["file"].eqNullSafe(F.col("f")) & (ours["offset"] == F.col("o")), "left")
    return out.select(
        F.col("record_id").alias("page_id"), "file", "record_offset", F.col("record_length").alias("length"), F.col("record_digest").alias("digest"),
        F.coalesce("state", F.lit("intact")).alias("state"),
    )


OP3_SQL = """
WITH r AS (
  SELECT page_id, page_id // 1024 AS file,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:record:' || page_id || '>'
    || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8'
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS rec
  FROM pages
)
SELECT page_id, file,
  CAST(coalesce(sum(strlen(rec)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_offset,
  strlen(rec) AS length, sha256(rec) AS digest,
  CASE WHEN page_id % 307 = 11 THEN 'missing' WHEN page_id % 101 = 7 THEN 'changed' ELSE 'intact' END AS state
FROM r
"""


PLANTED_TURN = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_TURN).alias("text"),
    )
    back = chat.read_back(chat.format_chats(rows.unionByName(planted)))
    turn_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turn_text.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, NULL, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, NULL, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, regexp_matches(role, '</?s>|\[/?INST\]|&[abl];') OR regexp_matches(text, '</?s>|\[/?INST\]|&[abl];') AS clash FROM turns
), rendered AS (
  SELECT *, 20 + CASE WHEN clash
    THEN length(regexp_replace(regexp_replace(replace(role, '&', '&a;'), '<(/?s>)', '&l;\1', 'g'), '\[(/?INST\])', '&b;\1', 'g'))
       + length(regexp_replace(regexp_replace(replace(text, '&', '&a;'), '<(/?s>)', '&l;\1', 'g'), '\[(/?INST\])', '&b;\1', 'g'))
    ELSE length(role) + length(text) END AS chars FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM rendered GROUP BY conv_id, alone
"""


def file_path() -> "F.Column":
    """The place of a document in its source's tree: two levels of folders, some of them with a LICENSE file."""
    doc, top = F.col("doc_id"), F.concat(F.col("source"), F.lit("/p"), F.floor(F.col("doc_id") / 500).cast("string"))
    low = F.concat(top, F.lit("/q"), F.floor(doc / 25).cast("string"))
    return (
        F.when(doc % 500 < 20, F.concat(top, F.lit("/LICENSE")))
        .when(doc % 25 < 5, F.concat(low, F.lit("/LICENSE")))
        .otherwise(F.concat(low, F.lit("/"), doc.cast("string"), F.lit(".txt")))
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text", file_path().alias("path")))


_QUOTE = lambda x: "'" + x.replace("'", "''") + "'"
_TEMPLATE_ROWS = ", ".join(f"({_QUOTE(x[0])}, {_QUOTE(x[1])}, {licenses.needed(x)}::VARCHAR[])" for x in licenses.templates())
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP5_SQL = rf"""
WITH f AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source || '/p' || (doc_id // 500) AS top, source || '/p' || (doc_id // 500) || '/q' || (doc_id // 25) AS low FROM documents
), d AS (
  SELECT r, doc_id, t, CASE WHEN doc_id % 500 < 20 THEN top ELSE low END AS dir, top, low, doc_id % 500 < 20 OR doc_id % 25 < 5 AS licence_file, string_split(t, chr(10)) AS lines FROM f
), n AS (
  SELECT license, i, names, unnest(regexp_extract_all({_LOWER.format("x")}, '{licenses.TERM}')) AS term
  FROM (SELECT license, x, names, row_number() OVER (ORDER BY license, x) AS i FROM (VALUES {_TEMPLATE_ROWS}) v(license, x, names))
), nt AS (SELECT license, i, names, term, count(*) AS tf FROM n GROUP BY ALL),
tot AS (SELECT count(*) AS n FROM d),
df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT r, unnest(regexp_extract_all({_LOWER.format("t")}, '{licenses.TERM}')) AS term FROM d) GROUP BY term),
idf AS MATERIALIZED (SELECT DISTINCT nt.term, ln((tot.n + 1) / (coalesce(df.df, 0) + 1)) + 1 AS idf FROM nt LEFT JOIN df USING (term), tot),
tw AS MATERIALIZED (SELECT license, i, names, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY i)) AS tw FROM nt JOIN idf USING (term)),
pt AS (
  SELECT r, unnest(list_distinct(list_concat([t, array_to_string(lines[:greatest(coalesce(list_position(list_transform(lines, lambda l: regexp_matches(l, '{licenses.COMMENT}')), false), 0) - 1, 0)], chr(10))],
    regexp_split_to_array(t, '{licenses.EMPTY_LINES}'), lines))) AS part FROM d
), ct AS (
  SELECT r, part, term, count(*) AS tf FROM (SELECT r, part, unnest(regexp_extract_all({_LOWER.format("part")}, '{licenses.TERM}')) AS term FROM pt) GROUP BY ALL
), cw AS MATERIALIZED (SELECT r, part, term, tf * coalesce(idf, ln(tot.n + 1) + 1) AS w FROM ct LEFT JOIN idf USING (term), tot),
norm AS (SELECT r, part, sqrt(sum(w * w)) AS norm FROM cw GROUP BY r, part),
s AS (
  SELECT r, license, round(sum(w * tw) / any_value(norm), 6) AS score FROM cw JOIN tw USING (term) JOIN norm USING (r, part) GROUP BY r, part, i, license, names
  HAVING count(*) FILTER (list_contains(names, term)) = len(names)
), own AS (SELECT r, arg_min(license, (-score, license)) AS own, max(score) AS own_score FROM s WHERE score >= {licenses.MIN_SCORE} GROUP BY r),
o AS (SELECT d.r, doc_id, dir, top, low, licence_file, own, own_score FROM d LEFT JOIN own USING (r)),
ld AS (SELECT dir AS at, min((own, own_score)) AS f FROM o WHERE licence_file AND own IS NOT NULL GROUP BY dir)
SELECT doc_id, CASE WHEN own IS NOT NULL THEN own ELSE coalesce(a.f[1], b.f[1]) END AS license,
  CASE WHEN own IS NOT NULL THEN 'own' WHEN coalesce(a.f[1], b.f[1]) IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CAST(CASE WHEN own IS NOT NULL THEN NULL WHEN a.f IS NOT NULL THEN 0 WHEN b.f IS NOT NULL THEN 1 END AS BIGINT) AS levels_up,
  CASE WHEN own IS NOT NULL THEN own_score ELSE coalesce(a.f[2], b.f[2]) END AS score
FROM o LEFT JOIN ld a ON a.at = o.dir LEFT JOIN ld b ON b.at = o.top AND o.dir <> o.top
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT r, source, line, length(line) AS n,
    translate(regexp_replace(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM (SELECT r, source, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY r
), win AS (
  SELECT r, i, w[i:i+4] AS win FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
), docs_of AS (
  SELECT source, count(*) AS docs FROM d GROUP BY source
), bad AS (
  SELECT f.source, f.norm FROM (SELECT source, norm, count(DISTINCT r) AS n FROM l GROUP BY source, norm) f
  JOIN docs_of USING (source) WHERE f.n > 10 AND f.n > docs * CAST(0.01 AS DOUBLE)
), cut AS (
  SELECT r, sum(n) AS total, sum(CASE WHEN bad.norm IS NULL THEN n ELSE 0 END) AS stays, count(bad.norm) AS removed
  FROM l LEFT JOIN bad USING (source, norm) GROUP BY r
), base AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(removed > 0 AND stays < total * CAST(0.3 AS DOUBLE), false) AS depleted
  FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN cut USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT depleted AS kept
FROM base
"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two batches, the one with the larger ids first: what the second repeats is found in the index."""
    docs = _table(spark, sf_dir, "documents")
    half = docs.agg(F.floor((F.min("doc_id") + F.max("doc_id")) / 2)).first()[0]
    newer = F.coalesce(F.col("doc_id") > F.lit(half), F.lit(False))
    return exact.dedup_batches([docs.where(newer), docs.where(~newer)])


OP8_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.write_and_read(_table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP11_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), t AS MATERIALIZED (
  SELECT DISTINCT item, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), p AS (
  SELECT r, i, n, w[i:i + n - 1] AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n)
), m AS MATERIALIZED (SELECT r, i, p.n, item FROM p JOIN t USING (n, win)),
hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


OP12_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0
), p AS (
  SELECT ar, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) AS n
  FROM s WHERE same AND r <> ar QUALIFY n <= 5
), g AS (
  SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.ar, p.n ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM g
"""


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT d.doc_id, part, concat(
      CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails
  FROM d
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), x AS (
  SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM f LEFT JOIN l USING (doc_id)
), c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c), o AS (
  SELECT a.c || b.c || e.c || g.c || h.c AS filter_order FROM c a, c b, c e, c g, c h
  WHERE len(list_distinct([a.c, b.c, e.c, g.c, h.c])) = 5
), y AS (
  SELECT x.*, filter_order, coalesce(list_min(list_filter([1, 2, 3, 4, 5], lambda i: contains(fails, filter_order[i]))), 6) AS first FROM x, o
), z AS (SELECT y.*, CAST(step AS INTEGER) AS step, filter_order[step] AS here FROM y, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
g AS (
  SELECT part, filter_order, step, here, count(*) FILTER (first > step) AS kept, count(*) FILTER (first = step) AS removed,
    count(*) FILTER (contains(fails, here) AND first < step) AS redundant, count(*) FILTER (fails = here) AS unique_fails,
    count(*) FILTER (first = step AND good) AS good_lost, count(*) FILTER (first = step AND toxic) AS toxic_lost
  FROM z GROUP BY ALL
)
SELECT * EXCLUDE (here), CAST(sum(removed) OVER (PARTITION BY part, here) AS BIGINT) AS shapley FROM g
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_simhash": op1_simhash,
        "op2_language_id": op2_language_id,
        "op3_warc_audit": op3_warc_audit,
        "op4_chat_format": op4_chat_format,
        "op5_license_scan": op5_license_scan,
        "op6_quality_rules": op6_quality_rules,
        "op7_packing": op7_packing,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_bpe": op9_bpe,
        "op10_token_files": op10_token_files,
        "op11_decontamination": op11_decontamination,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_filter_interactions": op13_filter_interactions,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_audit": OP3_SQL,
        "op4_chat_format": OP4_SQL,
        "op5_license_scan": OP5_SQL,
        "op6_quality_rules": OP6_SQL,
        "op8_exact_dedup": OP8_SQL,
        "op11_decontamination": OP11_SQL,
        "op12_hard_negatives": OP12_SQL,
        "op13_filter_interactions": OP13_SQL,
    }
