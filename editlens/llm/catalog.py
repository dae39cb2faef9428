"""Queries of the training-data operators and, where SQL can say it, their
DuckDB twins. Each runs its operator over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlens.llm import (chat, covertree, decontam, filter_audit, html, langid, lines, mixing, quality, sharding,
                          simhash, substrings, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op2_source_mixing")
def op2(spark, sf):
    out = mixing.mix(table(spark, sf, "documents"))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "rate")


@query("op3_language_id")
def op3(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~held))
    pred = docs.select("doc_id", held.alias("held_out"), langid.predict(F.col("text"), model).alias("p"))
    return pred.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous")


OP4_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s+12], ' ') AS k, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dk AS (
  SELECT doc_id, n, s, array_to_string(w[s:s+n-1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, dk.n, item_id FROM dk JOIN win USING (k, n)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""


@query("op4_decontamination", OP4_SQL)
def op4(spark, sf):
    out = decontam.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query("op5_simhash_near_dedup")
def op5(spark, sf):
    out = simhash.near_duplicates(table(spark, sf, "documents"))
    return out.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query("op6_sharding")
def op6(spark, sf):
    out = sharding.shard(table(spark, sf, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op7_chat_format")
def op7(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    rows = rows.union(spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)],
                                            "conv_id bigint, turn bigint, role string, text string"))
    out = chat.format_chat(rows).select("conv_id", "segments", "formatted", "valid",
                                        chat.read_back(F.col("formatted")).alias("turns"),
                                        chat.loss_text(F.col("segments")).alias("loss"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "valid")


@query("op8_embedding_near_dedup")
def op8(spark, sf):
    out = covertree.near_duplicates(table(spark, sf, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op1_line_dedup", f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
bad AS (
  SELECT trim(line, ' ') AS t FROM l WHERE trim(line, ' ') <> ''
  GROUP BY t HAVING count(DISTINCT source) >= {lines.MIN_SITES}),
k AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS kept
  FROM l WHERE trim(line, ' ') NOT IN (SELECT t FROM bad) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(string_split(text, chr(10))), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id)""")
def op1(spark, sf):
    out = lines.dedup_lines(table(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op9_substring_dedup", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s+12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
f AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p
  FROM win JOIN f USING (k) WHERE first_doc < doc_id),
n AS (SELECT doc_id, count(*) AS n_removed, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id)""")
def op9(spark, sf):
    out = substrings.dedup(table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op10_html_extraction")
def op10(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    text = pages.select("page_id", "url", html.main_text(F.col("html"), html.learn(pages)).alias("text"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op11_embedding_whitening")
def op11(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


@query("op12_filter_audit", r"""
WITH lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_doc FROM d GROUP BY t),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t), regexp_matches(t, '[#$%&*|]'),
          coalesce(d.doc_id > first_doc, false)] AS fails
  FROM d JOIN firsts USING (t) LEFT JOIN lab ON lab.doc_id = d.doc_id),
c AS (SELECT part, good, bad, fails, count(*) AS n FROM f GROUP BY ALL),
l AS (SELECT unnest(range(1, 6)) AS i),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS ord FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT ord, i AS step, ord[i] AS f, ord[1:i-1] AS before FROM o, l),
r AS (
  SELECT part, array_to_string(list_transform(ord, lambda x: 'ABCDE'[x]), '') AS filter_order, step, f,
         sum(CASE WHEN NOT fails[f] AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails[f] AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails[f] AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails[f] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails[f] AND NOT gone THEN n * good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails[f] AND NOT gone THEN n * bad ELSE 0 END) AS toxic_lost
  FROM (SELECT *, len(list_filter(before, lambda x: fails[x])) > 0 AS gone FROM c, s) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r""")
def op12(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op13_quality_classifier")
def op13(spark, sf):
    return quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))
