"""Registered queries of the llm operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import ann, bpe, conversations, idfile, lexical, packing, scratch, sketch, toxicity, warc
from postlake.llm.brown_lm import brown_scores
from postlake.llm.crf_lang import identify
from postlake.llm.line_dedup import line_dedup
from postlake.llm.simhash import simhash_groups

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by the rank file, and their bytes again."""
    return bpe.encode(table(spark, sf_dir, "documents"), RANKS, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least 10 documents hold."""
    out = line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1, keep="none")
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op3_token_id_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, written as plane-shuffled shards and read back."""
    path = scratch.new_path(spark, "token-ids")
    idfile.write_ids(table(spark, sf_dir, "documents"), path, VOCABULARY, END_ID)
    return idfile.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every whole text and the group its near copies form."""
    return simhash_groups(table(spark, sf_dir, "documents"), words=3, radius=3)


def id_fold(n: int):
    """crc32 of the doc_id as text, modulo ``n`` (null id: null)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op5_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based scores of every whole text, learnt from all but one fold in seven."""
    return brown_scores(table(spark, sf_dir, "documents"), held_out=id_fold(7) == 2)


def op6_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; one fold in four is never learnt from."""
    held_out = F.coalesce(id_fold(4) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, train_on=~held_out).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def page_captures(pages: DataFrame) -> DataFrame:
    """Archive records derived from ``pages``: a full response per page, a
    minute apart, and a revisit per page around it, with the page's URL
    written in another way and agreeing, weak, other or no validators."""
    captured = 1704067200 + F.col("page_id") * 60
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.col("html").cast("binary")), 1, 16), F.lit('"'))
    written = lambda seconds: F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    header = lambda name, value: F.struct(F.lit(name).alias("key"), value.alias("value"))
    given = lambda *h: F.map_from_entries(F.filter(F.array(*h), lambda e: e["value"].isNotNull()))
    way, validator = F.col("page_id") % 4, F.col("page_id") % 5
    again = captured + (F.col("page_id") % 9 - 1) * 3600 + 30
    response = pages.select(
        F.concat(F.lit("response-"), F.col("page_id")).alias("record_id"), F.lit("response").alias("record_type"),
        F.col("url").alias("uri"), F.timestamp_seconds(captured).alias("date"),
        F.when(F.col("page_id") % 17 == 9, 404).otherwise(200).alias("status"),
        given(header("Content-Type", F.lit("text/html")), header("ETag", etag), header("Server", F.lit("demo")),
              header("Content-Length", F.octet_length("html").cast("string")),
              header("Last-Modified", written(captured)), header("Cache-Control", F.lit("max-age=60"))).alias("headers"),
        F.col("html").alias("payload"))
    revisit = pages.select(
        F.concat(F.lit("revisit-"), F.col("page_id")).alias("record_id"), F.lit("revisit").alias("record_type"),
        F.when(way == 1, F.regexp_replace("url", "example", "EXAMPLE"))
        .when(way == 2, F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")))
        .when(way == 3, F.regexp_replace("url", "^http://([^/]+)", "http://$1:80"))
        .otherwise(F.col("url")).alias("uri"),
        F.timestamp_seconds(again).alias("date"), F.lit(304).alias("status"),
        given(header("ETag", F.when(validator == 0, etag).when(validator == 1, F.concat(F.lit("W/"), etag))
                     .when(validator == 3, F.lit('"other"'))),
              header("Last-Modified", F.when(validator == 2, written(captured))),
              header("Date", written(again)), header("Cache-Control", F.lit("max-age=600")),
              header("Content-Length", F.lit("0")), header("X-Cache", F.lit("HIT"))).alias("headers"),
        F.lit(None).cast("string").alias("payload"))
    return response.unionByName(revisit)


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of all pages, resolved against the pages' responses."""
    out = warc.resolve_revisits(page_captures(table(spark, sf_dir, "pages")))
    text = F.array_join(F.array_sort(F.transform(
        F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return out.select("record_id", "canonical_uri", "outcome", "response_id", "matched_by",
                      text.alias("headers"), F.sha2(F.col("payload").cast("binary"), 256).alias("payload_sha256"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, END_ID, capacity=1024)


def op9_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 20 == 0, k=20)


def op10_bottom_k_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text."""
    return sketch.compare_edits(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; one fold in five of the labels is never learnt from."""
    held_out = F.coalesce(id_fold(5) == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), train_on=~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation, after damage."""
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_id_file": op3_token_id_file,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_brown_lm": op5_brown_lm,
    "op6_crf_language": op6_crf_language,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_adaptive_scan": op9_adaptive_scan,
    "op10_bottom_k_sketch": op10_bottom_k_sketch,
    "op11_lexical_search": op11_lexical_search,
    "op12_toxicity_mil": op12_toxicity_mil,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": """
        WITH docs AS (
            SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
            FROM documents),
        lines AS (
            SELECT rid, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM docs),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        frequent AS (
            SELECT key FROM keyed WHERE length(key) >= 1
            GROUP BY key HAVING count(DISTINCT rid) >= 10),
        marked AS (
            SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
               count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
                   AS kept_sha256
        FROM marked GROUP BY rid""",
    "op7_warc_revisits": r"""
        WITH p AS (
            SELECT page_id, url, html, 1704067200 + page_id * 60 AS captured,
                   1704067200 + page_id * 60 + (page_id % 9 - 1) * 3600 + 30 AS again,
                   '"' || substr(md5(html), 1, 16) || '"' AS tag
            FROM pages),
        captures AS (
            SELECT 'response-' || page_id AS record_id, 1 AS kind, url AS uri, captured AS ts, html,
                   tag AS etag, strftime(make_timestamp(captured * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS modified
            FROM p WHERE page_id % 17 <> 9
            UNION ALL
            SELECT 'revisit-' || page_id, 0,
                   CASE page_id % 4 WHEN 1 THEN replace(url, 'example', 'EXAMPLE')
                        WHEN 2 THEN regexp_replace(url, '#.*$', '') || '#again'
                        WHEN 3 THEN regexp_replace(url, '^http://([^/]+)', 'http://\1:80') ELSE url END,
                   again, NULL,
                   CASE page_id % 5 WHEN 0 THEN tag WHEN 1 THEN 'W/' || tag WHEN 3 THEN '"other"' END,
                   CASE page_id % 5 WHEN 2
                        THEN strftime(make_timestamp(captured * 1000000), '%Y-%m-%dT%H:%M:%SZ') END
            FROM p),
        parts AS (
            SELECT *, regexp_extract(uri, '^([a-z]+)://', 1) AS scheme,
                   lower(regexp_extract(uri, '^[a-z]+://([^/?#]*)', 1)) AS host,
                   regexp_extract(uri, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
                   regexp_extract(uri, '^[^?#]*[?]([^#]*)', 1) AS query
            FROM captures),
        keyed AS (
            SELECT *, regexp_replace(regexp_replace(host,
                           CASE scheme WHEN 'http' THEN ':(80)?$' WHEN 'https' THEN ':(443)?$' ELSE '$' END, ''),
                       '^www[.]', '')
                   || CASE path WHEN '' THEN '/' ELSE path END
                   || CASE WHEN trim(query, '&') = '' THEN ''
                           ELSE '?' || array_to_string(list_sort(string_split(
                               trim(regexp_replace(query, '&+', '&', 'g'), '&'), '&')), '&')
                      END AS canonical_uri
            FROM parts),
        joined AS (
            SELECT v.record_id, v.canonical_uri, v.ts, v.etag, v.modified, r.record_id AS response_id,
                   r.etag AS r_etag, r.modified AS r_modified, r.html,
                   row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC) AS n
            FROM keyed v LEFT JOIN keyed r
              ON r.kind = 1 AND r.canonical_uri = v.canonical_uri AND r.ts < v.ts
            WHERE v.kind = 0),
        judged AS (
            SELECT *, CASE WHEN response_id IS NULL THEN NULL
                           WHEN etag IS NOT NULL
                           THEN CASE WHEN regexp_replace(etag, '^W/', '') = r_etag THEN 'etag' END
                           WHEN modified = r_modified THEN 'last-modified' END AS matched_by
            FROM joined WHERE n = 1)
        SELECT record_id, canonical_uri, response_id, matched_by,
               CASE WHEN response_id IS NULL THEN 'no_response' WHEN matched_by IS NOT NULL THEN 'resolved'
                    WHEN etag IS NOT NULL OR modified IS NOT NULL THEN 'mismatch' ELSE 'no_validator' END AS outcome,
               CASE WHEN matched_by IS NOT NULL THEN array_to_string(list_sort([
                   'cache-control: max-age=600', 'content-length: ' || strlen(html), 'content-type: text/html',
                   'date: ' || strftime(make_timestamp(ts * 1000000), '%Y-%m-%dT%H:%M:%SZ'),
                   'etag: ' || coalesce(etag, r_etag), 'last-modified: ' || coalesce(modified, r_modified),
                   'server: demo']), chr(10)) END AS headers,
               CASE WHEN matched_by IS NOT NULL THEN sha256(html) END AS payload_sha256
        FROM judged""",
    "op11_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        sized AS (SELECT rid, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized),
        asked AS (
            SELECT qid, item_id, unnest(terms) AS term FROM (
                SELECT row_number() OVER () AS qid, item_id, regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
                FROM benchmark) AS b),
        times AS (SELECT qid, item_id, term, count(*) AS times FROM asked GROUP BY qid, item_id, term),
        postings AS (
            SELECT o.rid, o.term, count(*) AS tf
            FROM (SELECT rid, unnest(terms) AS term FROM d) AS o
            WHERE o.term IN (SELECT term FROM times) GROUP BY o.rid, o.term),
        weighted AS (
            SELECT p.term, CAST(floor(1000 * ln((2 * any_value(t.docs) + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM postings p CROSS JOIN total t GROUP BY p.term),
        impacts AS (
            SELECT p.term, s.rid, s.doc_id, v.w * (1000000000 * p.tf
                // (1000 * p.tf + 8 * (100 - 75 + (75 * s.n * t.docs) // t.all_terms))) AS impact
            FROM postings p JOIN sized s ON s.rid = p.rid JOIN weighted v ON v.term = p.term CROSS JOIN total t),
        scored AS (
            SELECT q.qid, q.item_id, i.rid, i.doc_id, CAST(sum(q.times * i.impact) AS BIGINT) AS score
            FROM times q JOIN impacts i ON i.term = q.term GROUP BY q.qid, q.item_id, i.rid, i.doc_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS FIRST) AS rank
            FROM scored WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
