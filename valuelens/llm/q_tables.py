"""Queries op1, op3 and op6: records, mixing and sharding."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuelens.llm import warc
from valuelens.llm.mixing import mix
from valuelens.llm.sharding import shard
from valuelens.llm.tables import register, table


def _sql_unescape(c: str) -> str:
    named = f"""replace(replace(replace(replace(replace({c}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', ' ')"""
    refs = f"list_distinct(regexp_extract_all({named}, '&#(?:[0-9]{{1,7}}|[xX][0-9a-fA-F]{{1,6}});'))"
    code = "CASE WHEN lower(e)[:3] = '&#x' THEN CAST('0x' || lpad(e[4:-2], 8, '0') AS BIGINT) ELSE CAST(e[3:-2] AS BIGINT) END"
    numeric = f"""list_reduce(list_prepend({named}, list_filter({refs}, lambda e: {code} > 0 AND {code} <> 38 AND {code} < 1114112
        AND {code} NOT BETWEEN 55296 AND 57343)), lambda t, e: replace(t, e, chr(CAST({code} AS INTEGER))))"""
    return f"regexp_replace({numeric}, '&(?:(?i:amp)|#0{{0,4}}38|#[xX]0{{0,4}}26);', '&', 'g')"


_LINE = "trim(regexp_replace({}, '\\s+', ' ', 'g'), ' ')"
_UUID = "'<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>'"


@register("op1_warc_derivatives", f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, md5(concat('response', chr(10), coalesce(CAST(page_id AS VARCHAR), ''), chr(10), coalesce(url, ''), chr(10), coalesce(html, ''))) AS h FROM pages),
r AS (SELECT page_id, url, html, {_UUID} AS rid,
        'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) AS head,
        regexp_replace(html, '{warc.DROP}', ' ', 'g') AS bare FROM p),
f AS (SELECT *,
        'http-status: 200' || chr(13) || chr(10) || 'title: ' || {_LINE.format(_sql_unescape("regexp_extract(bare, '(?is)<title[^>]*>(.*?)</title', 1)"))}
        || chr(13) || chr(10) || 'language: ' || regexp_extract(html, '(?i)<html(?:\\s[^>]*?)?\\slang\\s*=\\s*["'']([^"''>]*)["'']', 1) || chr(13) || chr(10)
        || array_to_string(list_transform(regexp_extract_all(bare, '(?i)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*["'']([^"''>]*)["'']', 1),
             lambda x: 'outlink: ' || {_LINE.format(_sql_unescape("x"))} || chr(13) || chr(10)), '') AS fields,
        trim(regexp_replace(regexp_replace({_sql_unescape("regexp_replace(regexp_replace(bare, '" + warc.BREAK + "', chr(10), 'g'), '" + warc.TAG + "', '', 'g')")},
          '[ \\t\\r\\f\\x0B\\x{{A0}}]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10)) AS plain
      FROM r),
k AS (SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type, fields AS block FROM f
      UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', plain FROM f),
i AS (SELECT *, md5(concat('d', chr(10), record_type, chr(10), rid)) AS h FROM k)
SELECT page_id, record_type, {_UUID} AS record_id, rid AS refers_to, url AS target_uri, '2024-01-01T00:00:00Z' AS date, content_type,
       CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest,
       'sha256:' || sha256(html) AS source_payload_digest,
       'sha256:' || sha256(head || chr(13) || chr(10) || chr(13) || chr(10) || html) AS source_block_digest, head AS source_headers, block
FROM i
""")
def op1_warc_derivatives(spark, sf_dir):
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


@register("op3_source_mix")
def op3_source_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "times")


@register("op6_ring_shards")
def op6_ring_shards(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
