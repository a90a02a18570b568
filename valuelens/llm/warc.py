"""WARC derivative builder (1): metadata and plain-text conversion records of responses.

``responses`` wraps stored pages as WARC response records; ``derive`` turns response records
into a metadata record (status, HTTP headers, title, language, links) and a conversion record
(plain text). Both refer to their response by WARC-Refers-To, share its target and date, and
carry its payload digest; the HTTP headers are kept as they were sent. ``serialise`` and
``write_warc`` give the records as WARC 1.1 bytes.

Digests are ``sha256:`` and lower-case hex. Record identifiers are name-based: equal input
gives equal identifiers on every run. Scale: one pass of column expressions per record, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
_BLOCKS = "p|div|br|hr|h[1-6]|li|ul|ol|dl|dt|dd|table|tr|td|th|article|section|nav|header|footer|main|aside|title|head|body|html|pre|blockquote|form|figure"

#: Patterns removed from HTML or replaced, in this order (dot matches line ends).
DROP = r"(?s)<(?:!--.*?-->|(?i:script[^>]*>.*?</script\s*>|style[^>]*>.*?</style\s*>|noscript[^>]*>.*?</noscript\s*>|template[^>]*>.*?</template\s*>))"
BREAK = rf"</?(?i:{_BLOCKS})(?:[\s/][^>]*)?>"
TAG = r"<[a-zA-Z/!?][^>]*>"
SPACES = r"[\t\r\f\x0B\x{A0}]+"
#: Named entities decoded besides &amp;, which comes last.
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "))


def _identifier(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4),
                    F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _digest(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages (page_id, url, html) as WARC response records; null html is an empty payload."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(html).cast("string"), F.lit(CRLF + CRLF))
    block = F.concat(head, html)
    return pages.select(
        "page_id", F.lit("response").alias("record_type"), _identifier("response", F.col("page_id"), F.col("url"), html).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.lit("application/http; msgtype=response").alias("content_type"),
        _digest(block).alias("block_digest"), _digest(html).alias("payload_digest"), block.alias("block"))


def _named(c: Column) -> Column:
    for name, value in NAMED:
        c = F.replace(c, F.lit(name), F.lit(value))
    return c


def unescape(c: Column) -> Column:
    """Character references decoded once: the NAMED ones, numeric ones, and last &amp;."""
    return _numeric(_named(c))


def _numeric(c: Column) -> Column:
    refs = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)"), F.lit(1)))
    digits = lambda e: F.regexp_extract(e, r"&#[xX]?([0-9a-fA-F]+);", 1)
    code = lambda e: F.when(F.lower(e).startswith("&#x"), F.conv(digits(e), 16, 10)).otherwise(digits(e)).cast("long")
    real = lambda k: (k > 0) & (k != 38) & (k < 0x110000) & ~k.between(0xD800, 0xDFFF)
    char = lambda k: F.decode(F.unhex(F.lpad(F.hex(k), 8, "0")), "UTF-32")
    c = F.aggregate(refs, c, lambda text, e: F.when(real(code(e)), F.replace(text, e, char(code(e)))).otherwise(text))
    return F.regexp_replace(c, r"&(?:(?i:amp)|#0{0,4}38|#[xX]0{0,4}26);", "&")


def _without_tags(bare: Column) -> Column:
    """Text with one line break per block tag; references of the NAMED kind decoded."""
    return _named(F.regexp_replace(F.regexp_replace(bare, BREAK, "\n"), TAG, ""))


def _tidy(text: Column) -> Column:
    """Numeric references decoded, single spaces, no empty lines, no space at either end."""
    t = F.regexp_replace(F.regexp_replace(_numeric(text), SPACES, " "), "  +", " ")
    return F.btrim(F.replace(F.regexp_replace(t, r"\n[ \n]+", "\n"), F.lit(" \n"), F.lit("\n")), F.lit(" \n"))


def plain_text(html: Column) -> Column:
    """Text of HTML: no comments, scripts or styles, one line per block, single spaces."""
    return _tidy(_without_tags(F.regexp_replace(html, DROP, " ")))


def derive(records: DataFrame) -> DataFrame:
    """Two records for each response: ``metadata``, then ``conversion``.

    records needs the columns of :func:`responses`.
    A block without an empty line has no payload. Records of other types are left
    out. Null blocks give empty derivatives; equal records give equal derivatives; columns
    of other names are ignored.
    """
    r = records.where("record_type = 'response'").select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("payload_digest").alias("source_payload_digest"),
        F.col("block_digest").alias("source_block_digest"), F.coalesce("block", F.lit("")).alias("b"))
    cut = F.locate(CRLF + CRLF, F.col("b"))
    r = r.withColumn("cut", cut).withColumn("source_headers", F.when(F.col("cut") > 0, F.expr("substring(b, 1, cut - 1)")).otherwise(F.col("b")))
    r = r.withColumn("html", F.when(F.col("cut") > 0, F.expr("substring(b, cut + 4)")).otherwise(F.lit(""))).drop("b", "cut")
    # columns of their own, so that each pass over the text runs once
    r = r.withColumn("bare", F.regexp_replace("html", DROP, " ")).withColumn("untagged", _without_tags(F.col("bare")))
    bare = F.col("bare")
    links = F.regexp_extract_all(bare, F.lit(r"(?i)<a\s(?:[^>]*?\s)?href\s*=\s*[\"']([^\"'>]*)[\"']"), F.lit(1))
    one_line = lambda c: F.btrim(F.regexp_replace(c, r"\s+", " "), F.lit(" "))
    title = one_line(unescape(F.regexp_extract(bare, r"(?is)<title[^>]*>(.*?)</title", 1)))
    lang = F.regexp_extract("html", r"(?i)<html(?:\s[^>]*?)?\slang\s*=\s*[\"']([^\"'>]*)[\"']", 1)
    status = F.regexp_extract("source_headers", r"^HTTP/\S+ ([0-9]{3})", 1)
    fields = F.concat(
        F.lit("http-status: "), status, F.lit(f"{CRLF}title: "), title, F.lit(f"{CRLF}language: "), lang, F.lit(CRLF),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), one_line(unescape(x)), F.lit(CRLF))), ""))
    r = r.withColumn("fields", fields).withColumn("text", _tidy(F.col("untagged"))).drop("html", "bare", "untagged")
    kinds = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), F.col("fields").alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")))
    d = r.withColumn("k", F.explode(kinds)).drop("fields", "text").select("*", "k.*").drop("k")
    return d.select(
        "page_id", "record_type", F.concat(F.lit("<urn:uuid:"), F.substring(_identifier("d", F.col("record_type"), F.col("refers_to")), 11, 37)).alias("record_id"),
        "refers_to", "target_uri", "date", "content_type", F.octet_length("block").cast("long").alias("content_length"),
        _digest(F.col("block")).alias("block_digest"), "source_payload_digest", "source_block_digest", "source_headers", "block")


def serialise(records: DataFrame) -> DataFrame:
    """Records with ``bytes``: the WARC 1.1 form of each, headers, block and two line ends."""
    field = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), c, F.lit(CRLF))).otherwise("")
    have = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    block = F.coalesce("block", F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), field("WARC-Type", F.col("record_type")), field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Refers-To", have("refers_to")), field("WARC-Target-URI", F.col("target_uri")), field("WARC-Date", F.col("date")),
        field("WARC-Block-Digest", F.col("block_digest")), field("WARC-Payload-Digest", F.coalesce(have("payload_digest"), have("source_payload_digest"))),
        field("Content-Type", F.col("content_type")), field("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF))
    return records.withColumn("bytes", F.encode(F.concat(head, block, F.lit(CRLF + CRLF)), "UTF-8"))


def parse(records: DataFrame) -> DataFrame:
    """Inverse of :func:`serialise` for a column ``bytes`` of single records."""
    text = F.decode("bytes", "UTF-8")
    cut = F.locate(CRLF + CRLF, text)
    d = records.select(text.alias("t"), cut.alias("cut")).select(F.expr("substring(t, 1, cut + 1)").alias("h"), F.expr("substring(t, cut + 4)").alias("rest"))
    get = lambda name: F.nullif(F.regexp_extract("h", rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1), F.lit(""))
    return d.select(
        get("WARC-Type").alias("record_type"), get("WARC-Record-ID").alias("record_id"), get("WARC-Refers-To").alias("refers_to"),
        get("WARC-Target-URI").alias("target_uri"), get("WARC-Date").alias("date"), get("Content-Type").alias("content_type"),
        get("WARC-Block-Digest").alias("block_digest"), get("WARC-Payload-Digest").alias("payload_digest"),
        get("Content-Length").cast("long").alias("content_length"), F.expr("substring(rest, 1, length(rest) - 4)").alias("block"))


def write_warc(records: DataFrame, path: str) -> None:
    """Text files of WARC records, one per partition, compressed by Spark's writer."""
    text = F.decode("bytes", "UTF-8")
    body = serialise(records).select(F.substring(text, F.lit(1), F.length(text) - 2).alias("value"))
    body.write.option("lineSep", CRLF).option("compression", "gzip").text(path)  # the writer adds the last line end
