"""Driver queries for HTML extraction on the pages table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from valuelens.sources import html as hx
from valuelens.plans.registry import register, table

_TAGS = r"regexp_replace({x}, '<[^>]+>', '', 'g')"
_ROOT = r"regexp_extract(url, '^(https?://[^/?#]+)', 1)"


def _strip(x: str) -> str:
    """The stored pages hold only these references."""
    text = _TAGS.format(x=x)
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{ref}', '{char}')"
    return f"trim({text})"


_AFTER_TAG = """string_split(string_split(item, '">')[2], '</a>')[1]"""


@register(
    "extract_links",
    r"""
WITH l AS (
  SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"[^>]*>(.*?)</a>', 1) AS hrefs,
         regexp_extract_all(html, '<a href="([^"]*)"[^>]*>(.*?)</a>', 2) AS texts FROM pages),
u AS (SELECT page_id, url, unnest(generate_series(1, len(hrefs))) AS pos, unnest(hrefs) AS href, unnest(texts) AS text FROM l)
SELECT page_id, CAST(pos AS INTEGER) AS pos, href, """ + _strip("text") + r""" AS text,
  CASE WHEN starts_with(href, '/') THEN concat(""" + _ROOT + r""", href) ELSE href END AS abs_url
FROM u""",
)
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hx.extract_links(table(spark, sf_dir, "pages"))


@register(
    "first_link_match",
    r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"[^>]*>(.*?)</a>', 1) AS hrefs FROM pages),
u AS (SELECT page_id, unnest(generate_series(1, len(hrefs))) AS pos, unnest(hrefs) AS href FROM l)
SELECT page_id, arg_min(href, pos) AS href, CAST(min(pos) AS INTEGER) AS pos FROM u
WHERE contains(href, '/') AND contains(href, 'e') GROUP BY page_id""",
)
def first_link_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = hx.extract_links(table(spark, sf_dir, "pages"))
    return hx.first_link_matching(links, ["/", "e"])


@register(
    "extract_comments",
    r"""
WITH u AS (SELECT page_id, unnest(range(1, len(string_split(html, '<!--')))) AS pos, unnest(string_split(html, '<!--')[2:]) AS part FROM pages)
SELECT page_id, CAST(pos AS INTEGER) AS pos, trim(string_split(part, '-->')[1]) AS comment FROM u""",
)
def extract_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hx.extract_comments(table(spark, sf_dir, "pages"))


@register(
    "extract_title",
    r"""
SELECT page_id,
  nullif(""" + _strip(r"string_split(string_split(html, '<title>')[2], '</title>')[1]") + r""", '') AS title,
  nullif(""" + _strip(r"string_split(string_split(html, '<h1>')[2], '</h1>')[1]") + r""", '') AS name,
  nullif(string_split(string_split(html, '<html lang="')[2], '"')[1], '') AS lang,
  CAST(len(string_split(html, '<p>')) - 1 AS INTEGER) AS n_paragraphs,
  CAST(len(string_split(html, '<li>')) - 1 AS INTEGER) AS n_items
FROM pages""",
)
def extract_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hx.extract_fields(table(spark, sf_dir, "pages"))


@register(
    "extract_list_items",
    r"""
WITH u AS (SELECT page_id, url, unnest(range(1, len(string_split(html, '<li>')))) AS pos, unnest(string_split(html, '<li>')[2:]) AS part FROM pages),
h AS (SELECT page_id, url, pos, string_split(part, '</li>')[1] AS item, string_split(string_split(string_split(part, '</li>')[1], '<a href="')[2], '"')[1] AS href FROM u)
SELECT page_id, CAST(pos AS INTEGER) AS pos, """ + _strip(_AFTER_TAG) + r""" AS text, href,
  CASE WHEN starts_with(href, '/') THEN concat(""" + _ROOT + r""", href) ELSE href END AS abs_url
FROM h WHERE href <> ''""",
)
def extract_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hx.extract_list_items(table(spark, sf_dir, "pages"))


@register("page_records")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + S13/S14 + J5 + F6 + F7 + W9 + K2: 70-column player records from every stored page
    (fields a page does not carry stay NULL / 0): rows-only check."""
    from valuelens.plans.scrape import records_from_pages

    return records_from_pages(table(spark, sf_dir, "pages"), as_of="2025-03-01")
