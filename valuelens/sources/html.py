"""Extraction from stored HTML pages (S10-S16) over a ``pages`` table.

The crawl itself is out of scope: pages arrive as rows ``(page_id, url, html)``.
Links are JVM regexes followed by ``posexplode``. Lists, tables, comments and fields depend on how
elements nest and are read from the page's tree (``html_tree``), over Arrow batches. Either way extraction
is a narrow transformation over the whole HTML text: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuelens.functions.text import decode_entities, parse_currency
from valuelens.sources import html_tree as ht

# an attribute may stand anywhere in its tag and be quoted either way; anchors may span lines
LINK_RE = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"'>]*)["'][^>]*>(.*?)</a\s*>"""
TAG_RE = r"<[^>]+>"


def site_root(url: Column | str) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(u, r"^(https?://[^/?#]+)", 1)


def absolute_href(href: Column, url: Column) -> Column:
    """hrefs starting with '/' are prefixed with the page's scheme and host."""
    return F.when(href.startswith("/"), F.concat(site_root(url), href)).otherwise(href)


def strip_tags(c: Column) -> Column:
    """Text of an HTML fragment as a parser gives it: tags removed, character references decoded, ends trimmed."""
    return F.trim(decode_entities(F.regexp_replace(c, TAG_RE, "")))


def extract_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per ``<a href>`` in document order: (id, pos 1.., href, text, abs_url)."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(LINK_RE), 1)
    texts = F.regexp_extract_all(F.col(html_col), F.lit(LINK_RE), 2)
    z = pages.select(id_col, url_col, F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias("p", "l"))
    z = z.select(id_col, url_col, (F.col("p") + 1).alias("pos"), decode_entities(F.col("l.href")).alias("href"), strip_tags(F.col("l.text")).alias("text"))
    return z.select(id_col, "pos", "href", "text", absolute_href(F.col("href"), F.col(url_col)).alias("abs_url"))


def first_link_matching(links: DataFrame, needles: Sequence[str], id_col: str = "page_id") -> DataFrame:
    """Per page, the first href (by position) that contains every needle."""
    cond = None
    for n in needles:
        c = F.col("href").contains(n)
        cond = c if cond is None else (cond & c)
    return links.filter(cond).groupBy(id_col).agg(F.min_by("href", "pos").alias("href"), F.min("pos").alias("pos"))


def extract_comments(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", needle: str | None = None) -> DataFrame:
    """Text of every HTML comment, in order; optional substring filter. Markup inside scripts is no comment."""
    def find(tree: ht.Tree):
        yield from ((n, c) for n, c in enumerate(tree.comments, 1))

    out = ht.records(pages, html_col, [id_col], find, "pos int, comment string").withColumn("comment", F.trim("comment"))
    return out.filter(F.col("comment").contains(needle)) if needle else out


def extract_fields(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Key fields of a profile page: title, h1 name, lang, number of paragraphs and list items."""
    def find(tree: ht.Tree):
        first = lambda tag: next((tree.text(i) for i in tree.find(tag)), "") or None
        lang = next((tree.attrs[i].get("lang") for i in tree.find("html")), None) or None
        yield first("title"), first("h1"), lang, sum(1 for _ in tree.find("p")), sum(1 for _ in tree.find("li"))

    return ht.records(pages, html_col, [id_col], find, "title string, name string, lang string, n_paragraphs int, n_items int")


def extract_list_items(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """S11 on lists: every ``<li>`` that carries a link -> (id, pos, text, href); items without a link are
    skipped. ``pos`` counts all items of the page; an item with a list inside covers it, as in the page."""
    def find(tree: ht.Tree):
        for n, i in enumerate(tree.find("li"), 1):
            href = tree.link(i)
            if href:
                yield n, tree.text(i), href

    z = ht.records(pages, html_col, [id_col, url_col], find, "pos int, text string, href string")
    return z.select(id_col, "pos", "text", "href", absolute_href(F.col("href"), F.col(url_col)).alias("abs_url"))


def extract_table_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                       require_link: bool = True, header_class: str = "thead") -> DataFrame:
    """Rows of HTML tables -> (id, row_pos, cells array, href); header rows (class=thead) and,
    optionally, rows without a link are skipped. A row's cells are its own; rows of a table inside a cell are rows too."""
    def find(tree: ht.Tree):
        for n, r in enumerate(tree.find("tr"), 1):
            href = tree.link(r)
            if header_class not in tree.attrs[r].get("class", "").split() and (href or not require_link):
                yield n, [tree.text(c) for c in ht.own_cells(tree, r)], href

    return ht.records(pages, html_col, [id_col], find, "row_pos int, cells array<string>, href string")


def stat_pairs(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", table_id_contains: str = "scout_full",
               use_comments: bool = True) -> DataFrame:
    """S13 (+S14): (id, pos, stat_label, per90 text) from stat tables whose id contains
    ``table_id_contains``; tables hidden in comments are read only when the page has none in the open."""
    def wanted(tree: ht.Tree) -> list[int]:
        return [t for t in tree.find("table") if table_id_contains in tree.attrs[t].get("id", "")]

    def find(tree: ht.Tree):
        tables = ht.with_commented(tree, wanted) if use_comments else ((tree, t) for t in wanted(tree))
        rows = [(t, r) for t, table in tables for r in ht.own_rows(t, table)]
        for n, (t, r) in enumerate(rows, 1):
            label, value = ht.cell(t, r, "th", "statistic"), ht.cell(t, r, "td", "per90")
            if label is not None and value is not None and t.text(label) and t.text(value):
                yield n, t.text(label), t.text(value)

    return ht.records(pages, html_col, [id_col], find, "pos int, stat_label string, per90 string")


def first_valid_price(cells: DataFrame, id_col: str, pos_col: str, text_col: str) -> DataFrame:
    """Per id, the first cell (by position) containing '€' whose amount parses (million)."""
    parsed = cells.filter(F.col(text_col).contains("€")).withColumn("value_m", parse_currency(text_col))
    return parsed.filter(F.col("value_m").isNotNull()).groupBy(id_col).agg(F.min_by("value_m", pos_col).alias("value_m"))


def expand_children(parents: DataFrame, links: DataFrame, parent_key: str, link_parent_key: str, child_key: str,
                    has_report: DataFrame | None = None) -> DataFrame:
    """Parent -> child rows through an extracted link table; children without a report are skipped (semi join)."""
    out = parents.join(links, parents[parent_key] == links[link_parent_key])
    if has_report is not None:
        out = out.join(has_report.select(child_key).distinct(), child_key, "left_semi")
    return out


def club_player_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                     table_prefix: str = "stats_standard") -> DataFrame:
    """S11 on club pages: rows of the standard-stats table (in the open, or inside a comment when
    absent) that have a linked player cell -> name, absolute URL and six typed basics."""
    from valuelens.functions.text import clean_number

    stats = ["games", "minutes", "goals", "assists", "xg", "xg_assist"]

    def wanted(tree: ht.Tree) -> list[int]:
        return [t for t in tree.find("table") if tree.attrs[t].get("id", "").startswith(table_prefix)]

    def find(tree: ht.Tree):
        rows = [(t, r) for t, table in ht.with_commented(tree, wanted) for r in ht.own_rows(t, table)]
        for n, (t, r) in enumerate(rows, 1):
            player = ht.cell(t, r, "th", "player")
            href = t.link(player) if player is not None else None
            if href and "thead" not in t.attrs[r].get("class", "").split():
                cells = [ht.cell(t, r, "td", s) for s in stats]
                yield n, t.text(player), href, *[None if c is None else t.text(c) for c in cells]

    z = ht.records(pages, html_col, [id_col, url_col], find, "pos int, player_name string, href string, " + ", ".join(f"{s} string" for s in stats))
    whole = lambda s: clean_number(F.col(s), False).cast("int")
    return z.select(
        id_col, "pos", "player_name", absolute_href(F.col("href"), F.col(url_col)).alias("player_url"),
        whole("games").alias("appearances"), whole("minutes").alias("minutes_played"), whole("goals").alias("goals"), whole("assists").alias("assists"),
        clean_number(F.col("xg"), True).alias("xG"), clean_number(F.col("xg_assist"), True).alias("xAG"),
    )


def profile_fields(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Name (h1), nationality (first /country/ link), date of birth (necro-birth data attribute),
    height (a span ending in 'cm'), position and foot (regex on the text, non-breaking spaces as spaces)."""
    from valuelens.functions.text import parse_height_cm, regex_capture

    def find(tree: ht.Tree):
        name = next((tree.text(i) for i in tree.find("h1")), "") or None
        nation = next((tree.text(i) for i in tree.find("a") if "/country/" in tree.attrs[i].get("href", "")), "") or None
        born = next((tree.attrs[i].get("data-birth") for i in tree.find("span", id="necro-birth")), None) or None
        height = next((t for i in tree.find("span") if (t := tree.text(i)).endswith("cm")), None)
        yield name, nation, born, height, " ".join(tree.texts).replace("\xa0", " ")

    z = ht.records(pages, html_col, [id_col], find, "player_name string, nationality string, dob string, height_text string, page_text string")
    return z.select(
        id_col, "player_name", "nationality", "dob", parse_height_cm(F.col("height_text")).alias("height"),
        regex_capture(F.col("page_text"), r"Position:\s*([A-Za-z0-9\-]+)").alias("position"),
        regex_capture(F.col("page_text"), r"Footed:\s*([A-Za-z]+)").alias("foot"),
    )
