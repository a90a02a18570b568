"""Stored HTML pages as trees: a tag stack over the tokens of the standard library's HTML parser.

Regular expressions over raw HTML go wrong where tags nest, stand inside comments or scripts, or share the
beginning of their name. ``parse`` reads a page once and keeps, per element, its tag, attributes, parent and the
span of nodes and of text that it covers, so that "the first link in this item" or "the cells of this row, not
those of a table inside one" are span tests. Rules are those of a lenient parser without implied
end tags: an end tag closes the nearest open element of its name and all opened after it, an end tag without
one is ignored, elements left open end with the page, of repeated attributes the last one counts, references
are decoded in texts and attribute values, and text of scripts, styles and templates belongs to no element.

``records`` runs a function of the tree over Arrow batches and returns one row per record, in document order;
a page is the unit of work, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from valuelens.session import ship_package

#: Elements that never have content (fixed by the HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(["script", "style", "template"])


class Tree:
    """Elements of a page in document order; element i covers elements i + 1 .. last[i] and texts first[i] .. end[i] - 1."""

    def __init__(self):
        self.tag: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.parent: list[int] = []
        self.last: list[int] = []
        self.first: list[int] = []
        self.end: list[int] = []
        self.texts: list[str] = []
        self.comments: list[str] = []

    def text(self, i: int) -> str:
        """Text inside element i, ends trimmed."""
        return "".join(self.texts[self.first[i] : self.end[i]]).strip()

    def find(self, tag: str, within: int | None = None, **attrs: str) -> Iterator[int]:
        """Elements of that tag (and with these attributes; data_x stands for data-x) in the page or inside an element."""
        want = {k.replace("_", "-"): v for k, v in attrs.items()}
        lo, hi = (0, len(self.tag)) if within is None else (within + 1, self.last[within] + 1)
        for i in range(lo, hi):
            if self.tag[i] == tag and all(self.attrs[i].get(k) == v for k, v in want.items()):
                yield i

    def nearest(self, i: int, tag: str) -> int:
        """The closest element of that tag around element i, -1 if there is none."""
        while (i := self.parent[i]) >= 0 and self.tag[i] != tag:
            pass
        return i

    def link(self, i: int) -> str | None:
        """Address of the first link with one inside element i."""
        return next((h for a in self.find("a", i) if (h := self.attrs[a].get("href"))), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tree, self.open, self.hidden = Tree(), [], 0

    def handle_starttag(self, tag, attrs):
        t = self.tree
        t.tag.append(tag)
        t.attrs.append({k: v or "" for k, v in attrs})
        t.parent.append(self.open[-1] if self.open else -1)
        t.last.append(len(t.tag) - 1)
        t.first.append(len(t.texts))
        t.end.append(len(t.texts))
        if tag not in VOID:
            self.open.append(len(t.tag) - 1)
            self.hidden += tag in HIDDEN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        t = self.tree
        at = next((k for k in range(len(self.open) - 1, -1, -1) if t.tag[self.open[k]] == tag), None)
        if at is not None:
            for i in self.open[at:]:
                t.last[i], t.end[i] = len(t.tag) - 1, len(t.texts)
                self.hidden -= t.tag[i] in HIDDEN
            del self.open[at:]

    def handle_data(self, data):
        if not self.hidden:
            self.tree.texts.append(data)

    def handle_comment(self, data):
        self.tree.comments.append(data)

    def finished(self) -> Tree:
        self.close()
        for i in self.open:
            self.tree.last[i], self.tree.end[i] = len(self.tree.tag) - 1, len(self.tree.texts)
        return self.tree


def parse(html: str | None) -> Tree:
    """The tree of a page; null is an empty page."""
    builder = _Builder()
    builder.feed(html or "")
    return builder.finished()


def with_commented(tree: Tree, wanted: Callable[[Tree], list[int]]) -> Iterator[tuple[Tree, int]]:
    """Wanted elements of the page, or, if it has none in the open, those of the markup in its comments."""
    found = [(tree, i) for i in wanted(tree)]
    if not found:
        for comment in tree.comments:
            inner = parse(comment)
            found += [(inner, i) for i in wanted(inner)]
    yield from found


def own_rows(tree: Tree, table: int) -> list[int]:
    """Rows of a table, not those of tables inside it."""
    return [r for r in tree.find("tr", table) if tree.nearest(r, "table") == table]


def own_cells(tree: Tree, row: int) -> list[int]:
    """Header and data cells of a row in document order, not those of rows inside it."""
    return [c for c in range(row + 1, tree.last[row] + 1) if tree.tag[c] in ("th", "td") and tree.nearest(c, "tr") == row]


def cell(tree: Tree, row: int, tag: str, stat: str) -> int | None:
    """The row's first own cell of that tag with that data-stat."""
    return next((c for c in own_cells(tree, row) if tree.tag[c] == tag and tree.attrs[c].get("data-stat") == stat), None)


def records(pages: DataFrame, html_col: str, carry: Sequence[str], find: Callable[[Tree], Iterator[tuple]], fields: str) -> DataFrame:
    """One row per record that ``find`` yields for a page's tree: the page's ``carry`` columns and ``fields``."""
    ship_package(pages.sparkSession)
    kinds = {f.name: f for f in pages.schema}
    schema = StructType([*[kinds[c] for c in carry], *StructType.fromDDL(fields)])
    names, types = schema.names, [f.type for f in to_arrow_schema(StructType.fromDDL(fields))]

    def run(batches):
        for b in batches:
            page, found = [], []
            for i, html in enumerate(b.column("__html").to_pylist()):
                for r in find(parse(html)):
                    page.append(i)
                    found.append(r)
            at = pa.array(page, pa.int64())
            columns = list(zip(*found)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in carry], *[pa.array(c, t) for c, t in zip(columns, types)]], names=names)

    return pages.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{html_col}`").alias("__html")).mapInArrow(run, schema)
