"""Stored pages through an HTML parser: one pass gives every harvest output.

``parse_pages`` reads each page once (``mapInArrow``, pages stay partitioned
by Spark, so frames of few partitions are spread before) and returns heading, labelled spans, text lists, list items, pager
links and the result label.  Tags may nest, attributes stand in any order and
quoting, entities are decoded.  The functions below it are projections of that
frame, one per harvest operator.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hirewave.functions import rules
from hirewave.operators import harvest
from hirewave.session import ship_package

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_LISTS = ", ".join(f"{name} array<string>" for name in ("job_qualification", "job_description"))
_FOUND = (f"heading string, spans map<string,string>, {_LISTS}, label string, "
          "items array<struct<listed:boolean,job_key:string,href:string>>, pager array<struct<label:string,href:string>>")

# Plain markup: text, tags with quoted attributes, simple comments, the document type.  Whatever else starts with '<' is the last group.
_ATTRS = r"""(?:[ \t\n]+[A-Za-z][A-Za-z0-9:_-]*=(?:"[^"]*"|'[^']*'))*"""
_TOKEN = re.compile(rf"([^<]+)|<(?:(/?)([A-Za-z][A-Za-z0-9]*)({_ATTRS})[ \t\n]*|(!--[^<>-]+--|!(?i:doctype)[ ][^<>]*))>|(<)")
_ATTR = re.compile(r"""([A-Za-z][A-Za-z0-9:_-]*)=(?:"([^"]*)"|'([^']*)')""")
_ODD_REF = re.compile(r"&(?!(?:amp|lt|gt|quot|#39);)")  # in an attribute
#: elements whose content is not markup: plain when it is one text at most, or never
_RAW, _NOT_PLAIN = {"script", "style", "title"}, {"iframe", "noembed", "noframes", "noscript", "plaintext", "textarea", "xmp"}


class _Page(HTMLParser):
    """Collects the wanted parts of one page; a part is open until its element closes."""

    def __init__(self, heading_tag: str) -> None:
        super().__init__(convert_charrefs=True)
        self.heading_tag = heading_tag
        self.spans = {tid for _, tid in rules.DETAIL_SPANS}
        self.wanted = {"a", "div", "span", "ul", "li", heading_tag}
        self.open: list[str] = []
        self.parts: list[tuple[int, list[str]]] = []  # (depth of the element, its text nodes)
        self.found: dict[str, list[str]] = {}
        self.depth: dict[str, int] = {}  # containers that are open
        self.items: list[dict] = []
        self.inside: list[tuple[int, dict]] = []  # open list items
        self.pager: list[dict] = []
        self.text: list[str] = []

    def read_plain(self, html: str) -> bool:
        """The library's events for a page of plain markup, several times as fast; False (and half a page) where it is not plain."""
        tokens = _TOKEN.findall(html)
        for k, (text, slash, tag, attrs, other, odd) in enumerate(tokens):
            if text:
                self.text.append(unescape(text) if "&" in text else text)
            elif slash:
                if attrs:
                    return False
                self.handle_endtag(tag.lower())
            elif tag:
                tag = tag.lower()
                if tag in _NOT_PLAIN or (tag in _RAW and not _closed(tokens, k + 1, tag)):
                    return False
                if not attrs or tag not in self.wanted:
                    self.handle_starttag(tag, [])
                elif "&" in attrs and _ODD_REF.search(attrs):
                    return False
                else:
                    self.handle_starttag(tag, [(name.lower(), unescape(a or b)) for name, a, b in _ATTR.findall(attrs)])
            elif odd:
                return False
            elif other.startswith("!--"):
                self._flush()
        self._flush()
        return True

    def _flush(self) -> None:
        if self.text and not (self.open and self.open[-1] in ("script", "style")):
            for _, nodes in self.parts:
                nodes.append("".join(self.text))
        self.text = []

    def _take(self, name: str) -> None:
        if name not in self.found:
            self.found[name] = []
            self.parts.append((len(self.open), self.found[name]))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.text:
            self._flush()
        if tag not in self.wanted:
            if tag not in _VOID:
                self.open.append(tag)
            return
        at = dict(reversed(attrs))
        classes = (at.get("class") or "").split()
        if tag == "a":
            if (at.get("class") or "") == rules.PAGER_LINK_CLASS:
                self.pager.append({"label": at.get("aria-label") or "", "href": at.get("href") or ""})
            for _, item in self.inside:
                item.setdefault("href", at.get("href") or "")
        if tag == "div":
            for _, item in self.inside:
                item.setdefault("job_key", at.get("data-jobkey"))
        if tag in _VOID:
            return
        self.open.append(tag)
        tid = at.get("data-testid")
        if tag == self.heading_tag:
            self._take("heading")
        if tag == "span" and tid in self.spans:
            self._take(tid)
        if tag == "span" and rules.RESULT_LABEL_CLASS in classes:
            self._take("label")
        if tag == "div" and tid == rules.DESCRIPTION_TESTID:
            self._take("description")
        for name, hit in (("qualification", tag == "div" and tid == rules.QUALIFICATIONS_TESTID),
                          ("job-list", tag == "ul" and at.get("id") == rules.JOB_LIST_ID)):
            if hit:  # the first such container counts; 0 once it is closed
                self.depth.setdefault(name, len(self.open))
        if tag == "ul" and self.depth.get("qualification"):
            self._take("qualification")
        if tag == "li":
            item = {"listed": bool(self.depth.get("job-list")) and rules.JOB_ITEM_CLASS in classes}
            self.items.append(item)
            self.inside.append((len(self.open), item))

    def handle_endtag(self, tag: str) -> None:
        if self.text:
            self._flush()
        if tag not in self.open:
            return
        left = len(self.open) - 1 - self.open[::-1].index(tag)
        del self.open[left:]
        for some in (self.parts, self.inside):  # in order of depth
            while some and some[-1][0] > left:
                some.pop()
        for name, d in self.depth.items():
            if d > left:
                self.depth[name] = 0

    def handle_data(self, data: str) -> None:
        self.text.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()

    def row(self) -> dict:
        joined = {name: "".join(nodes) for name, nodes in self.found.items()}
        return {"heading": joined.get("heading", "").strip(), "spans": [(t, joined.get(t, "")) for t in sorted(self.spans)],
                "job_qualification": self.found.get("qualification", []), "job_description": self.found.get("description", []),
                "label": joined.get("label", "").strip(),
                "items": [{"listed": i["listed"], "job_key": i.get("job_key"), "href": i.get("href", "")} for i in self.items],
                "pager": self.pager}


def _closed(tokens: list[tuple], k: int, tag: str) -> bool:
    """Whether the tokens from ``k`` are the element's one text, if any, and its end."""
    if k < len(tokens) and tokens[k][0]:
        k += 1
    return k < len(tokens) and bool(tokens[k][1]) and tokens[k][2].lower() == tag


def parse_page(html: str | None, heading_tag: str) -> dict:
    page = _Page(heading_tag)
    if not page.read_plain(html or ""):
        page = _Page(heading_tag)
        page.feed(html or "")
        page.close()
        page._flush()
    return page.row()


def parse_pages(pages: DataFrame, heading_tag: str = "h2") -> DataFrame:
    """All columns of ``pages`` but the markup, and what was found in it, as struct ``found``.

    Missing parts are '' or empty lists, a null page has none; repeated pages come back as often as they came.
    """
    ship_package(pages.sparkSession)
    keep = [c for c in pages.columns if c != "html"]
    kind = StructType(pages.select(*keep).schema.fields + StructType().add("found", StructType.fromDDL(_FOUND)).fields)
    found_type = to_arrow_schema(kind).field("found").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [parse_page(h, heading_tag) for h in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(rows, found_type)], names=[*keep, "found"])

    return pages.select(*keep, "html").mapInArrow(run, kind)


# HRV-01
def fields(parsed: DataFrame) -> DataFrame:
    return parsed.select("page_id", F.col("found.heading").alias("job_title"),
                         *[F.col("found.spans")[tid].alias(name) for name, tid in rules.DETAIL_SPANS])


# HRV-02
def lists(parsed: DataFrame) -> DataFrame:
    return parsed.select("page_id", "found.job_qualification", "found.job_description")


# HRV-03
def list_items(parsed: DataFrame) -> DataFrame:
    """One row per <li>: the first href inside it ('' when none), its job key, and whether it is a posting of the job list."""
    return parsed.select(*[c for c in parsed.columns if c != "found"], F.explode("found.items").alias("i")).select("*", "i.*").drop("i")


# HRV-04
def detail_links(items: DataFrame) -> DataFrame:
    """Detail link = list-page url + '&job=' + job key, for the postings of the job list that have a key."""
    link = F.concat(F.col("url"), F.lit(rules.DETAIL_LINK_JOIN), F.col("job_key"))
    return items.where("listed and job_key is not null").select("page_id", link.alias("job_link"))


# HRV-05
def next_link(current_page: Column) -> Column:
    """Href of the first pager link labelled 'page n+1', else NULL."""
    want = F.concat(F.lit(rules.PAGER_LABEL), (current_page + 1).cast("string"))
    hit = F.try_element_at(F.filter("found.pager", lambda x: x["label"] == want), F.lit(1))
    return F.nullif(hit["href"], F.lit(""))


# HRV-06
def result_count() -> Column:
    return harvest.result_count(F.col("found.label"))
