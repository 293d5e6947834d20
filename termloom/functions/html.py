"""Listing rows, detail records and plain text out of stored pages.

Each parser is a plain function over one page and is offered to Spark as an Arrow UDF or a table function; what needs
no tree (ids, addresses, the embedded skill list) is a built-in expression.
"""

from __future__ import annotations

import logging
import html
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where records without an address of their own are looked up; callers pass their site's.
BASE_URL = "https://vacancies.example/vacancy/"
#: Elements that hold no text content and never close.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: The attribute values by which a page marks its parts.
RESULT_TITLE, PAGE_TITLE, PAGE_TEXT = "serp-item__title", "vacancy-title", "vacancy-description"
_TEXT = T.StringType()
LISTING = T.ArrayType(T.StructType([T.StructField(c, _TEXT) for c in ("id", "name", "alternate_url")]))
DETAIL = T.StructType([T.StructField("name", _TEXT), T.StructField("description", _TEXT), T.StructField("key_skills", T.ArrayType(T.StructType([T.StructField("name", _TEXT)])))])


class _Parts(HTMLParser):
    """Texts of marked elements, the raw markup of one, and the scripts of linked data."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.page, self.starts = page, [0]
        for m in re.finditer("\n", page):
            self.starts.append(m.end())
        self.open: list[dict] = []
        self.links: list[dict] = []
        self.titles: list[list[str]] = []
        self.headings: list[list[str]] = []
        self.inner: tuple[int, int] | None = None
        self.linked: list[list[str]] = []
        self.text: list[str] = []
        self.silent = 0
        self.feed(page)
        self.close()
        while self.open:
            self._leave(self.open.pop(), len(page))

    def _at(self) -> int:
        line, column = self.getpos()
        return self.starts[line - 1] + column

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        node: dict = {"tag": tag, "into": []}
        mark = a.get("data-qa")
        if tag == "a" and mark == RESULT_TITLE:
            self.links.append(link := {"href": a.get("href") or "", "text": []})
            node["into"].append(link["text"])
        if mark == PAGE_TITLE:
            self.titles.append(own := [])
            node["into"].append(own)
        if tag == "h1":
            self.headings.append(own := [])
            node["into"].append(own)
        if mark == PAGE_TEXT and self.inner is None and not any("from" in x for x in self.open):
            node["from"] = self._at() + len(self.get_starttag_text() or "")
        if tag == "script" and (a.get("type") or "").lower() == "application/ld+json":
            self.linked.append(own := [])
            node["linked"] = own
        if tag in ("script", "style"):
            self.silent += 1
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if any(x["tag"] == tag for x in self.open):
            while self.open:
                node = self.open.pop()
                self._leave(node, self._at())
                if node["tag"] == tag:
                    break

    def _leave(self, node: dict, at: int) -> None:
        if "from" in node and self.inner is None:
            self.inner = node["from"], max(node["from"], at)
        if node["tag"] in ("script", "style"):
            self.silent -= 1

    def handle_data(self, data: str) -> None:
        for node in self.open:
            if "linked" in node:
                node["linked"].append(data)
            if not self.silent:
                for own in node["into"]:
                    own.append(data)
        if not self.silent:
            self.text.append(data)


def spaced(pieces: list[str]) -> str:
    """Pieces of text, each stripped, with single spaces between; how titles are read."""
    return " ".join(p for x in pieces if (p := x.strip()))


def glued_text(page: str | None) -> str | None:
    """The text of a page without its mark-up, pieces glued together with nothing between them; null for null."""
    if page is None:
        return None
    return "".join(_Parts(page).text) if "<" in page or "&" in page else page


def read_vacancy_id(text: str | None) -> str | None:
    """The number behind ``/vacancy/``, else the first word of six or more digits."""
    if not text:
        return None
    m = re.search(r"/vacancy/(\d+)", text) or re.search(r"\b(\d{6,})\b", text)
    return m[1] if m else None


def search_results(page: str | None) -> list[dict]:
    """The rows of a page of search results in their order; of equal ids on a page the first, none without an id."""
    rows: dict[str, dict] = {}
    for link in _Parts(page or "").links:
        if (i := read_vacancy_id(link["href"])) and i not in rows:
            rows[i] = {"id": i, "name": spaced(link["text"]), "alternate_url": link["href"]}
    return list(rows.values())


def embedded_skills(page: str | None) -> list[str]:
    """The skill names of the list embedded in a page's data; empty for null, a missing or a broken list.

    Texts stand for themselves; of objects the first non-empty of name, text, value and label; anything else is left out."""
    m = re.search(r'"keySkills":(null|\[.*?\]),"driverLicenseTypes"', page or "", re.S)
    try:
        items = json.loads(m[1]) if m else None
    except ValueError:
        items = None
    out = []
    for x in items or []:
        name = x if isinstance(x, str) else next((x[k] for k in ("name", "text", "value", "label") if x.get(k)), None) if isinstance(x, dict) else None
        if name:
            out.append(name if isinstance(name, str) else json.dumps(name, ensure_ascii=False))
    return out


def detail_record(page: str | None, listed_name: str | None = None) -> dict:
    """name, description and key_skills of a detail page.

    The name is the marked title, else the first heading, else the listed name.  The description is the inner mark-up
    of the marked element, else the unescaped description of the linked data, else an empty text."""
    p = _Parts(page or "")
    title = next((t for t in (*map(spaced, p.titles[:1]), *map(spaced, p.headings[:1])) if t), None) or listed_name or ""
    description = (page or "")[p.inner[0] : p.inner[1]].strip() if p.inner else ""
    if not p.inner:
        for script in p.linked:
            try:
                data = json.loads("".join(script))
            except ValueError:
                continue
            if isinstance(data, dict) and isinstance(data.get("description"), str):
                description = html.unescape(data["description"])
                break
    return {"name": title, "description": description, "key_skills": [{"name": x} for x in embedded_skills(page)]}


def isolated(parse, *args):  # noqa: ANN001, ANN002, ANN201
    """``parse(*args)``; null, with a line in the log, where it raises, so that a page doesn't end the job."""
    try:
        return parse(*args)
    except Exception:
        logging.getLogger("termloom").exception("a page can't be read and is skipped")
        return None


@F.pandas_udf(_TEXT)
def html_text(pages: pd.Series) -> pd.Series:
    """Arrow UDF of ``glued_text``; null for a page that makes the parser raise."""
    return pages.map(lambda x: isolated(glued_text, x))


@F.pandas_udf(LISTING)
def listing_rows(pages: pd.Series) -> pd.Series:
    """Arrow UDF of ``search_results``; explode it for a row each."""
    return pages.map(search_results)


@F.pandas_udf(DETAIL)
def detail_of(pages: pd.Series, names: pd.Series) -> pd.DataFrame:
    """Arrow UDF of ``detail_record``; nulls for a page that makes the parser raise."""
    return pd.DataFrame([isolated(detail_record, p, n) or {} for p, n in zip(pages, names)], columns=["name", "description", "key_skills"])


class SearchResults:
    """Table function: ``select * from pages, lateral search_results(html)``."""

    def eval(self, page: str) -> Iterator[tuple]:
        for pos, r in enumerate(search_results(page)):
            yield pos, r["id"], r["name"], r["alternate_url"]


def register(spark: SparkSession) -> None:
    """Makes the parsers known to SQL."""
    spark.udtf.register("search_results", F.udtf(SearchResults, returnType="pos int, id string, name string, alternate_url string"))
    spark.udf.register("html_text", html_text)


def vacancy_id(col: Column) -> Column:
    """``read_vacancy_id`` as an expression."""
    return F.coalesce(F.nullif(F.regexp_extract(col, r"/vacancy/(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(col, r"(?U)\b([0-9]{6,})\b", 1), F.lit("")))


def page_url(id_col: Column, base_url: str = BASE_URL) -> Column:
    """The address of a record."""
    return F.concat(F.lit(base_url), id_col)


def text_without_tags(col: Column) -> Column:
    """The text of simple mark-up by a built-in expression: tags, comments, scripts and styles out, the five entities of
    XML and the no-break space decoded.  ``html_text`` reads any mark-up."""
    s = F.regexp_replace(col, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>|<[^>]*>", "")
    for name, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        s = F.replace(s, F.lit(name), F.lit(ch))
    return s


def embedded_skill_names(col: Column) -> Column:
    """``embedded_skills`` as an expression.  Numbers in the list come out as texts here."""
    items = F.from_json(F.regexp_extract(col, r'(?s)"keySkills":(null|\[.*?\]),"driverLicenseTypes"', 1), "array<string>")
    key = lambda x, k: F.nullif(F.get_json_object(x, f"$.{k}"), F.lit(""))
    pick = lambda x: F.when(x.startswith("{"), F.coalesce(*[key(x, k) for k in ("name", "text", "value", "label")])).otherwise(x)
    return F.coalesce(F.filter(F.transform(items, pick), lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))
