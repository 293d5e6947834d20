"""Paged listings as a data source: a partition for each query and page, read by any function that fetches a page.

Fetching itself is a parameter (stored pages in tests and replays); what belongs here is how many pages a limit means,
where reading stops, how a failed request is repeated and when a run changes from one source to the other.
"""

from __future__ import annotations

import json
import logging
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

log = logging.getLogger(__name__)
#: Rows of a page, and rows that the structured source gives at most.
API_PAGE, API_MOST, HTML_PAGE = 100, 2000, 20
ROWS = "query_ord int, page int, pos int, id string, name string, alternate_url string, _source string"


class SourceBlocked(RuntimeError):
    """The structured source refuses requests as those of a robot."""


class ProxyUnavailable(RuntimeError):
    """The proxy can't be reached; no request will succeed."""


class RequestFailed(RuntimeError):
    """A request failed; ``status`` is the HTTP status (null for a network error), ``retry_after`` what the server asked for."""

    def __init__(self, message: str, status: int | None = None, retry_after: str | None = None, server: str = ""):
        super().__init__(message)
        self.status, self.retry_after, self.server = status, retry_after, server


def looks_blocked(e: RequestFailed) -> bool:
    """Whether an answer comes from a guard against robots."""
    return e.status == 403 and "ddos-guard" in (e.server or "").lower()


@dataclass(frozen=True)
class RetryPolicy:
    """Repeats network errors and the statuses 403, 429 and 5xx with doubling waits; a numeric Retry-After of a 429 wins."""

    tries: int = 3
    base: float = 1.0
    longest: float = 30.0

    def repeats(self, e: RequestFailed) -> bool:
        return e.status is None or e.status in (403, 429) or e.status >= 500

    def wait(self, attempt: int, e: RequestFailed) -> float:
        if e.status == 429 and e.retry_after and e.retry_after.strip().isdigit():
            return float(e.retry_after)
        return min(self.base * 2**attempt, self.longest)

    def call(self, fetch: Callable, *args, sleep: Callable[[float], None] = time.sleep):  # noqa: ANN002, ANN201
        for attempt in range(self.tries):
            try:
                return fetch(*args)
            except RequestFailed as e:
                if attempt + 1 == self.tries or not self.repeats(e):
                    raise
                sleep(self.wait(attempt, e))
        raise ValueError("tries must be positive")


def polite_pause(least: float, most: float, sleep: Callable[[float], None] = time.sleep) -> float:
    """Waits a random time between two bounds; the time waited."""
    if not 0 <= least <= most:
        raise ValueError("delays must satisfy 0 <= least <= most")
    sleep(t := random.uniform(least, most))
    return t


def pages_for(limit: int, source: str) -> int:
    """Pages that a limit of rows takes; the structured source gives 2000 rows at most, which a warning says."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    if source == "api" and limit > API_MOST:
        log.warning("the structured source gives %d rows at most, not %d", API_MOST, limit)
    size = API_PAGE if source == "api" else HTML_PAGE
    return -(-(min(limit, API_MOST) if source == "api" else limit) // size)


def read_query(fetch: Callable[[str, int], list[dict]], query: str, limit: int, source: str, retry: RetryPolicy | None = None, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """The rows of one query.  Reading stops at the first empty page.  A page that fails is skipped for the structured
    source, unless the source is blocked; for pages any failure raises.  Only pages are cut to the limit exactly."""
    rows: list[dict] = []
    for page in range(pages_for(limit, source)):
        try:
            items = (retry or RetryPolicy()).call(fetch, query, page, sleep=sleep) if source == "api" else fetch(query, page)
        except RequestFailed as e:
            if source != "api":
                raise
            if looks_blocked(e):
                raise SourceBlocked(str(e)) from e
            continue
        if not items:
            break
        rows += items
    return rows if source == "api" else rows[:limit]


class Router:
    """The source for each query: the wanted one or, in automatic mode, the structured one until it is blocked and pages
    from then on, for all later queries too.  Rows of a query that was blocked half-way are read anew from pages."""

    def __init__(self, source: str = "auto"):
        if source not in ("api", "html", "auto"):
            raise ValueError(f"unknown source: {source}")
        self.source, self.blocked = source, False

    def read(self, query: str, limit: int, api: Callable, pages: Callable, **kwargs) -> tuple[list[dict], str]:  # noqa: ANN003
        if self.source == "html" or self.blocked:
            return read_query(pages, query, limit, "html", **kwargs), "html"
        try:
            return read_query(api, query, limit, "api", **kwargs), "api"
        except SourceBlocked:
            if self.source == "api":
                raise
            self.blocked = True
            return read_query(pages, query, limit, "html", **kwargs), "html"


class StoredPages(DataSource):
    """``spark.read.format("stored_pages")``: stored pages of results, ``<path>/<query_ord>/<page>.json`` (an object with
    ``items``) or ``.html``; a partition a query, so that a query's early stop costs no other one anything."""

    @classmethod
    def name(cls) -> str:
        return "stored_pages"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _StoredReader(self.options)


class _StoredReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = Path(options["path"])
        self.limit = int(options.get("limit", API_MOST))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p.name) for p in sorted(self.path.iterdir()) if p.is_dir() and p.name.isdigit()] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        from termloom.functions.html import search_results

        folder = self.path / partition.value
        source = "html" if any(folder.glob("*.html")) else "api"

        def fetch(_: str, page: int) -> list[dict]:
            file = folder / f"{page}.{'html' if source == 'html' else 'json'}"
            if not file.exists():
                return []
            text = file.read_text(encoding="utf-8")
            rows = search_results(text) if source == "html" else json.loads(text).get("items") or []
            return [{**r, "page": page} for r in rows]

        for pos, r in enumerate(read_query(fetch, partition.value, self.limit, source)):
            yield int(partition.value), r["page"], pos, None if r.get("id") is None else str(r["id"]), r.get("name"), r.get("alternate_url"), source


def stored_listings(spark: SparkSession, path: str, limit: int = API_MOST) -> DataFrame:
    """Listing rows of stored pages."""
    spark.dataSource.register(StoredPages)
    return spark.read.format("stored_pages").option("path", path).option("limit", str(limit)).load()
