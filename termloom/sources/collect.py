"""Collecting pages with a caller's fetcher, and the tables of what was collected.

A fetcher is made by ``make(settings)`` and has ``listing(source, query, page)`` and ``detail(source, id, url)``, which return
the text of an answer or raise ``RequestFailed``; region, proxy, user agent and time limit are in the settings.  Collecting
is one request after the other with polite pauses, as the sites asked want it; what is collected is then read in parallel.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterable
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.html import search_results
from termloom.plans.settings import Settings
from termloom.sources.pages import ProxyUnavailable, RequestFailed, RetryPolicy, looks_blocked, pages_for, polite_pause

ENDING = {"api": "json", "html": "html"}


def load_fetcher(name: str, settings: Settings) -> Any:
    """The fetcher that ``module:function`` makes for the settings."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)(settings)


def _ask(call: Callable, source: str, settings: Settings, file: Path, sleep: Callable[[float], None]) -> tuple[str | None, bool]:
    """(text, blocked) of a request; the answer is stored as ``file`` with the ending of its source, or of its status."""
    try:
        text = RetryPolicy().call(call, sleep=sleep) if source == "api" else call()
    except RequestFailed as e:
        if e.status is None and settings.proxy:
            raise ProxyUnavailable(str(e)) from e
        file.with_suffix(f".{e.status or 599}").write_text(e.server or "", encoding="utf-8")
        return None, looks_blocked(e)
    file.with_suffix("." + ENDING[source]).write_text(text, encoding="utf-8")
    if source == "api":
        for old in file.parent.glob(file.name + ".[0-9][0-9][0-9]"):  # an earlier refusal
            old.unlink()
    return text, False


def collect_listings(fetcher: Any, phrases: Iterable[tuple[int, str]], settings: Settings, folder: str, sleep: Callable[[float], None] = time.sleep) -> str:
    """Stores the listing pages of the phrases under ``<folder>/<query_ord>/``; the source that the next request would use.

    Pages that are there already are not asked for again.  A proxy that can't be reached ends all."""
    source = "html" if settings.source == "html" else "api"
    for number, phrase in phrases:
        own = Path(folder) / str(number)
        own.mkdir(parents=True, exist_ok=True)
        page = 0
        while page < pages_for(settings.vacancies_limit, source):
            file = own / str(page)
            if (there := file.with_suffix("." + ENDING[source])).exists():
                text = there.read_text(encoding="utf-8")
            else:
                text, blocked = _ask(lambda: fetcher.listing(source, phrase, page), source, settings, file, sleep)  # noqa: B023
                if blocked and settings.source == "auto":
                    source, page = "html", 0  # this query anew, and all later ones
                    continue
                if text is None and (source == "html" or blocked):
                    raise RequestFailed(f"page {page} of {phrase!r} failed")
                polite_pause(settings.page_delay_min, settings.page_delay_max, sleep)
            if text is not None and not (search_results(text) if source == "html" else json.loads(text).get("items")):
                break
            page += 1
    return source


def collect_details(fetcher: Any, rows: Iterable[tuple[str, str | None, str]], settings: Settings, folder: str, sleep: Callable[[float], None] = time.sleep) -> int:
    """Stores the detail pages of rows (id, address, source) as ``<folder>/<id>.<ending>``; the number of requests."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    asked = 0
    for id_, url, own in rows:
        source = "html" if "html" in (settings.source, own) else "api"
        file = Path(folder) / id_
        while not file.with_suffix("." + ENDING[source]).exists():
            _, blocked = _ask(lambda: fetcher.detail(source, id_, url), source, settings, file, sleep)  # noqa: B023
            asked += 1
            polite_pause(settings.vacancy_delay_min, settings.vacancy_delay_max, sleep)
            if not blocked or settings.source != "auto" or source == "html":
                break
            source = "html"
    return asked


def stored(spark: SparkSession, folder: str, pattern: str, names: dict[str, str]) -> DataFrame:
    """(the named parts of the path, source, status, server, body) of stored answers whose path ends with ``pattern``, whose
    last group is the ending.  A refused answer is a file named by its status that holds the server's name."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(folder)
    part = lambda k: F.regexp_extract(F.col("_metadata.file_path"), pattern, k)
    named = files.select(*[part(k).cast(kind).alias(n) for k, (n, kind) in enumerate(names.items(), 1)], part(len(names) + 1).alias("kind"), F.col("value"))
    refused = F.col("kind").rlike(r"^\d{3}$")
    return named.where("kind <> ''").select(
        *names,
        F.when(F.col("kind") == "html", "html").otherwise("api").alias("source"),
        F.when(refused, F.col("kind").cast("int")).otherwise(200).alias("status"),
        F.when(refused, F.col("value")).alias("server"),
        F.when(~refused, F.col("value")).alias("body"),
    )


def stored_listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing pages as ``operators.pages`` reads them."""
    return stored(spark, folder, r"/(\d+)/(\d+)\.(\w+)$", {"query_ord": "int", "page": "int"})


def stored_detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Detail pages as ``operators.pages`` reads them."""
    return stored(spark, folder, r"/([^/]+)\.(\w+)$", {"id": "string"})
