"""The whole run as one plan: listings, filter, deduplication, details, skills, counts, order.

What is executed while the plan is made: the dictionary is read where texts are searched, and the ranges of the final
order are written down.  The plan shuffles by id for the deduplication and the lookup, by skill for the counts, and by
ranges for the final order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.dictionary import collect_dictionary
from termloom.functions.html import html_text
from termloom.functions.text import normalize_query
from termloom.operators import counts, extract, listing, pages
from termloom.operators.ordering import numbered
from termloom.session import checkpointed
from termloom.sources.tables import table
from termloom.streaming.progress import State, fingerprint

#: Each saving is a job of its own, so a run has no more of them.
MAX_SAVES = 20


def selected(listings: DataFrame, queries: DataFrame, processed: DataFrame | None = None, limit: int | None = None, source: str = "html", columns: list[str] | None = None) -> DataFrame:
    """The listing row of each id to work on: of the queries' rows (within ``limit`` for each) those whose title matches
    their own query, of an id the first, and no id that was processed before.  ``columns`` as in
    ``listing.first_passing``."""
    if limit is not None:
        listings = listing.limit_per_query(listings, limit, source)
    named = listings.join(queries.select("query_ord", normalize_query(F.col("query_text")).alias("query")), "query_ord")
    if processed is not None:
        named = listing.not_processed(named, processed)
    return listing.first_passing(named, listing.title_matches(F.col("query"), F.col("name")), columns)


def searches_texts(mode: str, html_fallback: bool) -> bool:
    """Whether any record's text may be searched for skills."""
    return mode != "key-skills" or html_fallback


def skills_of(rows: DataFrame, details: DataFrame, dictionary: dict[str, str], mode: str = "key-skills", html_fallback: bool = False) -> DataFrame:
    """(id, query_ord, pos, skills) of the rows that have a detail record; records without skills have an empty array, those
    whose text can't be read are left out.

    Texts are searched only where a record's mode asks for it."""
    described_too = searches_texts(mode, html_fallback)
    own = details.select("id", *(["description"] if described_too else []), "key_skills", "_source")
    looked_up = rows.select("id", "query_ord", "pos").join(own, "id").withColumn("mode", extract.effective_mode(mode, F.col("_source"), html_fallback))
    if not described_too:
        described = F.array().cast("array<string>")
    else:
        wanted = (F.col("mode") != "key-skills") & F.col("description").isNotNull()
        looked_up = looked_up.withColumn("text", html_text(F.when(wanted, F.col("description")))).where(~F.coalesce(wanted, F.lit(False)) | F.col("text").isNotNull())
        described = extract.skills_in_text(F.col("text"), dictionary)
    return looked_up.withColumn("described", described).select("id", "query_ord", "pos", extract.record_skills(F.col("mode"), F.col("key_skills"), F.col("described")).alias("skills"))


def _dictionary(table_: DataFrame, mode: str, html_fallback: bool) -> dict[str, str]:
    return collect_dictionary(table_) if searches_texts(mode, html_fallback) else {}


def _details(spark: SparkSession, base: str, mode: str, html_fallback: bool) -> DataFrame:
    return listing.latest_details(table(spark, base, "vacancy"), ["key_skills", *(["description"] if searches_texts(mode, html_fallback) else [])])


def run(spark: SparkSession, base: str, mode: str = "key-skills", html_fallback: bool = False, limit: int | None = None, processed: DataFrame | None = None, source: str = "html") -> DataFrame:
    """(rank, skill, count, first_seen) over the tables in ``base``."""
    dictionary = _dictionary(table(spark, base, "skills_whitelist"), mode, html_fallback)
    rows = selected(table(spark, base, "listings"), table(spark, base, "search_queries"), processed, limit, source, columns=[])
    return counts.ranked(counts.skill_counts(skills_of(rows, _details(spark, base, mode, html_fallback), dictionary, mode, html_fallback)))


def page_skills(listing_pages: DataFrame, detail_pages: DataFrame, queries: DataFrame, dictionary: dict[str, str], mode: str = "key-skills", html_fallback: bool = False, limit: int = 2000, source: str = "auto", processed: DataFrame | None = None) -> DataFrame:
    """(id, query_ord, pos, skills, error) of the records that stored pages list; a record whose own page can't be had has
    an error and no skills.  Pages as in ``operators.pages``, ``queries`` (query_ord, query_text)."""
    listed = pages.listings_of_pages(listing_pages, limit, source)
    rows = selected(listed.where("id is not null"), queries, processed, columns=["name", "_source"])
    found = pages.details_of_pages(rows, detail_pages, source)
    good = found.where("error is null")
    details = good.select("id", "detail.description", "detail.key_skills", F.col("used").alias("_source"))
    own = skills_of(good, details, dictionary, mode, html_fallback).withColumn("error", F.lit(None).cast("string"))
    bad = found.where("error is not null").select("id", "query_ord", "pos", F.lit(None).cast("array<string>").alias("skills"), "error")
    return own.unionByName(bad)


def saved_counts(state: State, rows: DataFrame, work: Callable[[DataFrame], DataFrame], save_every: int) -> DataFrame:
    """Ranked counts of ``state`` after ``work`` has turned the rows (id, query_ord, pos, more) into skills, saved after
    ``save_every`` records, or after a ``MAX_SAVES``-th of them where that is more."""
    rows = checkpointed(numbered(rows, F.asc("query_ord"), F.asc("pos"), F.asc("id")))
    n, first = rows.count(), state.next_batch()
    size = max(save_every, -(-n // MAX_SAVES))
    for k in range(-(-n // size)):
        state.add(work(rows.where(F.col("rank").between(k * size + 1, (k + 1) * size)).drop("rank")), first + k)
    return counts.ranked(state.counts())


def _state(spark: SparkSession, path: str, queries: DataFrame, mode: str, strict: dict | None) -> State:
    state = State(spark, path)
    state.keep_for(fingerprint([r[0] for r in queries.orderBy("query_ord").select("query_text").collect()], mode, strict))
    return state


def run_saved(spark: SparkSession, base: str, path: str, mode: str = "key-skills", html_fallback: bool = False, limit: int | None = None, source: str = "html", save_every: int = 10, strict: bool = False) -> DataFrame:
    """As ``run``, with ids and counts saved in the folder ``path``: what an earlier run of the same phrases and mode (in
    strict form also dictionary, source, limit and fallback) has saved is counted and not worked on again."""
    dictionary = _dictionary(table(spark, base, "skills_whitelist"), mode, html_fallback or strict)
    queries = table(spark, base, "search_queries")
    state = _state(spark, path, queries, mode, {"dictionary": dictionary, "source": source, "limit": limit, "html_fallback": html_fallback} if strict else None)
    rows = selected(table(spark, base, "listings"), queries, state.processed(), limit, source, columns=[])
    details = _details(spark, base, mode, html_fallback)
    return saved_counts(state, rows.select("id", "query_ord", "pos"), lambda own: skills_of(own, details, dictionary, mode, html_fallback), save_every)


def run_pages(spark: SparkSession, listing_pages: DataFrame, detail_pages: DataFrame, queries: DataFrame, aliases: DataFrame, path: str, mode: str = "key-skills", html_fallback: bool = False, limit: int = 2000, source: str = "auto", save_every: int = 10, strict: bool = False) -> DataFrame:
    """As ``run_saved``, from stored pages, phrases (query_ord, query_text) and a dictionary (ord, alias, canonical).

    Records with an error are counted nowhere and aren't marked as processed, so a later run tries them again."""
    dictionary = _dictionary(aliases, mode, html_fallback or strict)
    state = _state(spark, path, queries, mode, {"dictionary": dictionary, "source": source, "limit": limit, "html_fallback": html_fallback} if strict else None)
    made = page_skills(listing_pages, detail_pages, queries, dictionary, mode, html_fallback, limit, source, state.processed())
    rows = checkpointed(made.where("error is null").drop("error"))
    return saved_counts(state, rows, lambda own: own, save_every)
