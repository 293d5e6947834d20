"""Listings and details out of stored pages, as plans: which pages are read, from which source, and what a failing page means.

A page is a row.  Listing pages: (query_ord, page, source, status, server, body), source api (JSON with ``items``) or html;
detail pages: (id, source, status, server, body).  Status and server are those of the answer.  The rules are those of a
run that asks for one page after the other: reading of a query ends at its first missing or empty page, a failing page of
the structured source is skipped, one of the other source ends the run, and once the structured source is blocked, this
query and all later ones are read from pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.html import detail_of, listing_rows
from termloom.sources.pages import pages_for

_ITEM = "struct<id:string,name:string,alternate_url:string>"
_DETAIL = "struct<name:string,description:string,key_skills:array<struct<name:string>>>"
PAGE_SOURCES = ("api", "html", "auto")


def blocked() -> Column:
    """Whether an answer comes from a guard against robots."""
    return (F.col("status") == 403) & F.coalesce(F.lower("server").contains("ddos-guard"), F.lit(False))


def _checked(source: str) -> None:
    if source not in PAGE_SOURCES:
        raise ValueError(f"unknown source: {source}")


def source_of_queries(pages: DataFrame, limit: int, source: str = "auto") -> DataFrame:
    """(query_ord, source) of the queries that have pages: the wanted source, in automatic mode the structured one up to the
    query where it is blocked.  With ``api`` a blocked page raises when the rows are read."""
    _checked(source)
    queries = pages.where("query_ord is not null").select("query_ord").distinct()
    if source == "html":
        return queries.withColumn("source", F.lit("html"))
    own = pages.where((F.col("source") == "api") & (F.col("page") < pages_for(limit, "api")))
    empty = (F.col("status") == 200) & (F.coalesce(F.size(_items()), F.lit(0)) <= 0)
    ends = own.groupBy("query_ord").agg(F.min(F.when(blocked(), F.col("page"))).alias("b"), F.min(F.when(empty, F.col("page"))).alias("e"))
    first = ends.where("b is not null and (e is null or b < e)").agg(F.min("query_ord").alias("first")).scalar()
    if source == "api":
        stop = F.raise_error(F.concat(F.lit("the structured source is blocked at query "), first.cast("string"))).cast("string")
        return queries.select("query_ord", F.when(first.isNull(), "api").otherwise(stop).alias("source"))
    return queries.select("query_ord", F.when(first.isNull() | (F.col("query_ord") < first), "api").otherwise("html").alias("source"))


def _items() -> Column:
    return F.from_json("body", f"struct<items:array<{_ITEM}>>")["items"]


def listings_of_pages(pages: DataFrame, limit: int, source: str = "auto") -> DataFrame:
    """(query_ord, page, pos, id, name, alternate_url, _source) of the pages that a run with this limit reads.

    Null query numbers and pages give no row; of repeated pages one is taken.  Whole pages of the structured source are
    kept, rows of the other are cut to the limit.  A page that fails to parse is an empty one."""
    chosen = source_of_queries(pages, limit, source)
    last = F.when(F.col("source") == "api", pages_for(limit, "api")).otherwise(pages_for(limit, "html"))
    own = pages.where("query_ord is not null and page is not null").dropDuplicates(["query_ord", "page", "source"]).join(chosen, ["query_ord", "source"]).where(F.col("page") < last)
    failed = F.coalesce(F.col("status"), F.lit(0)) != 200
    fail = F.raise_error(F.concat(F.lit("page "), F.col("page"), F.lit(" of query "), F.col("query_ord"), F.lit(" failed"))).cast(f"array<{_ITEM}>")
    api, pages_ = own.where("source = 'api'"), own.where("source = 'html'")
    api = api.withColumn("items", F.when(~failed, F.coalesce(_items(), F.array().cast(f"array<{_ITEM}>")))).drop("body")  # null: skipped
    rows = F.transform(listing_rows(F.col("body")), lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"), x["alternate_url"].alias("alternate_url")))
    pages_ = pages_.withColumn("items", F.when(failed, fail).otherwise(rows)).drop("body")
    read = api.unionByName(pages_)
    of_query = Window.partitionBy("query_ord").orderBy("page")  # at most as many pages as the limit means
    empty = F.coalesce(F.size("items") == 0, F.lit(False))
    read = read.withColumn("__gap", F.row_number().over(of_query) - 1 != F.col("page")).withColumn("__end", F.max(F.col("__gap") | empty).over(of_query))
    rows = read.where("not __end").select("query_ord", "page", F.col("source").alias("_source"), F.posexplode("items").alias("at", "i")).select("query_ord", "page", "_source", "at", "i.*")
    rows = rows.withColumn("pos", (F.row_number().over(Window.partitionBy("query_ord").orderBy("page", "at")) - 1).cast("int"))
    return rows.where((F.col("_source") == "api") | (F.col("pos") < limit)).select("query_ord", "page", "pos", "id", "name", "alternate_url", "_source")


def details_of_pages(rows: DataFrame, pages: DataFrame, source: str = "auto") -> DataFrame:
    """``rows`` (id, name, _source, more) with ``detail`` (name, description, key_skills), ``used`` (api, html) and ``error``.

    Rows of pages, and all with source ``html``, are looked up in pages; the others in the structured source and, in
    automatic mode, in pages where that is blocked.  A row whose page is missing, failed or can't be parsed has an error,
    no detail, and isn't to be counted as processed.  Of repeated pages of an id one is taken."""
    _checked(source)
    one = pages.where("id is not null").dropDuplicates(["id", "source"]).withColumn("guarded", blocked())
    side = lambda s: one.where(F.col("source") == s).select("id", F.struct("status", "guarded", "body").alias(f"__{s}"))
    both = rows.join(side("api"), "id", "left").join(side("html"), "id", "left")
    by_page = F.lit(source == "html") | F.coalesce(F.col("_source") == "html", F.lit(False))
    if source == "auto":
        by_page = by_page | F.coalesce(F.col("__api.guarded"), F.lit(False))
    both = both.withColumn("used", F.when(by_page, "html").otherwise("api"))
    page = F.when(F.col("used") == "html", F.col("__html")).otherwise(F.col("__api"))
    both = both.withColumn("__page", page).drop("__api", "__html").withColumn("__ok", F.coalesce(F.col("__page.status") == 200, F.lit(False)))
    html_body = F.when(F.col("__ok") & (F.col("used") == "html"), F.col("__page.body"))
    both = both.withColumn("__parsed", detail_of(html_body, F.col("name")))
    made = F.when(F.col("used") == "html", F.when(F.col("__parsed.description").isNotNull(), F.col("__parsed").cast(_DETAIL))).otherwise(F.from_json("__page.body", _DETAIL))
    both = both.withColumn("detail", F.when(F.col("__ok"), made))
    missing, failed = F.col("__page").isNull() | F.col("__page.status").isNull(), F.concat(F.lit("status "), F.col("__page.status").cast("string"))
    error = F.when(missing, "no page").when(~F.col("__ok"), failed).when(F.col("detail").isNull(), "the page can't be read")
    return both.withColumn("error", error).drop("__page", "__ok", "__parsed")
