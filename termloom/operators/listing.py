"""Choosing and looking up records: title filter, deduplication across queries, limits and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import PYTHON_SPACE

#: Fixed value: rows of a page of the structured source.
API_PAGE = 100


def title_pattern(query: Column) -> Column:
    """The pattern that finds any word of a query; words are not escaped, they may be patterns themselves."""
    return F.concat(F.lit("(?iu)("), F.array_join(F.split(query, f"[{PYTHON_SPACE}]|-"), "|"), F.lit(")"))


def title_matches(query: Column, name: Column) -> Column:
    """Whether any word of the query occurs in the title, as a part of a word too; false for a null title."""
    return F.coalesce(F.regexp_like(name, title_pattern(query)), F.lit(False))


def not_processed(rows: DataFrame, processed: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows whose id isn't in ``processed``."""
    return rows.join(processed.select(id_col), id_col, "left_anti")


def first_passing(rows: DataFrame, passes: Column, columns: list[str] | None = None) -> DataFrame:
    """Of each id the first row, by query and position, that passes: a row that fails leaves its id to later queries.

    The earliest row is found by an aggregation with map-side combining, not by sorting all rows of an id.  Of rows
    equal in query and position the one with the smallest remaining columns is taken; null ids are left out.
    ``columns`` are those wanted beside id, query_ord and pos.  Where that are none, both numbers (not null, not negative)
    travel as one, which keeps the aggregation in hash tables."""
    order = ["query_ord", "pos"]
    rest = sorted(c for c in rows.columns if c not in ("id", *order) and (columns is None or c in columns))
    if not rest:
        place = F.shiftleft(F.col("query_ord").cast("long"), 32) + F.col("pos").cast("long")
        first = rows.where(passes & F.col("id").isNotNull()).groupBy("id").agg(F.min(place).alias("p"))
        return first.select("id", F.shiftright("p", 32).cast("int").alias("query_ord"), F.col("p").bitwiseAND(0xFFFFFFFF).cast("int").alias("pos"))
    first = rows.where(passes & F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct(*order, *rest)).alias("r"))
    return first.select(*[F.col("id") if c == "id" else F.col(f"r.{c}").alias(c) for c in rows.columns if c in ("id", *order, *rest)])


def limit_per_query(rows: DataFrame, limit: int, source: str = "html") -> DataFrame:
    """The first rows of each query: exactly ``limit`` of a source of pages, whole pages of 100 of the structured one;
    with ``auto`` a query with any row from a page counts as the first.

    Each task keeps its own first rows of a query before the shuffle, however large the limit: the session's threshold for
    that is raised where it is lower."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    pages = -(-limit // API_PAGE) * API_PAGE
    most = limit if source == "html" else pages
    conf, name = rows.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(conf.get(name)) < most:
        conf.set(name, str(most))
    order = Window.partitionBy("query_ord").orderBy("pos", "id")
    first = rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= most)
    if source == "auto":
        by_page = rows.groupBy("query_ord").agg(F.max(F.coalesce(F.col("_source") == "html", F.lit(False))).alias("__html"))  # a row a query
        first = first.join(by_page, "query_ord").where(~F.col("__html") | (F.col("__n") <= limit)).drop("__html")
    return first.select(*[F.col(f"`{c}`") for c in rows.columns])


def until_empty_page(pages: DataFrame) -> DataFrame:
    """The pages (query_ord, page, n_items) before the first empty one of their query."""
    stop = F.min(F.when(F.coalesce("n_items", F.lit(0)) == 0, F.col("page"))).over(Window.partitionBy("query_ord"))
    return pages.withColumn("__stop", stop).where(F.col("__stop").isNull() | (F.col("page") < F.col("__stop"))).drop("__stop")


def latest_details(details: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One detail row an id: a structured one before one of a page, then the last fetched; ties by the smallest content.

    ``columns`` are those wanted beside id, _source and fetched_at: only they are read and moved.  Each task keeps one row
    of an id before the shuffle."""
    content = sorted(c for c, k in details.dtypes if c not in ("id", "_source", "fetched_at") and not k.startswith("map") and (columns is None or c in columns))
    order = [F.coalesce(F.col("_source") == "html", F.lit(False)), F.desc_nulls_last("fetched_at"), *[F.col(f"`{c}`") for c in content], F.col("_source")]
    wanted = [c for c in details.columns if c in ("id", *content, "_source", "fetched_at")]
    rows = details.where(F.col("id").isNotNull()).select(*[F.col(f"`{c}`") for c in wanted])
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy("id").orderBy(*order))).where("__n = 1").drop("__n")


def with_details(rows: DataFrame, details: DataFrame) -> DataFrame:
    """Rows with their detail record (inner); columns of the detail that clash get the prefix ``detail_``."""
    named = details.select("id", *[F.col(c).alias(f"detail_{c}" if c in rows.columns else c) for c in details.columns if c != "id"])
    return rows.join(named, "id")


def with_fallback(rows: DataFrame, first: DataFrame, second: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with ``columns`` of the first source that has their id, and ``used`` (api, html, or null for neither)."""
    side = lambda df, s: df.select("id", F.struct(*columns).alias(s))
    both = rows.join(side(first, "__a"), "id", "left").join(side(second, "__b"), "id", "left")
    used = F.when(F.col("__a").isNotNull(), "api").when(F.col("__b").isNotNull(), "html")
    pick = [F.when(F.col("__a").isNotNull(), F.col(f"__a.{c}")).otherwise(F.col(f"__b.{c}")).alias(c) for c in columns]
    return both.select(*[c for c in rows.columns if c not in columns], *pick, used.alias("used"))


def annotate_api(rows: DataFrame, base_url: str) -> DataFrame:
    """Rows of the structured source marked as such, with an address where there is none."""
    return rows.withColumn("_source", F.lit("api")).withColumn("alternate_url", F.coalesce("alternate_url", F.concat(F.lit(base_url), F.col("id"))))


def sticky_source(queries: DataFrame, blocked_from: int | None) -> DataFrame:
    """(query_ord, source): the structured source until a query is blocked, pages from there on to the end."""
    blocked = F.lit(False) if blocked_from is None else F.col("query_ord") >= blocked_from
    return queries.select("query_ord", F.when(blocked, "html").otherwise("api").alias("source"))
