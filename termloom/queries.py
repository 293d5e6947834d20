"""The registered queries of the core, each with the SQL that gives the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import html as pages
from termloom.functions import text
from termloom.functions.dictionary import collect_dictionary, conflicts
from termloom.operators import counts, extract, listing
from termloom.operators import pages as stored
from termloom.plans import pipeline
from termloom.session import checkpointed, scratch
from termloom.sinks.files import write_result, write_runs
from termloom.sources.files import load_result
from termloom.sources.tables import table
from termloom.streaming import progress

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- SQL that several queries share -------------------------------------------------------------------------------

_WS = text.PYTHON_SPACE
_NORM = lambda x: f"lower(trim(regexp_replace({x}, '[{_WS}]+', ' ', 'g'), ' '))"
_STRIP = lambda x: f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"
_QUERY = (
    lambda x: f"""(CASE WHEN length({_STRIP(x)}) >= 2 AND ({_STRIP(x)} LIKE '"%"' OR {_STRIP(x)} LIKE '''%''')
    THEN {_STRIP(f"substr({_STRIP(x)}, 2, length({_STRIP(x)}) - 2)")} ELSE {_STRIP(x)} END)"""
)
_MATCH = f"coalesce(regexp_matches(l.name, '(?i)(' || array_to_string(string_split_regex({_QUERY('q.query_text')}, '[{_WS}]|-'), '|') || ')'), false)"
_PLAIN = lambda x: "replace(" * 6 + f"regexp_replace({x}, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<[^>]*>', '', 'g')" + ", '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"
_LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY (_source = 'html'), fetched_at DESC NULLS LAST) AS rn
    FROM vacancy WHERE id IS NOT NULL) WHERE rn = 1)"""
_SELECTED = f"""selected AS (SELECT * FROM (SELECT l.*, row_number() OVER (PARTITION BY l.id ORDER BY l.query_ord, l.pos) AS rn
    FROM listings l JOIN search_queries q ON l.query_ord = q.query_ord WHERE {_MATCH} AND l.id IS NOT NULL) WHERE rn = 1)"""
_NAMES = lambda src: f"""names AS (SELECT id, skill, min(p) AS p FROM (SELECT id, {_NORM('e.name')} AS skill, p FROM
    (SELECT id, unnest(key_skills) AS e, generate_subscripts(key_skills, 1) AS p FROM {src})) WHERE skill <> '' GROUP BY id, skill)"""  # noqa: E731


def _extracted(source: str, key: str, col: str) -> str:
    """CTEs ending in ``found(key, step, canonical)``: the sequential, longest-first extraction as a recursion."""
    guard = "[^\\p{L}\\p{N}_]"
    pattern = f"'(^|{guard})' || regexp_escape(cands[step].alias) || '({guard}|$)'"
    return f"""texts AS (SELECT {key} AS k, lower({col}) AS t FROM {source} WHERE {col} IS NOT NULL),
    cand AS (SELECT k, t, list({{'alias': a.alias, 'canonical': a.canonical}} ORDER BY length(a.alias) DESC, a.ord) AS cands
        FROM texts JOIN skills_whitelist a ON contains(t, a.alias) GROUP BY k, t),
    walk(k, step, rest, cands, hit) AS (SELECT k, 1, t, cands, NULL::VARCHAR FROM cand
        UNION ALL SELECT k, step + 1, regexp_replace(regexp_replace(rest, {pattern}, '\\1 \\2', 'g'), {pattern}, '\\1 \\2', 'g'), cands,
            CASE WHEN regexp_matches(rest, {pattern}) THEN cands[step].canonical END FROM walk WHERE step <= len(cands)),
    found AS (SELECT k, hit AS skill, min(step) AS step FROM walk WHERE hit IS NOT NULL GROUP BY k, hit)"""


def _dictionary(spark: SparkSession, base: str) -> dict[str, str]:
    return collect_dictionary(table(spark, base, "skills_whitelist"))


def _queries(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "search_queries")


def _latest(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    return listing.latest_details(table(spark, base, "vacancy"), [*columns])


def _place(skills: DataFrame, key: str) -> DataFrame:
    return skills.select(key, F.posexplode("skills").alias("p", "skill")).select(key, (F.col("p") + 1).cast("bigint").alias("place"), "skill")


# ---- extraction ---------------------------------------------------------------------------------------------------


@query(f"WITH RECURSIVE {_extracted('documents', 'doc_id', 'text')} SELECT skill, count(*)::BIGINT AS n_docs FROM found GROUP BY skill")
def skill_doc_freq(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select(extract.skills_in_text(F.col("text"), _dictionary(spark, base)).alias("skills"))
    return docs.select(F.explode("skills").alias("skill")).groupBy("skill").agg(F.count("*").alias("n_docs"))


@query(f"WITH RECURSIVE {_extracted('documents', 'doc_id', 'text')} SELECT k AS doc_id, row_number() OVER (PARTITION BY k ORDER BY step)::BIGINT AS place, skill FROM found")
def skills_per_document(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", extract.skills_in_text(F.col("text"), _dictionary(spark, base)).alias("skills"))
    return _place(docs, "doc_id")


@query(f"WITH RECURSIVE {_extracted('documents', 'doc_id', 'text')} SELECT lang, skill, count(*)::BIGINT AS n_docs FROM found JOIN documents ON k = doc_id GROUP BY lang, skill")
def skill_freq_by_lang(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("lang", extract.skills_in_text(F.col("text"), _dictionary(spark, base)).alias("skills"))
    return docs.select("lang", F.explode("skills").alias("skill")).groupBy("lang", "skill").agg(F.count("*").alias("n_docs"))


@query(f"WITH RECURSIVE {_LATEST}, plain AS (SELECT id, {_PLAIN('description')} AS d FROM latest), {_extracted('plain', 'id', 'd')} SELECT k AS id, row_number() OVER (PARTITION BY k ORDER BY step)::BIGINT AS place, skill FROM found")
def description_skills(spark: SparkSession, base: str) -> DataFrame:
    rows = _latest(spark, base, "description").select("id", extract.description_skills(F.col("description"), _dictionary(spark, base)).alias("skills"))
    return _place(rows, "id")


@query(
    f"""WITH RECURSIVE {_LATEST}, {_NAMES('latest')}, plain AS (SELECT id, {_PLAIN('description')} AS d FROM latest), {_extracted('plain', 'id', 'd')},
    merged AS (SELECT id, skill, min(o) AS o FROM (SELECT id, skill, p AS o FROM names UNION ALL SELECT k, {_NORM('skill')}, 1000000 + step FROM found) GROUP BY id, skill)
    SELECT id, row_number() OVER (PARTITION BY id ORDER BY o)::BIGINT AS place, skill FROM merged"""
)
def both_mode_merge(spark: SparkSession, base: str) -> DataFrame:
    rows = _latest(spark, base, "description", "key_skills")
    described = extract.description_skills(F.col("description"), _dictionary(spark, base))
    rows = rows.withColumn("described", described)
    return _place(rows.select("id", extract.record_skills(F.lit("both"), F.col("key_skills"), F.col("described")).alias("skills")), "id")


@query(f"WITH {_LATEST}, {_NAMES('latest')} SELECT id, row_number() OVER (PARTITION BY id ORDER BY p)::BIGINT AS place, skill FROM names")
def key_skills_dedup(spark: SparkSession, base: str) -> DataFrame:
    rows = _latest(spark, base, "key_skills").select("id", extract.unique_skills(extract.key_skill_names(F.col("key_skills"))).alias("skills"))
    return _place(rows, "id")


@query(f"WITH {_LATEST}, {_NAMES('latest')} SELECT skill, count(*)::BIGINT AS n FROM names GROUP BY skill")
def key_skills_freq(spark: SparkSession, base: str) -> DataFrame:
    rows = _latest(spark, base, "key_skills").select(F.explode(extract.unique_skills(extract.key_skill_names(F.col("key_skills")))).alias("skill"))
    return rows.groupBy("skill").agg(F.count("*").alias("n"))


@query(f"WITH {_LATEST} SELECT id, CASE WHEN _source = 'html' THEN 'description' ELSE 'key-skills' END AS mode FROM latest")
def mode_fallback_dispatch(spark: SparkSession, base: str) -> DataFrame:
    return _latest(spark, base).select("id", extract.effective_mode("key-skills", F.col("_source"), True).alias("mode"))


# ---- selection and lookup -----------------------------------------------------------------------------------------


@query(f"SELECT l.query_ord, l.pos, l.id FROM listings l JOIN search_queries q ON l.query_ord = q.query_ord WHERE {_MATCH}")
def soft_title_filter(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "listings").join(_queries(spark, base).select("query_ord", text.normalize_query(F.col("query_text")).alias("query")), "query_ord")
    return rows.where(listing.title_matches(F.col("query"), F.col("name"))).select("query_ord", "pos", "id")


@query(f"WITH {_SELECTED} SELECT id, query_ord, pos FROM selected")
def soft_filter_then_dedup(spark: SparkSession, base: str) -> DataFrame:
    return pipeline.selected(table(spark, base, "listings"), _queries(spark, base), columns=[]).select("id", "query_ord", "pos")


@query("SELECT query_ord, pos, id FROM listings l WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM (SELECT unnest(processed_vacancy_ids) AS i FROM run_progress) WHERE i = l.id)")
def processed_anti_join(spark: SparkSession, base: str) -> DataFrame:
    done = table(spark, base, "run_progress").select(F.explode("processed_vacancy_ids").alias("id"))
    rows = table(spark, base, "listings").where("id is not null")
    return listing.not_processed(rows, done).select("query_ord", "pos", "id")


@query(f"WITH {_SELECTED}, {_LATEST} SELECT s.id, s.query_ord, s.pos, v.area, v._source AS detail_source FROM selected s JOIN latest v ON s.id = v.id")
def detail_lookup_join(spark: SparkSession, base: str) -> DataFrame:
    rows = pipeline.selected(table(spark, base, "listings"), _queries(spark, base), columns=[])
    return listing.with_details(rows, _latest(spark, base, "area")).select("id", "query_ord", "pos", "area", F.col("_source").alias("detail_source"))


@query(
    """WITH one AS (SELECT id, _source, min(name) AS name FROM vacancy GROUP BY id, _source), ids AS (SELECT DISTINCT id FROM listings WHERE id IS NOT NULL)
    SELECT ids.id, CASE WHEN a.id IS NOT NULL THEN a.name ELSE h.name END AS name, CASE WHEN a.id IS NOT NULL THEN 'api' WHEN h.id IS NOT NULL THEN 'html' END AS used
    FROM ids LEFT JOIN one a ON a.id = ids.id AND a._source = 'api' LEFT JOIN one h ON h.id = ids.id AND h._source = 'html'"""
)
def source_fallback_coalesce(spark: SparkSession, base: str) -> DataFrame:
    one = table(spark, base, "vacancy").groupBy("id", "_source").agg(F.min("name").alias("name"))
    ids = table(spark, base, "listings").where("id is not null").select("id").distinct()
    return listing.with_fallback(ids, one.where("_source = 'api'"), one.where("_source = 'html'"), ["name"])


@query("SELECT query_ord, pos, id FROM (SELECT *, row_number() OVER (PARTITION BY query_ord ORDER BY pos, id) AS n FROM (SELECT DISTINCT query_ord, pos, id FROM listings)) WHERE n <= 20")
def per_query_limit(spark: SparkSession, base: str) -> DataFrame:
    return listing.limit_per_query(table(spark, base, "listings").select("query_ord", "pos", "id").distinct(), 20, "html")


@query("SELECT query_ord, pos, id FROM (SELECT *, row_number() OVER (PARTITION BY query_ord ORDER BY pos, id) AS n FROM (SELECT DISTINCT query_ord, pos, id FROM listings)) WHERE n <= 200")
def page_round_limit(spark: SparkSession, base: str) -> DataFrame:
    return listing.limit_per_query(table(spark, base, "listings").select("query_ord", "pos", "id").distinct(), 150, "api")


_PAGES = "pages AS (SELECT query_ord, (pos // 5)::INT AS page, count(*) FILTER (WHERE _source = 'api')::BIGINT AS n_items FROM listings GROUP BY 1, 2)"


@query(f"WITH {_PAGES}, stop AS (SELECT query_ord, min(page) AS s FROM pages WHERE n_items = 0 GROUP BY 1) SELECT p.* FROM pages p LEFT JOIN stop USING (query_ord) WHERE s IS NULL OR page < s")
def early_stop_pages(spark: SparkSession, base: str) -> DataFrame:
    made = table(spark, base, "listings").groupBy("query_ord", F.floor(F.col("pos") / 5).cast("int").alias("page")).agg(F.count(F.when(F.col("_source") == "api", 1)).alias("n_items"))
    return listing.until_empty_page(made)


@query("SELECT count(*)::BIGINT AS total FROM listings")
def total_to_process(spark: SparkSession, base: str) -> DataFrame:
    return counts.total_to_process(table(spark, base, "listings"))


@query("SELECT query_ord, CASE WHEN query_ord >= 20 THEN 'html' ELSE 'api' END AS source FROM search_queries")
def sticky_source(spark: SparkSession, base: str) -> DataFrame:
    return listing.sticky_source(_queries(spark, base), 20)


@query(f"SELECT DISTINCT id, coalesce(alternate_url, '{pages.BASE_URL}' || id) AS alternate_url, 'api' AS _source FROM listings WHERE _source = 'api' AND id IS NOT NULL")
def annotate_api(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "listings").where("_source = 'api' and id is not null").select("id", "alternate_url")
    return listing.annotate_api(rows, pages.BASE_URL).distinct()


@query("SELECT id, count(*)::BIGINT AS n FROM (SELECT id FROM listings UNION ALL SELECT id FROM vacancy) GROUP BY id")
def page_concatenation(spark: SparkSession, base: str) -> DataFrame:
    both = table(spark, base, "listings").select("id").unionByName(table(spark, base, "vacancy").select("id"))
    return both.groupBy("id").agg(F.count("*").alias("n"))


# ---- counting and order -------------------------------------------------------------------------------------------

_RANKED = f"""{_SELECTED}, {_LATEST}, {_NAMES('latest')}, hits AS (SELECT n.skill, s.query_ord, s.pos, n.p FROM selected s JOIN names n ON n.id = s.id),
    counted AS (SELECT skill, count(*)::BIGINT AS count, min({{'q': query_ord, 'p': pos, 's': p}}) AS f FROM hits GROUP BY skill),
    ranked AS (SELECT row_number() OVER (ORDER BY count DESC, f, skill)::BIGINT AS rank, skill, count FROM counted)"""


@query(f"WITH {_RANKED} SELECT rank, skill, count FROM ranked")
def stable_tie_order(spark: SparkSession, base: str) -> DataFrame:
    return pipeline.run(spark, base).select("rank", "skill", "count")


def _counted(spark: SparkSession, base: str) -> DataFrame:
    rows = pipeline.selected(table(spark, base, "listings"), _queries(spark, base), columns=[])
    return counts.skill_counts(pipeline.skills_of(rows, _latest(spark, base, "key_skills"), {}, "key-skills"))


@query(f"WITH {_RANKED} SELECT rank, skill, count FROM ranked WHERE rank <= 50")
def topk_skills(spark: SparkSession, base: str) -> DataFrame:
    return counts.top(_counted(spark, base), 50).select("rank", "skill", "count")


@query(
    f"""WITH {_RANKED}, saved AS (SELECT {_NORM('skill')} AS skill, sum(skill_count)::BIGINT AS count FROM top_skills_all_data
        WHERE run_id = (SELECT min(run_id) FROM top_skills_all_data) AND skill_count IS NOT NULL AND {_NORM('skill')} <> '' GROUP BY 1)
    SELECT skill, sum(count)::BIGINT AS count FROM (SELECT skill, count FROM counted UNION ALL SELECT skill, count FROM saved) GROUP BY skill"""
)
def resume_merge(spark: SparkSession, base: str) -> DataFrame:
    runs = table(spark, base, "top_skills_all_data")
    own = runs.join(F.broadcast(runs.agg(F.min("run_id").alias("run_id"))), "run_id")  # one row
    saved = own.where("skill_count is not null").groupBy(text.normalize_term(F.col("skill")).alias("skill")).agg(F.min("line_no").alias("ord"), F.sum("skill_count").alias("count")).where("skill <> ''")
    return counts.resumed(_counted(spark, base), saved).select("skill", "count")


@query(f"SELECT run_id, {_STRIP('skill')} AS skill, max_by(skill_count, line_no)::BIGINT AS count FROM top_skills_all_data WHERE run_id IS NOT NULL AND skill_count IS NOT NULL AND {_STRIP('skill')} <> '' GROUP BY 1, 2")
def result_last_wins(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "top_skills_all_data").where("run_id is not null and skill_count is not null and skill is not null")
    with scratch(spark, "results") as path:
        write_runs(rows.select("run_id", "line_no", F.col("skill_count").alias("count"), "skill"), path)
        return load_result(spark, path, by="run_id").select(F.col("run_id").cast("bigint").alias("run_id"), "skill", "count")


@query(f"WITH {_RANKED} SELECT skill, count FROM counted WHERE {_STRIP('skill')} <> ''")
def csv_round_trip(spark: SparkSession, base: str) -> DataFrame:
    with scratch(spark, "result") as path:
        write_result(counts.ranked(_counted(spark, base)), path)
        return load_result(spark, path).select("skill", "count")


@query(f"WITH {_LATEST}, {_NAMES('latest')} SELECT skill, count(*)::BIGINT AS count FROM names GROUP BY skill")
def streaming_skill_freq(spark: SparkSession, base: str) -> DataFrame:
    path = f"{base.rstrip('/')}/vacancy.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4)
    whole = os.path.isfile(path)
    rows = reader.option("pathGlobFilter", "vacancy.parquet").parquet(base) if whole else reader.parquet(path)
    with scratch(spark, "stream") as folder:
        state = progress.State(spark, f"{folder}/state")
        progress.count_stream(rows, _named_skills, state, f"{folder}/checkpoint").awaitTermination()
        return checkpointed(state.counts().select("skill", "count"))


def _named_skills(details: DataFrame) -> DataFrame:
    """The skills of the records of one batch; of each id its best row there, with or without skills."""
    own = listing.latest_details(details, ["key_skills"])
    return own.select("id", F.lit(0).alias("query_ord"), F.lit(0).alias("pos"), extract.unique_skills(extract.key_skill_names(F.col("key_skills"))).alias("skills"))


@query(f"WITH {_LATEST}, {_NAMES('latest')} SELECT latest.id, count(skill)::BIGINT AS n_skills FROM latest LEFT JOIN names ON names.id = latest.id GROUP BY latest.id")
def zero_skill_rows_processed(spark: SparkSession, base: str) -> DataFrame:
    skills = checkpointed(_named_skills(table(spark, base, "vacancy")))
    with scratch(spark, "state") as folder:
        state = progress.State(spark, folder)
        state.add(skills, 0)
        return checkpointed(state.processed().join(skills, "id").select("id", F.size("skills").cast("bigint").alias("n_skills")))


@query(f"WITH {_RANKED} SELECT rank, skill, count FROM ranked")
def resume_split_equals_full(spark: SparkSession, base: str) -> DataFrame:
    details, queries = _latest(spark, base, "key_skills"), _queries(spark, base)
    work = lambda own: pipeline.skills_of(own, details, {}, "key-skills")
    listings = table(spark, base, "listings")
    with scratch(spark, "state") as folder:
        state = progress.State(spark, folder)
        began = pipeline.selected(listings, queries, columns=[]).where("query_ord < 24")  # where the first run was interrupted
        pipeline.saved_counts(state, began, work, 1000)
        rest = pipeline.selected(listings, queries, state.processed(), columns=[])
        return checkpointed(pipeline.saved_counts(state, rest, work, 1000).select("rank", "skill", "count"))


# ---- pages --------------------------------------------------------------------------------------------------------


@query(f"WITH {_LATEST} SELECT id, {_PLAIN('description')} AS text FROM latest")
def html_text_glued(spark: SparkSession, base: str) -> DataFrame:
    return _latest(spark, base, "description").select("id", pages.html_text(F.col("description")).alias("text"))


@query(f"WITH {_LATEST} SELECT id, {_PLAIN('description')} AS text FROM latest")
def html_text_native(spark: SparkSession, base: str) -> DataFrame:
    return _latest(spark, base, "description").select("id", pages.text_without_tags(F.col("description")).alias("text"))


def _escaped(col: str) -> Column:
    s = F.col(col)
    for ch, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        s = F.replace(s, F.lit(ch), F.lit(name))
    return s


@query(f"""SELECT query_ord, pos, id, {_STRIP('name')} AS name FROM (SELECT DISTINCT query_ord, pos, id, name FROM listings WHERE alternate_url IS NOT NULL AND name IS NOT NULL AND id IS NOT NULL)""")
def html_search_results(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "listings").select("query_ord", "pos", "id", "name", "alternate_url").distinct()
    link = F.concat(F.lit('<div><a data-qa="serp-item__title" href="'), "alternate_url", F.lit('"><span>'), _escaped("name"), F.lit("</span></a> <a href='/x'>more</a></div>"))
    page = F.concat(F.lit("<html><body>"), link, link, F.lit("</body></html>"))  # the same hit twice: once in the result; null where a part is
    return rows.select("query_ord", "pos", F.explode(pages.listing_rows(page)).alias("r")).select("query_ord", "pos", "r.id", "r.name")


@query("SELECT DISTINCT id, regexp_extract(alternate_url, '/vacancy/(\\d+)', 1) AS url_id FROM listings")
def url_id_extract(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "listings").select("id", pages.vacancy_id(F.col("alternate_url")).alias("url_id")).distinct()


@query(f"""WITH {_LATEST} SELECT id, e.name AS skill, count(*)::BIGINT AS n FROM (SELECT id, unnest(key_skills) AS e FROM latest) WHERE e.name <> '' GROUP BY 1, 2""")
def json_key_extract(spark: SparkSession, base: str) -> DataFrame:
    page = F.concat(F.lit('<script>window.data = {"keySkills":'), F.coalesce(F.to_json("key_skills"), F.lit("null")), F.lit(',"driverLicenseTypes":[]};</script>'))
    rows = _latest(spark, base, "key_skills").select("id", F.explode(pages.embedded_skill_names(page)).alias("skill"))
    return rows.groupBy("id", "skill").agg(F.count("*").alias("n"))


@query(f"""WITH {_LATEST} SELECT id, coalesce({_STRIP('name')}, '') AS name, coalesce({_STRIP('description')}, '') AS description FROM latest""")
def html_detail_page(spark: SparkSession, base: str) -> DataFrame:
    rows = _latest(spark, base, "name", "description")
    part = lambda c: F.coalesce(c, F.lit(""))
    page = F.concat(F.lit('<html><h1 data-qa="vacancy-title">'), part(_escaped("name")), F.lit('</h1><div data-qa="vacancy-description">'), part(F.col("description")), F.lit("</div></html>"))
    return rows.select("id", pages.detail_of(page, F.col("name")).alias("d")).select("id", text.strip(F.col("d.name")).alias("name"), text.strip(F.col("d.description")).alias("description"))


BLOCKED_FROM = 20  # the query at which the structured source is blocked in the stored pages


def _listing_pages(spark: SparkSession, base: str) -> DataFrame:
    """The listings as stored pages: of 100 rows as JSON, of 20 as mark-up; the source of JSON is blocked at one query."""
    rows = table(spark, base, "listings").where("id is not null").select("query_ord", "pos", "id", "name").distinct()
    link = F.concat(F.lit('<a data-qa="serp-item__title" href="/vacancy/'), "id", F.lit('"><span>'), F.coalesce(_escaped("name"), F.lit("")), F.lit("</span></a>"))
    page = lambda n: F.floor(F.col("pos") / n).cast("int").alias("page")
    hits = F.array_sort(F.collect_list(F.struct("pos", "id", "name", link.alias("link"))))  # the rows of a page
    refused = F.col("query_ord") == BLOCKED_FROM
    api = rows.groupBy("query_ord", page(100)).agg(hits.alias("h")).select("query_ord", "page", F.lit("api").alias("source"), F.when(refused, 403).otherwise(200).alias("status"), F.when(refused, "ddos-guard").alias("server"), F.when(~refused, F.to_json(F.struct(F.transform("h", lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"))).alias("items")))).alias("body"))
    html = rows.groupBy("query_ord", page(20)).agg(hits.alias("h")).select("query_ord", "page", F.lit("html").alias("source"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("server"), F.concat(F.lit("<html><body>"), F.array_join(F.transform("h", lambda x: x["link"]), "<br>"), F.lit("</body></html>")).alias("body"))
    return api.unionByName(html)


def _detail_pages(spark: SparkSession, base: str) -> DataFrame:
    """The details as stored pages: all as mark-up; as JSON those of the structured source, which refuses the others."""
    rows = _latest(spark, base, "name", "description", "key_skills")
    structured, none = F.col("_source") == "api", F.lit(None).cast("string")
    page = F.concat(F.lit('<html><h1 data-qa="vacancy-title">'), F.coalesce(_escaped("name"), F.lit("")), F.lit('</h1><script>{"keySkills":'), F.coalesce(F.to_json("key_skills"), F.lit("null")), F.lit(',"driverLicenseTypes":[]}</script><div data-qa="vacancy-description">'), F.coalesce("description", F.lit("")), F.lit("</div></html>"))
    api = rows.select("id", F.lit("api").alias("source"), F.when(structured, 200).otherwise(403).alias("status"), F.when(~structured, "ddos-guard").alias("server"), F.when(structured, F.to_json(F.struct("name", "description", "key_skills"))).alias("body"))
    return api.unionByName(rows.select("id", F.lit("html").alias("source"), F.lit(200).alias("status"), none.alias("server"), page.alias("body")))


_READ = f"""hits AS (SELECT DISTINCT query_ord, pos, id, name, CASE WHEN query_ord < {BLOCKED_FROM} THEN pos // 100 ELSE pos // 20 END AS page FROM listings WHERE id IS NOT NULL),
    seen AS (SELECT query_ord, page, row_number() OVER (PARTITION BY query_ord ORDER BY page) - 1 AS r FROM (SELECT DISTINCT query_ord, page FROM hits)),
    listed AS (SELECT query_ord, page, pos, id, name, row_number() OVER (PARTITION BY query_ord, page, id ORDER BY pos, name NULLS FIRST) AS k FROM hits JOIN seen USING (query_ord, page)
        WHERE r = page AND page < CASE WHEN query_ord < {BLOCKED_FROM} THEN 20 ELSE 100 END),
    l AS (SELECT * FROM listed WHERE query_ord < {BLOCKED_FROM} OR k = 1)"""


@query(f"WITH {_READ} SELECT query_ord, CASE WHEN query_ord < {BLOCKED_FROM} THEN 'api' ELSE 'html' END AS source, count(*)::BIGINT AS n_rows FROM l GROUP BY query_ord")
def auto_source_switch(spark: SparkSession, base: str) -> DataFrame:
    rows = stored.listings_of_pages(_listing_pages(spark, base), 2000)
    return rows.groupBy("query_ord", F.col("_source").alias("source")).agg(F.count("*").alias("n_rows"))


@query(
    f"""WITH {_LATEST}, src AS (SELECT id, max(_source) AS s FROM listings WHERE id IS NOT NULL GROUP BY id)
    SELECT src.id, CASE WHEN s = 'html' OR v._source = 'html' THEN 'html' ELSE 'api' END AS used, nullif({_STRIP('v.name')}, '') AS name, CASE WHEN v.id IS NULL THEN 'no page' END AS error FROM src LEFT JOIN latest v ON v.id = src.id"""
)
def detail_from_pages(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "listings").where("id is not null").groupBy("id").agg(F.max("_source").alias("_source")).withColumn("name", F.lit(None).cast("string"))
    found = stored.details_of_pages(rows, _detail_pages(spark, base))
    return found.select("id", "used", F.nullif(text.strip(F.col("detail.name")), F.lit("")).alias("name"), "error")


@query(f"WITH {_READ}, {_LATEST}, {_NAMES('latest')}, ids AS (SELECT DISTINCT l.id FROM l JOIN search_queries q ON l.query_ord = q.query_ord WHERE {_MATCH}) SELECT skill, count(*)::BIGINT AS count FROM names JOIN ids USING (id) GROUP BY skill")
def run_from_pages(spark: SparkSession, base: str) -> DataFrame:
    with scratch(spark, "state") as folder:
        ranked = pipeline.run_pages(spark, _listing_pages(spark, base), _detail_pages(spark, base), _queries(spark, base), table(spark, base, "skills_whitelist"), folder, save_every=1000)
        return checkpointed(ranked.select("skill", "count"))


# ---- names, phrases, dictionary -----------------------------------------------------------------------------------


@query(f"SELECT run_id, line_no, {_NORM('skill')} AS skill FROM top_skills_all_data WHERE skill IS NOT NULL")
def normalize_skill_names(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "top_skills_all_data").where("skill is not null").select("run_id", "line_no", text.normalize_term(F.col("skill")).alias("skill"))


@query(f"SELECT query_ord, {_QUERY('query_text')} AS query FROM search_queries")
def normalize_queries(spark: SparkSession, base: str) -> DataFrame:
    return _queries(spark, base).select("query_ord", text.normalize_query(F.col("query_text")).alias("query"))


@query(f"SELECT query_ord, '\"' || {_QUERY('query_text')} || '\"' AS query FROM search_queries")
def exact_query_quote(spark: SparkSession, base: str) -> DataFrame:
    return _queries(spark, base).select("query_ord", text.exact_query(text.exact_query(F.col("query_text"))).alias("query"))


@query("SELECT canonical, count(DISTINCT alias)::BIGINT AS n_aliases, max(length(alias))::BIGINT AS longest FROM skills_whitelist GROUP BY canonical")
def alias_dictionary(spark: SparkSession, base: str) -> DataFrame:
    rows = spark.createDataFrame([(a, c) for a, c in _dictionary(spark, base).items()], "alias string, canonical string")
    return rows.groupBy("canonical").agg(F.count_distinct("alias").alias("n_aliases"), F.max(F.length("alias")).cast("bigint").alias("longest"))


@query("SELECT alias, count(DISTINCT canonical)::BIGINT AS n_canonicals FROM (SELECT split_part(alias, ' ', 1) AS alias, canonical FROM skills_whitelist) GROUP BY alias HAVING count(DISTINCT canonical) > 1")
def alias_conflicts(spark: SparkSession, base: str) -> DataFrame:
    return conflicts(table(spark, base, "skills_whitelist").select(F.split_part("alias", F.lit(" "), F.lit(1)).alias("alias"), "canonical"))
