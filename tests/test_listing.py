import pytest
from pyspark.sql import functions as F

from termloom.operators import counts, listing
from termloom.plans import pipeline

ROWS = "query_ord int, pos int, id string, name string"


def test_title_filter(spark):
    cases = [("data engineer", "Engineers wanted", True), ("аналитик данных", "Старший АНАЛИТИК", True), ("data", None, False), ("a - b", "zzz", True), ("c++", "C lover", True), ("night-shift", "Shift lead", True), ("nlp", "lead", False)]
    df = spark.createDataFrame(cases, "q string, n string, w boolean")
    assert df.where(listing.title_matches(F.col("q"), F.col("n")) != F.col("w")).count() == 0


def test_filter_comes_before_deduplication(spark):
    listings = spark.createDataFrame([(0, 0, "1", "clerk"), (1, 0, "1", "clerk"), (1, 1, "2", "clerk"), (1, 1, "2", "clerk"), (1, 2, None, "clerk"), (1, 3, "3", None)], ROWS)
    queries = spark.createDataFrame([(0, "engineer"), (1, '"clerk"')], "query_ord int, query_text string")
    got = pipeline.selected(listings, queries).select("id", "query_ord", "pos").collect()
    assert sorted(map(tuple, got)) == [("1", 1, 0), ("2", 1, 1)]
    done = spark.createDataFrame([("1",)], "id string")
    assert [r.id for r in pipeline.selected(listings, queries, done).collect()] == ["2"]


def test_limits(spark):
    rows = spark.createDataFrame([(q, p, str(p), "n") for q in (0, 1) for p in range(250)], ROWS)
    assert listing.limit_per_query(rows, 150, "api").count() == 400
    assert listing.limit_per_query(rows, 30, "html").count() == 60
    with pytest.raises(ValueError):
        listing.limit_per_query(rows, 0)


def test_pages_stop_at_the_first_empty_one(spark):
    pages = spark.createDataFrame([(0, 0, 3), (0, 1, 0), (0, 2, 5), (1, 0, 1), (2, 0, None)], "query_ord int, page int, n_items int")
    assert sorted((r.query_ord, r.page) for r in listing.until_empty_page(pages).collect()) == [(0, 0), (1, 0)]


def test_lookup_and_fallback(spark):
    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "id string, name string")
    api, page = spark.createDataFrame([("1", None)], "id string, name string"), spark.createDataFrame([("1", "z"), ("2", "y")], "id string, name string")
    assert sorted((r.id, r.name, r.used) for r in listing.with_fallback(rows, api, page, ["name"]).collect()) == [("1", None, "api"), ("2", "y", "html"), ("3", None, None)]
    assert sorted((r.id, r.detail_name) for r in listing.with_details(rows, page).collect()) == [("1", "z"), ("2", "y")]
    assert [r.source for r in listing.sticky_source(spark.range(4).select(F.col("id").alias("query_ord")), 2).orderBy("query_ord").collect()] == ["api", "api", "html", "html"]
    assert {r.alternate_url for r in listing.annotate_api(spark.createDataFrame([("1", None), ("2", "u")], "id string, alternate_url string"), "b/").collect()} == {"b/1", "u"}


def counted(spark, rows):
    return counts.skill_counts(spark.createDataFrame(rows, "query_ord int, pos int, skills array<string>"))


def test_counts_and_stable_ties(spark):
    c = counted(spark, [(0, 0, ["b", "a"]), (0, 1, ["c", "a"]), (1, 0, ["c", "d"]), (1, 1, [])])
    assert [(r["rank"], r.skill, r["count"]) for r in counts.ranked(c).orderBy("rank").collect()] == [(1, "a", 2), (2, "c", 2), (3, "b", 1), (4, "d", 1)]
    assert [r.skill for r in counts.top(c, 2).orderBy("rank").collect()] == ["a", "c"]
    assert counts.top(c, 0).count() == 0
    with pytest.raises(ValueError):
        counts.top(c, -1)
    saved = spark.createDataFrame([(0, "z", 1), (1, "d", 1)], "ord int, skill string, count long")
    assert [(r.skill, r["count"]) for r in counts.ranked(counts.resumed(c, saved)).orderBy("rank").collect()] == [("d", 2), ("a", 2), ("c", 2), ("z", 1), ("b", 1)]


def test_split_runs_equal_one(spark):
    rows = [(q, p, [f"s{(q * p) % 5}", f"t{p % 3}"]) for q in range(3) for p in range(9)]
    whole = counted(spark, rows)
    first = counts.ranked(counted(spark, rows[:11])).select((F.col("rank") - 1).alias("ord"), "skill", "count")
    both = counts.resumed(counted(spark, rows[11:]), first)
    assert {(r.skill, r["count"]) for r in both.collect()} == {(r.skill, r["count"]) for r in whole.collect()}


def test_empty_everything(spark):
    c = counted(spark, [])
    assert counts.ranked(c).count() == 0 and counts.top(c, 5).count() == 0
    assert counts.total_to_process(spark.createDataFrame([], ROWS)).first().total == 0
