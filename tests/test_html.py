from pyspark.sql import functions as F

from termloom.functions import html

PAGE = """<html><body><h1 data-qa="vacancy-title">ML <b>Engineer</b></h1>
<div data-qa="vacancy-description"><p>Python &amp; SQL<br>in production.</p><div>more</div></div>
<script>window.data = {"keySkills":[{"name":"Python"},"SQL",{"text":"Airflow"},{"label":"x","value":"Spark"},3,{}],"driverLicenseTypes":[]};</script></body></html>"""


def test_detail_page():
    got = html.detail_record(PAGE, "listed")
    assert got["name"] == "ML Engineer"
    assert got["description"] == "<p>Python &amp; SQL<br>in production.</p><div>more</div>"
    assert [x["name"] for x in got["key_skills"]] == ["Python", "SQL", "Airflow", "Spark"]


def test_detail_fallbacks():
    linked = '<h1>Head</h1><script type="application/ld+json">{"description": "&lt;b&gt;text&lt;/b&gt;"}</script>'
    assert html.detail_record(linked) == {"name": "Head", "description": "<b>text</b>", "key_skills": []}
    assert html.detail_record('<script type="application/ld+json">{broken</script>', "listed") == {"name": "listed", "description": "", "key_skills": []}
    assert html.detail_record(None) == {"name": "", "description": "", "key_skills": []}


def test_embedded_skills():
    assert html.embedded_skills('"keySkills":null,"driverLicenseTypes"') == []
    assert html.embedded_skills('"keySkills":[oops],"driverLicenseTypes"') == html.embedded_skills(None) == html.embedded_skills("") == []


def test_search_results():
    link = lambda href, text: f'<a data-qa="serp-item__title" href="{href}">{text}</a>'
    page = link("/vacancy/12?x", "One <b> two</b>") + link("/other", "none") + link("https://x/7654321", "far") + link("/vacancy/12", "again") + '<a href="/vacancy/9">plain</a>'
    assert [(r["id"], r["name"]) for r in html.search_results(page)] == [("12", "One two"), ("7654321", "far")]
    assert html.search_results(None) == []


def test_ids(spark):
    values = ["https://a/vacancy/123?x=1", "see 1234567", "12345", "", None, "a1234567", "/vacancy/x 7654321"]
    want = ["123", "1234567", None, None, None, None, "7654321"]
    assert [html.read_vacancy_id(v) for v in values] == want
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    assert [r[0] for r in df.orderBy("k").select(html.vacancy_id(F.col("v"))).collect()] == want
    assert df.select(html.page_url(F.lit("7"))).first()[0].endswith("/vacancy/7")


def test_texts(spark):
    values = ["<li>Python</li><li>SQL</li>", "a<!-- b -->c", "<script>x</script>y<style>z</style>", "1 &lt; 2 &amp; 3&nbsp;", "plain", "", None]
    want = ["PythonSQL", "ac", "y", "1 < 2 & 3\xa0", "plain", "", None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string").orderBy("k")
    rows = df.select(html.html_text(F.col("v")).alias("u"), html.text_without_tags(F.col("v")).alias("n")).collect()
    assert [r.u for r in rows] == [r.n for r in rows] == want


def test_native_skills_and_table_function(spark):
    df = spark.createDataFrame([(PAGE,), (None,)], "v string")
    assert [r[0] for r in df.select(html.embedded_skill_names(F.col("v"))).collect()] == [["Python", "SQL", "Airflow", "Spark", "3"], []]
    html.register(spark)
    spark.createDataFrame([('<a data-qa="serp-item__title" href="/vacancy/5">n</a>',)], "h string").createOrReplaceTempView("some_pages")
    assert [tuple(r) for r in spark.sql("select s.* from some_pages, lateral search_results(h) s").collect()] == [(0, "5", "n", "/vacancy/5")]
