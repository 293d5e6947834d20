import json

import pytest

from termloom.operators import pages as ops
from termloom.plans import cli, pipeline
from termloom.plans.settings import Settings
from termloom.sources import collect
from termloom.sources.pages import ProxyUnavailable, RequestFailed

LISTING = "query_ord int, page int, source string, status int, server string, body string"
DETAIL = "id string, source string, status int, server string, body string"


def items(*ids):
    return json.dumps({"items": [{"id": i, "name": f"python {i}"} for i in ids]})


def links(*ids):
    return "".join(f'<a data-qa="serp-item__title" href="/vacancy/{i}">python {i}</a>' for i in ids)


def read(spark, rows, limit=100, source="auto"):
    df = ops.listings_of_pages(spark.createDataFrame(rows, LISTING), limit, source)
    return [(r.query_ord, r.pos, r.id, r["_source"]) for r in df.orderBy("query_ord", "pos").collect()]


def test_reading_ends_at_the_first_empty_or_missing_page(spark):
    rows = [(1, 0, "api", 200, None, items(1, 2)), (1, 1, "api", 200, None, items()), (1, 2, "api", 200, None, items(3)), (2, 0, "api", 200, None, items(4)), (2, 2, "api", 200, None, items(5))]
    assert read(spark, rows, 2000) == [(1, 0, "1", "api"), (1, 1, "2", "api"), (2, 0, "4", "api")]
    assert read(spark, []) == []
    nulls = [(None, 0, "api", 200, None, items(1)), (1, None, "api", 200, None, items(1)), (1, 0, "api", 200, None, None), (2, 0, "html", 200, None, None), (3, 0, "api", 200, None, "no json")]
    assert read(spark, nulls) == []


def test_failing_pages(spark):
    rows = [(1, 0, "api", 500, None, None), (1, 1, "api", 200, None, items(1))]
    assert read(spark, rows, 2000) == [(1, 0, "1", "api")]  # skipped, and reading goes on
    with pytest.raises(Exception, match="failed"):
        read(spark, [(1, 0, "html", 500, None, None)], source="html")


def test_limits(spark):
    rows = [(1, 0, "api", 200, None, items(*range(100, 200))), (1, 1, "api", 200, None, items(*range(200, 300))), (1, 2, "api", 200, None, items(999))]
    assert len(read(spark, rows, 150, "api")) == 200  # whole pages
    rows = [(1, p, "html", 200, None, links(*range(100_000 + 20 * p, 100_020 + 20 * p))) for p in range(3)]
    assert len(read(spark, rows, 30, "html")) == 30


def test_once_blocked_always_pages(spark):
    guard = (403, "DDoS-Guard", None)
    rows = [(1, 0, "api", 200, None, items(1)), (2, 0, "api", 200, None, items(2)), (2, 1, "api", *guard), (3, 0, "api", 200, None, items(3))]
    rows += [(q, 0, "html", 200, None, links(100_000 + q)) for q in (1, 2, 3)]
    assert read(spark, rows, 2000) == [(1, 0, "1", "api"), (2, 0, "100002", "html"), (3, 0, "100003", "html")]
    assert {s for *_, s in read(spark, rows, 2000, "html")} == {"html"}
    with pytest.raises(Exception, match="blocked at query 2"):
        read(spark, rows, 2000, "api")
    unread = [(1, 0, "api", 200, None, items(1)), (1, 1, "api", 200, None, items()), (1, 2, "api", *guard)]  # behind the end
    assert read(spark, unread, 2000) == [(1, 0, "1", "api")]


def test_details_and_their_errors(spark):
    page = '<h1>Title</h1><div data-qa="vacancy-description">text</div>'
    found = [("1", "api", 200, None, '{"name": "n", "description": "d", "key_skills": [{"name": "sql"}]}'), ("2", "api", 403, "ddos-guard", None), ("2", "html", 200, None, page), ("3", "html", 200, None, page)]
    found += [("4", "api", 404, None, None), ("5", "html", 503, None, None), ("7", "api", 200, None, None), ("1", "api", 200, None, '{"name": "n", "description": "d", "key_skills": [{"name": "sql"}]}')]
    rows = [("1", "a", "api"), ("2", "b", "api"), ("3", "c", "html"), ("4", "d", "api"), ("5", None, "html"), ("6", "f", None), ("7", "g", "api")]
    df = ops.details_of_pages(spark.createDataFrame(rows, "id string, name string, _source string"), spark.createDataFrame(found, DETAIL))
    got = {r.id: (r.used, r.detail and r.detail.name, r.error) for r in df.collect()}
    assert got == {
        "1": ("api", "n", None), "2": ("html", "Title", None), "3": ("html", "Title", None), "4": ("api", None, "status 404"), "5": ("html", None, "status 503"), "6": ("api", None, "no page"), "7": ("api", None, "the page can't be read"),
    }


def test_records_with_an_error_are_tried_again(spark, tmp_path):
    queries = spark.createDataFrame([(0, "python")], "query_ord int, query_text string")
    aliases = spark.createDataFrame([(0, "python", "python")], "ord int, alias string, canonical string")
    listed = spark.createDataFrame([(0, 0, "api", 200, None, items(1, 2))], LISTING)
    body = '{"key_skills": [{"name": "sql"}]}'
    run = lambda details: [(r.skill, r["count"]) for r in pipeline.run_pages(spark, listed, spark.createDataFrame(details, DETAIL), queries, aliases, str(tmp_path / "s")).collect()]
    assert run([("1", "api", 200, None, body), ("2", "api", 500, None, None)]) == [("sql", 1)]
    assert run([("1", "api", 200, None, body), ("2", "api", 200, None, body)]) == [("sql", 2)]
    assert run([("1", "api", 200, None, body), ("2", "api", 200, None, body)]) == [("sql", 2)]


class Site:
    """Two phrases; the structured source is blocked at the second."""

    asked: list = []

    def __init__(self, settings):
        self.settings = settings

    def listing(self, source, query, page):
        self.asked.append((source, query, page))
        if source == "api" and query == "sql":
            raise RequestFailed("no", 403, server="ddos-guard")
        n = {"python": 100, "sql": 200}[query]
        return (items(n, n + 1) if page == 0 else items()) if source == "api" else links(100_000 + n) if page == 0 else ""

    def detail(self, source, id, url):
        self.asked.append((source, id))
        return '{"key_skills": [{"name": "Python"}], "description": ""}' if source == "api" else '<script>{"keySkills":["SQL"],"driverLicenseTypes":[]}</script>'


def site(settings):
    return Site(settings)


def test_command_line_runs_from_collected_pages(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    (tmp_path / "q.txt").write_text("python\nsql\n", encoding="utf-8")
    (tmp_path / "d.txt").write_text("python\nsql\n", encoding="utf-8")
    Site.asked.clear()
    options = f"run --pages pages --phrases q.txt --dictionary d.txt --no-chart --no-dotenv -o {tmp_path}/out.csv --page-delay-min 0 --page-delay-max 0 --vacancy-delay-min 0 --vacancy-delay-max 0 --fetch tests.test_pages:site".split()
    monkeypatch.setattr(collect, "load_fetcher", lambda name, settings: Site(settings))
    assert cli.main(options) == 0
    assert (tmp_path / "out.csv").read_text(encoding="utf-8").split() == ["Count,Skill", "2,python"]  # a title must hold its own phrase
    n = len(Site.asked)
    assert ("api", "python", 1) in Site.asked and ("html", "sql", 0) in Site.asked and cli.main(options) == 0
    assert len([x for x in Site.asked[n:] if x[0] == "html"]) == 0  # pages that are there aren't asked for again


def test_a_dead_proxy_ends_the_run(tmp_path):
    class Dead:
        def listing(self, *_):
            raise RequestFailed("no route")

    s = Settings(proxy="http://proxy", page_delay_min=0, page_delay_max=0)
    with pytest.raises(ProxyUnavailable):
        collect.collect_listings(Dead(), [(0, "x")], s, str(tmp_path), sleep=lambda _: None)
