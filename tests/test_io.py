import csv
import json
import os

import pytest

from termloom.plans.settings import parse, split_command
from termloom.sinks import files as sinks
from termloom.sources import files, pages
from termloom.streaming import progress


def test_queries_file(spark, tmp_path):
    p = tmp_path / "q.txt"
    p.write_text('"data scientist"\n# no\n\n #kept\n""\n\'x\'\nx\n', encoding="utf-8")
    assert [r["query"] for r in files.load_queries(spark, str(p)).orderBy("query_ord").collect()] == ["data scientist", "#kept", "x", "x"]
    assert files.load_queries(spark, str(tmp_path / "new" / "q.txt")).count() > 0 and (tmp_path / "new" / "q.txt").exists()
    assert "k8s" in {r.alias for r in files.load_dictionary(spark, str(tmp_path / "d.txt")).collect()}


def test_result_files(spark, tmp_path):
    p = str(tmp_path / "r.csv")
    sinks.save_result_file([("python", 3), ('a,"b"', 2), ("sql", 1)], p)
    with open(p, newline="", encoding="utf-8") as f:
        text = f.read()
    assert text.startswith("Count,Skill\r\n3,python\r\n") and list(csv.reader(text.splitlines()))[2] == ["2", 'a,"b"']
    assert {(r.skill, r["count"]) for r in files.load_result(spark, p).collect()} == {("python", 3), ('a,"b"', 2), ("sql", 1)}
    (tmp_path / "twice.csv").write_text("Count,Skill\n1, a \n2,b\n3,a\n4,\n", encoding="utf-8")
    rows = files.load_result(spark, str(tmp_path / "twice.csv")).orderBy("line").collect()
    assert [(r.skill, r["count"]) for r in rows] == [("a", 3), ("b", 2)]  # the last value at the first place
    sinks.save_result_file([], p)
    with pytest.raises(ValueError):
        files.load_result(spark, p)
    for bad in ("Skill,Count\na,1\n", "Count,Skill\nx,a\n"):
        (tmp_path / "bad.csv").write_text(bad, encoding="utf-8")
        with pytest.raises(Exception):
            files.load_result(spark, str(tmp_path / "bad.csv")).collect()


def test_written_folder_is_in_order(spark, tmp_path):
    df = spark.createDataFrame([(k, f"s{k}", 100 - k) for k in range(1, 60)], "rank long, skill string, count long")
    sinks.write_result(df, str(tmp_path / "out"))
    got = [line for f in sorted((tmp_path / "out").glob("part-*")) for line in f.read_bytes().decode().split("\r\n")[1:] if line]
    assert got == [f"{100 - k},s{k}" for k in range(1, 60)]


def test_chart_needs_something(tmp_path):
    assert sinks.save_chart([], 5, str(tmp_path / "x.png")) is False
    with pytest.raises(ValueError):
        sinks.save_chart([("a", 1)], -1, "x.png")


def test_env_file(tmp_path, monkeypatch):
    monkeypatch.setenv("TL_A", "env")
    monkeypatch.delenv("TL_B", raising=False)
    (tmp_path / ".env").write_text("# c\nTL_A=file\nTL_B='q u'\nbroken\n", encoding="utf-8")
    assert files.load_env_file(str(tmp_path / ".env")) and (os.environ["TL_A"], os.environ["TL_B"]) == ("env", "q u")
    files.load_env_file(str(tmp_path / ".env"), override=True)
    assert os.environ["TL_A"] == "file" and not files.load_env_file(str(tmp_path / "none"))
    monkeypatch.delenv("TL_B")


def test_commands_and_settings(monkeypatch):
    assert split_command([]) == ("help", []) and split_command(["run", "--no-chart"]) == ("run", ["--no-chart"])
    for bad in (["--no-chart"], ["run", "--help"]):
        with pytest.raises(SystemExit):
            split_command(bad)
    s = parse(["--mode", "both", "--skills-count", "7", "--no-dotenv", "--chart-input", "x.csv"])
    assert (s.mode, s.skills_show_count, s.area, s.vacancies_limit, s.save_every, s.chart_input) == ("both", 7, 1, 2000, 10, "x.csv")
    with pytest.raises(ValueError):
        parse(["--page-delay-min", "9", "--no-dotenv"])


def failing(*errors):
    left, calls = list(errors), []

    def fetch(*args):
        calls.append(args)
        if left:
            raise left.pop(0)
        return [{"id": "1"}]

    return fetch, calls


def test_retries():
    waits = []
    policy = pages.RetryPolicy()
    fetch, calls = failing(pages.RequestFailed("x"), pages.RequestFailed("x", 429, "7"))
    assert policy.call(fetch, 1, sleep=waits.append) and waits == [1.0, 7.0] and len(calls) == 3
    for status, n in ((404, 1), (500, 3), (403, 3)):
        fetch, calls = failing(*[pages.RequestFailed("x", status)] * 5)
        with pytest.raises(pages.RequestFailed):
            policy.call(fetch, sleep=lambda _: None)
        assert len(calls) == n


def test_paging_and_router():
    rows = lambda size, last: lambda q, p: [{"id": f"{q}{p}-{k}"} for k in range(size)] if p < last else []
    assert len(pages.read_query(rows(100, 9), "q", 150, "api")) == 200  # whole pages
    assert len(pages.read_query(rows(20, 9), "q", 30, "html")) == 30
    assert len(pages.read_query(rows(20, 1), "q", 90, "html")) == 20
    assert pages.pages_for(9999, "api") == 20
    with pytest.raises(ValueError):
        pages.pages_for(0, "api")
    asked = []

    def blocked(q, p):
        asked.append(q)
        raise pages.RequestFailed("no", 403, server="DDoS-Guard")

    router = pages.Router()
    got = [router.read(q, 20, blocked, rows(20, 1), sleep=lambda _: None)[1] for q in "ab"]
    assert got == ["html", "html"] and set(asked) == {"a"}  # once blocked, always pages
    with pytest.raises(pages.SourceBlocked):
        pages.Router("api").read("a", 20, blocked, rows(20, 1), sleep=lambda _: None)


def test_stored_pages(spark, tmp_path):
    (tmp_path / "0").mkdir()
    (tmp_path / "1").mkdir()
    for p in range(3):
        (tmp_path / "0" / f"{p}.json").write_text(json.dumps({"items": [{"id": 100 * p + k, "name": "n"} for k in range(2 if p < 2 else 0)]}))
    (tmp_path / "1" / "0.html").write_text('<a data-qa="serp-item__title" href="/vacancy/5">x</a>')
    got = pages.stored_listings(spark, str(tmp_path)).orderBy("query_ord", "pos").collect()
    assert [(r.query_ord, r.page, r.pos, r.id, r._source) for r in got] == [(0, 0, 0, "0", "api"), (0, 0, 1, "1", "api"), (0, 1, 2, "100", "api"), (0, 1, 3, "101", "api"), (1, 0, 0, "5", "html")]


def test_progress_document(tmp_path):
    p, key = str(tmp_path / "p.json"), progress.fingerprint(["a"], "both")
    assert progress.resume_document(p, key) == ([], {})
    progress.save_document(p, key, ["1", "2"], {"sql": 2})
    assert progress.resume_document(p, key) == (["1", "2"], {"sql": 2})
    assert progress.resume_document(p, progress.fingerprint(["a"], "description")) == ([], {})
    assert progress.resume_document(p, progress.fingerprint(["a"], "both", {"limit": 3})) == ([], {})  # strict: more must agree
    (tmp_path / "p.json").write_text("{")
    with pytest.raises(ValueError):
        progress.resume_document(p, key)


ROWS = "id string, query_ord int, pos int, skills array<string>"


def test_state_counts_once(spark, tmp_path):
    state = progress.State(spark, str(tmp_path / "s"))
    one = spark.createDataFrame([("1", 0, 0, ["a", "b"]), ("1", 0, 1, ["c"]), ("2", 0, 2, [])], ROWS)
    two = spark.createDataFrame([("2", 1, 0, ["z"]), ("3", 1, 1, ["a"])], ROWS)
    assert state.counts().count() == 0
    assert state.add(one, 0) and not state.add(one, 0) and state.add(two, 1)
    assert {(r.skill, r["count"]) for r in state.counts().collect()} == {("a", 2), ("b", 1)}
    assert {r.id for r in state.processed().collect()} == {"1", "2", "3"}  # those without skills too


def test_interrupted_batch_is_replayed(spark, tmp_path):
    state = progress.State(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([("1", 0, 0, ["a"])], ROWS)
    rows.select("id").write.parquet(str(tmp_path / "s" / "ids" / "0-0"))  # left by a run that died before its mark
    assert state.processed().count() == 0 and state.add(rows, 0)
    assert [(r.skill, r["count"]) for r in state.counts().collect()] == [("a", 1)]


def test_many_batches_stay_few_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(progress, "MERGED", 2)
    state = progress.State(spark, str(tmp_path / "s"))
    for k in range(5):
        assert state.add(spark.createDataFrame([(str(k), 0, k, ["a", f"b{k}"]), ("0", 0, 9, ["z"])], ROWS), k)
    assert state._done() == [(0, 3), (4, 4)] and state.next_batch() == 5 and not state.add(spark.createDataFrame([("9", 0, 0, ["a"])], ROWS), 2)
    counts = {r.skill: (r["count"], r.first_seen.batch) for r in state.counts().collect()}
    assert counts == {"a": (5, 0), **{f"b{k}": (1, k) for k in range(5)}} and state.processed().count() == 5
    (tmp_path / "s" / "done" / "1-1").touch()  # a mark that an interrupted merge left behind
    assert state._done() == [(0, 3), (4, 4)]


def test_scratch_is_deleted_and_needs_a_shared_folder(spark, monkeypatch):
    from termloom import session

    with session.scratch(spark, "x") as path:
        spark.range(3).write.parquet(path)
    assert not os.path.exists(path)

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return {}

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError):
        session.shared_folder(Cluster)


def test_results_of_many_runs(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 5, "a"), (1, 1, 6, "a"), (2, 0, 7, " a "), (2, 1, 8, "b")], "run_id long, line_no int, count long, skill string")
    sinks.write_runs(rows, str(tmp_path / "r"))
    assert {(r.run_id, r.skill, r["count"]) for r in files.load_result(spark, str(tmp_path / "r"), by="run_id").collect()} == {("1", "a", 6), ("2", "a", 7), ("2", "b", 8)}


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    src, state = tmp_path / "in", progress.State(spark, str(tmp_path / "s"))
    put = lambda k, ids: spark.createDataFrame([(i, 0, int(i), [f"s{int(i) % 3}"]) for i in ids], ROWS).coalesce(1).write.parquet(str(src / f"f{k}"))
    put(0, ["1", "2", "3"])
    run = lambda: progress.count_stream(progress.batches_of(spark, str(src) + "/*", ROWS), lambda df: df, state, str(tmp_path / "c")).awaitTermination()
    run()
    put(1, ["3", "4", "5"])  # overlaps
    run()
    run()
    assert {(r.skill, r["count"]) for r in state.counts().collect()} == {("s1", 2), ("s2", 2), ("s0", 1)}


def test_run_saves_and_resumes(spark, tmp_path):
    from termloom.plans import pipeline
    from termloom.streaming.progress import State

    base, saved = "/root/testdata/sf0.001", str(tmp_path / "x.progress")
    plain = [(r.skill, r["count"]) for r in pipeline.run(spark, base, limit=150, source="api").orderBy("rank").collect()]
    again = lambda **kw: [(r.skill, r["count"]) for r in pipeline.run_saved(spark, base, saved, limit=150, source="api", save_every=40, **kw).orderBy("rank").collect()]
    assert again() == plain
    state = State(spark, saved)
    batches = state.next_batch()
    assert batches > 0 and again() == plain and state.next_batch() == batches  # nothing was left to do
    assert again(strict=True) == plain and state.next_batch() == batches  # another fingerprint: started anew


def test_source_decides_the_limit(spark):
    from termloom.operators.listing import limit_per_query

    rows = spark.createDataFrame([(q, p, str(p), "html" if q == 1 and p == 7 else "api") for q in (1, 2) for p in range(250)], "query_ord int, pos int, id string, _source string")
    n = lambda s: {r.query_ord: r["count"] for r in limit_per_query(rows, 150, s).groupBy("query_ord").count().collect()}
    assert n("html") == {1: 150, 2: 150} and n("api") == {1: 200, 2: 200} and n("auto") == {1: 150, 2: 200}


def test_a_failing_page_is_skipped():
    from termloom.functions import html

    assert html.isolated(lambda x: 1 // x, 0) is None and html.isolated(lambda x: x, "a") == "a"
