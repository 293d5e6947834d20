import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from termloom import queries as core

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")


def test_registered():
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and set(core.SQL) == set(core.QUERIES)


def test_core_does_not_import_the_optional_part():
    for f in (ROOT / "termloom").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert "termloom.llm" not in f.read_text() and "from .llm" not in f.read_text(), f


@needs_data
def test_flagship(spark):
    rows = entry.entry(spark).orderBy("rank").collect()
    assert rows and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert all(a["count"] >= b["count"] for a, b in zip(rows, rows[1:]))


@needs_data
@pytest.mark.parametrize("name", [*core.QUERIES])
def test_core_queries_match_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    df = core.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    rel = con.sql(core.SQL[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


@needs_data
@pytest.mark.parametrize("name", ["skill_doc_freq", "skills_per_document", "skill_freq_by_lang", "description_skills", "both_mode_merge"])
def test_texts_are_searched_once(spark, name):
    plan = core.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    evaluated = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert sum("run(" in line for line in evaluated) == 1 and len(evaluated) <= 2  # the mark-up is taken out by another one


@needs_data
def test_latest_details_without_wide_sort_aggregate(spark):
    plan = core.QUERIES["description_skills"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


@needs_data
def test_limits_are_cut_before_the_shuffle(spark):
    from termloom.operators import listing
    from termloom.sources.tables import table

    for source in ("html", "api", "auto"):
        plan = listing.limit_per_query(table(spark, SMALL, "listings"), 2000, source)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan


def test_help_runs():
    out = subprocess.run([sys.executable, "-m", "termloom.plans.cli", "help"], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "--source" in out.stdout
