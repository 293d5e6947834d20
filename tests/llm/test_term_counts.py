from collections import Counter, defaultdict

from termloom.llm import term_counts, terms

SCHEMA = "field_name string, rec_id string, raw_value string"


def counted(spark, rows, **kw):
    out = term_counts.term_counts(spark.createDataFrame(rows, SCHEMA), {"f": 0.5}, **kw)
    return {(r.field_name, r.term): (r.occurrences, r.records, r.is_rare, r.is_common) for r in out.collect()}


def test_counts_like_brute_force(spark):
    rows = [("f", str(i % 37), f"t{(i * i) % 11}") for i in range(500)] + [("f", "1", "T0 "), ("g", "1", "t0")]
    occ, rec = Counter(), defaultdict(set)
    for f, r, v in rows:
        occ[f, v.strip().lower()] += 1
        rec[f, v.strip().lower()].add(r)
    got = counted(spark, rows)
    assert {k: v[:2] for k, v in got.items()} == {k: (occ[k], len(rec[k])) for k in occ}


def test_marks_ties_and_repeats(spark):
    rows = [("f", "1", "a"), ("f", "1", "a"), ("f", "2", "a"), ("f", "3", "b"), ("f", "4", "b"), ("f", "5", "b")]
    got = counted(spark, rows)
    assert got["f", "a"] == (3, 2, True, False)  # repeated rows are occurrences, not records
    assert got["f", "b"] == (3, 3, False, True)  # 3 of 5 records
    out = term_counts.marks(term_counts.term_counts(spark.createDataFrame([("f", "1", "x")], SCHEMA), {"f": 0.5}))
    assert sorted(r.mark for r in out.collect()) == ["common", "rare"]  # both marks, where there are few records


def test_nulls_blanks_and_white_space(spark):
    rows = [("f", "1", None), ("f", "2", "  　"), ("f", None, "a"), ("f", "3", "A  b"), ("f", "4", "a​b")]
    assert set(counted(spark, rows)) == {("f", "a b"), ("f", "a​b")}  # zero-width is no white space


def test_empty_table_long_value_and_extra_columns(spark):
    assert counted(spark, []) == {}
    df = spark.createDataFrame([("f", "1", "z" * 200_000, 1, "x")], SCHEMA + ", salt int, term string")
    assert [r.records for r in term_counts.term_counts(df, {}).collect()] == [1]


def test_skill_values_of_odd_records(spark):
    vac = spark.createDataFrame([("1", [("a",), None, (None,)]), ("2", None), ("3", []), (None, [("b",)])], "id string, key_skills array<struct<name:string>>")
    top = spark.createDataFrame([(7, "c"), (None, "d"), (8, None)], "run_id long, skill string")
    got = {tuple(r) for r in terms.skill_values(vac, top).collect()}
    assert got == {("key_skills", "1", "a"), ("skill", "7", "c")}
