import random
import re

import pytest
from pyspark.sql import functions as F

from termloom.functions.dictionary import AliasConflict, Matcher, collect_dictionary, conflicts, parse_alias_lines
from termloom.operators import extract


def specification(text, dictionary):
    """The operator as its description says, without any speed-up."""
    pairs = list(dictionary.items()) if isinstance(dictionary, dict) else [(x, x) for x in dictionary]
    rest, found = text.lower(), []
    for a, c in sorted(pairs, key=lambda p: -len(p[0])):
        p = r"(?<!\w)" + re.escape(a) + r"(?!\w)"
        if re.search(p, rest):
            if c not in found:
                found.append(c)
            rest = re.sub(p, " ", rest)
    return found


def both(spark, texts, dictionary):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    rows = df.select("k", extract.skills_in_text(F.col("t"), dictionary).alias("u"), extract.skills_in_text_native(F.col("t"), dictionary).alias("n")).orderBy("k").collect()
    return [r.u for r in rows], [r.n for r in rows]


CASES = [
    ("Опыт Kubernetes и k8s в production.", {"kubernetes": "kubernetes", "k8s": "kubernetes"}, ["kubernetes"]),
    ("apache beam and more", {"apache": "apache", "apache beam": "apache beam"}, ["apache beam"]),
    ("apache beam on apache", {"apache": "apache", "apache beam": "apache beam"}, ["apache beam", "apache"]),
    ("convex optimization algorithms", {"convex optimization": "co", "optimization algorithms": "oa"}, ["oa"]),
    ("c++11 and C#", {"c++": "c++", "c": "c", "c#": "c#"}, ["c#", "c"]),
    ("xйml ml", {"ml": "ml"}, ["ml"]),
    ("xйml", {"ml": "ml"}, []),
    ("machine\nlearning", {"machine learning": "ml"}, []),
    ("rest api", {"rest api": "rest", "api": "api"}, ["rest"]),
    ("b a", {"a": "z", "b": "y"}, ["z", "y"]),  # the dictionary's order, not the text's
    (None, {"a": "a"}, []),
    ("", {"a": "a"}, []),
]


@pytest.mark.parametrize("text, dictionary, want", CASES)
def test_cases(spark, text, dictionary, want):
    assert both(spark, [text], dictionary) == ([want], [want])


def test_random_texts_like_the_specification(spark):
    rng = random.Random(8)
    for alphabet, joined in (("ab +.", 7), (["the", "of", "la", "de", " ", " "], 9)):
        words = ["".join(rng.choices(alphabet, k=rng.randint(1, 5))) for _ in range(14)]
        dictionary = {re.sub(r"\s+", " ", w.strip()): f"s{k % 9}" for k, w in enumerate(words) if w.strip()}
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 4 * joined))) for _ in range(300)]
        want = [specification(t, dictionary) for t in texts]
        assert both(spark, texts, dictionary) == (want, want)


def test_prefilter_is_off_where_a_space_could_make_an_alias():
    assert Matcher.of({"a b": "x", "c++": "y"}).prefilter
    assert not Matcher.of({"+ +": "x"}).prefilter


def test_alias_lines():
    got = parse_alias_lines(["# no", "", "Kubernetes | K8s |  k8s ", "  # no", " Big   Data|"])
    assert list(got.items()) == [("kubernetes", "kubernetes"), ("k8s", "kubernetes"), ("big data", "big data")]
    assert parse_alias_lines(["a | b", "a | b"]) == {"a": "a", "b": "a"}
    with pytest.raises(AliasConflict):
        parse_alias_lines(["a | b", "c | b"])


def test_dictionary_tables(spark):
    df = spark.createDataFrame([(2, "b", "x"), (1, "a", "x"), (3, None, "x"), (4, "a", "x")], "ord int, alias string, canonical string")
    assert list(collect_dictionary(df).items()) == [("a", "x"), ("b", "x")]
    bad = df.union(spark.createDataFrame([(5, "a", "y")], df.schema))
    assert [tuple(r) for r in conflicts(bad).collect()] == [("a", 2)]
    with pytest.raises(AliasConflict):
        collect_dictionary(bad)
    with pytest.raises(ValueError):
        collect_dictionary(df, max_rows=1)


def record(spark, mode, skills, text, dictionary=("python", "sql", "airflow")):
    df = spark.createDataFrame([(mode, skills, text)], "m string, key_skills array<struct<name:string>>, d string")
    described = extract.description_skills(F.col("d"), list(dictionary))
    return df.withColumn("x", described).select(extract.record_skills(F.col("m"), F.col("key_skills"), F.col("x"))).first()[0]


def test_modes(spark):
    skills, text = [("Python",), ("SQL",), (" ",), (None,), None, ("python",)], "<p>python and sql and airflow</p>"
    assert record(spark, "both", skills, text) == ["python", "sql", "airflow"]
    assert record(spark, "key-skills", skills, text) == ["python", "sql"]
    assert record(spark, "description", None, "<li>python</li><li>sql</li> airflow") == ["airflow"]  # pieces are glued
    assert record(spark, "key-skills", None, None) == []
    with pytest.raises(Exception, match="unknown mode"):
        record(spark, "other", skills, text)
    with pytest.raises(ValueError):
        extract.description_skills(F.col("d"), {})


def test_effective_mode(spark):
    df = spark.createDataFrame([("html",), ("api",), (None,)], "s string")
    pick = lambda m, f: [r[0] for r in df.select(extract.effective_mode(m, F.col("s"), f)).collect()]
    assert pick("key-skills", True) == ["description", "key-skills", "key-skills"]
    assert pick("key-skills", False) == ["key-skills"] * 3
    assert pick("both", True) == ["both"] * 3


def test_the_search_is_known_to_sql(spark):
    extract.register(spark, {"k8s": "kubernetes", "sql": "sql"})
    assert spark.sql("select skills_in_text('K8s and SQL, null too') as s, skills_in_text(null) as n").first() == (["kubernetes", "sql"], [])
