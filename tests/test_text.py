import re

from pyspark.sql import functions as F

from termloom.functions import text

SPACES = [chr(c) for c in [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]


def column(spark, values, f):
    return [r.o for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string").orderBy("k").select(f(F.col("v")).alias("o")).collect()]


def test_white_space_is_pythons(spark):
    values = [f"{s}a{s}{s}b{s}" for s in SPACES] + ["a​b", "᠎a", None, "", " "]
    assert column(spark, values, text.strip) == [v if v is None else v.strip() for v in values]
    assert column(spark, values, text.collapse) == [v if v is None else re.sub(r"\s+", " ", v) for v in values]
    assert column(spark, values, text.normalize_term) == [v if v is None else re.sub(r"\s+", " ", v.strip().lower()) for v in values]


def test_lower_case(spark):
    assert column(spark, ["ЁÄ", "ПРИВЕТ"], text.normalize_term) == ["ёä", "привет"]


def test_queries(spark):
    values = ['"data scientist"', " 'a b' ", '"', '""', "'a\"", "x", None, '""a""']
    assert column(spark, values, text.normalize_query) == ["data scientist", "a b", '"', "", "'a\"", "x", None, '"a"']
    assert column(spark, ['"data scientist"', "a"], lambda c: text.exact_query(text.exact_query(c))) == ['"data scientist"', '"a"']


def test_literal_in_a_pattern(spark):
    values = ["c++", "a.b", "\\E", "x\\Ey"]
    assert column(spark, values, lambda c: F.regexp_like(c, F.concat(F.lit("^"), text.quote_literal(c), F.lit("$")))) == [True] * 4
    assert column(spark, ["aXb"], lambda c: F.regexp_like(c, text.quote_literal(F.lit("a.b")))) == [False]
