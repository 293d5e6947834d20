"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import UNICODE_SPACE
from termloom.session import checkpointed
from termloom.sources.tables import table

from . import bpe, canonical, confusables, content, cooccur, mixing, near_dup, term_counts, terms

P1_COMMON = {"key_skills": 0.1, "skill": 0.5}
P5 = {"min_count": 3, "min_share": 0.001, "min_lift": 8}
P3 = {"main": "description", "more": "name", "shingle": 1, "min_words": 20, "threshold": 0.6}


def _values(spark: SparkSession, base: str) -> DataFrame:
    return terms.skill_values(table(spark, base, "vacancy"), table(spark, base, "top_skills_all_data"))


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    return term_counts.marks(term_counts.term_counts(_values(spark, base), P1_COMMON))


def p1_counts(spark: SparkSession, base: str) -> DataFrame:
    return term_counts.term_counts(_values(spark, base), P1_COMMON)


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    values = _values(spark, base)
    return canonical.mapped_values(values, canonical.map_values(values, table(spark, base, "skills_whitelist")))


def p2_unmatched(spark: SparkSession, base: str) -> DataFrame:
    return canonical.map_values(_values(spark, base), table(spark, base, "skills_whitelist")).where("canonical is null").select("raw_value")


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return near_dup.near_duplicate_pairs(table(spark, base, "vacancy"), "id", **P3)


def p3_groups(spark: SparkSession, base: str) -> DataFrame:
    groups = near_dup.near_duplicate_groups(table(spark, base, "vacancy"), "id", **P3)
    return groups.select("id", F.col("first_id").alias("class_id"), "class_size", "n_links")


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    vacancy = table(spark, base, "vacancy")
    values = terms.array_values(vacancy, "key_skills", "id", "key_skills").unionByName(terms.column_values(vacancy, "name", "id", "name"))
    clean = confusables.clean_values(values)
    return clean.select("field_name", F.col("rec_id").alias("vacancy_id"), "clean_value").distinct()


def _baskets(spark: SparkSession, base: str) -> DataFrame:
    values = terms.array_values(table(spark, base, "vacancy"), "key_skills", "id", "key_skills")
    return values.select("rec_id", terms.term(F.col("raw_value")).alias("item"))


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    pairs = cooccur.cooccurring_pairs(_baskets(spark, base), "rec_id", "item", **P5)
    return pairs.select(F.col("item_a").alias("skill_a"), F.col("item_b").alias("skill_b"))


def p5_pairs(spark: SparkSession, base: str) -> DataFrame:
    return cooccur.cooccurring_pairs(_baskets(spark, base), "rec_id", "item", **P5)


def p6_ids(spark: SparkSession, base: str) -> DataFrame:
    return bpe.encode(table(spark, base, "documents"))


def _mix_plan(spark: SparkSession, base: str) -> DataFrame:
    return mixing.plan_mix(table(spark, base, "documents"), table(spark, base, "mix_targets"))


def p7_mix(spark: SparkSession, base: str) -> DataFrame:
    plan = checkpointed(_mix_plan(spark, base))
    return mixing.mix(table(spark, base, "documents").select("doc_id", "source", "text"), plan)


def p7_shares(spark: SparkSession, base: str) -> DataFrame:
    return _mix_plan(spark, base)


def _scored(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "source", "text")
    return content.score_documents(docs, content.train(table(spark, base, "content_examples"), docs))


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    return _scored(spark, base).where("offends").select("doc_id")


def p8_scores(spark: SparkSession, base: str) -> DataFrame:
    return _scored(spark, base)


def p8_rates(spark: SparkSession, base: str) -> DataFrame:
    return content.rates(_scored(spark, base))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_counts, p2_found, p2_unmatched, p3_found, p3_groups, p4_found, p5_found, p5_pairs, p6_ids, p7_mix, p7_shares, p8_found, p8_scores, p8_rates)}


_TERM = f"nullif(lower(trim(regexp_replace(v, '[{UNICODE_SPACE}]+', ' ', 'g'), ' ')), '')"
_TERMS = f"""vals AS (SELECT 'key_skills' AS field_name, id AS rec, unnest(key_skills).name AS v FROM vacancy WHERE id IS NOT NULL
        UNION ALL SELECT 'skill', run_id::VARCHAR, skill FROM top_skills_all_data WHERE run_id IS NOT NULL),
    terms AS (SELECT field_name, rec, {_TERM} AS term FROM vals WHERE {_TERM} IS NOT NULL),
    totals AS (SELECT field_name, count(DISTINCT rec) AS total_records FROM terms GROUP BY 1),
    counted AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT rec) AS records FROM terms GROUP BY 1, 2),
    marked AS (SELECT *, records < 3 AS is_rare, CASE field_name WHEN 'key_skills' THEN records * 10 > total_records ELSE records * 2 > total_records END AS is_common
        FROM counted JOIN totals USING (field_name))"""
_GRAM = """bask AS (SELECT DISTINCT rec, term FROM terms WHERE field_name = 'key_skills'), tot AS (SELECT count(DISTINCT rec) AS n FROM bask),
    c AS (SELECT term, count(*) AS k FROM bask GROUP BY 1), ab AS (SELECT x.term AS a, y.term AS b, count(*) AS n_ab FROM bask x JOIN bask y ON x.rec = y.rec AND x.term < y.term GROUP BY 1, 2),
    pairs AS (SELECT a, ab.b, n_ab, ca.k AS n_a, cb.k AS n_b, n FROM ab JOIN c ca ON ca.term = a JOIN c cb ON cb.term = ab.b, tot WHERE n_ab >= 3 AND 1000 * n_ab >= n AND n_ab * n >= 8 * ca.k * cb.k)"""
_TEXT = "regexp_replace(regexp_replace({0}, '(?is)<!--.*?-->|<script.*?</script|<style.*?</style', ' ', 'g'), '<[^<>]*>', ' ', 'g')"
_DECODED = "replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&')"
_WORDS = lambda c: f"regexp_extract_all(lower({_DECODED.format(_TEXT.format(c))}), '[\\p{{L}}\\p{{N}}]+')"
_ALIKE = f"""t AS (SELECT DISTINCT id, list_sort(list_distinct({_WORDS('description')} || coalesce({_WORDS('name')}, []))) AS w FROM vacancy
        WHERE id IS NOT NULL AND len({_WORDS('description')}) >= 20),
    s AS MATERIALIZED (SELECT row_number() OVER () AS i, w FROM (SELECT DISTINCT w FROM t)), x AS (SELECT i, len(w) AS n, unnest(w) AS word FROM s),
    near AS (SELECT a.i, b.i AS j FROM x a JOIN x b ON a.word = b.word AND a.i < b.i GROUP BY a.i, b.i HAVING 10 * count(*) >= 6 * (min(a.n) + min(b.n) - count(*))),
    m AS (SELECT id, i FROM t JOIN s USING (w)), links AS (SELECT i, j FROM near UNION ALL SELECT j, i FROM near UNION ALL SELECT i, i FROM s)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"WITH {_TERMS} SELECT field_name, term, 'rare' AS mark FROM marked WHERE is_rare UNION ALL SELECT field_name, term, 'common' FROM marked WHERE is_common",
        "p1_counts": f"WITH {_TERMS} SELECT field_name, term, occurrences, records, total_records, is_rare, is_common FROM marked",
        "p3_found": f"WITH {_ALIKE} SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM links l JOIN m a ON a.i = l.i JOIN m b ON b.i = l.j WHERE a.id < b.id",
        "p3_groups": f"""WITH {_ALIKE}, c AS (SELECT i, min(id) AS class_id, count(*) AS class_size FROM m GROUP BY i), d AS (SELECT i, count(*) - 1 AS n_links FROM links GROUP BY i)
            SELECT id, class_id, class_size, n_links FROM m JOIN c USING (i) JOIN d USING (i)""",
        "p5_found": f"WITH {_TERMS}, {_GRAM} SELECT a AS skill_a, b AS skill_b FROM pairs",
        "p5_pairs": f"WITH {_TERMS}, {_GRAM} SELECT a AS item_a, b AS item_b, n_ab, n_a, n_b, n, n_ab * n::DOUBLE / n_a / n_b AS lift FROM pairs",
    }
