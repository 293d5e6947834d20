"""Terms: the one normal form in which the term operators compare values, and the long table of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import UNICODE_SPACE, normalize_term


def term(col: Column) -> Column:
    """A value lower-cased, trimmed, each run of white space as one space; null for null and blank values.

    White space is what Unicode calls so; zero-width characters are none."""
    return F.nullif(normalize_term(col, UNICODE_SPACE), F.lit(""))


def array_values(df: DataFrame, field_name: str, rec: str, array: str, item: str | None = "name") -> DataFrame:
    """(field_name, rec_id, raw_value) of an array column, one row an entry; null arrays, entries and records give none."""
    entry = F.explode(array)
    out = df.where(F.col(rec).isNotNull()).select(F.lit(field_name).alias("field_name"), F.col(rec).cast("string").alias("rec_id"), entry.alias("e"))
    return out.select("field_name", "rec_id", (F.col(f"e.{item}") if item else F.col("e")).alias("raw_value")).where(F.col("raw_value").isNotNull())


def column_values(df: DataFrame, field_name: str, rec: str, column: str) -> DataFrame:
    """(field_name, rec_id, raw_value) of a plain string column."""
    return df.where(F.col(rec).isNotNull() & F.col(column).isNotNull()).select(
        F.lit(field_name).alias("field_name"), F.col(rec).cast("string").alias("rec_id"), F.col(column).alias("raw_value")
    )


def skill_values(vacancy: DataFrame, skills: DataFrame) -> DataFrame:
    """The typed skills of both tables: ``key_skills`` by vacancy id and ``skill`` by run id."""
    return array_values(vacancy, "key_skills", "id", "key_skills").unionByName(column_values(skills, "skill", "run_id", "skill"))
