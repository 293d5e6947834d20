"""Counting skills over records, and the order of the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import numbered


def skill_counts(rows: DataFrame) -> DataFrame:
    """(skill, count, first_seen) of rows with unique ``skills``; ``first_seen`` is the place where a skill came up first.

    One shuffle by skill, after partial aggregation; a skill that every record has costs a row a task.  The three numbers
    of a place (none negative) travel as one decimal, which keeps the aggregation in hash tables."""
    seen = rows.select("query_ord", "pos", F.posexplode("skills").alias("skill_pos", "skill"))
    digits = lambda c, n: F.col(c).cast("decimal(10,0)") * F.lit(f"1{'0' * n}").cast(f"decimal({n + 1},0)")
    place = (digits("query_ord", 20) + digits("pos", 10) + F.col("skill_pos")).cast("decimal(38,0)")
    counted = seen.groupBy("skill").agg(F.count("*").alias("count"), F.min(place).alias("place"))
    text = F.lpad(F.col("place").cast("string"), 30, "0")
    part = lambda at, name: F.substring(text, at, 10).cast("int").alias(name)
    return counted.select("skill", "count", F.struct(part(1, "query_ord"), part(11, "pos"), part(21, "skill_pos")).alias("first_seen"))


def resumed(counts: DataFrame, saved: DataFrame) -> DataFrame:
    """Counts with those of an earlier run (ord, skill, count) added; saved skills come first in their order."""
    place = lambda q, p, s: F.struct(q.cast("int").alias("query_ord"), p.cast("int").alias("pos"), s.cast("int").alias("skill_pos")).alias("first_seen")
    old = saved.select("skill", "count", place(F.lit(-1), F.col("ord"), F.lit(0)))
    new = counts.select("skill", "count", place(*[F.col(f"first_seen.{c}") for c in ("query_ord", "pos", "skill_pos")]))
    return old.unionByName(new).groupBy("skill").agg(F.sum("count").alias("count"), F.min("first_seen").alias("first_seen"))


def _order() -> list[Column]:
    return [F.desc("count"), F.asc("first_seen"), F.asc("skill")]


def ranked(counts: DataFrame) -> DataFrame:
    """Counts with their ``rank``: the largest first, ties in the order in which the skills came up."""
    return numbered(counts, *_order())


def top(counts: DataFrame, n: int) -> DataFrame:
    """The first n of the ranked counts, with their rank; n must not be negative.  Only n rows reach the last task."""
    if n < 0:
        raise ValueError("n must not be negative")
    return counts.orderBy(*_order()).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*_order())).cast("long"))


def total_to_process(rows: DataFrame) -> DataFrame:
    """(total): all listing rows, repeated ones too."""
    return rows.agg(F.count("*").alias("total"))
