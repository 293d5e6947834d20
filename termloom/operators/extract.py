"""Skills of a record: from its field, from its text, or both.

The text operator looks for the longest alias first and blanks out what it found before it looks for shorter ones, so
"apache beam" leaves no "apache" behind.  It has two physical forms with equal results: an Arrow UDF, which finds the
aliases a text contains in one pass of an automaton and then replays only those, and a fold of built-in expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.dictionary import Matcher
from termloom.functions.html import html_text
from termloom.functions.text import WORD_CHAR, normalize_term, quote_literal

MODES = ("key-skills", "description", "both")


def compile_matcher(matcher: Matcher) -> Callable[[str | None], list[str]]:
    """A function from a text to its canonical skills, in the order in which they are found; empty for null."""
    patterns = [(a, c, re.compile(rf"(?<!\w){re.escape(a)}(?!\w)")) for a, c in matcher.entries]
    present = None
    if matcher.prefilter and patterns:
        try:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            numbers: dict[str, list[int]] = {}
            for i, (a, _, _) in enumerate(patterns):
                numbers.setdefault(a, []).append(i)
            for a, own in numbers.items():
                automaton.add_word(a, own)
            automaton.make_automaton()
            present = lambda text: sorted({i for _, own in automaton.iter(text) for i in own})
        except ImportError:
            present = lambda text: [i for i, (a, _, _) in enumerate(patterns) if a in text]

    def skills(text: str | None) -> list[str]:
        if not text:
            return []
        rest, found = text.lower(), {}
        for i in present(rest) if present else range(len(patterns)):
            _, canonical, pattern = patterns[i]
            left, n = pattern.subn(" ", rest)
            if n:
                found.setdefault(canonical)
                rest = left
        return list(found)

    return skills


def skills_in_text(col: Column, dictionary: dict[str, str] | Iterable[str]) -> Column:
    """array<string>: canonical skills found in a text, longest alias first; empty for null and empty texts (Arrow UDF).

    It is declared non-deterministic, so that the optimiser doesn't copy it: a filter on the result, such as that which an
    explode implies, would run it a second time for each text."""
    return _text_udf(dictionary)(col)


def _text_udf(dictionary: dict[str, str] | Iterable[str]):  # noqa: ANN202
    matcher, made = Matcher.of(dictionary), []

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(compile_matcher(matcher))
        return texts.map(made[0], na_action=None)

    return run.asNondeterministic()


def register(spark: SparkSession, dictionary: dict[str, str] | Iterable[str]) -> None:
    """Makes the search of a dictionary known to SQL, as ``skills_in_text``."""
    spark.udf.register("skills_in_text", _text_udf(dictionary))


def skills_in_text_native(col: Column, dictionary: dict[str, str] | Iterable[str]) -> Column:
    """``skills_in_text`` as a fold of built-in expressions, for plans without Python."""
    matcher = Matcher.of(dictionary)
    text = F.lower(F.coalesce(col, F.lit("")))
    if not matcher.entries:
        return F.array().cast("array<string>")
    entries = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(c).alias("c")) for a, c in matcher.entries])
    if matcher.prefilter:
        entries = F.filter(entries, lambda e: F.contains(text, e.a))
    pattern = lambda e: F.concat(F.lit(f"(?<![{WORD_CHAR}])"), quote_literal(e.a), F.lit(f"(?![{WORD_CHAR}])"))
    start = F.struct(text.alias("rest"), F.array().cast("array<string>").alias("found"))
    step = lambda s, e: F.when(
        F.regexp_like(s.rest, pattern(e)),
        F.struct(F.regexp_replace(s.rest, pattern(e), F.lit(" ")).alias("rest"), F.array_union(s.found, F.array(e.c)).alias("found")),
    ).otherwise(s)
    return F.aggregate(entries, start, step, lambda s: s.found)


def key_skill_names(col: Column) -> Column:
    """Names of a ``key_skills`` array; empty for a null array, null for entries without a name."""
    return F.transform(F.coalesce(col, F.array().cast("array<struct<name:string>>")), lambda x: x["name"])


def unique_skills(col: Column) -> Column:
    """Normalised names, blank and null ones out, each once, in the order of first appearance."""
    return F.array_distinct(F.filter(F.transform(col, lambda x: normalize_term(x)), lambda x: x.isNotNull() & (x != "")))


def description_skills(description: Column, dictionary: dict[str, str] | Iterable[str]) -> Column:
    """Skills of a marked-up description; the mark-up is taken out without putting spaces in its place."""
    if not dictionary:
        raise ValueError("the dictionary is empty")
    return skills_in_text(html_text(description), dictionary)


def effective_mode(mode: Column | str, source: Column, html_fallback: bool) -> Column:
    """The mode for one record: ``description`` in place of ``key-skills`` for records of pages, if that is wanted."""
    mode = F.lit(mode) if isinstance(mode, str) else mode
    return F.when(F.lit(html_fallback) & (mode == "key-skills") & (source == "html"), "description").otherwise(mode)


def record_skills(mode: Column, key_skills: Column, described: Column) -> Column:
    """Unique skills by a mode for each record; ``described`` are the skills of the text.  An unknown mode is an error."""
    named = key_skill_names(key_skills)
    wanted = (
        F.when(mode == "key-skills", named)
        .when(mode == "description", described)
        .when(mode == "both", F.concat(unique_skills(named), unique_skills(described)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown mode: "), F.coalesce(mode, F.lit("null")))).cast("array<string>"))
    )
    return unique_skills(wanted)
