"""Command line: ``python -m termloom.plans.cli help | run | chart``."""

from __future__ import annotations

import logging
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators.pages import listings_of_pages
from termloom.plans import pipeline
from termloom.plans.settings import Settings, parse, parser, split_command
from termloom.session import build_session
from termloom.sinks.files import chart_from_result, save_chart, save_result_file, write_result
from termloom.sources import collect
from termloom.sources.files import load_dictionary, load_queries
from termloom.sources.pages import ProxyUnavailable, RequestFailed

log = logging.getLogger("termloom")


def print_help() -> None:
    print("Commands:\n  help   this text\n  run    counts skills and writes the result\n  chart  draws an earlier result (--chart-input)\n")
    parser().print_help()


def _run(spark: SparkSession, settings: Settings) -> DataFrame:
    saved = settings.output.rstrip("/") + ".progress"
    how = {"mode": settings.mode, "html_fallback": settings.html_description_fallback, "limit": settings.vacancies_limit, "source": settings.source, "save_every": settings.save_every, "strict": settings.strict_resume}
    if not settings.pages:
        return pipeline.run_saved(spark, settings.input, saved, **how)
    queries = load_queries(spark, settings.phrases).withColumnRenamed("query", "query_text")
    listings, details = (os.path.join(settings.pages, x) for x in ("listings", "details"))
    if settings.fetch:
        fetcher = collect.load_fetcher(settings.fetch, settings)
        phrases = [(r.query_ord, r.query_text) for r in queries.orderBy("query_ord").collect()]
        collect.collect_listings(fetcher, phrases, settings, listings)
        listed = listings_of_pages(collect.stored_listing_pages(spark, listings), settings.vacancies_limit, settings.source)
        rows = pipeline.selected(listed.where("id is not null"), queries, columns=["alternate_url", "_source"]).orderBy("query_ord", "pos")
        collect.collect_details(fetcher, ((r.id, r.alternate_url, r["_source"]) for r in rows.toLocalIterator()), settings, details)
    aliases = load_dictionary(spark, settings.dictionary)
    return pipeline.run_pages(spark, collect.stored_listing_pages(spark, listings), collect.stored_detail_pages(spark, details), queries, aliases, saved, **how)


def main(argv: list[str] | None = None) -> int:
    """0 for success, 1 where the source or the proxy ends the run, 2 where a chart can't be made."""
    command, options = split_command(sys.argv[1:] if argv is None else argv)
    if command == "help":
        print_help()
        return 0
    settings = parse(options)
    logging.basicConfig(level=os.environ.get("LOGLEVEL", "INFO").upper())
    spark = build_session()
    picture = os.path.splitext(settings.output)[0] + ".png"
    if command == "chart":
        try:
            chart_from_result(spark, settings.chart_input or settings.output, picture, settings.skills_show_count)
        except (FileNotFoundError, RuntimeError, ValueError) as e:
            log.error("%s", e)
            return 2
        return 0
    if not settings.input and not settings.pages:
        raise SystemExit("--input, the folder of the tables, or --pages, that of stored pages, is needed")
    try:
        ranked = _run(spark, settings)
    except (ProxyUnavailable, RequestFailed) as e:
        log.critical("%s; the run ends", e)
        return 1
    if settings.output.endswith(".csv"):
        rows = [(r.skill, r["count"]) for r in ranked.orderBy("rank").select("skill", "count").toLocalIterator()]  # a named file is for results of a file's size
        save_result_file(rows, settings.output)
        if not settings.no_chart:
            save_chart(rows, settings.skills_show_count, picture)
    else:
        write_result(ranked, settings.output)
        if not settings.no_chart:
            head = ranked.where(F.col("rank") <= settings.skills_show_count).orderBy("rank").collect()
            save_chart([(r.skill, r["count"]) for r in head], settings.skills_show_count, settings.output.rstrip("/") + ".png")
    return 0


if __name__ == "__main__":
    sys.exit(main())
