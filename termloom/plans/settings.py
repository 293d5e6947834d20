"""Settings of a run, and the command line that sets them."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, field, fields

from termloom.operators.extract import MODES
from termloom.sources.files import load_env_file

COMMANDS = ("help", "run", "chart")
TRUE = frozenset("1 true yes on".split())


# The names of the options and their defaults are the interface.
@dataclass
class Settings:
    output: str = "skills.csv"
    area: int = 1
    vacancies_limit: int = 2000
    skills_show_count: int = 50
    mode: str = "key-skills"
    save_every: int = 10
    browser_user_agent: str | None = None
    proxy: str | None = None
    request_timeout: float = 20.0
    page_delay_min: float = 2.0
    page_delay_max: float = 5.0
    vacancy_delay_min: float = 1.0
    vacancy_delay_max: float = 3.0
    source: str = "auto"
    html_description_fallback: bool = False
    no_chart: bool = False
    chart_input: str | None = None
    env_file: str = ".env"
    no_dotenv: bool = False
    input: str | None = None
    strict_resume: bool = field(default=False)
    pages: str | None = None
    phrases: str = "queries.txt"
    dictionary: str = "skills_whitelist.txt"
    fetch: str | None = None

    def check(self) -> Settings:
        """The settings, or ``ValueError`` for what can't be."""
        if self.mode not in MODES:
            raise ValueError(f"unknown mode: {self.mode}")
        if self.source not in ("api", "html", "auto"):
            raise ValueError(f"unknown source: {self.source}")
        if self.vacancies_limit <= 0 or self.save_every <= 0 or self.request_timeout <= 0:
            raise ValueError("limits and timeouts must be positive")
        if not (0 <= self.page_delay_min <= self.page_delay_max and 0 <= self.vacancy_delay_min <= self.vacancy_delay_max):
            raise ValueError("a smallest delay is above its largest one")
        if self.skills_show_count < 0:
            raise ValueError("the number of skills to show must not be negative")
        return self


def split_command(argv: list[str]) -> tuple[str, list[str]]:
    """The command and its options; no argument means help.  Anything else than a known command ends the program."""
    if not argv or argv[0] in ("-h", "--help", "help"):
        return "help", []
    if argv[0] not in COMMANDS:
        raise SystemExit(f"unknown command: {argv[0]}; one of {', '.join(COMMANDS)} is needed")
    if any(x in ("-h", "--help") for x in argv[1:]):
        raise SystemExit(f"for help use: {COMMANDS[0]}")
    return argv[0], argv[1:]


def bootstrap(argv: list[str]) -> tuple[str, bool]:
    """The environment file and whether to leave it out: read before the other options, whose defaults it may set."""
    p = argparse.ArgumentParser(add_help=False)
    p.add_argument("--env-file", default=os.environ.get("TERMLOOM_ENV_FILE", ".env"))
    p.add_argument("--no-dotenv", action="store_true")
    known, _ = p.parse_known_args(argv)
    return known.env_file, known.no_dotenv


def _absolute(path: str) -> str:
    return path if "://" in path else os.path.abspath(path)


def parser() -> argparse.ArgumentParser:
    d, env = Settings(), os.environ.get
    flag = lambda name: (env(name) or "").lower() in TRUE
    p = argparse.ArgumentParser(prog="termloom", description="Counts the skills that vacancies ask for.")
    p.add_argument("-o", "--output", default=d.output, help="result file (Count,Skill)")
    p.add_argument("-a", "--area", type=int, default=d.area, help="region number")
    p.add_argument("--vacancies-limit", type=int, default=d.vacancies_limit, help="rows for each phrase")
    p.add_argument("--skills-show-count", "--skills-count", type=int, default=d.skills_show_count, help="bars of the chart")
    p.add_argument("-m", "--mode", choices=MODES, default=d.mode, help="where skills are taken from")
    p.add_argument("--save-every", type=int, default=d.save_every, help="records between two savings of progress")
    p.add_argument("--browser-user-agent", default=env("TERMLOOM_USER_AGENT"))
    p.add_argument("--proxy", default=env("HTTPS_PROXY") or env("HTTP_PROXY"))
    p.add_argument("--request-timeout", type=float, default=d.request_timeout)
    for name in ("page_delay_min", "page_delay_max", "vacancy_delay_min", "vacancy_delay_max"):
        p.add_argument("--" + name.replace("_", "-"), type=float, default=getattr(d, name))
    p.add_argument("--source", choices=("api", "html", "auto"), default=d.source)
    p.add_argument("--html-description-fallback", action="store_true", default=flag("TERMLOOM_HTML_DESCRIPTION_FALLBACK"), help="read the text of records that come from pages")
    p.add_argument("--no-chart", action="store_true", default=flag("TERMLOOM_NO_CHART"))
    p.add_argument("--chart-input", help="result file to draw")
    p.add_argument("--env-file", default=d.env_file)
    p.add_argument("--no-dotenv", action="store_true")
    p.add_argument("--input", help="folder of the listings, vacancy, search_queries and skills_whitelist tables")
    p.add_argument("--pages", type=_absolute, help="folder of stored pages (listings, details) to run from in place of tables")
    p.add_argument("--phrases", default=d.phrases, help="file of search phrases, for a run from pages")
    p.add_argument("--dictionary", default=d.dictionary, help="file of skills and their other names, for a run from pages")
    p.add_argument("--fetch", help="module:function that makes a fetcher; missing pages are collected with it first, with the region, proxy, user agent, time limit and delays given here")
    p.add_argument("--strict-resume", action="store_true", help="resume only with the same dictionary, source and limit too")
    return p


def parse(argv: list[str]) -> Settings:
    """Settings of options, the environment and the environment file, in this order of precedence."""
    env_file, skip = bootstrap(argv)
    if not skip:
        load_env_file(env_file)
    given = vars(parser().parse_args(argv))
    return Settings(**{f.name: given[f.name] for f in fields(Settings)}).check()
