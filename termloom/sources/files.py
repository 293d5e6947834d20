"""Small files a run starts from: phrases, dictionaries, earlier results, progress and environment files."""

from __future__ import annotations

import json
import logging
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.dictionary import parse_alias_lines
from termloom.functions.text import PYTHON_SPACE, strip
from termloom.session import checkpointed

log = logging.getLogger(__name__)
#: What a missing file is created with.
QUERY_TEMPLATE = "# one search phrase a line\nai wizard intern\nпопутчик по легаси\n"
SKILL_TEMPLATE = "# canonical name | other name | other name\npython\nkubernetes | k8s\nтерпение к легаси\n"
QUERIES = T.StructType([T.StructField("query_ord", T.IntegerType(), False), T.StructField("query", T.StringType(), False)])
ALIASES = T.StructType([T.StructField("ord", T.IntegerType(), False), T.StructField("alias", T.StringType(), False), T.StructField("canonical", T.StringType(), False)])
RESULT = "Count bigint, Skill string"


def ensure_file(path: str | os.PathLike, content: str, what: str) -> bool:
    """Creates a missing file, with its folder; whether it did."""
    p = Path(path)
    if p.exists():
        return False
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(content, encoding="utf-8")
    log.warning("%s was missing; %s written", p, what)
    return True


def plain_query(text: str) -> str:
    """A phrase without surrounding white space and one matching pair of outer quotes."""
    text = text.strip()
    if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'":
        return text[1:-1].strip()
    return text


def load_queries(spark: SparkSession, path: str) -> DataFrame:
    """(query_ord, query) of a file with a phrase a line, in its order, repeats kept.

    Blank lines and lines whose very first character is # are left out, as are phrases that are empty without quotes."""
    ensure_file(path, QUERY_TEMPLATE, "an example of phrases")
    with open(path, encoding="utf-8") as f:
        phrases = [q for line in f if line.strip() and not line.startswith("#") and (q := plain_query(line))]
    return spark.createDataFrame(list(enumerate(phrases)), QUERIES)


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(ord, alias, canonical) of a file ``canonical | alias | alias``; an alias of two skills raises."""
    ensure_file(path, SKILL_TEMPLATE, "an example dictionary")
    with open(path, encoding="utf-8") as f:
        pairs = parse_alias_lines(f)
    return spark.createDataFrame([(i, a, c) for i, (a, c) in enumerate(pairs.items())], ALIASES)


def load_result(spark: SparkSession, path: str, by: str | None = None) -> DataFrame:
    """(skill, count, line): a result file read again; of a repeated skill the last count, at its first place.

    ``by`` names the part of the folder's names (``run_id=...``) that tells results of several runs apart; it comes first.
    Other columns, or counts that are no whole numbers, raise; blank skills are left out.  A file without rows raises
    ``ValueError``.  The rows are written down at once, so the file may go afterwards."""
    lines = spark.read.csv(path, schema=RESULT, header=True, mode="FAILFAST", enforceSchema=False, quote='"', escape='"', multiLine=True)
    run = [F.regexp_extract(F.col("_metadata.file_path"), f"/{by}=([^/]*)/", 1).alias(by)] if by else []
    lines = lines.select(*run, "Count", strip(F.col("Skill"), PYTHON_SPACE).alias("skill"), F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")).alias("line")).where("skill is not null and skill <> ''")
    out = checkpointed(lines.groupBy(*([by] if by else []), "skill").agg(F.max_by("Count", "line").alias("count"), F.min("line").alias("line")))
    if out.isEmpty():
        raise ValueError(f"{path} has no skills")
    return out


def load_progress(path: str) -> dict:
    """A progress document, or an empty one where there is none; a broken one raises."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


#: A line of an environment file: a name, an equals sign and a value, perhaps quoted.
_ASSIGNMENT = re.compile(r"""^\s*(?P<key>[^#=\s][^=]*?)\s*=\s*(?:(?P<quote>["'])(?P<quoted>.*)(?P=quote)|(?P<plain>.*?))\s*$""")


def read_env(text: str) -> dict[str, str]:
    """The pairs of an environment file; other lines than blank ones and comments are reported and left out."""
    pairs = {}
    for number, line in enumerate(text.splitlines(), 1):
        if m := _ASSIGNMENT.match(line):
            pairs[m["key"]] = m["plain"] if m["quote"] is None else m["quoted"]
        elif line.strip() and not line.lstrip().startswith("#"):
            log.warning("line %d of the environment file is no assignment", number)
    return pairs


def load_env_file(path: str, override: bool = False) -> bool:
    """Sets the variables of a file; what is set already stays unless ``override``.  Whether the file exists."""
    if not os.path.exists(path):
        return False
    pairs = read_env(Path(path).read_text(encoding="utf-8"))
    os.environ.update(pairs if override else {k: v for k, v in pairs.items() if k not in os.environ})
    return True
