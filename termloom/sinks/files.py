"""What a run leaves behind: the result file, a chart of its head, and the progress document."""

from __future__ import annotations

import csv
import json
import logging
import os
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def write_result(ranked: DataFrame, path: str) -> None:
    """A folder of ``Count,Skill`` part files in rank order: ranges of ranks, so that no task writes everything."""
    rows = ranked.repartitionByRange("rank").sortWithinPartitions("rank").select(F.col("count").alias("Count"), F.col("skill").alias("Skill"))
    _as_csv(rows).csv(path)


def _as_csv(rows: DataFrame):  # noqa: ANN202
    """A writer of result files, of which no character is changed by writing and reading."""
    out = rows.write.mode("overwrite").option("header", True).option("lineSep", "\r\n").option("escape", '"')
    return out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)


def write_runs(rows: DataFrame, path: str) -> None:
    """Result files of many runs, rows (run_id, line_no, count, skill): a folder ``run_id=...`` a run, its lines in order."""
    own = rows.repartition("run_id").sortWithinPartitions("run_id", "line_no").select("run_id", F.col("count").alias("Count"), F.col("skill").alias("Skill"))
    _as_csv(own).partitionBy("run_id").csv(path)


def save_result_file(rows: list[tuple[str, int]], path: str) -> None:
    """One file ``Count,Skill`` of (skill, count) in the given order; only a header, and a warning, where there are none."""
    if not rows:
        log.warning("there are no skills to write")
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(["Count", "Skill"])
        out.writerows((int(n), s) for s, n in rows)


def save_progress(data: dict, path: str) -> None:
    """A progress document, replaced as a whole: a reader meets the old or the new one, never a part."""
    folder = os.path.dirname(os.path.abspath(path))
    fd, name = tempfile.mkstemp(dir=folder, suffix=".part")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            json.dump(data, f, ensure_ascii=False, indent=2)
        os.replace(name, path)
    except BaseException:
        os.unlink(name)
        raise


def save_chart(rows: list[tuple[str, int]], n: int, path: str) -> bool:
    """The first n rows as horizontal bars; false, with a warning, without matplotlib or rows."""
    if n < 0:
        raise ValueError("n must not be negative")
    head = rows[:n]
    try:
        from matplotlib import pyplot
    except ImportError:
        log.warning("matplotlib isn't installed; no chart")
        return False
    if not head:
        log.warning("there are no skills to draw")
        return False
    figure, axes = pyplot.subplots(figsize=(12, max(10, 0.45 * len(head))))
    shades = pyplot.get_cmap("viridis")
    bars = axes.barh([s for s, _ in head], [c for _, c in head], color=[shades(i / max(1, len(head) - 1)) for i in range(len(head))])
    axes.bar_label(bars, padding=3)
    axes.invert_yaxis()
    axes.set_xlabel("Count")
    axes.set_ylabel("Skill")
    axes.set_title(f"Top {len(head)} skills")
    figure.tight_layout()
    figure.savefig(path, dpi=150)
    pyplot.close(figure)
    return True


def chart_from_result(spark, csv_path: str, chart_path: str, n: int) -> bool:  # noqa: ANN001
    """A chart of an earlier result file; raises without matplotlib."""
    import importlib.util

    from termloom.sources.files import load_result

    if importlib.util.find_spec("matplotlib") is None:
        raise RuntimeError("matplotlib isn't installed")
    head = load_result(spark, csv_path).orderBy(F.desc("count"), "line").limit(n).collect()
    return save_chart([(r.skill, r["count"]) for r in head], n, chart_path)
