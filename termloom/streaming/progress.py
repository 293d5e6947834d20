"""Resumable and incremental counting.

State is two tables in a folder: the ids that were processed and partial counts.  A micro-batch appends to both under
its own number and is complete when its mark is written last; what an interrupted batch left behind is overwritten
when it is replayed.  So ids and counts always belong together and every record counts once, however often a batch runs.
Batches are merged into longer segments, so that many small ones stay few files.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termloom.operators import counts as counting
from termloom.sinks.files import save_progress
from termloom.sources.files import load_progress


def fingerprint(queries: list[str], mode: str, strict: dict | None = None) -> dict:
    """What a saved state must agree with to be used: the phrases and the mode; in strict form also all of ``strict``
    (dictionary, source, limit, area), as one hash."""
    out = {"queries": list(queries), "mode": mode}
    if strict is not None:
        out["strict"] = hashlib.sha256(json.dumps(strict, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()
    return out


def usable(saved: dict, wanted: dict) -> bool:
    """Whether a saved progress document may be resumed."""
    return bool(saved) and all(saved.get(k) == v for k, v in wanted.items())


def resume_document(path: str, wanted: dict) -> tuple[list[str], dict[str, int]]:
    """Processed ids and counts of a progress document that fits, else nothing."""
    saved = load_progress(path)
    if not usable(saved, wanted):
        return [], {}
    return list(saved.get("processed_vacancy_ids", [])), dict(saved.get("current_skill_counts", {}))


def save_document(path: str, wanted: dict, ids: list[str], skill_counts: dict[str, int]) -> None:
    """Ids and counts in one document, so that they can't come apart."""
    save_progress({**wanted, "processed_vacancy_ids": ids, "current_skill_counts": skill_counts}, path)


#: Segments of a state that are merged into one.
MERGED = 8
_STATE = {"ids": "id string", "counts": "skill string, count bigint, batch bigint, first_seen struct<query_ord:int,pos:int,skill_pos:int>"}


class State:
    """Processed ids and counts in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):  # noqa: ANN202
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _done(self) -> list[tuple[int, int]]:
        """The complete segments (first batch, last batch), in order; those that a merged one holds are left out."""
        fs, make = self._fs()
        folder = make(f"{self.path}/done")
        if not fs.exists(folder):
            return []
        found = sorted((int(a), int(b)) for a, b in (s.getPath().getName().split("-") for s in fs.listStatus(folder)))
        return [x for x in found if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in found)]

    def next_batch(self) -> int:
        """The number after that of the last complete batch."""
        return max((b for _, b in self._done()), default=-1) + 1

    def keep_for(self, wanted: dict) -> None:
        """Empties the state unless it was kept for the same fingerprint."""
        fs, make = self._fs()
        text = json.dumps(wanted, ensure_ascii=True, sort_keys=True)
        key = make(f"{self.path}/key/" + hashlib.sha256(text.encode()).hexdigest())
        if not fs.exists(key):
            fs.delete(make(self.path), True)
            fs.create(key, True).close()

    def _read(self, kind: str, segments: list[tuple[int, int]]) -> DataFrame:
        paths = [f"{self.path}/{kind}/{a}-{b}" for a, b in segments]
        schema = _STATE[kind]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def processed(self) -> DataFrame:
        """(id) of all records of complete batches, those without skills too."""
        return self._read("ids", self._done())

    def counts(self) -> DataFrame:
        """(skill, count, first_seen) over all complete batches."""
        return self._summed(self._done())

    def _summed(self, segments: list[tuple[int, int]]) -> DataFrame:
        place = F.struct("batch", "first_seen.query_ord", "first_seen.pos", "first_seen.skill_pos")
        return self._read("counts", segments).groupBy("skill").agg(F.sum("count").alias("count"), F.min(place).alias("first_seen"))

    def _write(self, kind: str, df: DataFrame, a: int, b: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{kind}/{a}-{b}")

    def _mark(self, a: int, b: int) -> None:
        fs, make = self._fs()
        fs.create(make(f"{self.path}/done/{a}-{b}"), True).close()

    def add(self, rows: DataFrame, batch: int) -> bool:
        """Adds a batch of (id, query_ord, pos, skills); false where it was complete already.  Ids of earlier batches,
        and all rows but the first of an id, are left out."""
        if any(a <= batch <= b for a, b in self._done()):
            return False
        first = rows.groupBy("id").agg(F.min(F.struct("query_ord", "pos", "skills")).alias("r")).select("id", "r.*")
        fresh = f"{self.path}/rows/{batch}"
        first.join(self.processed(), "id", "left_anti").write.mode("overwrite").parquet(fresh)
        rows = self.spark.read.parquet(fresh)
        self._write("ids", rows.select("id"), batch, batch)
        out = counting.skill_counts(rows).withColumn("batch", F.lit(batch).cast("bigint"))
        place = F.struct(*[F.col(f"first_seen.{c}").cast("int").alias(c) for c in ("query_ord", "pos", "skill_pos")])
        self._write("counts", out.select("skill", "count", "batch", place.alias("first_seen")), batch, batch)
        fs, make = self._fs()
        fs.delete(make(fresh), True)
        self._mark(batch, batch)
        self._merge()
        return True

    def _merge(self) -> None:
        """Makes one segment of the last ``MERGED`` ones where these are of equal length, again and again: a stream of n
        batches has a number of segments that grows as the logarithm of n, and a row is rewritten as often."""
        while True:
            last = self._done()[-MERGED:]
            lengths = {b - a + 1 for a, b in last}
            if len(last) < MERGED or len(lengths) > 1 or last[-1][1] - last[0][0] + 1 != MERGED * lengths.pop():
                return
            a, b = last[0][0], last[-1][1]
            self._write("ids", self._read("ids", last), a, b)
            place = F.struct(*[F.col(f"first_seen.{c}").alias(c) for c in ("query_ord", "pos", "skill_pos")])
            self._write("counts", self._summed(last).select("skill", "count", F.col("first_seen.batch").alias("batch"), place.alias("first_seen")), a, b)
            self._mark(a, b)
            fs, make = self._fs()
            for kind in ("done", "ids", "counts"):  # marks first: an unmarked folder is read by nobody
                for x, y in last:
                    fs.delete(make(f"{self.path}/{kind}/{x}-{y}"), True)


def count_stream(source: DataFrame, skills: Callable[[DataFrame], DataFrame], state: State, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Counts a stream of records into ``state``; ``skills`` turns a batch into (id, query_ord, pos, skills).

    A batch that is run again after a failure changes nothing.  Ids are deduplicated against the state, so the stream
    itself keeps none in memory."""
    out = source.writeStream.foreachBatch(lambda df, batch: state.add(skills(df), batch) and None).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if available_now else out).start()


def batches_of(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    """A stream of the Parquet files of a folder, so many files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
