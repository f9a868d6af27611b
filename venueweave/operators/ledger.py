"""Run ledger, unit markers and expiry: what makes stages resumable."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venueweave.functions.ranking import top_by

# Days after which the units of a source are stale.
TTL_DAYS = {"infatuation": 30, "wikipedia": 14, "wikivoyage": 14, "osm": 30, "dohmh": 7}

RUNS = "id string, stage string, started_at timestamp, finished_at timestamp, status string, stats map<string,bigint>, error string"
PROGRESS = "stage string, unit_key string, done_at timestamp, run_id string, stats map<string,bigint>"


#: Markers that are written in one file.
MARKERS = 1_000


def pending(units: DataFrame, progress: DataFrame, stage: str, key: str = "unit_key") -> DataFrame:
    """Units of a stage without a marker."""
    return units.join(progress.filter(F.col("stage") == stage).select(F.col("unit_key").alias(key)), key, "left_anti")


def expire(progress: DataFrame, now: Column, ttl: dict[str, int] = TTL_DAYS, force: bool = False) -> DataFrame:
    """The markers that stay: those of other sources and those younger than their source's days."""
    source = F.split_part("unit_key", F.lit(":"), F.lit(1))
    days = F.try_element_at(F.create_map(*[F.lit(x) for pair in ttl.items() for x in pair]), source)
    stale = F.col("unit_key").contains(":") & days.isNotNull() & (F.lit(force) | (F.col("done_at") < now - F.make_interval(days=days)))
    return progress.filter(~stale)


def next_run(now: dt.datetime, hour: int, minute: int = 0) -> dt.datetime:
    """Today's slot if it is still to come, else tomorrow's."""
    slot = now.replace(hour=hour, minute=minute, second=0, microsecond=0)
    return slot if slot > now else slot + dt.timedelta(days=1)


def latest_markers(progress: DataFrame) -> DataFrame:
    """One marker for each stage and unit: the last one written."""
    return top_by(progress, ["stage", "unit_key"], F.col("done_at").desc_nulls_last(), F.col("run_id").desc_nulls_last())


def stage_counters(df: DataFrame, by: list[str], counter: str) -> DataFrame:
    """(by, stats): the rows of each value of a column, as the map a run keeps, counted from the data."""
    counts = df.filter(F.col(counter).isNotNull()).groupBy(*by, counter).agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(counter, "n")))).alias("stats"))


def run_daily(job: Callable[[], None], hour: int, minute: int = 0, clock: Callable[[], dt.datetime] = dt.datetime.now, sleep: Callable[[float], None] = time.sleep, heartbeat: Callable[[dict], None] = lambda _: None, times: int | None = None) -> None:
    """Runs a job once a day at this time, for so many days or for ever. A heartbeat is sent each minute of waiting and after
    each run; a run that fails is reported in it and doesn't end the loop."""
    done = 0
    while times is None or done < times:
        due = next_run(clock(), hour, minute)
        while (left := (due - clock()).total_seconds()) > 0:
            heartbeat({"state": "waiting", "next_run": due})
            sleep(min(left, 60.0))
        try:
            job()
            heartbeat({"state": "succeeded", "last_run": due})
        except Exception as error:
            heartbeat({"state": "failed", "last_run": due, "error": str(error)})
        done += 1


class Run:
    """A stage's run: appends a row on start and one on end (succeeded, failed or interrupted); markers as it goes."""

    def __init__(self, spark: SparkSession, folder: str, stage: str, clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None)):
        self.spark, self.folder, self.stage, self.clock = spark, folder.rstrip("/"), stage, clock
        self.stats: dict[str, int] = {}
        self.markers: list[tuple] = []
        self.started = clock()
        self.id = f"{stage}-{self.started:%Y%m%dT%H%M%S%f}"

    def _append(self, table: str, schema: str, *rows: tuple) -> None:
        self.spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/{table}")

    def __enter__(self) -> Run:
        self._append("pipeline_runs", RUNS, (self.id, self.stage, self.started, None, "running", {}, None))
        return self

    def __exit__(self, kind, error, trace) -> bool:
        self.write_markers()
        status = "succeeded" if kind is None else "interrupted" if kind is KeyboardInterrupt else "failed"
        self._append("pipeline_runs", RUNS, (self.id, self.stage, self.started, self.clock(), status, self.stats, None if error is None else str(error)[:2000]))
        return False

    def bump(self, name: str, n: int = 1) -> None:
        self.stats[name] = self.stats.get(name, 0) + n

    def mark_done(self, unit: str, stats: dict[str, int] | None = None) -> None:
        """Notes a unit as done; the markers are written together, when ``MARKERS`` have come up and when the run ends."""
        self.markers.append((self.stage, unit, self.clock(), self.id, stats or {}))
        if len(self.markers) >= MARKERS:
            self.write_markers()

    def write_markers(self) -> None:
        if self.markers:
            self._append("stage_progress", PROGRESS, *self.markers)
            self.markers = []

    def mark_all_done(self, units: DataFrame, key: str = "unit_key") -> None:
        """Notes every unit of a table as done, without bringing them to the driver."""
        done = units.select(F.lit(self.stage).alias("stage"), F.col(key).alias("unit_key"), F.lit(self.clock()).alias("done_at"), F.lit(self.id).alias("run_id"), F.create_map().cast("map<string,bigint>").alias("stats"))
        done.write.mode("append").parquet(f"{self.folder}/stage_progress")

    def runs(self) -> DataFrame:
        """The ledger: the last row of each run."""
        rows = self.spark.read.schema(RUNS).parquet(f"{self.folder}/pipeline_runs")
        return rows.groupBy("id").agg(*[F.max_by(c, F.struct(F.col("finished_at").isNotNull(), "finished_at")).alias(c) for c in ("stage", "started_at", "finished_at", "status", "stats", "error")])
