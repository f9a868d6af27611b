"""Incremental variants: file-fed stages with checkpoints, change detection by hash, event-time expiry.

A file source with a checkpoint is the unit ledger of a stage: each new file is one unit and is read once. Late rows are
bounded by watermarks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def file_stage(spark: SparkSession, folder: str, schema: str, checkpoint: str, step: Callable[[DataFrame, int], None], kind: str = "parquet", files: int | None = None):
    """Runs ``step`` on each batch of new files and returns when none is left; the checkpoint marks what is done."""
    reader = spark.readStream.format(kind).schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    query = reader.load(folder).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def changed_rows(stream: DataFrame, key: str, content: str, time: str, delay: str = "1 day") -> DataFrame:
    """(key, content, time) of every row whose content isn't that of its key's last row: repeated deliveries are dropped, a
    content that comes back after another isn't. The last content of each key is kept as state; within a batch rows go by
    time, then content. Nulls are a content like any other; rows without a key are dropped."""
    kinds = dict(stream.dtypes)
    out = f"{key} {kinds[key]}, {content} {kinds[content]}, {time} {kinds[time]}"

    def work(who: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, last = (True, state.get[0]) if state.exists else (False, None)
        rows = pd.concat(list(batches)).sort_values([time, content], kind="stable")
        kept = []
        for value in rows[content]:
            value = None if pd.isna(value) else value
            kept.append(not known or value != last)
            known, last = True, value
        state.update((last,))
        yield rows.loc[kept, [key, content, time]]

    slim = stream.select(key, content, time).filter(F.col(key).isNotNull()).withWatermark(time, delay)
    return slim.groupBy(key).applyInPandasWithState(work, out, f"last {kinds[content]}", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows of each value in each window of event time; windows close behind the watermark."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def session_counts(stream: DataFrame, time: str, by: str, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Rows of each session, which ends after a gap without rows."""
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n")
