"""Write semantics on snapshots: each operator takes the stored and the new rows and gives the next snapshot.

Parquet has no update in place; a snapshot is written beside the old one and swapped in. All are joins or windows on
the key, so a delta of any size costs one shuffle of both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pair(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    a = old.select(*key, F.struct(*old.columns).alias("_old"))
    return a.join(new.select(*key, F.struct(*new.columns).alias("_new")), key, "full_outer")


def classify(old: DataFrame, new: DataFrame, key: list[str], content: str = "content_hash") -> DataFrame:
    """New rows with ``action``: inserted, updated (other content) or unchanged; null contents compare as equal."""
    stored = old.select(*key, F.col(content).alias("_content"), F.lit(True).alias("_stored"))
    rows = new.join(stored, key, "left")
    action = F.when(F.col("_stored").isNull(), "inserted").when(F.col("_content").eqNullSafe(F.col(content)), "unchanged").otherwise("updated")
    return rows.withColumn("action", action).drop("_content", "_stored")


def conditional_upsert(old: DataFrame, new: DataFrame, key: list[str], content: str = "content_hash") -> DataFrame:
    """The next snapshot: a new row replaces a stored one only if its content differs."""
    joined = _pair(old, new, key)
    keep_old = F.col("_new").isNull() | F.col(f"_old.{content}").eqNullSafe(F.col(f"_new.{content}")) & F.col("_old").isNotNull()
    return joined.select(F.when(keep_old, F.col("_old")).otherwise(F.col("_new")).alias("r")).select("r.*")


def keyed_upsert(old: DataFrame, new: DataFrame, key: list[str], order: Column) -> DataFrame:
    """The last row of each key by ``order``, new rows before stored ones of equal order."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy(*key).orderBy(order.desc_nulls_last(), F.col("_new").desc())
    return both.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank", "_new")


def insert_absent(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Stored rows and the new ones whose key isn't stored."""
    return old.unionByName(new.join(old.select(*key), key, "left_anti"))


def union_upsert(old: DataFrame, new: DataFrame, key: list[str], arrays: list[str]) -> DataFrame:
    """New rows replace stored ones; the array columns of both are united and sorted."""
    joined = _pair(old, new, key)
    none = F.array().cast("array<string>")
    columns = [
        F.array_sort(F.array_union(F.coalesce(F.col(f"_old.{c}"), none), F.coalesce(F.col(f"_new.{c}"), none))).alias(c) if c in arrays else F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
        for c in new.columns
    ]
    return joined.select(*columns)


def retire_absent(old: DataFrame, new: DataFrame, key: list[str], now: Column) -> DataFrame:
    """A rebuilt snapshot: new rows live; stored ones that are no longer built keep their row and get ``retired_at``."""
    live = new.withColumn("retired_at", F.lit(None).cast("timestamp_ntz"))
    gone = old.join(new.select(*key), key, "left_anti").withColumn("retired_at", F.coalesce("retired_at", now))
    return live.unionByName(gone, allowMissingColumns=True)


def update_columns(old: DataFrame, new: DataFrame, key: list[str], columns: list[str], content: str = "content_hash") -> DataFrame:
    """The next snapshot: of a stored row whose content differs only ``columns`` and the content are taken from the new one;
    rows without a stored one are inserted whole; all else stays."""
    joined = _pair(old, new, key)
    differs = F.col("_new").isNotNull() & ~F.col(f"_old.{content}").eqNullSafe(F.col(f"_new.{content}"))
    taken = lambda c: F.when(F.col("_old").isNull(), F.col(f"_new.{c}")).when(differs, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}"))
    kept = lambda c: F.when(F.col("_old").isNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}"))
    return joined.select(*key, *[(taken(c) if c in (*columns, content) else kept(c)).alias(c) for c in old.columns if c not in key])


def append_run(df: DataFrame, folder: str, run: str) -> None:
    """Appends the rows of a run to a table partitioned by ``run_id``; writing a run again replaces it, so that a repeated
    run doesn't leave its rows twice."""
    df.withColumn("run_id", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(folder)


def rebuild(df: DataFrame, folder: str) -> None:
    """Replaces a table by rows that don't come from it."""
    df.write.mode("overwrite").parquet(folder)
