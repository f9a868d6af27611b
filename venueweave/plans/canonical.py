"""Stage-level plans: canonical venues from raw records, links of review-like records to venues, the nightly run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueweave.functions.text import street_split
from venueweave.operators.blocking import best_match, cross_candidates, decide, fold_clusters, held_entities, same_source_duplicates
from venueweave.operators.components import components
from venueweave.operators.ledger import Run, expire
from venueweave.operators.readmodels import live
from venueweave.operators.upsert import append_run, rebuild, retire_absent
from venueweave.storage import Stash


def canonical_venues(rec: DataFrame, inspections: str = "dohmh", base: str = "osm") -> tuple[DataFrame, DataFrame]:
    """(venues, decisions): one row for each cluster of records, and every decided candidate pair."""
    records = held_entities(rec)
    duplicates = Stash(same_source_duplicates(records), "duplicates").df
    candidates = Stash(cross_candidates(records.filter(F.col("source") == inspections), records.filter(F.col("source") == base)), "candidates").df
    decisions = Stash(decide(candidates, duplicates), "decisions").df
    links = duplicates.select("left_id", "right_id").unionByName(decisions.filter("decision = 'matched'").select("left_id", "right_id"))
    groups = components(links, "left_id", "right_id")
    clusters = records.select("raw_id").join(groups.withColumnRenamed("id", "raw_id"), "raw_id", "left").select("raw_id", F.coalesce("group_id", "raw_id").alias("cluster"))
    return fold_clusters(rec, clusters), decisions


def with_split_address(reviews: DataFrame) -> DataFrame:
    """House number and street out of a one-line address, where no house number is stated."""
    number, street = street_split("street")
    bare = F.coalesce("housenumber", F.lit("")) == ""
    return reviews.withColumns({"housenumber": F.when(bare, number).otherwise(F.col("housenumber")), "street": F.when(bare, street).otherwise(F.col("street"))})


def link_reviews(reviews: DataFrame, venues: DataFrame, region: DataFrame | None = None) -> DataFrame:
    """Review-like records (in the entity table's shape) linked to their best live venue record; those outside ``region``
    are told so."""
    return best_match(held_entities(with_split_address(reviews)), held_entities(live(venues)), region)


def save_canonical(venues: DataFrame, decisions: DataFrame, members: DataFrame, folder: str, run: str, now: Column) -> None:
    """The write half: candidates appended under the run's id, memberships rebuilt, venues merged into the stored snapshot
    (new and changed ones live, those no longer built retired), written beside it and swapped in."""
    append_run(decisions, f"{folder}/match_candidates", run)
    rebuild(members, f"{folder}/venue_sources")
    spark, target = venues.sparkSession, f"{folder}/venues"
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stored = spark.read.parquet(target) if system.exists(path(target)) else venues.withColumn("retired_at", F.lit(None).cast("timestamp_ntz")).limit(0)
    retire_absent(stored, venues, ["key"], now).write.mode("overwrite").parquet(f"{target}.next")
    system.delete(path(target), True)
    system.rename(path(f"{target}.next"), path(target))


def nightly(run: Run, progress: DataFrame, stages: dict[str, Callable[[], None]], now, force: bool = False) -> DataFrame:
    """Expires stale markers, then runs every stage in order inside one ledger entry, so that a failing stage fails the
    run. Resolving the records again belongs to the stages: new raw records become venues the same night."""
    kept = expire(progress, now, force=force)
    run.stats["markers_kept"] = kept.count()
    for name, stage in stages.items():
        stage()
        run.bump(f"ran_{name}")
    return kept
