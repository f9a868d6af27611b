"""Read models over venues, insights and verdicts: profiles, map, evidence, review queue, status, scorecard, search.

Each is one plan over its tables; pre-aggregates are joined instead of correlated subqueries, so every table is read
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venueweave.functions.ranking import top_by

# Versions whose insights count, stages of the pipeline.
ADOPTED = ["v2", "v3"]
STAGES = ["discover", "dedupe", "collect_reviews", "collect_text", "match_reviews", "extract_insights", "review_sample", "freshness", "claim_readiness"]
TOP_TAGS, EVIDENCE = 5, 6


def live(venues: DataFrame) -> DataFrame:
    """Venues that aren't retired; all of a table that keeps no retirement."""
    return venues.filter("retired_at is null") if "retired_at" in venues.columns else venues


def adopted_insights(insights: DataFrame, reviews: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """Insights on venues under an adopted version, with the source of their review."""
    rows = insights.filter("venue_id is not null")
    rows = rows.filter(F.col("prompt_version").isin(ADOPTED)) if versions is None else rows.join(versions.filter("adopted").select(F.col("version").alias("prompt_version")), "prompt_version", "left_semi")
    return rows.join(reviews.select(F.col("doc_id").alias("raw_review_id"), "source"), "raw_review_id")


def sentiment_value(c: Column) -> Column:
    return F.when(c == "positive", 1).when(c.isin("mixed", "neutral"), 0).when(c == "negative", -1)


def ranked_tags(ins: DataFrame) -> DataFrame:
    """venue_id, vibe_tags_ranked (most frequent first, then by name) and vibe_tag_counts."""
    tags = ins.select("venue_id", F.explode("vibe_tags").alias("tag")).groupBy("venue_id", "tag").agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("tag").alias("tag"))))
    return tags.groupBy("venue_id").agg(F.transform(ordered, lambda t: t["tag"]).alias("vibe_tags_ranked"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("tag", "n")))).alias("vibe_tag_counts"))


def distinct_items(ins: DataFrame, column: str) -> DataFrame:
    return ins.select("venue_id", F.explode(column).alias("x")).groupBy("venue_id").agg(F.sort_array(F.collect_set("x")).alias(column))


def first_evidence(ins: DataFrame) -> DataFrame:
    """The first quotes of each venue, in order of insight and place."""
    rows = ins.select("venue_id", "id", F.posexplode("evidence").alias("pos", "e"))
    order = Window.partitionBy("venue_id").orderBy("id", "pos")
    rows = rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= EVIDENCE)
    return rows.groupBy("venue_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "e"))), lambda s: s["e"]).alias("evidence"))


def venue_profiles(venues: DataFrame, ins: DataFrame) -> DataFrame:
    """One row for each live venue with insights. An insight of either adopted version counts in the means."""
    empty = F.array().cast("array<string>")
    totals = ins.groupBy("venue_id").agg(
        F.count_distinct("raw_review_id").alias("review_count"),
        F.sort_array(F.collect_set("source")).alias("sources"),
        F.mode("noise_level", True).alias("noise_level"),
        F.mode("crowd_level", True).alias("crowd_level"),
        F.min_by("best_time", F.when(F.col("best_time").isNotNull(), F.struct("raw_review_id", "id"))).alias("best_time"),
        F.round(F.avg(sentiment_value(F.col("sentiment"))).cast("decimal(20,10)"), 2).cast("double").alias("sentiment_score"),
        F.round(F.avg(F.col("confidence").cast("double")).cast("decimal(20,10)"), 2).cast("double").alias("mean_confidence"),
    )
    out = live(venues).join(totals, "venue_id").join(ranked_tags(ins), "venue_id", "left")
    for column in ("recurring_events", "good_for"):
        out = out.join(distinct_items(ins, column), "venue_id", "left")
    out = out.join(first_evidence(ins), "venue_id", "left")
    return out.withColumn("top_vibe_tags", F.slice(F.coalesce("vibe_tags_ranked", empty), 1, TOP_TAGS)).drop("vibe_tags_ranked")


def venue_map(venues: DataFrame, neighborhoods: DataFrame, insights: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """Live venues with a place: neighbourhood (of the first review by source that has one, else of the zip), has_insights."""
    out = live(venues).filter("lat is not null").join(neighborhoods.groupBy("zip").agg(F.min("neighborhood").alias("zip_neighborhood")), "zip", "left")
    if reviewed is not None:
        near = reviewed.filter("neighborhood is not null").groupBy("venue_id").agg(F.min_by("neighborhood", F.struct("source", "doc_id")).alias("own"))
        out = out.join(near, "venue_id", "left").withColumn("neighborhood", F.coalesce("own", "zip_neighborhood")).drop("own")
    else:
        out = out.withColumn("neighborhood", F.col("zip_neighborhood"))
    known = insights.filter("venue_id is not null").select("venue_id", F.lit(True).alias("has_insights")).distinct()
    return out.join(known, "venue_id", "left").withColumn("has_insights", F.coalesce("has_insights", F.lit(False))).drop("zip_neighborhood")


def venue_evidence(insights: DataFrame, reviews: DataFrame) -> DataFrame:
    rows = insights.filter("venue_id is not null").select("venue_id", "raw_review_id", "prompt_version", "model", F.explode("evidence").alias("e"))
    return rows.join(reviews.select(F.col("doc_id").alias("raw_review_id"), "source", "title", "published_at"), "raw_review_id").select("venue_id", "source", F.col("title").alias("source_title"), "published_at", "e.field", "e.quote", "prompt_version", "model")


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """The last submission of each reviewer on each insight."""
    return top_by(verdicts.filter("insight_id is not null and reviewer is not null"), ["insight_id", "reviewer"], F.col("reviewed_at").desc_nulls_last(), F.col("id").desc())


def review_queue(insights: DataFrame, reviews: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row for each insight with its text and the map of its verdicts, empty where there are none."""
    given = F.struct("verdict", F.col("field_verdicts").alias("fields"), "notes")
    maps = latest_verdicts(verdicts).groupBy("insight_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("reviewer").alias("key"), F.to_json(given).alias("value"))))).alias("verdicts"))
    text = reviews.select(F.col("doc_id").alias("raw_review_id"), "source", "text")
    out = insights.withColumnRenamed("id", "insight_id").join(text, "raw_review_id").join(maps, "insight_id", "left")
    return out.withColumn("verdicts", F.coalesce("verdicts", F.create_map().cast("map<string,string>")))


def queue_mode(queue: DataFrame, me: str, mode: str = "unreviewed", version: str | None = None) -> DataFrame:
    """all; unreviewed by me; or disagreement: I judged and somebody judged otherwise."""
    verdict = lambda v: F.get_json_object(v, "$.verdict")
    mine = F.try_element_at("verdicts", F.lit(me))
    if version is not None:
        queue = queue.filter(F.col("prompt_version") == version)
    if mode == "unreviewed":
        return queue.filter(mine.isNull())
    if mode == "disagreement":
        return queue.filter(mine.isNotNull() & F.exists(F.map_values("verdicts"), lambda v: ~verdict(v).eqNullSafe(verdict(mine))))
    return queue


def pipeline_status(spark: SparkSession, runs: DataFrame, progress: DataFrame, now: Column, stages: list[str] = STAGES) -> DataFrame:
    """One row for each stage: its latest run, units done, whether the latest run is running and younger than two days."""
    last = top_by(runs, ["stage"], F.col("id").desc())
    count = runs.groupBy("stage").agg(F.count("*").alias("runs"))
    units = progress.groupBy("stage").agg(F.count("*").alias("units_done"), F.max("done_at").alias("last_unit_at"))
    spine = spark.createDataFrame([(s,) for s in stages], "stage string")
    out = spine.join(last, "stage", "left").join(count, "stage", "left").join(units, "stage", "left")
    running = (F.col("status") == "running") & (F.col("started_at") > now - F.expr("interval 2 days"))
    return out.select("stage", F.col("id").alias("run_id"), F.coalesce("status", F.lit("never")).alias("status"), "started_at", F.coalesce("units_done", F.lit(0)).alias("units_done"), "last_unit_at", F.coalesce(running, F.lit(False)).alias("is_running"), F.coalesce("runs", F.lit(0)).alias("runs"))


def sentiment_label(score: Column) -> Column:
    return F.when(score.isNull(), "-").when(score > 0.33, "positive").when(score < -0.33, "negative").otherwise("mixed")


def stage_mark(status: Column, running: Column) -> Column:
    return F.when(F.coalesce(status, F.lit("never")) == "never", "[ ]").when(running, "[~]").when(status == "succeeded", "[x]").otherwise("[!]")


def percent_done(done: Column, total: Column) -> Column:
    """Whole per cent, 100 at most; null without a total."""
    return F.when((total > 0) & done.isNotNull(), F.least(F.lit(100), F.floor(done / total * 100 + 0.5))).cast("int")


def map_features(places: DataFrame, hits: DataFrame | None = None, selected: int | None = None) -> DataFrame:
    """(venue_id, feature): a GeoJSON point of each place (of ``venue_map``), with flags 0 or 1 for insights, a search hit
    (``hits``: venue_id) and the selected venue."""
    flagged = places.withColumn("hit", F.lit(0)) if hits is None else places.join(hits.select("venue_id", F.lit(1).alias("hit")).distinct(), "venue_id", "left")
    flag = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    shown = F.struct(F.col("venue_id").alias("id"), "name", flag(F.col("has_insights")).alias("insight"), flag(F.col("hit")).alias("hit"), flag(F.col("venue_id") == F.lit(selected)).alias("sel"))
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return flagged.select("venue_id", F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("venue_id").alias("id"), point.alias("geometry"), shown.alias("properties"))).alias("feature"))


def evidence_totals(grounded: DataFrame) -> DataFrame:
    """One row over grounded insights: their number, the share whose quotes all stand in the text, mean confidence, fields dropped."""
    return grounded.agg(
        F.count("*").alias("insights"),
        F.round(F.avg(F.col("evidence_verbatim").cast("int")), 3).alias("evidence_verbatim_rate"),
        F.round(F.avg(F.col("confidence").cast("double")), 3).alias("mean_confidence"),
        F.coalesce(F.sum(F.size("dropped_fields")), F.lit(0)).alias("fields_dropped"),
    )


def scorecard(insights: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(part, name, n): insights, verdict counts by verdict and reviewer, field-verdict counts."""
    rows = latest_verdicts(verdicts)
    parts = [
        insights.agg(F.count("*").alias("n")).select(F.lit("insights").alias("part"), F.lit("all").alias("name"), "n"),
        rows.groupBy("verdict").agg(F.count("*").alias("n")).select(F.lit("verdict").alias("part"), F.col("verdict").alias("name"), "n"),
        rows.groupBy("reviewer").agg(F.count("*").alias("n")).select(F.lit("reviewer").alias("part"), F.col("reviewer").alias("name"), "n"),
        rows.select(F.explode("field_verdicts").alias("f", "v")).groupBy("f", "v").agg(F.count("*").alias("n")).select(F.lit("field").alias("part"), F.concat_ws("=", "f", "v").alias("name"), "n"),
        rows.groupBy("reviewer", "verdict").agg(F.count("*").alias("n")).select(F.lit("reviewer verdict").alias("part"), F.concat_ws("=", "reviewer", "verdict").alias("name"), "n"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def review_sample(insights: DataFrame, verdicts: DataFrame, n: int, seed: int, version: str | None = None) -> DataFrame:
    """A seeded random sample of the insights nobody has reviewed; ordered by hash, so it doesn't hang on the layout."""
    rows = insights.join(verdicts.select(F.col("insight_id").alias("id")), "id", "left_anti")
    rows = rows if version is None else rows.filter(F.col("prompt_version") == version)
    return rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n)


def search(profiles: DataFrame, vibes: list[str] = (), category: str | None = None, neighborhood: str | None = None, good_for: str | None = None, k: int = 200) -> DataFrame:
    """Venues with every tag and facet asked for: most reviews first, then highest mean confidence, null as 0."""
    if vibes:
        profiles = profiles.filter(F.size(F.array_except(F.array(*[F.lit(v) for v in vibes]), F.map_keys(F.coalesce("vibe_tag_counts", F.create_map().cast("map<string,bigint>"))))) == 0)
    if category is not None:
        profiles = profiles.filter(F.col("category") == category)
    if neighborhood is not None:
        profiles = profiles.filter(F.col("neighborhood") == neighborhood)
    if good_for is not None:
        profiles = profiles.filter(F.array_contains("good_for", good_for))
    return profiles.orderBy(F.col("review_count").desc(), F.coalesce("mean_confidence", F.lit(0.0)).desc(), "venue_id").limit(k)


def with_neighborhood(profiles: DataFrame, places: DataFrame) -> DataFrame:
    """Profiles with the neighbourhood the map shows for them (of ``venue_map``), null where it shows none."""
    return profiles.join(places.select("venue_id", "neighborhood"), "venue_id", "left")


def facet_values(profiles: DataFrame, column: str = "good_for", n: int = 12) -> DataFrame:
    """The most frequent values of a list facet."""
    return profiles.select(F.explode(column).alias("value")).groupBy("value").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value").limit(n)
