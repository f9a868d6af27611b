"""Readers of the project's Parquet tables, each with its declared schema (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "rec": "raw_id bigint, source string, source_id string, name string, name_norm string, housenumber string, street string, "
    "street_norm string, zip string, lat double, lon double, phone string, website string, cuisine string, category string, "
    "last_inspection string, geohash string, name_variants array<string>, fetched_at timestamp_ntz, first_seen timestamp_ntz",
    "venue_sources": "venue_id bigint, source string, source_id string, raw_venue_id bigint, match_score float, match_method string",
    "match_candidates": "id bigint, run_id bigint, left_raw_id bigint, right_raw_id bigint, score float, name_sim float, dist_m float, "
    "addr_score float, phone_match boolean, decision string",
    "insights": "id bigint, raw_review_id bigint, venue_id bigint, model string, prompt_version string, vibe_tags array<string>, "
    "noise_level string, crowd_level string, best_time string, recurring_events array<string>, good_for array<string>, "
    "sentiment string, evidence array<struct<field: string, quote: string>>, confidence float, duration_ms int, created_at timestamp_ntz",
    "extraction_reviews": "id bigint, insight_id bigint, reviewer string, verdict string, field_verdicts map<string, string>, "
    "notes string, reviewed_at timestamp_ntz",
    "boundaries": "name string, geojson string",
    "zip_neighborhoods": "zip string, neighborhood string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, title string, published_at date, fetched_at timestamp_ntz",
    "eval_items": "item_id bigint, suite string, text string",
    "containers": "container_id int, capacity_tokens int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; its declared schema where there is one, else the schema in the files."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def prompt_versions(spark: SparkSession) -> DataFrame:
    """Seed of the versions of the extraction prompt (fixed values): v2 and v3 are adopted."""
    return spark.createDataFrame([("v1", False), ("v2", True), ("v3", True), ("v4", False), ("v5", False)], "version string, adopted boolean")
