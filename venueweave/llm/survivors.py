"""Best representative of each duplicate group: one surviving record, or one surviving value for each field.

Both are ranked by a window ordering that leaves one row; Spark keeps that row per group before the shuffle already
(a window group limit), so a group with a third of all rows costs each task one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venueweave.llm.values import cuisine_value, date_value, phone_value, web_host


def best_record(df: DataFrame, group: str, fields: dict[str, Column], trust: Column, recency: Column, tie: Column) -> DataFrame:
    """The top row of each group: most fields with a real value, then highest trust, then latest, then least ``tie``.

    ``fields`` gives each field's real value or null; nulls in trust and recency rank last; rows without a group are
    left out. Adds ``completeness``.
    """
    rows = df.filter(F.col(group).isNotNull()).withColumn("completeness", sum((v.isNotNull().cast("int") for v in fields.values()), F.lit(0)))
    order = Window.partitionBy(group).orderBy(F.col("completeness").desc(), trust.desc_nulls_last(), recency.desc_nulls_last(), tie.asc_nulls_last())
    return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def best_values(df: DataFrame, group: str, fields: dict[str, Column], recency: Column, tie: Column) -> DataFrame:
    """(group, field, value): for each field the value of the latest row that states a real one; least ``tie`` decides ties.

    ``fields`` gives each field's real value as text, or null. A field that no row of a group states gives no row.
    """
    stated = F.array(*[F.struct(F.lit(name).alias("field"), value.cast("string").alias("value")) for name, value in fields.items()])
    rows = df.filter(F.col(group).isNotNull()).select(F.col(group), recency.alias("_recency"), tie.alias("_tie"), F.explode(F.filter(stated, lambda s: s["value"].isNotNull())).alias("s"))
    rows = rows.select(group, "_recency", "_tie", "s.field", "s.value")
    order = Window.partitionBy(group, "field").orderBy(F.col("_recency").desc_nulls_last(), F.col("_tie").asc_nulls_last(), F.col("value"))
    return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").select(group, "field", "value")


def rec_fields() -> dict[str, Column]:
    """Real values of the entity table's attributes."""
    return {"website": web_host("website"), "phone": phone_value("phone"), "last_inspection": date_value("last_inspection"), "cuisine": cuisine_value("cuisine")}


def members(rec: DataFrame, venue_sources: DataFrame) -> DataFrame:
    """The records of each group, once each, with the score they were grouped by."""
    links = venue_sources.filter("venue_id is not null and raw_venue_id is not null").groupBy("venue_id", F.col("raw_venue_id").alias("raw_id")).agg(F.max(F.when(~F.isnan("match_score"), F.col("match_score"))).alias("score"))
    return links.join(rec.select("raw_id", "name", "website", "phone", "last_inspection", "cuisine", "fetched_at"), "raw_id")
