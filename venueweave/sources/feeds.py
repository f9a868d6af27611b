"""The two venue feeds as entity records: map objects with tags, and inspection rows.

File-backed: a live collector is a reader of the same shape. One unit of work is one file or one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venueweave.functions.geo import geohash, usable
from venueweave.functions.text import norm_housenumber, norm_name, norm_phone, norm_street, norm_zip, title_case
from venueweave.operators.spatial import inside_regions

# Amenities kept as they are, and the category of a cuisine (all others: restaurant).
AMENITIES = ["restaurant", "cafe", "bar", "pub", "fast_food", "ice_cream", "food_court"]
CUISINE_CATEGORY = {
    "Bottled Beverages": "other",
    "Coffee/Tea": "cafe",
    "Juice, Smoothies, Fruit Salads": "cafe",
    "Bakery Products/Desserts": "cafe",
    "Donuts": "cafe",
    "Frozen Desserts": "cafe",
    "Hamburgers": "fast_food",
    "Sandwiches": "fast_food",
    "Hotdogs": "fast_food",
    "Pizza": "fast_food",
    "Chicken": "fast_food",
}

OSM = "osm_type string, osm_id bigint, lat double, lon double, center struct<lat: double, lon: double>, tags map<string, string>"
INSPECTIONS = "camis string, dba string, building string, street string, zipcode string, phone string, cuisine_description string, latitude string, longitude string, inspection_date string, boro string"


def read_osm(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OSM).json(path)


def read_inspections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INSPECTIONS).json(path)


def _finish(df: DataFrame) -> DataFrame:
    zero_free = lambda c: F.when((F.col(c) != 0) & ~F.isnan(c), F.col(c))
    df = df.withColumns({"lat": zero_free("lat"), "lon": zero_free("lon")})
    return df.withColumns({"name_norm": norm_name("name"), "street_norm": norm_street("street"), "housenumber": norm_housenumber("housenumber"), "zip": norm_zip("zip"), "phone": norm_phone("phone"), "geohash": F.when(usable("lat", "lon"), geohash("lat", "lon", 7))})


def osm_entities(raw: DataFrame) -> DataFrame:
    """Named objects: the centre where there is one, 'type/id' as the source's id, unlisted amenities as other."""
    tag = lambda *names: F.coalesce(*[F.try_element_at("tags", F.lit(n)) for n in names])
    named = raw.filter(F.coalesce(tag("name"), F.lit("")) != "")
    amenity = tag("amenity")
    rows = named.select(
        F.lit("osm").alias("source"),
        F.concat_ws("/", "osm_type", F.col("osm_id").cast("string")).alias("source_id"),
        tag("name").alias("name"),
        *[tag(f"addr:{t}").alias(c) for t, c in (("housenumber", "housenumber"), ("street", "street"), ("postcode", "zip"))],
        F.coalesce("center.lat", "lat").alias("lat"),
        F.coalesce("center.lon", "lon").alias("lon"),
        tag("phone", "contact:phone").alias("phone"),
        tag("website", "contact:website").alias("website"),
        tag("cuisine").alias("cuisine"),
        F.when(amenity.isin(AMENITIES), amenity).otherwise("other").alias("category"),
        F.lit(None).cast("string").alias("last_inspection"),
    )
    return _finish(rows)


def category_of(cuisine: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in CUISINE_CATEGORY.items() for x in pair])
    return F.coalesce(F.try_element_at(table, cuisine), F.lit("restaurant"))


def inspection_entities(raw: DataFrame, borough: str | None = "Manhattan") -> DataFrame:
    """One record for each permit and address of a borough (of all without one), with its last inspection; the sentinel of
    1900 is none."""
    raw = raw if borough is None else raw.filter(F.col("boro") == borough)
    keys = ["camis", "dba", "building", "street", "zipcode", "phone", "cuisine_description", "latitude", "longitude"]
    last = raw.filter(F.coalesce("dba", F.lit("")) != "").groupBy(*keys).agg(F.max("inspection_date").alias("inspection_date"))
    day = F.substring("inspection_date", 1, 10)
    rows = last.select(
        F.lit("dohmh").alias("source"),
        F.col("camis").alias("source_id"),
        title_case("dba").alias("name"),
        F.col("building").alias("housenumber"),
        "street",
        F.col("zipcode").alias("zip"),
        F.expr("try_cast(latitude as double)").alias("lat"),
        F.expr("try_cast(longitude as double)").alias("lon"),
        "phone",
        F.lit(None).cast("string").alias("website"),
        F.col("cuisine_description").alias("cuisine"),
        category_of(F.col("cuisine_description")).alias("category"),
        F.when(day > "1901", day).alias("last_inspection"),
    )
    return _finish(rows)


def clip(entities: DataFrame, regions: DataFrame, key: str = "source_id") -> DataFrame:
    """The records inside any of the regions."""
    return entities.join(inside_regions(entities, regions, key=key).select(F.col("id").alias(key)).distinct(), key, "left_semi")
