"""Same postal address written differently: weighted character n-grams, prefix-filtered index, exact verification.

Records are parsed, missing and mistyped zips are settled by where the street's other records stand, and equal
readings become one node. Nodes of the same house number and zip that share a prefix n-gram of the street name are
candidates; they denote one building if the cosine of their n-grams, the edit distance, the street type and the
direction allow it and one spelling is much rarer in that zip than the other (or they are the same). Each node then
hangs on the most frequent node it is linked to. The index is keyed by house number, zip and n-gram, so a zip or a
street with a third of all rows is spread over its house numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueweave.llm.address_parts import with_address
from venueweave.llm.groups import followed
from venueweave.functions.geo import haversine_m, usable
from venueweave.functions.ranking import top_by
from venueweave.llm.ngrams import cosine, weighted_ngrams
from venueweave.storage import Stash

#: Least cosine of street names, most edits between them, most metres between two readings of a zip of one street,
#: how many times rarer a mistyped zip is, largest share of a misspelling among a street's records.
COSINE, EDITS, SAME_STREET_M, ZIP_RATIO, RARE_SHARE = 0.35, 2, 700.0, 5, 0.25


def _compatible(a: Column, b: Column) -> Column:
    return (a == b) | (a == "") | (b == "")


def settle_zips(parsed: DataFrame) -> DataFrame:
    """Zips filled in and put right. A mistyped zip goes to the far more frequent zip of a street of that name at the
    same place; a missing one to the nearest street of that name, or to the only one if there are no coordinates."""
    placed = parsed.withColumns({c: F.when(usable("lat", "lon"), F.col(c)) for c in ("lat", "lon")})
    streets = placed.groupBy("base", "zip").agg(F.count("*").alias("n"), F.avg("lat").alias("slat"), F.avg("lon").alias("slon"))
    streets = Stash(streets.filter("zip != ''"), "streets").df
    other = streets.select("base", F.col("zip").alias("right_zip"), F.col("n").alias("m"), F.col("slat").alias("tlat"), F.col("slon").alias("tlon"))
    apart = haversine_m(F.col("slat"), F.col("slon"), F.col("tlat"), F.col("tlon"))
    wrong = streets.join(other, "base").filter((F.col("m") >= ZIP_RATIO * F.col("n")) & (apart <= SAME_STREET_M))
    wrong = Stash(top_by(wrong, ["base", "zip"], F.col("m").desc(), F.col("right_zip")).select("base", "zip", "right_zip"), "zips").df
    known = placed.filter("zip != ''").join(wrong, ["base", "zip"], "left").withColumn("zip", F.coalesce("right_zip", "zip")).drop("right_zip")
    sound = streets.join(wrong, ["base", "zip"], "left_anti").select("base", F.col("zip").alias("right_zip"), "n", "slat", "slon")
    only = sound.groupBy("base").agg(F.count("*").alias("zips"))
    blank = placed.filter("zip = ''").join(sound.join(only, "base"), "base", "left").withColumn("apart", haversine_m(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon")))
    fits = (F.col("apart") <= 2 * SAME_STREET_M) | (F.col("lat").isNull() & (F.col("zips") == 1))
    blank = top_by(blank, ["raw_id", "number", "base", "type", "way"], F.when(fits, 0).otherwise(1), F.col("apart").asc_nulls_last(), F.col("n").desc(), F.col("right_zip"))
    return known.unionByName(blank.withColumn("zip", F.when(fits, F.col("right_zip")).otherwise("")).select(known.columns))


def parsed_addresses(rec: DataFrame) -> DataFrame:
    """raw_id, number, way, base, type, zip, lat, lon of the records that state a house number and a street."""
    rows = with_address(rec.select("raw_id", "housenumber", "street", "zip", "lat", "lon").filter("raw_id is not null"))
    rows = Stash(rows.select("raw_id", "lat", "lon", *[F.col(f"a_{c}").alias(c) for c in ("number", "way", "base", "type", "zip")]), "parsed")
    return rows.df.filter("number != '' and base != ''").distinct()


def buildings(rec: DataFrame) -> DataFrame:
    """(raw_id, building) for every record that states a house number and a street; equal ``building``, one building.

    Null or blank fields, filler without a number and empty tables give no rows; copies of a record count once; a
    record whose zip is neither stated nor to be settled only equals records with the same reading.
    """
    rows = Stash(settle_zips(parsed_addresses(rec)).drop("lat", "lon"), "settled")
    street_n = rows.df.groupBy("zip", "base").agg(F.count("*").alias("street_n"))
    names = Stash(weighted_ngrams(rows.df.select("base").distinct(), "base", COSINE), "grams")
    parts = ["number", "zip", "base", "way", "type"]
    nodes = rows.df.groupBy(*parts).agg(F.count("*").alias("n")).withColumn("node", F.xxhash64(*parts))
    nodes = Stash(nodes.join(street_n, ["zip", "base"]).join(names.df.select("base", "prefix"), "base"), "nodes").df
    index = nodes.withColumn("gram", F.explode("prefix")).drop("prefix")
    right = index.select("number", "zip", "gram", *[F.col(c).alias(f"{c}_b") for c in ("node", "base", "way", "type", "n", "street_n")])
    rare = F.least("street_n", "street_n_b") <= RARE_SHARE * F.greatest("street_n", "street_n_b")
    digits = F.col("base").rlike("\\d") | F.col("base_b").rlike("\\d")
    near = (F.col("base") == F.col("base_b")) | (rare & (F.levenshtein("base", "base_b", EDITS) >= 0) & ~digits)
    better = (F.col("street_n_b") > F.col("street_n")) | ((F.col("street_n_b") == F.col("street_n")) & ((F.col("n_b") > F.col("n")) | ((F.col("n_b") == F.col("n")) & (F.col("node_b") < F.col("node")))))
    pairs = index.join(right, ["number", "zip", "gram"]).filter(better & _compatible(F.col("way"), F.col("way_b")) & _compatible(F.col("type"), F.col("type_b")) & near)
    pairs = pairs.select("node", "node_b", "base", "base_b", "street_n_b", "n_b").distinct()
    grams = names.df.select("base", "grams")
    pairs = pairs.join(grams, "base").join(grams.withColumnsRenamed({"base": "base_b", "grams": "grams_b"}), "base_b")
    pairs = pairs.filter((F.col("base") == F.col("base_b")) | (cosine(F.col("grams"), F.col("grams_b")) >= COSINE))
    best = top_by(pairs.select("node", "node_b", "street_n_b", "n_b"), ["node"], F.col("street_n_b").desc(), F.col("n_b").desc(), F.col("node_b"))
    # a misspelling may hang on one that hangs on a third; every parent is more frequent, so there are no circles
    top = followed(Stash(best.select(F.col("node").alias("id"), F.col("node_b").alias("to")), "parents")).df.select(F.col("id").alias("node"), F.col("to").alias("building"))
    return rows.df.select("raw_id", F.xxhash64(*parts).alias("node")).join(top, "node", "left").select("raw_id", F.coalesce("building", "node").alias("building")).distinct()


def same_building_pairs(rec: DataFrame) -> DataFrame:
    """(raw_id_a < raw_id_b) for every pair of records that denote the same building."""
    found = Stash(buildings(rec), "buildings").df
    a, b = found.withColumnRenamed("raw_id", "raw_id_a"), found.withColumnRenamed("raw_id", "raw_id_b")
    return a.join(b, "building").filter("raw_id_a < raw_id_b").select("raw_id_a", "raw_id_b")
