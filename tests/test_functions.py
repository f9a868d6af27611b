import pytest
from pyspark.sql import functions as F

from venueweave.functions import geo, strings, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f("x").alias("y")).first()[0]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("McSORLEY'S OLD ALE HOUSE", "mcsorleys old ale house"),
        ("McSorley’s Old Ale House", "mcsorleys old ale house"),
        ("Acosta Restaurant", "acosta"),
        ("Time Out Market (Manhattan) LLC", "time out market manhattan"),
        ("CHIPOTLE MEXICAN GRILL #3056", "chipotle mexican grill"),
        ("Café & Niña", "cafe and nina"),
        (None, ""),
        ("", ""),
    ],
)
def test_norm_name(spark, value, expected):
    assert one(spark, value, text.norm_name) == expected


@pytest.mark.parametrize(("value", "expected"), [("WEST   23 STREET", "w 23 st"), ("West 23rd Street", "w 23 st"), ("1st Avenue", "1 ave"), ("PARK AVENUE SOUTH", "park ave s"), (None, "")])
def test_norm_street(spark, value, expected):
    assert one(spark, value, text.norm_street) == expected


@pytest.mark.parametrize(("value", "expected"), [("+1-212-741-3560", "2127413560"), ("2127413560", "2127413560"), ("212-741", ""), (None, "")])
def test_norm_phone(spark, value, expected):
    assert one(spark, value, text.norm_phone) == expected


@pytest.mark.parametrize(("value", "expected"), [("411b", "411b"), ("34-36", "34-36"), ("   ", ""), (None, "")])
def test_norm_housenumber(spark, value, expected):
    assert one(spark, value, text.norm_housenumber) == expected


def test_zip_and_title(spark):
    assert one(spark, "10019-1234", text.norm_zip) == "10019"
    assert one(spark, "", text.norm_zip) == ""
    assert one(spark, "MCSORLEY'S ale", text.title_case) == "Mcsorley'S Ale"
    assert one(spark, "https://x.example/a/b-c/", text.url_slug) == "b-c"


def test_content_hash_tells_null_from_empty(spark):
    frame = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    hashes = [r[0] for r in frame.select(text.content_hash("x", "y")).collect()]
    assert hashes[0] == hashes[2] != hashes[1]


def test_geohash_vectors(spark):
    row = spark.range(1).select(geo.geohash(F.lit(57.64911), F.lit(10.40744), 11), geo.geohash(F.lit(42.6), F.lit(-5.6), 5)).first()
    assert tuple(row) == ("u4pruydqqvj", "ezs42")


def test_similarities():
    assert strings.ratio("abcd", "abcd") == 100 and strings.ratio("", "") == 100
    assert strings.common_length("nziegow", "nizegow") == 6
    assert strings.token_set("the bao", "nan xiang the bao") == 100
    assert strings.token_sort("b a", "a b") == 100
    assert strings.name_similarity("the bao", "nan xiang xiao long bao") < 0.75
    assert strings.best_similarity(["fellini cucina fellini coffee", "fellini coffee"], ["fellini coffee"]) == 1.0
    assert strings.best_similarity([], ["x"]) == 0.0


def test_distance_of_nulls(spark):
    frame = spark.createDataFrame([(40.0, -74.0, 40.0, -74.0), (None, -74.0, 40.0, -74.0), (40.0, -74.0, 40.0, None), (90.0, 0.0, -90.0, 0.0)], "a double, b double, c double, d double")
    same, *gone, apart = [r[0] for r in frame.select(geo.haversine_m("a", "b", "c", "d")).collect()]
    assert same == 0.0 and gone == [None, None] and abs(apart - 20_015_086.8) < 1
