from venueweave.llm.addresses import same_building_pairs

REC = "raw_id bigint, housenumber string, street string, zip string, lat double, lon double, node string"


def found(spark, data):
    frame = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(data, 1)] + [(1, *data[0], "clash")], REC)
    rows = [tuple(r) for r in same_building_pairs(frame).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_spellings(spark):
    many = [(str(n), "Papuvick Drive", "10003", None, None) for n in range(100, 112)]
    data = [
        ("10", "Papuvick Drive", "10003", None, None),
        ("No. 10", "PAPUVICK DR. Ste 4", "10003-1234", None, None),
        ("", "10 Papuvick Drv", "NY 10003", None, None),
        ("10", "Papuivck", "10003", None, None),
        ("010", "papuvick drive, 10003", None, None, None),
        ("10A", "Papuvick Drive", "10003", None, None),
        ("10", "Papuvick Drive", "10099", None, None),
        (None, None, "10003", None, None),
        ("10", None, "10003", 40.0, -74.0),
        *many,
    ]
    same = {1, 2, 3, 4, 5}
    assert {p for p in found(spark, data) if max(p) <= 9} == {(a, b) for a in same for b in same if a < b}


def test_numbered_streets_directions_and_zips(spark):
    data = [
        ("5", "W 13 Ave", "10010", 40.7, -74.0),
        ("5", "West Thirteenth Avenue", "10010", 40.7, -74.0),
        ("5", "13th Ave W", "", 40.7001, -74.0),
        ("5", "E 13 Ave", "10010", 40.7, -74.0),
        ("5", "W 13 Street", "10010", 40.7, -74.0),
        ("5", "W 14 Ave", "10010", 40.7, -74.0),
    ]
    assert found(spark, data) == {(1, 2), (1, 3), (2, 3)}


def test_empty_and_long(spark):
    assert same_building_pairs(spark.createDataFrame([], REC)).count() == 0
    assert found(spark, [("1", "x" * 5000, "1", None, None), ("1", "x" * 5000, "1", None, None)]) == {(1, 2)}
