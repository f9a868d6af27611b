import pytest

from venueweave.operators.multivalue import split_values

ONES = ["Blue Fig Cafe", "Rusty Moth Bar", "Salty Kettle Grill", "Lark & Moth Tavern", "Twin Otter Deli Inc", "Maison Rebar", "Harbor & Pickle Diner", "Quiet Plum Bakery, Llc", "Winter Sail Kitchen LLC", "Amber Spoon Bistro"]
PLAIN = [f"{a} {b} {c}" for a in ("Blue", "Rusty", "Salty", "Quiet", "Amber", "Twin") for b in ("Fig", "Moth", "Kettle", "Plum", "Spoon", "Otter") for c in ("Cafe", "Bar", "Grill", "Bakery Llc", "Bistro Inc", "Deli")]


def values_of(spark, names):
    frame = spark.createDataFrame([(i, n, "clash") for i, n in enumerate([*names, *PLAIN])], "raw_id bigint, name string, value string")
    found = {}
    for row in split_values(frame).collect():
        found.setdefault(row["key"], {})[row["pos"]] = row["value"]
    return [[v for _, v in sorted(found.get(i, {}).items())] for i in range(len(names))]


def test_dialects(spark):
    cases = {
        "Blue Fig Cafe | Rusty Moth Bar": ["Blue Fig Cafe", "Rusty Moth Bar"],
        "Blue Fig Cafe;Rusty Moth Bar;Amber Spoon Grill;": ["Blue Fig Cafe", "Rusty Moth Bar", "Amber Spoon Grill"],
        '"Blue ""Fig"" Cafe" / "Lark, Moth & Plum"': ['Blue "Fig" Cafe', "Lark, Moth & Plum"],
        "Blue Fig Cafe, Rusty Moth Bar": ["Blue Fig Cafe", "Rusty Moth Bar"],
        "Blue Fig Cafe, Llc": ["Blue Fig Cafe, Llc"],
        "24/7 Fig Bar": ["24/7 Fig Bar"],
        "No. 9 1/2 Plum Bar": ["No. 9 1/2 Plum Bar"],
        "Burger w/ Fig Bar": ["Burger w/ Fig Bar"],
        "Blue Fig Cafe aka Rusty Moth Bar": ["Blue Fig Cafe", "Rusty Moth Bar"],
        "Blue Fig Cafe a/k/a Rusty Moth Bar\tAmber Spoon Grill": ["Blue Fig Cafe", "Rusty Moth Bar", "Amber Spoon Grill"],
        "Blue Fig Cafe/ /Rusty Moth Bar": ["Blue Fig Cafe", "Rusty Moth Bar"],
        "Blue Fig Cafe\nRusty Moth Bar · Amber Spoon Grill": ["Blue Fig Cafe", "Rusty Moth Bar", "Amber Spoon Grill"],
        '"Blue Fig Cafe"': ["Blue Fig Cafe"],
        "Blue Fig Cafe - 20th": ["Blue Fig Cafe - 20th"],
    }
    assert values_of(spark, list(cases)) == list(cases.values())


def test_nulls_blanks_and_copies(spark):
    long = " | ".join(["Blue Fig Cafe"] * 3000)
    frame = spark.createDataFrame([(1, None), (2, "  "), (3, "||;"), (4, "Blue Fig Cafe|Rusty Moth Bar"), (4, "Blue Fig Cafe|Rusty Moth Bar"), (None, "x|y"), (5, long), (6, '"unclosed | Blue Fig Cafe')], "raw_id bigint, name string")
    rows = [tuple(r) for r in split_values(frame).collect()]
    assert sorted(r for r in rows if r[0] in (1, 2, 3, 4)) == [(4, 1, "Blue Fig Cafe", 2), (4, 2, "Rusty Moth Bar", 2)]
    assert sum(r[0] == 5 for r in rows) == 3000
    assert None not in {r[0] for r in rows}


def test_empty_table(spark):
    assert split_values(spark.createDataFrame([], "raw_id bigint, name string")).count() == 0


@pytest.mark.parametrize("name", ONES)
def test_single_names_stay(spark, name):
    assert values_of(spark, [name]) == [[name]]
