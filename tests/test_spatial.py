import json
import math
import random

from venueweave.operators.spatial import inside_regions, near_pairs, region_cover

POINTS = "raw_id bigint, lat double, lon double, cell string"


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371000.0 * math.asin(min(1.0, math.sqrt(h)))


def test_near_pairs_as_brute_force(spark):
    rng = random.Random(1)
    spots = [(40.7 + rng.random() * 0.004, -74 + rng.random() * 0.004) for _ in range(250)]
    spots += [(rng.choice([89.99995, -89.99995, 80.0]), rng.random() * 360 - 180) for _ in range(60)]
    spots += [(10 + rng.random() * 0.0003, 180 - rng.random() * 0.0003) for _ in range(20)] + [(10 + rng.random() * 0.0003, -180 + rng.random() * 0.0003) for _ in range(20)]
    spots += [(0.0001, 0.0001), (-0.0001, -0.0001), (51.5, -0.00005), (51.5, 0.00005)]
    frame = spark.createDataFrame([(i, *p, "x") for i, p in enumerate(spots)], POINTS)
    for reach in (5.0, 30.0, 400.0):
        expected = {(i, j) for i in range(len(spots)) for j in range(i + 1, len(spots)) if metres(spots[i], spots[j]) <= reach}
        found = [tuple(r)[:2] for r in near_pairs(frame, reach).collect()]
        assert set(found) == expected and len(found) == len(expected)


def test_unusable_copies_and_empty(spark):
    nan = float("nan")
    data = [(1, 40.0, -74.0, "a"), (1, 40.0, -74.0, "a"), (2, 40.0, -74.0, None), (3, None, -74.0, ""), (4, nan, -74.0, ""), (5, 0.0, 0.0, ""), (6, 91.0, 10.0, ""), (None, 40.0, -74.0, "")]
    frame = spark.createDataFrame(data, POINTS)
    assert [tuple(r)[:2] for r in near_pairs(frame, 30.0).collect()] == [(1, 2)]
    assert near_pairs(frame.limit(0), 30.0).count() == 0


def ring(cx, cy, r, n=24):
    points = [[cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)] for k in range(n)]
    return points + points[:1]


def test_inside_as_brute_force(spark):
    rng = random.Random(2)
    shapes = [("disc", {"type": "Polygon", "coordinates": [ring(-74, 40.7, 0.02), ring(-74, 40.7, 0.008)[::-1]]}), ("two", {"type": "MultiPolygon", "coordinates": [[ring(-74.02, 40.7, 0.01)], [ring(-73.98, 40.71, 0.01, 5)]]}), ("big", {"type": "Polygon", "coordinates": [[[-80, 30], [-60, 30], [-60, 50], [-80, 50], [-80, 30]]]}), ("broken", {"type": "Point"})]
    regions = spark.createDataFrame([(n, json.dumps(s)) for n, s in shapes] + [(None, "{}"), ("text", "no json"), ("null", None), ("disc", json.dumps(shapes[0][1]))], "name string, geojson string")
    spots = [(40.66 + rng.random() * 0.08, -74.05 + rng.random() * 0.1) for _ in range(400)]
    frame = spark.createDataFrame([(i, *p, "x") for i, p in enumerate(spots)], POINTS)

    def holds(rings, lat, lon):
        odd = False
        for points in rings:
            for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1], strict=True):
                if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
                    odd = not odd
        return odd

    expected = set()
    for name, shape in shapes[:3]:
        parts = [shape["coordinates"]] if shape["type"] == "Polygon" else shape["coordinates"]
        expected |= {(i, name) for i, (lat, lon) in enumerate(spots) if any(holds(p, lat, lon) for p in parts)}
    found = [tuple(r) for r in inside_regions(frame, regions).collect()]
    assert set(found) == expected and len(found) == len(expected)
    assert inside_regions(frame, regions.limit(0)).count() == 0
    assert inside_regions(frame.limit(0), regions).count() == 0


def test_region_of_many_edges(spark):
    """A wavy coast of 200,000 edges: points are judged as by its radius, and no cell carries more than a few edges."""
    n = 200_000
    radius = lambda t: 0.5 + 0.05 * math.sin(40 * t)
    points = [[-74 + radius(t) * math.cos(t), 40.7 + radius(t) * math.sin(t)] for t in (2 * math.pi * k / n for k in range(n))]
    regions = spark.createDataFrame([("coast", json.dumps({"type": "Polygon", "coordinates": [points + points[:1]]}))], "name string, geojson string")
    rng = random.Random(5)
    spots = [(rng.uniform(0.3, 0.6), rng.uniform(0, 2 * math.pi)) for _ in range(500)]
    frame = spark.createDataFrame([(i, 40.7 + r * math.sin(t), -74 + r * math.cos(t), "x") for i, (r, t) in enumerate(spots)], POINTS)
    expected = {i for i, (r, t) in enumerate(spots) if r < radius(t) - 1e-6}
    unsure = {i for i, (r, t) in enumerate(spots) if abs(r - radius(t)) <= 1e-6}
    assert {r["id"] for r in inside_regions(frame, regions).collect()} - unsure == expected
    assert region_cover(regions).selectExpr("max(size(edges))").first()[0] <= 64
