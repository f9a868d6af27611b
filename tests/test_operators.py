import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from venueweave.operators import blocking, extraction, ledger, readmodels, upsert
from venueweave.operators.components import components

REC = "raw_id bigint, source string, name string, housenumber string, street string, zip string, lat double, lon double, phone string"


def naive(edges):
    group = {}
    for a, b in edges:
        group.setdefault(a, {a})
        group.setdefault(b, {b})
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    return {x: min(g) for x, g in group.items()}


@pytest.mark.parametrize("kind", ["chain", "sorted", "star", "random", "clique"])
def test_components(spark, kind):
    rng = random.Random(3)
    ids = list(range(1, 121))
    rng.shuffle(ids)
    edges = {
        "chain": list(zip(ids, ids[1:], strict=False)),
        "sorted": [(i, i + 1) for i in range(1, 120)],
        "star": [(7, i) for i in ids if i != 7],
        "random": [(rng.choice(ids), rng.choice(ids)) for _ in range(70)],
        "clique": [(a, b) for a in ids[:12] for b in ids[:12] if a != b],
    }[kind]
    frame = spark.createDataFrame([*edges, edges[0], (None, 3), (5, 5)], "a bigint, b bigint")
    assert dict(tuple(r) for r in components(frame).collect()) == naive([e for e in edges if e[0] != e[1]])


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


PAIRS = [
    (("FRENCH ROAST", "2340", "BROADWAY", 40.7855, -73.9765), ("French Roast", "2340", "Broadway", 40.7856, -73.9766), (1.0, 1.0, 13.9, 1.0)),
    (("NAN XIANG XIAO LONG BAO", "15", "SAINT MARKS PLACE", 40.7295, -73.9885), ("The Bao", "13", "Saint Marks Place", 40.7296, -73.9886), (0.6385, 0.6154, 14.0, 0.5)),
    (("FELLINI CUCINA / FELLINI COFFEE", "176", "7 AVENUE SOUTH", 40.7345, -74.0025), ("Fellini Coffee", "174", "7th Avenue South", 40.7346, -74.0026), (0.85, 1.0, 14.0, 0.5)),
    (("POPEYES LOUISIANA KITCHEN", "934", "8 AVENUE", 40.7625, -73.9885), ("Deep Indian Kitchen", "934", "8th Avenue", 40.7626, -73.9886), (0.825, 0.6818, 13.9, 1.0)),
    (("Joe's Pizza", "7", "CARMINE STREET", 40.7305, -74.0025), ("Joe's Pizza", "1435", "Broadway", 40.7550, -73.9870), (0.385, 1.0, 3021.1, 0.0)),
]


@pytest.mark.parametrize(("left", "right", "expected"), PAIRS)
def test_published_pairs(spark, left, right, expected):
    of = lambda i, source, v: (i, source, v[0], v[1], v[2], "", v[3], v[4], "")
    records = blocking.entities(spark.createDataFrame([of(1, "dohmh", left), of(2, "osm", right)], REC))
    pair = spark.createDataFrame([(1, 2, 0)], "left_id bigint, right_id bigint, position int")
    row = blocking.scored(pair, records, records).first()
    assert (row["score"], row["name_sim"], row["dist_m"], row["addr_score"]) == expected


def one_by_one(candidates, duplicates):
    """The decision rule as its text reads: one pair after another, clusters as sets of ids."""
    cluster, matched_before, out = {}, set(), {}
    of = lambda x: cluster.setdefault(x, frozenset([x]))

    def merge(x, y):
        both = of(x) | of(y)
        for member in both:
            cluster[member] = both

    for a, b, *_ in duplicates:
        merge(a, b)
    for left, right, position, score, name, dist, address in sorted(candidates, key=lambda r: (-r[3], r[0], r[2], r[1])):
        decision = "review"
        if name >= (0.75 if address is not None or (dist is not None and dist <= 25) else 0.85):
            certain = score >= 0.95 and (address == 1.0 or (dist is not None and dist <= 50))
            if right in of(left):
                decision = "matched"
            elif score >= 0.80 and (certain or not matched_before & (of(left) | of(right))):
                merge(left, right)
                matched_before |= of(left)
                decision = "matched"
        out[left, right] = decision
    return sorted((a, b, d) for (a, b), d in out.items())


@pytest.mark.parametrize("seed", range(6))
def test_decisions_equal_the_plain_loop(spark, seed):
    rng = random.Random(seed)
    wide, n = (40, 120) if seed % 2 else (12, 140)  # sparse and dense components
    rows = [(rng.randrange(1, wide), rng.randrange(101, 100 + wide), rng.randrange(3), round(rng.uniform(0.7, 1), 2), round(rng.uniform(0.6, 1), 2), rng.choice([None, 10.0, 45.0, 60.0]), rng.choice([None, 0.5, 1.0])) for _ in range(n)]
    rows = list({r[:2]: r for r in rows}.values())
    candidates = spark.createDataFrame(rows, "left_id bigint, right_id bigint, position int, score double, name_sim double, dist_m double, addr_score double")
    twins = [(1, 2, 1.0, 5.0), (103, 104, 0.95, 9.0), (10, 11, 1.0, None)]
    duplicates = spark.createDataFrame(twins, "left_id bigint, right_id bigint, name_sim double, dist_m double")
    found = sorted(tuple(r) for r in blocking.decide(candidates, duplicates).select("left_id", "right_id", "decision").collect())
    assert found == one_by_one(rows, twins)


def test_fold_takes_first_stated_value_by_rank(spark):
    data = [(1, "dohmh", "A", "1", "", None, 1.0, None, ""), (2, "osm", "B", "", "S", "z", None, 2.0, "p"), (3, "osm", "C", "3", None, "y", 0.0, 4.0, "")]
    rec = spark.createDataFrame(data, REC).withColumns({c: F.lit(None).cast("string") for c in ("website", "cuisine", "last_inspection", "name_norm", "category")}).withColumn("source_id", F.col("raw_id").cast("string"))
    row = blocking.fold_clusters(rec, spark.createDataFrame([(i, 9) for i in (1, 2, 3)], "raw_id bigint, cluster bigint")).first()
    assert (row["key"], row["name"], row["housenumber"], row["street"], row["zip"], row["lat"], row["lon"], row["phone"], row["source_count"]) == ("osm:3", "C", "3", "S", "y", 1.0, 4.0, "p", 3)


def test_upserts_are_idempotent(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id bigint, content_hash string")
    new = spark.createDataFrame([(2, None), (3, "x"), (4, "d")], "id bigint, content_hash string")
    assert {(r["id"], r["action"]) for r in upsert.classify(old, new, ["id"]).collect()} == {(2, "unchanged"), (3, "updated"), (4, "inserted")}
    once = upsert.conditional_upsert(old, new, ["id"])
    assert rows(once) == rows(upsert.conditional_upsert(once, new, ["id"])) == [(1, "a"), (2, None), (3, "x"), (4, "d")]
    assert rows(upsert.insert_absent(old, new, ["id"])) == [(1, "a"), (2, None), (3, "c"), (4, "d")]


def test_expiry_and_schedule(spark):
    now = dt.datetime(2026, 1, 31)
    data = [("s", "osm:1", now - dt.timedelta(days=31)), ("s", "osm:2", now - dt.timedelta(days=29)), ("s", "dohmh:1", now - dt.timedelta(days=8)), ("s", "other:1", dt.datetime(2000, 1, 1)), ("s", "osm", dt.datetime(2000, 1, 1))]
    progress = spark.createDataFrame(data, "stage string, unit_key string, done_at timestamp")
    kept = lambda force: {r["unit_key"] for r in ledger.expire(progress, F.lit(now), force=force).collect()}
    assert kept(False) == {"osm:2", "other:1", "osm"} and kept(True) == {"other:1", "osm"}
    assert ledger.next_run(dt.datetime(2026, 1, 1, 2), 3) == dt.datetime(2026, 1, 1, 3)
    assert ledger.next_run(dt.datetime(2026, 1, 1, 4), 3) == dt.datetime(2026, 1, 2, 3)


def test_ledger(spark, tmp_path):
    with pytest.raises(ValueError, match="broken"), ledger.Run(spark, str(tmp_path), "match") as run:
        run.bump("pairs", 3)
        run.mark_done("osm:1")
        raise ValueError("broken")
    row = run.runs().first()
    assert (row["status"], row["stats"], row["error"]) == ("failed", {"pairs": 3}, "broken")
    progress = spark.read.schema(ledger.PROGRESS).parquet(f"{tmp_path}/stage_progress")
    units = spark.createDataFrame([("osm:1",), ("osm:2",)], "unit_key string")
    assert [r[0] for r in ledger.pending(units, progress, "match").collect()] == ["osm:2"]


def test_grounding(spark):
    evidence = [("vibe_tags", "a  QUIET “room”"), ("noise_level", ""), ("best_time", "not there"), ("good_for", None)]
    data = [(1, 'It is a quiet "room".', ["quiet"], "quiet", None, "late", ["x"], ["groups"], evidence), (2, None, [], None, None, None, [], [], [])]
    schema = "id bigint, text string, vibe_tags array<string>, noise_level string, crowd_level string, best_time string, recurring_events array<string>, good_for array<string>, evidence array<struct<field: string, quote: string>>"
    one, two = extraction.ground(spark.createDataFrame(data, schema)).orderBy("id").collect()
    assert one["vibe_tags"] == ["quiet"] and one["noise_level"] is None and one["recurring_events"] == []
    assert one["dropped_fields"] == ["noise_level", "best_time", "recurring_events", "good_for"] and not one["evidence_verbatim"]
    assert two["dropped_fields"] == [] and two["evidence_verbatim"]


def test_provider_and_search(spark):
    reviews = spark.createDataFrame([(1, "A quiet and cozy place."), (2, None)], "id bigint, text string")
    found = {r["id"]: r for r in extraction.extract(reviews, parallel=2).collect()}
    assert found[1]["vibe_tags"] == ["cozy", "quiet"] and found[1]["noise_level"] == "quiet" and found[2]["vibe_tags"] == []
    profiles = spark.createDataFrame([(1, {"quiet": 2, "cozy": 1}, 3, None), (2, {"quiet": 1}, 9, 0.5), (3, None, 1, 0.1)], "venue_id bigint, vibe_tag_counts map<string,bigint>, review_count bigint, mean_confidence double")
    assert [r["venue_id"] for r in readmodels.search(profiles, ["quiet"]).collect()] == [2, 1]
    assert [r["venue_id"] for r in readmodels.search(profiles, ["quiet", "cozy"]).collect()] == [1]


def test_extraction_reads_whole_texts(spark):
    text = "Plain words here. " * 2000 + "A cozy and loud room."
    reviews = spark.createDataFrame([(1, text)], "id int, text string")
    row = extraction.ground(extraction.extract(reviews).join(reviews, "id")).first()
    assert row["vibe_tags"] == ["cozy", "loud"] and row["noise_level"] == "loud" and row["dropped_fields"] == []
