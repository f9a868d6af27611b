"""Resolution against brute force: every pair of records, scored and decided by plain Python."""

import datetime as dt
import math
import pathlib
import time

import pytest
from pyspark.sql import functions as F

from tests.test_operators import one_by_one
from venueweave.functions.strings import best_similarity, highest_similarity, letter_bits, name_similarities, name_sizes, name_similarity, word_bits
from venueweave.operators import blocking
from venueweave.operators.ledger import Run
from venueweave.plans import canonical
from venueweave.sources.tables import table
from venueweave.storage import Stash, sweep

SMALL = "/root/testdata/sf0.001"


def metres(a, b):
    p, q = math.radians(a["lat"]), math.radians(b["lat"])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b["lon"] - a["lon"]) / 2) ** 2
    return 2 * 6371000.0 * math.asin(min(1.0, math.sqrt(h)))


def cell(r):
    return (math.floor((r["lat"] + 90) / 180 * 2**17), math.floor((r["lon"] + 180) / 360 * 2**18))


def address(r):
    return (r["zip"], r["street_norm"]) if r["zip"] and r["street_norm"] else None


STEPS = [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (1, -1), (-1, 1), (-1, -1)]


def first_meeting(a, b, both=False):
    """Position of the first block of ``a`` that holds ``b``, or None."""
    if a["lat"] is not None and b["lat"] is not None:
        (i, j), (k, m) = cell(a), cell(b)
        if (k - i, m - j) in STEPS:
            return STEPS.index((k - i, m - j))
    if address(a) and address(a) == address(b) and (both or b["lat"] is None):
        return 9
    return None


def half_up(x, n):
    return math.floor(x * 10**n + 0.5) / 10**n


def score(a, b):
    name = best_similarity(a["variants"], b["variants"])
    dist = metres(a, b) if a["lat"] is not None and b["lat"] is not None else None
    near = None if dist is None else max(0.0, 1 - max(0.0, dist - 40) / 260)
    place = None
    if a["street_norm"] and b["street_norm"]:
        place = 0.0 if a["street_norm"] != b["street_norm"] else 1.0 if a["housenumber"] and a["housenumber"] == b["housenumber"] else 0.5
    where = place if place is not None else near if near is not None else 0.0
    total = 0.55 * name + 0.30 * where + 0.15 * (near if near is not None else where)
    if a["phone"] and a["phone"] == b["phone"]:
        total = min(1.0, total + 0.15)
    if place == 0.0 and dist is not None and dist > 150:
        total *= 0.7
    return half_up(total, 4), half_up(name, 4), None if dist is None else half_up(dist, 1), place


@pytest.fixture(scope="module")
def records(spark):
    frame = blocking.entities(table(spark, SMALL, "rec")).cache()
    return frame, [r.asDict() for r in frame.collect()]


def close(found, expected):
    """Equal but for the last digit of a rounded score."""
    assert set(found) == set(expected)
    for key, values in expected.items():
        assert all(x == y or (x is not None and y is not None and not isinstance(x, str) and abs(x - y) < 2e-4) for x, y in zip(found[key], values, strict=True)), (key, found[key], values)


def test_duplicates_candidates_and_decisions(spark, records):
    frame, rows = records
    twins, pairs = {}, {}
    for a in rows:
        for b in rows:
            if a["source"] == b["source"] and a["raw_id"] < b["raw_id"] and first_meeting(a, b) is not None:
                _, name, dist, _ = score(a, b)
                same = a["housenumber"] and a["housenumber"] == b["housenumber"] and a["street_norm"] == b["street_norm"]
                if name >= 0.9 and (same or (dist is not None and dist <= 80)):
                    twins[a["raw_id"], b["raw_id"]] = (name,)
            if a["source"] == "dohmh" and b["source"] == "osm" and (at := first_meeting(a, b)) is not None and score(a, b)[0] >= 0.7:
                pairs[a["raw_id"], b["raw_id"]] = (at, *score(a, b))
    duplicates = blocking.same_source_duplicates(frame)
    close({(r["left_id"], r["right_id"]): (r["name_sim"],) for r in duplicates.collect()}, twins)
    candidates = blocking.cross_candidates(frame.filter("source = 'dohmh'"), frame.filter("source = 'osm'"))
    close({(r["left_id"], r["right_id"]): (r["position"], r["score"], r["name_sim"], r["dist_m"], r["addr_score"]) for r in candidates.collect()}, pairs)
    decided = sorted((r["left_id"], r["right_id"], r["decision"]) for r in canonical.canonical_venues(table(spark, SMALL, "rec"))[1].collect())
    assert len(pairs) > 50 and decided == one_by_one([(*k, *v) for k, v in pairs.items()], list(twins))


def test_best_match(spark, records):
    frame, rows = records
    expected = {}
    for a in (r for r in rows if r["source"] == "dohmh"):
        met = [(-score(a, b)[0], at, b["raw_id"], score(a, b)[1]) for b in rows if b["source"] == "osm" and (at := first_meeting(a, b, both=True)) is not None]
        if met:
            value, _, who, name = min(met)
            matched = -value >= 0.8 and name >= 0.75
            expected[a["raw_id"]] = (who if matched else None, "matched" if matched else "review" if -value >= 0.7 else "unmatched", len(met))
        else:
            expected[a["raw_id"]] = (None, "unmatched", 0)
    found = blocking.best_match(frame.filter("source = 'dohmh'"), frame.filter("source = 'osm'")).collect()
    assert {r["left_id"]: (r["venue_id"], r["decision"], r["candidates"]) for r in found} == expected


def test_saved_twice(spark, tmp_path):
    rec = table(spark, SMALL, "rec")
    venues, decisions = canonical.canonical_venues(rec)
    venues, members = venues.cache(), decisions.select(F.col("left_id").alias("raw_id"))
    now = F.lit("2026-01-01").cast("timestamp_ntz")
    canonical.save_canonical(venues, decisions, members, str(tmp_path), "r1", now)
    canonical.save_canonical(venues.filter("source_count > 1"), decisions, members, str(tmp_path), "r2", now)
    stored = spark.read.parquet(f"{tmp_path}/venues")
    assert stored.count() == venues.count() and stored.filter("retired_at is null").count() == venues.filter("source_count > 1").count()
    assert spark.read.parquet(f"{tmp_path}/match_candidates").select("run_id").distinct().count() == 2


def test_nightly(spark, tmp_path):
    ran = []
    progress = spark.createDataFrame([("s", "osm:1", dt.datetime(2000, 1, 1)), ("s", "x:1", dt.datetime(2000, 1, 1))], "stage string, unit_key string, done_at timestamp")
    with Run(spark, str(tmp_path), "nightly") as run:
        kept = canonical.nightly(run, progress, {"collect": lambda: ran.append(1), "resolve": lambda: ran.append(2)}, F.lit(dt.datetime(2026, 1, 1)))
    assert ran == [1, 2] and [r["unit_key"] for r in kept.collect()] == ["x:1"]
    assert run.runs().first()["status"] == "succeeded"


def crowd(spark, n=400):
    """Records of both feeds within some metres of one spot, at as many addresses, with names that share no word, and a copy of one."""
    name = "concat(translate(substr(sha2(cast(id as string), 256), 1, 12), '0123456789', 'ghijklmnop'), ' ', translate(substr(md5(cast(id as string)), 1, 9), '0123456789', 'ghijklmnop'))"
    rows = spark.range(n).selectExpr("id as raw_id", "if(id % 2 = 0, 'osm', 'dohmh') as source", f"{name} as name", "cast(id as string) as housenumber", "concat('lane ', id) as street", "'10001' as zip", "'' as phone", "40.7 + id * 1e-7 as lat", "-73.9D as lon")
    twin = rows.filter("raw_id = 2").withColumn("raw_id", F.lit(n + 2).cast("bigint"))
    return rows.unionByName(twin).unionByName(twin.withColumns({"raw_id": F.lit(n + 1).cast("bigint"), "source": F.lit("dohmh")}))


def shuffled(spark, work) -> int:
    """Rows that ``work`` writes to shuffles."""
    context = spark.sparkContext
    store, none = context._jsc.sc().statusStore(), context._gateway.new_array(context._jvm.double, 0)
    written = lambda: sum(s.shuffleWriteRecords() for s in context._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, none, None)))
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = written()
    work()
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return written() - before


def test_pairs_of_one_source_are_not_shuffled(spark):
    frame = blocking.entities(crowd(spark)).repartition(3).cache()
    frame.count()
    found = []
    rows = shuffled(spark, lambda: found.extend(blocking.same_source_duplicates(frame).collect()))
    assert [(r["left_id"], r["right_id"]) for r in found] == [(2, 402)]
    assert rows < 10_000  # of 40,000 pairs


def test_pairs_of_two_sources_are_not_shuffled(spark):
    frame = blocking.entities(crowd(spark)).repartition(3).cache()
    frame.count()
    found = []
    rows = shuffled(spark, lambda: found.extend(blocking.cross_candidates(frame.filter("source = 'dohmh'"), frame.filter("source = 'osm'")).collect()))
    assert sorted((r["left_id"], r["right_id"]) for r in found) == [(401, 2), (401, 402)]
    assert rows < 10_000  # of 40,401 pairs


def test_best_of_a_crowd_is_found_without_shuffling_all_pairs(spark):
    frame = blocking.entities(crowd(spark)).repartition(3).cache()
    frame.count()
    found, left = [], frame.filter("raw_id = 401").crossJoin(spark.range(1000, 1100)).withColumn("raw_id", F.col("id")).drop("id")
    rows = shuffled(spark, lambda: found.extend(blocking.best_match(left, frame.filter("source = 'osm'")).collect()))
    assert {r["left_id"]: (r["venue_id"], r["candidates"]) for r in found} == {k: (2, 201) for k in range(1000, 1100)}
    assert rows < 10_000  # of 20,100 pairs


def test_sweep_frees_the_last_plan(spark):
    folders = [f.toString() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {str(p) for f in folders for p in pathlib.Path(f).rglob("shuffle_*")}
    before = files()
    written = Stash(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "counted")
    made = files() - before
    sweep(spark)
    until = time.time() + 5
    while made & files() and time.time() < until:
        time.sleep(0.1)
    assert made and not made & files() and written.rows == 7


def test_bounds_of_names(spark):
    names = sorted({v for r in blocking.entities(table(spark, SMALL, "rec")).collect() for v in r["variants"]} | {"a a", "a", "a b a", "bar grill", "grill bar", "z" * 70, "y" * 64})[:220] + ["z" * 70, "y" * 64, "a a", "a"]
    frame = spark.createDataFrame([(n,) for n in names], "name string").select("name", letter_bits(F.col("name")).alias("letters"), word_bits(F.col("name")).alias("words"), name_sizes(F.col("name")).alias("sizes"))
    side = lambda mark: frame.select(*[F.col(c).alias(f"{mark}_{c}") for c in frame.columns])
    rows = side("a").crossJoin(side("b")).select("a_name", "b_name", highest_similarity("a_", "b_").alias("high")).collect()
    exact = name_similarities([r["a_name"] for r in rows], [r["b_name"] for r in rows])
    assert all(s <= r["high"] + 1e-9 for s, r in zip(exact, rows, strict=True))
    assert all(s == name_similarity(r["a_name"], r["b_name"]) for s, r in list(zip(exact, rows, strict=True))[::7])
    assert list(name_similarities(["", "é a", "a"], ["", "é b", ""])) == [name_similarity(*p) for p in (("", ""), ("é a", "é b"), ("a", ""))]
