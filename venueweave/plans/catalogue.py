"""Queries of the write half, of stage bookkeeping and of what the catalogue's pages show."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venueweave.operators import extraction, ledger, readmodels, upsert
from venueweave.operators.blocking import best_match, entities
from venueweave.plans.canonical import with_split_address
from venueweave.plans.reference import _INS, _USABLE, _VENUES, _adopted, _venues
from venueweave.plans.reference import ORACLES as _REFERENCE
from venueweave.sources import parsers
from venueweave.sources.tables import table
from venueweave.storage import Stash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__], ORACLES[function.__name__] = function, sql
        return function

    return register


_DOCS = "d as (select distinct on (doc_id) * from documents where doc_id is not null)"


@query(
    f"with {_DOCS}, old as (select doc_id, title, length(text) as score, text as body from d where doc_id % 4 <> 0), new as (select doc_id, 'new ' || title as title, length(text) + 1 as score, case when doc_id % 2 = 0 then text || '!' else text end as body from d where doc_id % 5 <> 0) "
    "select doc_id, case when old.doc_id is null then new.title else old.title end as title, case when old.doc_id is null or (new.doc_id is not null and old.body is distinct from new.body) then new.score else old.score end as score, case when old.doc_id is null or (new.doc_id is not null and old.body is distinct from new.body) then new.body else old.body end as body from old full join new using (doc_id)"
)
def comment_upsert(spark, folder):
    """Body and score of changed comments are taken over, their other columns stay; documents stand for comments."""
    docs = table(spark, folder, "documents").filter("doc_id is not null").dropDuplicates(["doc_id"])
    old = docs.filter("doc_id % 4 != 0").select("doc_id", "title", F.length("text").alias("score"), F.col("text").alias("body"))
    new = docs.filter("doc_id % 5 != 0").select("doc_id", F.concat(F.lit("new "), "title").alias("title"), (F.length("text") + 1).alias("score"), F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("body"))
    return upsert.update_columns(old, new, ["doc_id"], ["score"], "body")


@query("select run_id, array_to_string(list_sort(list(decision || '=' || n)), '|') as stats from (select run_id, decision, count(*) as n from match_candidates where decision is not null group by all) group by run_id")
def run_counters(spark, folder):
    """What each run decided, counted from its rows."""
    found = ledger.stage_counters(table(spark, folder, "match_candidates"), ["run_id"], "decision")
    return found.select("run_id", F.array_join(F.array_sort(F.transform(F.map_entries("stats"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))), "|").alias("stats"))


@query("select event_type as stage, 'u' || user_id as unit_key, max(ts) as done_at from events group by all")
def progress_markers(spark, folder):
    """The last marker of each stage and unit; events stand for markers."""
    rows = table(spark, folder, "events").select(F.col("event_type").alias("stage"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("unit_key"), F.col("ts").alias("done_at"), F.col("event_id").alias("run_id"))
    return ledger.latest_markers(rows).select("stage", "unit_key", "done_at")


_RETIRED = f"{_VENUES}, live as (select * from venues where venue_id % 7 <> 0)"


@query(f"with {_RETIRED}, {_INS} select venue_id, name, count(distinct raw_review_id) as review_count from live join ins using (venue_id) group by all")
def live_profiles(spark, folder):
    """Profiles of venues that aren't retired; every seventh is."""
    retired = F.when(F.col("venue_id") % 7 == 0, F.lit("2026-01-01").cast("timestamp_ntz"))
    return readmodels.venue_profiles(_venues(spark, folder).withColumn("retired_at", retired), _adopted(spark, folder)).select("venue_id", "name", "review_count")


@query(
    f"with {_VENUES}, {_INS}, z as (select zip, min(neighborhood) as neighborhood from zip_neighborhoods group by zip), near as (select venue_id, z.neighborhood from venues v join z on z.zip = v.zip where v.lat is not null), "
    "tot as (select venue_id, count(distinct raw_review_id) as review_count, cast(round(cast(avg(cast(confidence as double)) as decimal(20, 10)), 2) as double) as mean_confidence from ins group by venue_id), best as (select neighborhood from near group by all order by count(*) desc, neighborhood limit 1) "
    "select venue_id, review_count, mean_confidence from venues join tot using (venue_id) join near using (venue_id) where neighborhood = (from best) order by review_count desc, coalesce(mean_confidence, 0) desc, venue_id limit 200"
)
def neighborhood_search(spark, folder):
    """Search within the neighbourhood that has most venues."""
    venues = Stash(_venues(spark, folder), "venues").df
    places = readmodels.venue_map(venues, table(spark, folder, "zip_neighborhoods"), table(spark, folder, "insights"))
    profiles = readmodels.with_neighborhood(readmodels.venue_profiles(venues, _adopted(spark, folder)), places)
    most = places.filter("neighborhood is not null").groupBy("neighborhood").count().orderBy(F.col("count").desc(), "neighborhood").first()
    return readmodels.search(profiles, neighborhood=most["neighborhood"] if most else "").select("venue_id", "review_count", "mean_confidence")


@query(f"with g as ({_REFERENCE['grounded_insights']}) select count(*) as insights, round(avg(cast(evidence_verbatim as int)), 3) as evidence_verbatim_rate, round(avg(cast(confidence as double)), 3) as mean_confidence, coalesce(sum(case when dropped_fields = '' then 0 else len(string_split(dropped_fields, '|')) end), 0)::bigint as fields_dropped from g join insights using (id)")
def evidence_scorecard(spark, folder):
    """Verbatim rate, mean confidence and number of fields dropped, over all insights."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("raw_review_id"), "text")
    return readmodels.evidence_totals(extraction.ground(table(spark, folder, "insights").join(docs, "raw_review_id")))


@query(f"with {_VENUES}, {_INS}, s as (select venue_id, avg(case sentiment when 'positive' then 1 when 'mixed' then 0 when 'neutral' then 0 when 'negative' then -1 end) as score from ins group by venue_id) select venue_id, case when score is null then '-' when cast(round(cast(score as decimal(20, 10)), 2) as double) > 0.33 then 'positive' when cast(round(cast(score as decimal(20, 10)), 2) as double) < -0.33 then 'negative' else 'mixed' end as label from venues join s using (venue_id)")
def sentiment_labels(spark, folder):
    return readmodels.venue_profiles(_venues(spark, folder), _adopted(spark, folder)).select("venue_id", readmodels.sentiment_label(F.col("sentiment_score")).alias("label"))


@query("select o_orderkey, case when o_orderstatus = 'P' then '[ ]' when o_orderstatus = 'O' and o_orderdate > timestamp '1998-01-01' then '[~]' when o_orderstatus = 'F' then '[x]' else '[!]' end as mark, cast(least(100, floor(o_totalprice / 200000 * 100 + 0.5)) as int) as percent from orders")
def status_marks(spark, folder):
    """Mark and per cent of a stage's row; orders stand for runs."""
    status = F.when(F.col("o_orderstatus") == "P", "never").when(F.col("o_orderstatus") == "F", "succeeded").otherwise("running")
    running = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp_ntz"))
    return table(spark, folder, "orders").select("o_orderkey", readmodels.stage_mark(status, running).alias("mark"), readmodels.percent_done(F.col("o_totalprice"), F.lit(200000)).alias("percent"))


@query("with q as (select id, raw_review_id, list_filter(list_transform(evidence, lambda e: e.quote), lambda x: coalesce(x, '') <> '') as quotes from insights) select q.id, true as whole, len(list_filter(quotes, lambda x: contains(d.text, x))) > 0 as quoted from q join documents d on d.doc_id = q.raw_review_id where d.text is not null")
def highlighted_quotes(spark, folder):
    """Texts cut at their quotes: the parts make up the text again, and hold a quoted one where a quote stands in it."""
    docs = table(spark, folder, "documents").filter("text is not null").select(F.col("doc_id").alias("raw_review_id"), "text")
    rows = table(spark, folder, "insights").join(docs, "raw_review_id").withColumn("parts", parsers.highlighted(F.col("text"), F.transform("evidence", lambda e: e["quote"])))
    return rows.select("id", (F.array_join(F.transform("parts", lambda p: p["part"]), "") == F.col("text")).alias("whole"), F.exists("parts", lambda p: p["quoted"]).alias("quoted"))


@query("select event_id as number, event_type || ' ' || props as line from events where contains(event_type || ' ' || props, 'click') order by event_id desc limit 50")
def log_lines(spark, folder):
    """The last fifty lines about clicks; events stand for log lines."""
    lines = table(spark, folder, "events").select(F.col("event_id").alias("number"), F.concat_ws(" ", "event_type", "props").alias("line"))
    return parsers.log_tail(lines, 50, "click")


_VIBES = ", ".join(f"'{v}'" for v in extraction.VIBES)


@query(
    f"with k as (select id, list_filter(list_distinct(vibe_tags), lambda x: x in ({_VIBES})) as tags, vibe_tags, noise_level as n, crowd_level as c, sentiment as s from insights) "
    "select id, array_to_string(list_sort(coalesce(tags, [])), '|') as vibe_tags, case when n in ('quiet', 'moderate', 'loud') then n end as noise_level, case when c in ('empty', 'comfortable', 'busy', 'packed') then c end as crowd_level, case when s in ('positive', 'mixed', 'negative', 'neutral') then s end as sentiment from k"
)
def checked_output(spark, folder):
    """Extracted fields held to the vocabulary."""
    found = extraction.checked(table(spark, folder, "insights"))
    return found.select("id", F.array_join(F.array_sort(F.coalesce("vibe_tags", F.array().cast("array<string>"))), "|").alias("vibe_tags"), "noise_level", "crowd_level", "sentiment")


@query(
    f"""with r as (select distinct on (raw_id) * from rec where raw_id is not null and name is not null and name <> '' and source = 'dohmh'),
p as (select raw_id, case when {_USABLE} then lat end as lat, case when {_USABLE} then lon end as lon from r), b as (select median(lat) as la, median(lon) as lo from p)
select raw_id as left_id, coalesce(lat is not null and not (lat > la - 0.02 and lat < la + 0.02 and lon > lo - 0.02 and lon < lo + 0.02), false) as outside from p, b"""
)
def outside_region(spark, folder):
    """Which records the match of reviews leaves out as outside of its region: a box around the median place."""
    rec = table(spark, folder, "rec")
    usable = rec.dropDuplicates(["raw_id"]).filter(f"raw_id is not null and name is not null and name != '' and source = 'dohmh' and {_USABLE}")
    la, lo = usable.agg(F.median("lat"), F.median("lon")).first()
    ring = [[lo - 0.02, la - 0.02], [lo + 0.02, la - 0.02], [lo + 0.02, la + 0.02], [lo - 0.02, la + 0.02], [lo - 0.02, la - 0.02]]
    region = spark.createDataFrame([("box", f'{{"type": "Polygon", "coordinates": [{ring}]}}')], "name string, geojson string")
    left = Stash(entities(with_split_address(rec.filter("source = 'dohmh'"))), "left").df
    found = best_match(left, Stash(entities(rec.filter("source = 'osm'")), "right").df, region)
    return found.select("left_id", (F.col("decision") == "outside").alias("outside"))
