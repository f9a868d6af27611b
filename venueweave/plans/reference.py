"""Queries of the engine's own operators over the project's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venueweave.functions.geo import NEIGHBOURS, geohash, geohash_cell, haversine_m, usable
from venueweave.functions.strings import similarity_columns
from venueweave.functions.text import fold_ascii, norm_housenumber, norm_name, norm_phone, norm_quote, norm_street, norm_zip, street_split, title_case
from venueweave.operators import blocking, extraction, ledger, readmodels, upsert
from venueweave.operators.components import components
from venueweave.plans import canonical
from venueweave.sources import tables
from venueweave.sources.tables import table
from venueweave.storage import Stash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_ASCII = "lower(regexp_replace(strip_accents(replace(replace({0}, '’', ''), '''', '')), '[^\\x00-\\x7F]', '', 'g'))"
_NORM_NAME = f"""array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(replace(regexp_replace({_ASCII.format("coalesce(name, '')")}, '#\\s*\\d+\\b', ' ', 'g'), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')), ' '),
  lambda w: w <> '' and w not in ('the', 'inc', 'llc', 'corp', 'co', 'ltd', 'nyc', 'ny', 'restaurant', 'rest')), ' ')"""
_WORDS = "map {'west': 'w', 'east': 'e', 'north': 'n', 'south': 's', 'avenue': 'ave', 'av': 'ave', 'street': 'st', 'boulevard': 'blvd', 'place': 'pl', 'square': 'sq', 'road': 'rd', 'drive': 'dr', 'lane': 'ln', 'parkway': 'pkwy', 'terrace': 'ter', 'court': 'ct', 'plaza': 'plz', 'saint': 'st'}"
_NORM_STREET = f"""array_to_string(list_transform(list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace({_ASCII.format("coalesce(street, '')")}, '[^a-z0-9 ]+', ' ', 'g'), '\\b(\\d+)(st|nd|rd|th)\\b', '\\1', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: w <> ''),
  lambda w: coalesce(({_WORDS})[w], w)), ' ')"""
_NORM_HOUSE = f"""regexp_replace(coalesce(list_filter(string_split(regexp_replace({_ASCII.format("coalesce(housenumber, '')")}, '\\s+', ' ', 'g'), ' '), lambda w: w <> '')[1], ''), '[^a-z0-9-]', '', 'g')"""
_NORM_PHONE = """(case when length(regexp_replace(coalesce(phone, ''), '\\D', '', 'g')) = 11 and regexp_replace(coalesce(phone, ''), '\\D', '', 'g') like '1%' then substr(regexp_replace(coalesce(phone, ''), '\\D', '', 'g'), 2)
  when length(regexp_replace(coalesce(phone, ''), '\\D', '', 'g')) = 10 then regexp_replace(coalesce(phone, ''), '\\D', '', 'g') else '' end)"""
_NORM_ZIP = "regexp_extract(trim(coalesce(zip, '')), '^\\d{5}')"
_USABLE = "lat is not null and lon is not null and not isnan(lat) and not isnan(lon) and lat <> 0 and lon <> 0 and abs(lat) <= 90 and abs(lon) <= 180"
_HAVERSINE = "2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians({1}.lat - {0}.lat) / 2), 2) + cos(radians({0}.lat)) * cos(radians({1}.lat)) * pow(sin(radians({1}.lon - {0}.lon) / 2), 2))))"
#: Normalised entity records as SQL, one for each raw id.
_ENTITIES = f"""
r as (select distinct on (raw_id) * from rec where raw_id is not null and name is not null and name <> ''),
ent as (
  select raw_id, source, {_NORM_NAME} as name_norm, {_NORM_HOUSE} as housenumber, {_NORM_STREET} as street_norm, {_NORM_ZIP} as zip, {_NORM_PHONE} as phone,
    case when {_USABLE} then lat end as lat, case when {_USABLE} then lon end as lon
  from r),
cell as (select *, cast(floor((lat + 90) / 180 * 131072) as bigint) as i, cast(floor((lon + 180) / 360 * 262144) as bigint) as j, case when zip <> '' and street_norm <> '' then 'a:' || zip || ':' || street_norm end as addr from ent),
block as (select raw_id, source, coalesce('g:' || i || ':' || j, addr) as block from cell where coalesce('g:' || i || ':' || j, addr) is not null),
steps(p, di, dj) as (values (0, 0, 0), (1, 1, 0), (2, -1, 0), (3, 0, 1), (4, 0, -1), (5, 1, 1), (6, 1, -1), (7, -1, 1), (8, -1, -1)),
seek as (
  select raw_id, source, 'g:' || (i + di) || ':' || (j + dj) as block, p from cell, steps where i is not null
  union all select raw_id, source, addr, 9 from cell where addr is not null)
"""
_LATEST = "(select * from extraction_reviews where insight_id is not null and reviewer is not null qualify row_number() over (partition by insight_id, reviewer order by reviewed_at desc nulls last, id desc) = 1)"
#: Canonical venues of the settled groups as SQL.
_FIRST = "arg_min({0}, rk) filter (coalesce({0}, '') <> '')"
_VENUES = f"""
links as (select distinct venue_id, raw_venue_id as raw_id from venue_sources where venue_id is not null and raw_venue_id is not null),
mem as (
  select venue_id, x.*, row_number() over (partition by venue_id order by source <> 'osm', coalesce(housenumber, '') = '', coalesce(phone, '') = '', raw_id) as rk
  from links join (select distinct on (raw_id) * from rec) x using (raw_id)),
venues as (
  select venue_id, arg_min(source, rk) || ':' || arg_min(source_id, rk) as key, arg_min(name, rk) as name, arg_min(name_norm, rk) as name_norm, arg_min(category, rk) as category,
    {", ".join(_FIRST.format(c) + f" as {c}" for c in ("housenumber", "street", "zip", "phone", "website", "cuisine", "last_inspection"))},
    {", ".join(f"arg_min({c}, rk) filter ({c} is not null and not isnan({c}) and {c} <> 0) as {c}" for c in ("lat", "lon"))},
    count(*) as source_count
  from mem group by venue_id)
"""
_INS = "ins as (select i.*, d.source from insights i join documents d on d.doc_id = i.raw_review_id where venue_id is not null and prompt_version in ('v2', 'v3'))"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def _rec(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "rec")


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    return blocking.held_entities(_rec(spark, folder))


def _venues(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "venue_sources").filter("venue_id is not null and raw_venue_id is not null").select(F.col("raw_venue_id").alias("raw_id"), F.col("venue_id").alias("cluster")).distinct()
    return blocking.fold_clusters(_rec(spark, folder), links).withColumnRenamed("cluster", "venue_id")


def _adopted(spark: SparkSession, folder: str) -> DataFrame:
    return readmodels.adopted_insights(table(spark, folder, "insights"), table(spark, folder, "documents"))


def _joined(column: str):
    return F.array_join(F.coalesce(column, F.array().cast("array<string>")), "|").alias(column)


# ------------------------------------------------------------------------------------------------ scalars


@query(f"select distinct raw_id, {_ASCII.format('name')} as folded from rec")
def fold_names(spark, folder):
    return _rec(spark, folder).select("raw_id", fold_ascii("name").alias("folded")).distinct()


@query(f"select distinct raw_id, {_NORM_NAME} as name_norm from rec")
def normal_names(spark, folder):
    return _rec(spark, folder).select("raw_id", norm_name("name").alias("name_norm")).distinct()


@query(f"select distinct raw_id, {_NORM_STREET} as street_norm from rec")
def normal_streets(spark, folder):
    return _rec(spark, folder).select("raw_id", norm_street("street").alias("street_norm")).distinct()


@query(f"select distinct raw_id, {_NORM_HOUSE} as housenumber, {_NORM_PHONE} as phone, {_NORM_ZIP} as zip from rec")
def normal_parts(spark, folder):
    return _rec(spark, folder).select("raw_id", norm_housenumber("housenumber").alias("housenumber"), norm_phone("phone").alias("phone"), norm_zip("zip").alias("zip")).distinct()


_TITLE = "array_to_string(list_transform(regexp_extract_all(lower({0}), '\\p{{L}}+|\\P{{L}}+'), lambda r: upper(r[1]) || r[2:]), '')"


@query(f"select distinct raw_id, {_TITLE.format('name')} as title from rec where name is not null")
def title_cased(spark, folder):
    return _rec(spark, folder).filter("name is not null").select("raw_id", title_case("name").alias("title")).distinct()


@query(
    "with s as (select distinct raw_id, trim(split_part(coalesce(street, ''), ',', 1)) as line from rec), n as (select *, regexp_extract(line, '^(\\d+\\S*)\\s+', 1) as number from s) "
    "select raw_id, number, case when number <> '' then regexp_replace(line, '^\\d+\\S*\\s+', '') else line end as street from n"
)
def split_streets(spark, folder):
    number, street = street_split("street")
    return _rec(spark, folder).select("raw_id", number.alias("number"), street.alias("street")).distinct()


@query(
    f"with p as (select distinct raw_id, lat, lon from rec where {_USABLE}), c as (select raw_id, cast(floor((lat + 90) / 180 * 131072) as bigint) as i, cast(floor((lon + 180) / 360 * 262144) as bigint) as j from p) "
    "select raw_id, i, j, array_to_string(list_transform(range(0, 7), lambda k: '0123456789bcdefghjkmnpqrstuvwxyz'[cast(list_sum(list_transform(range(0, 5), lambda b: "
    "(case when (5 * k + b) % 2 = 0 then (j >> cast(17 - (5 * k + b) // 2 as bigint)) else (i >> cast(16 - (5 * k + b) // 2 as bigint)) end & 1) * (16 >> cast(b as int)))) as int) + 1]), '') as hash from c"
)
def geohash_cells(spark, folder):
    i, j = geohash_cell("lat", "lon", 7)
    return _rec(spark, folder).filter(usable("lat", "lon")).select("raw_id", i.alias("i"), j.alias("j"), geohash("lat", "lon", 7).alias("hash")).distinct()


@query(
    f"with p as (select distinct cast(floor((lat + 90) / 180 * 131072) as bigint) as i, cast(floor((lon + 180) / 360 * 262144) as bigint) as j from rec where {_USABLE}), "
    "s(p, di, dj) as (values (0, 0, 0), (1, 1, 0), (2, -1, 0), (3, 0, 1), (4, 0, -1), (5, 1, 1), (6, 1, -1), (7, -1, 1), (8, -1, -1)) select i, j, cast(p as int) as position, i + di as ni, j + dj as nj from p, s"
)
def cell_neighbours(spark, folder):
    i, j = geohash_cell("lat", "lon", 7)
    cells = _rec(spark, folder).filter(usable("lat", "lon")).select(i.alias("i"), j.alias("j")).distinct()
    steps = F.array(*[F.struct(F.lit(p).alias("position"), F.lit(a).alias("a"), F.lit(b).alias("b")) for p, (a, b) in enumerate(NEIGHBOURS)])
    return cells.withColumn("s", F.explode(steps)).select("i", "j", "s.position", (F.col("i") + F.col("s.a")).alias("ni"), (F.col("j") + F.col("s.b")).alias("nj"))


@query(
    f"with p as (select distinct on (raw_id) raw_id, lat, lon from rec where {_USABLE}) select distinct m.left_raw_id as a, m.right_raw_id as b, round({_HAVERSINE.format('x', 'y')}, 3) as metres "
    "from match_candidates m join p x on x.raw_id = m.left_raw_id join p y on y.raw_id = m.right_raw_id"
)
def candidate_distances(spark, folder):
    p = _rec(spark, folder).filter(usable("lat", "lon")).select("raw_id", "lat", "lon").dropDuplicates(["raw_id"])
    pairs = table(spark, folder, "match_candidates").select(F.col("left_raw_id").alias("a"), F.col("right_raw_id").alias("b")).distinct()
    both = pairs.join(p.toDF("a", "la", "lo"), "a").join(p.toDF("b", "lb", "lp"), "b")
    return both.select("a", "b", F.round(haversine_m(F.col("la"), F.col("lo"), F.col("lb"), F.col("lp")), 3).alias("metres"))


_LCS = """list_reduce(list_prepend(list_transform(range(0, length({y}) + 1), lambda q: 0), list_transform(string_split({x}, ''), lambda c: [unicode(c)])),
  lambda old, c: list_reduce(list_prepend([0], list_transform(range(1, length({y}) + 1), lambda j: [cast(j as int)])),
    lambda acc, j: list_append(acc, case when unicode(substr({y}, j[1], 1)) = c[1] then old[j[1]] + 1 else greatest(acc[j[1]], old[j[1] + 1]) end)))[length({y}) + 1]"""


@query(
    f"""with n as (select distinct raw_id, {_NORM_NAME} as nn from rec where name is not null),
p as (select distinct x.nn as x, y.nn as y from match_candidates m join n x on x.raw_id = m.left_raw_id join n y on y.raw_id = m.right_raw_id where x.nn <> '' and y.nn <> ''),
s as (select x, y, array_to_string(list_sort(string_split(x, ' ')), ' ') as sx, array_to_string(list_sort(string_split(y, ' ')), ' ') as sy from p)
select x, y, round(200.0 * {_LCS.format(x="x", y="y")} / (length(x) + length(y)), 6) as ratio, round(200.0 * {_LCS.format(x="sx", y="sy")} / (length(x) + length(y)), 6) as token_sort from s"""
)
def name_ratios(spark, folder):
    names = _rec(spark, folder).filter("name is not null").select("raw_id", norm_name("name").alias("n")).distinct()
    pairs = table(spark, folder, "match_candidates").select("left_raw_id", "right_raw_id").distinct()
    both = pairs.join(names.toDF("left_raw_id", "x"), "left_raw_id").join(names.toDF("right_raw_id", "y"), "right_raw_id").filter("x != '' and y != ''").select("x", "y").distinct()
    of = similarity_columns()
    return both.select("x", "y", F.round(of["ratio"]("x", "y"), 6).alias("ratio"), F.round(of["token_sort"]("x", "y"), 6).alias("token_sort"))


_RATIO = "(case when length({x}) + length({y}) = 0 then 100.0 else 200.0 * " + _LCS + " / (length({x}) + length({y})) end)"


@query(
    f"""with n as (select distinct raw_id, {_NORM_NAME} as nn from rec where name is not null),
p as (select distinct x.nn as x, y.nn as y from match_candidates m join n x on x.raw_id = m.left_raw_id join n y on y.raw_id = m.right_raw_id where x.nn <> '' and y.nn <> ''),
w as (select x, y, list_distinct(string_split(x, ' ')) as a, list_distinct(string_split(y, ' ')) as b, array_to_string(list_sort(string_split(x, ' ')), ' ') as sx, array_to_string(list_sort(string_split(y, ' ')), ' ') as sy from p),
s as (
  select *, array_to_string(list_sort(list_intersect(a, b)), ' ') as i, array_to_string(list_sort(list_filter(a, lambda v: not list_contains(b, v))), ' ') as l, array_to_string(list_sort(list_filter(b, lambda v: not list_contains(a, v))), ' ') as r from w),
t as (select *, trim(i || ' ' || l) as il, trim(i || ' ' || r) as ir from s),
q as (
  select x, y, sx, sy, case when i <> '' and (l = '' or r = '') then 100.0 when i = '' then {_RATIO.format(x="il", y="ir")} else greatest({_RATIO.format(x="il", y="ir")}, {_RATIO.format(x="i", y="il")}, {_RATIO.format(x="i", y="ir")}) end as token_set from t)
select x, y, round(token_set, 6) as token_set, round(greatest({_RATIO.format(x="x", y="y")}, (token_set + {_RATIO.format(x="sx", y="sy")}) / 2) / 100.0, 6) as name_sim from q"""
)
def name_similarity(spark, folder):
    """The blended similarity and its token-set part, over the same pairs."""
    pairs = name_ratios(spark, folder).select("x", "y")
    of = similarity_columns()
    return pairs.select("x", "y", F.round(of["token_set"]("x", "y"), 6).alias("token_set"), F.round(of["name_sim"]("x", "y"), 6).alias("name_sim"))


@query("select doc_id, sha256(text) as hash, count(*) over (partition by sha256(text)) as copies from documents where text is not null")
def content_hashes(spark, folder):
    docs = table(spark, folder, "documents").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("hash"))
    return docs.join(docs.groupBy("hash").agg(F.count("*").alias("copies")), "hash").select("doc_id", "hash", "copies")


@query("select id, pos, lower(trim(regexp_replace(translate(quote, '“”‘’', '\"\"'''''), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))) as quote from (select id, unnest(evidence).quote as quote, unnest(range(1, len(evidence) + 1)) as pos from insights)")
def normal_quotes(spark, folder):
    rows = table(spark, folder, "insights").select("id", F.posexplode("evidence").alias("i", "e"))
    return rows.select("id", (F.col("i") + 1).cast("bigint").alias("pos"), norm_quote("e.quote").alias("quote"))


# ------------------------------------------------------------------------------------------------ resolution


@query(f"with {_ENTITIES} select raw_id, block from block")
def block_index(spark, folder):
    return blocking.block_keys(_entities(spark, folder)).select("raw_id", F.col("block"))


@query(f"with {_ENTITIES} select s.raw_id as left_id, b.raw_id as right_id, cast(min(p) as int) as position from seek s join block b using (block) where s.source = 'dohmh' and b.source = 'osm' group by 1, 2")
def block_probe(spark, folder):
    records = _entities(spark, folder)
    return blocking.probe(records.filter("source = 'dohmh'"), records.filter("source = 'osm'"))


@query()
def same_source_pairs(spark, folder):
    """Duplicates within a source; the similarity of all pairs is beyond SQL, so this is tested against brute force."""
    return blocking.same_source_duplicates(_entities(spark, folder)).select("left_id", "right_id", "name_sim")


@query()
def cross_source_pairs(spark, folder):
    """Scored candidates between the two feeds, with every component of the score."""
    records = _entities(spark, folder)
    return blocking.cross_candidates(records.filter("source = 'dohmh'"), records.filter("source = 'osm'"))


@query()
def one_to_one(spark, folder):
    """Decisions of the greedy one-to-one rule."""
    return canonical.canonical_venues(_rec(spark, folder))[1].select("left_id", "right_id", "score", "decision")


@query()
def canonical_venues(spark, folder):
    """Venues from raw records, end to end."""
    return canonical.canonical_venues(_rec(spark, folder))[0].select("cluster", "key", "name", "category", "housenumber", "street", "zip", "phone", "source_count")


@query(
    "with recursive e0 as (select distinct left_raw_id as a, right_raw_id as b from match_candidates where decision = 'review' and left_raw_id <> right_raw_id), e as (select a, b from e0 union select b, a from e0), "
    "walk as (select a, a as b from e union select walk.a, e.b from walk join e on e.a = walk.b) select a as id, min(b) as group_id from walk group by a"
)
def review_components(spark, folder):
    return components(table(spark, folder, "match_candidates").filter("decision = 'review'"), "left_raw_id", "right_raw_id")


@query(f"with {_VENUES} select * exclude (name_norm) from venues")
def cluster_fold(spark, folder):
    return _venues(spark, folder).drop("name_norm")


@query()
def best_venue(spark, folder):
    """Each inspection record's best map record: the argmax link with its decision."""
    rec = _rec(spark, folder)
    return canonical.link_reviews(rec.filter("source = 'dohmh'"), rec.filter("source = 'osm'"))


# ------------------------------------------------------------------------------------------------ read models


@query(
    f"""with {_VENUES}, {_INS},
tags as (select venue_id, tag, count(*) as n from (select venue_id, unnest(vibe_tags) as tag from ins) group by all),
ranked as (select venue_id, list(tag order by n desc, tag)[1:5] as top from tags group by venue_id),
ev as (select venue_id, list(distinct x order by x) as l from (select venue_id, unnest(recurring_events) as x from ins) group by venue_id),
gf as (select venue_id, list(distinct x order by x) as l from (select venue_id, unnest(good_for) as x from ins) group by venue_id),
tot as (select venue_id, count(distinct raw_review_id) as review_count, list(distinct source order by source) as sources, mode() within group (order by noise_level) as noise_level, mode() within group (order by crowd_level) as crowd_level,
  arg_min(best_time, (raw_review_id, id)) filter (best_time is not null) as best_time,
  cast(round(cast(avg(case sentiment when 'positive' then 1 when 'mixed' then 0 when 'neutral' then 0 when 'negative' then -1 end) as decimal(20, 10)), 2) as double) as sentiment_score,
  cast(round(cast(avg(cast(confidence as double)) as decimal(20, 10)), 2) as double) as mean_confidence from ins group by venue_id)
select v.venue_id, v.key, v.name, v.category, review_count, array_to_string(sources, '|') as sources, coalesce(array_to_string(r.top, '|'), '') as top_vibe_tags, noise_level, crowd_level, best_time,
  coalesce(array_to_string(ev.l, '|'), '') as recurring_events, coalesce(array_to_string(gf.l, '|'), '') as good_for, sentiment_score, mean_confidence
from venues v join tot using (venue_id) left join ranked r using (venue_id) left join ev using (venue_id) left join gf using (venue_id)"""
)
def venue_profiles(spark, folder):
    out = readmodels.venue_profiles(_venues(spark, folder), _adopted(spark, folder))
    return out.select("venue_id", "key", "name", "category", "review_count", _joined("sources"), _joined("top_vibe_tags"), "noise_level", "crowd_level", "best_time", _joined("recurring_events"), _joined("good_for"), "sentiment_score", "mean_confidence")


@query(f"with {_INS} select venue_id, tag, count(*) as n, row_number() over (partition by venue_id order by count(*) desc, tag) as rank from (select venue_id, unnest(vibe_tags) as tag from ins) group by venue_id, tag")
def tag_counts(spark, folder):
    """The tag map of each venue as rows, in its ranked order."""
    tags = readmodels.ranked_tags(_adopted(spark, folder))
    rows = tags.select("venue_id", "vibe_tag_counts", F.posexplode("vibe_tags_ranked").alias("i", "tag"))
    return rows.select("venue_id", "tag", F.element_at("vibe_tag_counts", F.col("tag")).alias("n"), (F.col("i") + 1).cast("bigint").alias("rank"))


@query(
    f"with {_INS} select venue_id, cast(row_number() over (partition by venue_id order by id, pos) as int) as rank, e.field as field, e.quote as quote from (select venue_id, id, unnest(evidence) as e, unnest(range(0, len(evidence))) as pos from ins) "
    "qualify row_number() over (partition by venue_id order by id, pos) <= 6"
)
def first_quotes(spark, folder):
    rows = readmodels.first_evidence(_adopted(spark, folder))
    return rows.select("venue_id", F.posexplode("evidence").alias("i", "e")).select("venue_id", (F.col("i") + 1).alias("rank"), "e.field", "e.quote")


@query(f"with {_VENUES}, z as (select zip, min(neighborhood) as neighborhood from zip_neighborhoods group by zip) select venue_id, name, category, lat, lon, v.zip, z.neighborhood, venue_id in (select venue_id from insights where venue_id is not null) as has_insights from venues v left join z on z.zip = v.zip where lat is not null")
def venue_map(spark, folder):
    out = readmodels.venue_map(_venues(spark, folder), table(spark, folder, "zip_neighborhoods"), table(spark, folder, "insights"))
    return out.select("venue_id", "name", "category", "lat", "lon", "zip", "neighborhood", "has_insights")


@query(
    f"""with {_VENUES}, z as (select zip, min(neighborhood) as neighborhood from zip_neighborhoods group by zip),
rv as (select i.venue_id, d.source, d.doc_id, d.lang as neighborhood from insights i join documents d on d.doc_id = i.raw_review_id where i.venue_id is not null and d.lang is not null),
own as (select venue_id, arg_min(neighborhood, (source, doc_id)) as neighborhood from rv group by venue_id)
select venue_id, coalesce(own.neighborhood, z.neighborhood) as neighborhood from venues v left join own using (venue_id) left join z on z.zip = v.zip where v.lat is not null"""
)
def neighborhood_fallback(spark, folder):
    """A venue's attribute of its first review by source, else of its zip (the reviews' language stands for it here)."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("raw_review_id"), "doc_id", "source", F.col("lang").alias("neighborhood"))
    reviewed = table(spark, folder, "insights").filter("venue_id is not null").select("venue_id", "raw_review_id").join(docs, "raw_review_id")
    return readmodels.venue_map(_venues(spark, folder), table(spark, folder, "zip_neighborhoods"), table(spark, folder, "insights"), reviewed).select("venue_id", "neighborhood")


@query("select i.venue_id, d.source, d.title as source_title, d.published_at, e.field as field, e.quote as quote, i.prompt_version, i.model from (select venue_id, raw_review_id, prompt_version, model, unnest(evidence) as e from insights where venue_id is not null) i join documents d on d.doc_id = i.raw_review_id")
def venue_evidence(spark, folder):
    return readmodels.venue_evidence(table(spark, folder, "insights"), table(spark, folder, "documents"))


@query(f"select i.id as insight_id, i.venue_id, d.source, md5(d.text) as text_hash, i.model, coalesce(string_agg(e.reviewer || '=' || coalesce(e.verdict, ''), '|' order by e.reviewer), '') as verdicts from insights i join documents d on d.doc_id = i.raw_review_id left join {_LATEST} e on e.insight_id = i.id group by all")
def review_queue(spark, folder):
    queue = readmodels.review_queue(table(spark, folder, "insights"), table(spark, folder, "documents"), table(spark, folder, "extraction_reviews"))
    shown = F.array_join(F.transform(F.array_sort(F.map_keys("verdicts")), lambda k: F.concat(k, F.lit("="), F.coalesce(F.get_json_object(F.element_at("verdicts", k), "$.verdict"), F.lit("")))), "|")
    return queue.select("insight_id", "venue_id", "source", F.md5("text").alias("text_hash"), "model", shown.alias("verdicts"))


@query(f"with l as {_LATEST}, m as (select insight_id, verdict from l where reviewer = 'rev_megebick') select i.id as insight_id from insights i join documents d on d.doc_id = i.raw_review_id join m on m.insight_id = i.id where exists (select 1 from l where l.insight_id = i.id and l.verdict is distinct from m.verdict)")
def queue_disagreements(spark, folder):
    queue = readmodels.review_queue(table(spark, folder, "insights"), table(spark, folder, "documents"), table(spark, folder, "extraction_reviews"))
    return readmodels.queue_mode(queue, "rev_megebick", "disagreement").select("insight_id")


@query("select i.id as insight_id from insights i join documents d on d.doc_id = i.raw_review_id where prompt_version = 'v3' and not exists (select 1 from extraction_reviews e where e.insight_id = i.id and e.reviewer = 'rev_megebick')")
def queue_unreviewed(spark, folder):
    queue = readmodels.review_queue(table(spark, folder, "insights"), table(spark, folder, "documents"), table(spark, folder, "extraction_reviews"))
    return readmodels.queue_mode(queue, "rev_megebick", "unreviewed", "v3").select("insight_id")


@query(
    """with s(stage) as (values ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('9-ABSENT')),
runs as (select o_orderkey as id, o_orderpriority as stage, case o_orderstatus when 'F' then 'succeeded' when 'O' then 'running' else 'failed' end as status, o_orderdate as started_at from orders),
last as (select distinct on (stage) * from runs order by stage, id desc),
units as (select case event_type when 'click' then '1-URGENT' when 'view' then '2-HIGH' else '3-MEDIUM' end as stage, count(*) as units_done, max(ts) as last_unit_at from events group by 1)
select s.stage, last.id as run_id, coalesce(last.status, 'never') as status, last.started_at, coalesce(u.units_done, 0) as units_done, u.last_unit_at,
  coalesce(last.status = 'running' and last.started_at > timestamp '1998-08-01' - interval 2 day, false) as is_running, (select count(*) from runs r where r.stage = s.stage) as runs
from s left join last on last.stage = s.stage left join units u on u.stage = s.stage"""
)
def stage_status(spark, folder):
    """Status by stage with a spine of stages; orders stand for runs and events for finished units."""
    status = F.when(F.col("o_orderstatus") == "F", "succeeded").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    runs = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("stage"), status.alias("status"), F.col("o_orderdate").alias("started_at"))
    stage = F.when(F.col("event_type") == "click", "1-URGENT").when(F.col("event_type") == "view", "2-HIGH").otherwise("3-MEDIUM")
    progress = table(spark, folder, "events").select(stage.alias("stage"), F.col("ts").alias("done_at"))
    return readmodels.pipeline_status(spark, runs, progress, F.lit("1998-08-01").cast("timestamp_ntz"), ["1-URGENT", "2-HIGH", "3-MEDIUM", "9-ABSENT"])


@query(
    "select (select count(*) from rec) as raw_venues, (select count(distinct venue_id) from venue_sources) as venues, (select count(*) from documents) as raw_reviews, (select count(*) from documents where source like 'guide/%') as raw_reviews_guide, "
    "(select count(*) from match_candidates where decision = 'matched') as matched, (select count(*) from insights) as insights, (select count(*) from extraction_reviews) as verdicts, (select count(*) from orders) as claims_scored, (select count(*) from events where event_type like 'click%') as guide_units"
)
def table_counts(spark, folder):
    t = lambda name: table(spark, folder, name)
    parts = [
        t("rec").agg(F.count("*").alias("raw_venues")),
        t("venue_sources").agg(F.count_distinct("venue_id").alias("venues")),
        t("documents").agg(F.count("*").alias("raw_reviews"), F.count_if(F.col("source").startswith("guide/")).alias("raw_reviews_guide")),
        t("match_candidates").agg(F.count_if(F.col("decision") == "matched").alias("matched")),
        t("insights").agg(F.count("*").alias("insights")),
        t("extraction_reviews").agg(F.count("*").alias("verdicts")),
        t("orders").agg(F.count("*").alias("claims_scored")),  # orders and events stand for the stores of other stages
        t("events").agg(F.count_if(F.col("event_type").startswith("click")).alias("guide_units")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part)  # one row each
    return out


@query(
    f"with l as {_LATEST} select 'insights' as part, 'all' as name, count(*) as n from insights union all select 'verdict', verdict, count(*) from l group by verdict union all select 'reviewer', reviewer, count(*) from l group by reviewer "
    "union all select 'field', f || '=' || v, count(*) from (select unnest(map_entries(field_verdicts)).key as f, unnest(map_entries(field_verdicts)).value as v from l) group by f, v union all select 'reviewer verdict', case when verdict is null then reviewer else reviewer || '=' || verdict end, count(*) from l group by reviewer, verdict"
)
def scorecard(spark, folder):
    return readmodels.scorecard(table(spark, folder, "insights"), table(spark, folder, "extraction_reviews"))


@query(f"select reviewer, count(*) as reviewed, count(*) filter (verdict = 'correct') as correct, count(*) filter (verdict = 'partial') as partial, count(*) filter (verdict = 'wrong') as wrong from {_LATEST} group by reviewer")
def reviewer_stats(spark, folder):
    rows = readmodels.latest_verdicts(table(spark, folder, "extraction_reviews"))
    return rows.groupBy("reviewer").agg(F.count("*").alias("reviewed"), *[F.count_if(F.col("verdict") == v).alias(v) for v in ("correct", "partial", "wrong")])


@query("with u as (select count(distinct id) as c from insights i where not exists (select 1 from extraction_reviews e where e.insight_id = i.id and e.reviewer = 'rev_megebick')) select least(20, c) as n, least(20, c) as different, 0 as reviewed, true as repeatable from u")
def unreviewed_sample(spark, folder):
    """A seeded sample of what one reviewer hasn't judged: its size, and that it is as a sample must be."""
    mine = table(spark, folder, "extraction_reviews").filter("reviewer = 'rev_megebick'")
    draw = lambda: readmodels.review_sample(table(spark, folder, "insights").dropDuplicates(["id"]), mine, 20, 7).select("id")
    sample, again = Stash(draw(), "sample").df, draw().withColumn("again", F.lit(True))
    judged = mine.select(F.col("insight_id").alias("id"), F.lit(True).alias("judged")).distinct()
    out = sample.join(judged, "id", "left").join(again, "id", "left")
    return out.agg(F.count("*").alias("n"), F.count_distinct("id").alias("different"), F.count("judged").alias("reviewed"), F.bool_and(F.coalesce("again", F.lit(False))).alias("repeatable"))


_SEARCH = f"""with {_VENUES}, {_INS},
tagged as (select venue_id from (select venue_id, unnest(vibe_tags) as tag from ins) where tag in ('quiet', 'trendy') group by venue_id having count(distinct tag) = 2),
tot as (select venue_id, count(distinct raw_review_id) as review_count, cast(round(cast(avg(cast(confidence as double)) as decimal(20, 10)), 2) as double) as mean_confidence from ins group by venue_id)"""


@query(f"{_SEARCH} select venue_id, category, review_count, mean_confidence from venues join tot using (venue_id) join tagged using (venue_id) order by review_count desc, coalesce(mean_confidence, 0) desc, venue_id limit 200")
def tag_search(spark, folder):
    profiles = readmodels.venue_profiles(_venues(spark, folder), _adopted(spark, folder))
    return readmodels.search(profiles, ["quiet", "trendy"]).select("venue_id", "category", "review_count", "mean_confidence")


@query(f"{_SEARCH}, gf as (select distinct venue_id from (select venue_id, unnest(good_for) as g from ins) where g = 'groups') select venue_id, category, review_count, mean_confidence from venues join tot using (venue_id) join gf using (venue_id) where category = 'bar' order by review_count desc, coalesce(mean_confidence, 0) desc, venue_id limit 50")
def facet_search(spark, folder):
    profiles = readmodels.venue_profiles(_venues(spark, folder), _adopted(spark, folder))
    return readmodels.search(profiles, category="bar", good_for="groups", k=50).select("venue_id", "category", "review_count", "mean_confidence")


@query(f"with {_VENUES}, {_INS}, g as (select distinct venue_id, x as value from (select venue_id, unnest(good_for) as x from ins) where venue_id in (select venue_id from venues)) select value, count(*) as n from g group by value order by n desc, value limit 12")
def top_facets(spark, folder):
    return readmodels.facet_values(readmodels.venue_profiles(_venues(spark, folder), _adopted(spark, folder)))


@query("select distinct neighborhood from zip_neighborhoods where neighborhood is not null order by neighborhood")
def distinct_neighborhoods(spark, folder):
    return table(spark, folder, "zip_neighborhoods").filter("neighborhood is not null").select("neighborhood").distinct().orderBy("neighborhood")


@query(f"with {_VENUES}, w as (select * from venues where lat is not null) select venue_id, 'Point' as kind, lon, lat, name, cast(venue_id in (select venue_id from insights where venue_id is not null) as int) as insight, cast(category = 'bar' as int) as hit, cast(venue_id = (select min(venue_id) from w) as int) as sel from w")
def map_features(spark, folder):
    """Features of the map, read back from their JSON; bars are the hits, the first venue is the one selected."""
    places = readmodels.venue_map(_venues(spark, folder), table(spark, folder, "zip_neighborhoods"), table(spark, folder, "insights"))
    places = Stash(places, "places").df
    found = readmodels.map_features(places, places.filter("category = 'bar'"), places.agg(F.min("venue_id")).first()[0])
    shape = "type string, id bigint, geometry struct<type: string, coordinates: array<double>>, properties struct<id: bigint, name: string, insight: int, hit: int, sel: int>"
    read = found.select("venue_id", F.from_json("feature", shape).alias("f"))
    return read.select("venue_id", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.geometry.coordinates")[1].alias("lat"), *[F.col(f"f.properties.{c}").alias(c) for c in ("name", "insight", "hit", "sel")])


@query("select id, case when sentiment = 'positive' then 'good' when sentiment = 'negative' then 'bad' when sentiment is null then '-' else 'mixed' end as label, least(100, round(cast(confidence as double) * 100)) as percent, coalesce(best_time, noise_level, '-') as tip from insights")
def case_labels(spark, folder):
    label = F.when(F.col("sentiment") == "positive", "good").when(F.col("sentiment") == "negative", "bad").when(F.col("sentiment").isNull(), "-").otherwise("mixed")
    return table(spark, folder, "insights").select("id", label.alias("label"), F.least(F.lit(100.0), F.round(F.col("confidence").cast("double") * 100)).alias("percent"), F.coalesce("best_time", "noise_level", F.lit("-")).alias("tip"))


# ------------------------------------------------------------------------------------------------ relational operators


@query("select distinct on (user_id) user_id, event_id, ts from events order by user_id, event_id desc")
def latest_per_group(spark, folder):
    return readmodels.top_by(table(spark, folder, "events"), ["user_id"], F.col("event_id").desc()).select("user_id", "event_id", "ts")


@query("select o_custkey, o_orderkey, rank from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders) where rank <= 3")
def first_k_per_group(spark, folder):
    order = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return table(spark, folder, "orders").withColumn("rank", F.row_number().over(order)).filter("rank <= 3").select("o_custkey", "o_orderkey", F.col("rank").cast("bigint").alias("rank"))


@query("select raw_id, max(score) as score from (select left_raw_id as raw_id, score from match_candidates where decision = 'matched' union all select right_raw_id, score from match_candidates where decision = 'matched') where raw_id is not null group by raw_id")
def best_score_per_record(spark, folder):
    rows = table(spark, folder, "match_candidates").filter("decision = 'matched'")
    ends = rows.select(F.explode(F.array("left_raw_id", "right_raw_id")).alias("raw_id"), "score").filter("raw_id is not null")
    return ends.groupBy("raw_id").agg(F.max("score").alias("score"))


@query("select distinct c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT') as urgent from customer")
def exists_flag(spark, folder):
    urgent = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("urgent")).distinct()
    return table(spark, folder, "customer").select("c_custkey").join(urgent, "c_custkey", "left").withColumn("urgent", F.coalesce("urgent", F.lit(False)))


@query("select id, venue_id from insights where prompt_version in (select version from (values ('v1', false), ('v2', true), ('v3', true), ('v4', false), ('v5', false)) v(version, adopted) where adopted)")
def adopted_only(spark, folder):
    versions = tables.prompt_versions(spark).filter("adopted").select(F.col("version").alias("prompt_version"))
    return table(spark, folder, "insights").join(versions, "prompt_version", "left_semi").select("id", "venue_id")


@query("select id from insights i where not exists (select 1 from extraction_reviews e where e.insight_id = i.id and e.reviewer = 'rev_megebick')")
def never_reviewed(spark, folder):
    """Insights that one reviewer hasn't judged."""
    done = table(spark, folder, "extraction_reviews").filter("reviewer = 'rev_megebick'").select(F.col("insight_id").alias("id"))
    return table(spark, folder, "insights").join(done, "id", "left_anti").select("id")


@query("select distinct r.raw_id, r.zip, z.neighborhood from rec r left join (select zip, min(neighborhood) as neighborhood from zip_neighborhoods group by zip) z using (zip)")
def zip_lookup(spark, folder):
    zips = table(spark, folder, "zip_neighborhoods").groupBy("zip").agg(F.min("neighborhood").alias("neighborhood"))
    return _rec(spark, folder).select("raw_id", "zip").distinct().join(zips, "zip", "left").select("raw_id", "zip", "neighborhood")


@query("select v.venue_id, coalesce(n, 0) as links from (select distinct venue_id from venue_sources) v left join (select venue_id, count(*) as n from venue_sources where match_method = 'auto' group by venue_id) c using (venue_id)")
def links_per_venue(spark, folder):
    rows = table(spark, folder, "venue_sources")
    counts = rows.filter("match_method = 'auto'").groupBy("venue_id").agg(F.count("*").alias("links"))
    return rows.select("venue_id").distinct().join(counts, "venue_id", "left").withColumn("links", F.coalesce("links", F.lit(0)))


@query("select event_id, k as key, cast(v as bigint) as value from (select event_id, unnest(json_keys(props)) as k, props from events) e, lateral (select e.props->>('$.' || k) as v)")
def json_entries(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return rows.select("event_id", "key", F.col("value").cast("bigint").alias("value"))


@query("select source, count(*) as records, count(distinct zip) as zips, sum(len(name_variants)) as variants, max(fetched_at) as last_fetch from rec group by source")
def source_counts(spark, folder):
    return _rec(spark, folder).groupBy("source").agg(F.count("*").alias("records"), F.count_distinct("zip").alias("zips"), F.sum(F.size("name_variants")).alias("variants"), F.max("fetched_at").alias("last_fetch"))


@query("select model, prompt_version, count(*) as n, round(avg(cast(len(evidence) > 0 as int)), 6) as with_evidence, round(avg(cast(confidence as double)), 6) as confidence from insights group by all")
def rates_by_version(spark, folder):
    return table(spark, folder, "insights").groupBy("model", "prompt_version").agg(F.count("*").alias("n"), F.round(F.avg((F.size("evidence") > 0).cast("int")), 6).alias("with_evidence"), F.round(F.avg(F.col("confidence").cast("double")), 6).alias("confidence"))


@query("select raw_id, cuisine, coalesce(map {'ramen': 'fast_food', 'bakery': 'cafe', 'juice': 'cafe', 'pizza': 'fast_food'}[lower(cuisine)], 'restaurant') as category from (select distinct raw_id, cuisine from rec where cuisine is not null)")
def map_lookup(spark, folder):
    kinds = F.create_map(*[F.lit(x) for pair in {"ramen": "fast_food", "bakery": "cafe", "juice": "cafe", "pizza": "fast_food"}.items() for x in pair])
    return _rec(spark, folder).filter("cuisine is not null").select("raw_id", "cuisine").distinct().withColumn("category", F.coalesce(F.try_element_at(kinds, F.lower("cuisine")), F.lit("restaurant")))


@query("select doc_id, source from documents where length(text) >= 20 and lower(trim(text)) not in ('[deleted]', '[removed]') and (lang is null or lang in ('en', 'es'))")
def engaged_documents(spark, folder):
    """Required, engagement and optional-parameter filters together."""
    langs: list[str] | None = ["en", "es"]
    rows = table(spark, folder, "documents").filter((F.length("text") >= 20) & ~F.lower(F.trim("text")).isin("[deleted]", "[removed]"))
    return (rows if langs is None else rows.filter(F.col("lang").isNull() | F.col("lang").isin(langs))).select("doc_id", "source")


@query("select distinct raw_id, pos, variant from (select raw_id, unnest(name_variants) as variant, unnest(range(1, len(name_variants) + 1)) as pos from rec) qualify row_number() over (partition by raw_id, variant order by pos) = 1")
def first_appearance(spark, folder):
    """Variants without repeats, each at its first position."""
    rows = _rec(spark, folder).select("raw_id", F.posexplode("name_variants").alias("i", "variant"))
    return rows.groupBy("raw_id", "variant").agg((F.min("i") + 1).cast("bigint").alias("pos")).select("raw_id", "pos", "variant")


@query("select event_id, user_id, value from events order by value desc, event_id limit 25 offset 50")
def paged_read(spark, folder):
    return table(spark, folder, "events").select("event_id", "user_id", "value").orderBy(F.col("value").desc(), "event_id").offset(50).limit(25)


@query("select doc_id, n_chars from documents order by n_chars desc nulls last, doc_id limit 50")
def longest_documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "n_chars").orderBy(F.col("n_chars").desc_nulls_last(), "doc_id").limit(50)


@query("select zip from rec where zip is not null union select zip from zip_neighborhoods where zip is not null")
def union_of_zips(spark, folder):
    return _rec(spark, folder).select("zip").filter("zip is not null").unionByName(table(spark, folder, "zip_neighborhoods").select("zip").filter("zip is not null")).distinct()


# ------------------------------------------------------------------------------------------------ writes on snapshots


def _snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The stored documents (all but those of the wiki) and a delivery (all but those of guides, forum texts edited)."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text").dropDuplicates(["doc_id"]).withColumn("content_hash", F.sha2("text", 256))
    new = docs.filter(~F.col("source").startswith("guide/")).withColumn("text", F.when(F.col("source").startswith("forum/"), F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text")))
    return docs.filter(~F.col("source").startswith("wiki/")), new.withColumn("content_hash", F.sha2("text", 256))


_SNAPSHOTS = """
docs as (select distinct on (doc_id) doc_id, source, text from documents),
old as (select doc_id, source, sha256(text) as h from docs where source not like 'wiki/%'),
new as (select doc_id, source, sha256(case when source like 'forum/%' then text || ' (edited)' else text end) as h from docs where source not like 'guide/%')"""


@query(f"with {_SNAPSHOTS} select new.doc_id, case when old.doc_id is null then 'inserted' when old.h is not distinct from new.h then 'unchanged' else 'updated' end as action from new left join old using (doc_id)")
def upsert_actions(spark, folder):
    old, new = _snapshots(spark, folder)
    return upsert.classify(old, new, ["doc_id"]).select("doc_id", "action")


@query(f"with {_SNAPSHOTS} select coalesce(new.doc_id, old.doc_id) as doc_id, case when new.doc_id is null then old.h when old.doc_id is not null and old.h is not distinct from new.h then old.h else new.h end as content_hash from old full join new using (doc_id)")
def conditional_upsert(spark, folder):
    old, new = _snapshots(spark, folder)
    return upsert.conditional_upsert(old, new, ["doc_id"]).select("doc_id", "content_hash")


@query(f"with {_SNAPSHOTS} select doc_id, h as content_hash from old union all select doc_id, h from new where doc_id not in (select doc_id from old)")
def insert_if_absent(spark, folder):
    old, new = _snapshots(spark, folder)
    return upsert.insert_absent(old, new, ["doc_id"]).select("doc_id", "content_hash")


@query(f"with {_SNAPSHOTS} select doc_id, null as retired_at from new union all select doc_id, timestamp '2026-01-01' from old where doc_id not in (select doc_id from new)")
def retire_absent(spark, folder):
    old, new = _snapshots(spark, folder)
    old = old.withColumn("retired_at", F.lit(None).cast("timestamp_ntz"))
    return upsert.retire_absent(old, new, ["doc_id"], F.lit("2026-01-01").cast("timestamp_ntz")).select("doc_id", "retired_at")


@query(
    "with r as (select distinct on (raw_id) raw_id, name_variants as v from rec where source = 'osm'), o as (select raw_id, list_distinct(v) as v from r where raw_id % 2 = 0 or raw_id % 3 = 0), n as (select raw_id, list_distinct(list_append(v, 'new')) as v from r where raw_id % 2 = 1 or raw_id % 3 = 0) "
    "select raw_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(o.v, []), coalesce(n.v, [])))), '|') as variants from o full join n using (raw_id)"
)
def union_upsert(spark, folder):
    """Arrays of both sides united; even ids stand for the stored rows, odd ones for the delivery, multiples of three are in both."""
    rows = _rec(spark, folder).filter("source = 'osm'").select("raw_id", F.col("name_variants").alias("variants")).dropDuplicates(["raw_id"])
    old = rows.filter("raw_id % 2 = 0 or raw_id % 3 = 0")
    new = rows.filter("raw_id % 2 = 1 or raw_id % 3 = 0").withColumn("variants", F.concat("variants", F.array(F.lit("new"))))
    return upsert.union_upsert(old, new, ["raw_id"], ["variants"]).select("raw_id", F.array_join("variants", "|").alias("variants"))


@query("select insight_id, reviewer, id, verdict from extraction_reviews where insight_id is not null and reviewer is not null qualify row_number() over (partition by insight_id, reviewer order by id desc) = 1")
def keyed_upsert(spark, folder):
    """Last write wins by key: the submissions up to the middle of the period, then the later ones."""
    rows = table(spark, folder, "extraction_reviews").filter("insight_id is not null and reviewer is not null").select("insight_id", "reviewer", "id", "verdict", "reviewed_at").distinct()
    middle = F.lit("2026-05-01").cast("timestamp_ntz")
    late = F.col("reviewed_at") >= middle
    return upsert.keyed_upsert(rows.filter(~late | F.col("reviewed_at").isNull()), rows.filter(late), ["insight_id", "reviewer"], F.col("id")).select("insight_id", "reviewer", "id", "verdict")


@query(
    "select event_id from events where not (case event_type when 'click' then ts < timestamp '2024-02-01' - interval 7 day when 'view' then ts < timestamp '2024-02-01' - interval 14 day else false end)"
)
def expired_units(spark, folder):
    """Markers younger than their source's days; event types stand for sources."""
    progress = table(spark, folder, "events").select("event_id", F.concat_ws(":", "event_type", F.col("event_id").cast("string")).alias("unit_key"), F.col("ts").alias("done_at"))
    return ledger.expire(progress, F.lit("2024-02-01").cast("timestamp_ntz"), {"click": 7, "view": 14}).select("event_id")


@query("select d.doc_id as id from (select distinct doc_id from documents) d left join (select distinct raw_review_id from insights where model = 'local:mini-3b' and prompt_version = 'v3') i on i.raw_review_id = d.doc_id where i.raw_review_id is null or d.doc_id % 3 = 0")
def extraction_work(spark, folder):
    """Texts without a result of one model and version, and those that have changed since: every third has."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"]).withColumn("content_hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    then = docs.select(F.col("id").alias("raw_review_id"), F.when(F.col("id") % 3 == 0, F.sha2(F.lit("as it was"), 256)).otherwise(F.col("content_hash")).alias("content_hash"))
    insights = table(spark, folder, "insights").join(then, "raw_review_id").dropDuplicates(["raw_review_id", "model", "prompt_version"])
    return extraction.work_list(docs, insights, "local:mini-3b", "v3").select("id")


_Q = "lower(trim(regexp_replace(translate({0}, '“”‘’', '\"\"'''''), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')))"


@query(
    f"""with t as (select doc_id, {_Q.format("coalesce(text, '')")} as t from documents),
e as (select id, unnest(evidence) as e, raw_review_id from insights),
s as (select e.id, list(distinct e.e.field) as fields from e join t on t.doc_id = e.raw_review_id where {_Q.format("e.e.quote")} <> '' and contains(t.t, {_Q.format("e.e.quote")}) group by e.id),
v as (select e.id, bool_and(coalesce({_Q.format("e.e.quote")} <> '' and contains(t.t, {_Q.format("e.e.quote")}), false)) as ok from e join t on t.doc_id = e.raw_review_id group by e.id),
x as (select i.id, i.raw_review_id, coalesce(s.fields, []) as f, coalesce(v.ok, true) as ok, i.* exclude (id, raw_review_id) from insights i join documents d on d.doc_id = i.raw_review_id left join s on s.id = i.id left join v on v.id = i.id)
select id, ok as evidence_verbatim, array_to_string(list_filter([case when len(vibe_tags) > 0 and not list_contains(f, 'vibe_tags') then 'vibe_tags' end, case when coalesce(noise_level, '') <> '' and not list_contains(f, 'noise_level') then 'noise_level' end,
  case when coalesce(crowd_level, '') <> '' and not list_contains(f, 'crowd_level') then 'crowd_level' end, case when coalesce(best_time, '') <> '' and not list_contains(f, 'best_time') then 'best_time' end,
  case when len(recurring_events) > 0 and not list_contains(f, 'recurring_events') then 'recurring_events' end, case when len(good_for) > 0 and not list_contains(f, 'good_for') then 'good_for' end], lambda z: z is not null), '|') as dropped_fields from x"""
)
def grounded_insights(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("raw_review_id"), "text")
    out = extraction.ground(table(spark, folder, "insights").join(docs, "raw_review_id"))
    return out.select("id", "evidence_verbatim", _joined("dropped_fields"))


@query()
def extracted_tags(spark, folder):
    """The rule-based provider over all texts, grounded."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    out = extraction.ground(extraction.extract(docs).join(docs, "id"))
    return out.select("id", _joined("vibe_tags"), "noise_level", _joined("dropped_fields"))
