"""Queries of the general problems: points near points or regions, several values packed in one field."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venueweave.operators.multivalue import split_values
from venueweave.operators.spatial import inside_regions, near_pairs
from venueweave.sources.tables import table

NEAR_M = 30.0


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """kind, raw_id, other: record pairs at most 30 m apart, and the regions that hold each record."""
    rec = table(spark, folder, "rec")
    near = near_pairs(rec, NEAR_M).select(F.lit("near").alias("kind"), F.col("id_a").alias("raw_id"), F.col("id_b").cast("string").alias("other"))
    inside = inside_regions(rec, table(spark, folder, "boundaries"))
    return near.unionByName(inside.select(F.lit("inside").alias("kind"), F.col("id").alias("raw_id"), F.col("region").alias("other")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """raw_id, pos, value of every record whose name holds two values or more."""
    values = split_values(table(spark, folder, "rec"))
    return values.filter("n_values > 1").select(F.col("key").alias("raw_id"), "pos", "value")


QUERIES = {"p2_found": p2_found, "p5_found": p5_found}

ORACLES = {
    "p2_found": """
with p as (
  select distinct raw_id, lat, lon from rec
  where lat is not null and lon is not null and not isnan(lat) and not isnan(lon) and lat <> 0 and lon <> 0 and abs(lat) <= 90 and abs(lon) <= 180),
c as (select *, floor(lat / 0.0003) as i, floor(lon / 0.0005) as j from p),
pairs as (
  select a.raw_id, b.raw_id as other
  from c a
  join (select c.*, i + di as bi, j + dj as bj from c, (values (-1), (0), (1)) x(di), (values (-1), (0), (1)) y(dj)) b on a.i = b.bi and a.j = b.bj
  where a.raw_id < b.raw_id
    and 2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) <= 30),
g as (
  select distinct name, geojson from boundaries where name is not null and geojson is not null),
polygon as (
  select name, unnest(case when geojson->>'$.type' = 'Polygon' then [geojson->'$.coordinates'] else from_json(geojson->'$.coordinates', '["JSON"]') end) as rings, row_number() over () as k from g),
ring as (select name, k, row_number() over () as r, ring from (select name, k, unnest(from_json(rings, '[[["DOUBLE"]]]')) as ring from (select name, rings, row_number() over () as k from polygon))),
edge as (
  select name, k, ring[i][1] as x1, ring[i][2] as y1, ring[case when i = len(ring) then 1 else i + 1 end][1] as x2, ring[case when i = len(ring) then 1 else i + 1 end][2] as y2
  from (select name, k, ring, unnest(range(1, len(ring) + 1)) as i from ring)),
box as (select name, k, min(x1) as x0, max(x1) as x9, min(y1) as y0, max(y1) as y9 from edge group by all),
inside as (
  select distinct raw_id, name
  from (
    select p.raw_id, e.name, e.k, count(*) as n
    from p join box b on p.lon between b.x0 and b.x9 and p.lat between b.y0 and b.y9
    join edge e on e.k = b.k and e.name = b.name and (e.y1 > p.lat) <> (e.y2 > p.lat) and p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
    group by all)
  where n % 2 = 1)
select 'near' as kind, raw_id, cast(other as varchar) as other from pairs
union all select 'inside', raw_id, name from inside
""",
}
