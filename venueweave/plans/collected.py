"""Queries of sources and parsers. Their inputs are files as a collector would leave them, made of whole tables row by row,
so that the SQL can say from the tables what must come out."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venueweave.plans.reference import _NORM_HOUSE, _NORM_NAME, _NORM_PHONE, _NORM_STREET, _NORM_ZIP, _TITLE
from venueweave.sources import feeds, parsers
from venueweave.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__], ORACLES[function.__name__] = function, sql
        return function

    return register


_BLANK = "[ \\t\\n\\r\\f\\x0B]"
_STRIP = f"regexp_replace({{0}}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"
_DOCS = "d as (select distinct on (doc_id) * from documents where doc_id is not null)"


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("doc_id is not null").dropDuplicates(["doc_id"])


def _document():
    """A rich-text document of a text: a paragraph for each line."""
    line = lambda x: F.struct(F.lit("paragraph").alias("nodeType"), F.array(F.struct(F.lit("text").alias("nodeType"), x.alias("value"))).alias("content"))
    return F.struct(F.lit("document").alias("nodeType"), F.transform(F.split("text", "\n"), line).alias("content"))


def _pages(docs: DataFrame) -> DataFrame:
    """A page (url, html) for each document: a state of a review, what it points to, and another review."""
    ref = lambda kind: F.struct(F.concat(F.lit(f"{kind}:"), F.col("doc_id").cast("string")).alias("__ref"))
    items = lambda *xs: F.struct(F.array(*xs).alias("items"))
    review = F.struct(
        F.lit(parsers.REVIEW_TYPE).alias("__typename"),
        ref("Slug").alias("slug"),
        ref("Venue").alias("venue"),
        "title",
        F.col("title").alias("preview"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm").alias("publishDate"),
        F.struct(_document().alias("json")).alias("content"),
        items(ref("Tag")).alias(f"{parsers.CUISINES}:1"),
        items(F.struct(F.col("source").alias("displayName"))).alias(parsers.HOODS),
        items(F.struct(F.lit("/x/other").alias("path")), F.struct(F.concat(F.lit(f"/x{parsers.OCCASION}"), "source").alias("path"))).alias(parsers.SECTIONS),
    )
    venue = F.struct(F.concat(F.lit("Venue "), F.col("doc_id").cast("string")).alias("name"), F.struct((F.col("doc_id") % 90 / 2).alias("lat"), (-F.col("doc_id") % 180 / 2).alias("lon")).alias("latlong"), F.length("text").alias("price"))
    other = F.lit(f'"R:0":{{"__typename":"{parsers.REVIEW_TYPE}","slug":{{"name":"other"}},"title":"Another"}}')
    objects = {"R": review, "Venue": venue, "Slug": F.struct(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name")), "Tag": F.struct(F.col("lang").alias("name"))}
    state = F.concat_ws(",", other, *[F.concat(F.lit(f'"{kind}:'), F.col("doc_id").cast("string"), F.lit('":'), F.to_json(o)) for kind, o in objects.items()])
    html = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"initialApolloState":{'), F.replace(state, F.lit("</"), F.lit("<\\/")), F.lit("}}}}</script></html>"))
    return docs.select("doc_id", F.concat(F.lit("https://x.example/reviews/doc-"), F.col("doc_id").cast("string"), F.lit("/")).alias("url"), html.alias("html"))


@query(
    f"""with {_DOCS}, t as (select *, {_STRIP.format("coalesce(text, '')")} as body, {_STRIP.format("coalesce(title, '')")} as preview from d)
select 'doc-' || doc_id as source_id, 'Venue ' || doc_id as venue_name, doc_id % 90 / 2.0 as lat, -(doc_id % 180) / 2.0 as lon, source as neighborhood, array_to_string(list_filter([lang, 'perfect-for:' || split_part(source, '/', -1)], lambda x: coalesce(x, '') <> ''), '|') as tags,
  cast(length(text) as varchar) as price, cast(published_at as varchar) as published_at, title, case when starts_with(body, left(preview, 40)) then body else {_STRIP.format("preview || chr(10) || chr(10) || body")} end as text from t"""
)
def html_pages(spark, folder):
    out = parsers.pages(_pages(_docs(spark, folder)))
    return out.select("source_id", "venue_name", "lat", "lon", "neighborhood", F.array_join("tags", "|").alias("tags"), "price", "published_at", "title", "text")


@query(f"with {_DOCS} select doc_id, text from d where text is not null")
def rich_text(spark, folder):
    docs = _docs(spark, folder).select("doc_id", F.to_json(_document()).alias("document"))
    return parsers.rich_texts(docs, "doc_id").select(F.col("key").alias("doc_id"), "text")


@query(f"with {_DOCS} select 'https://x.example/reviews/doc-' || doc_id || '/' as url, case when doc_id % 5 = 0 then 'missing' when doc_id % 7 = 0 then 'failed' when doc_id % 11 = 0 then 'unreadable' else 'read' end as status from d where doc_id % 3 <> 0 order by url limit 500")
def page_collector(spark, folder):
    """The status of the first 500 pages without a marker: every third page has one, some are gone, some hold no review."""
    pages = _pages(_docs(spark, folder)).withColumn("code", F.when(F.col("doc_id") % 5 == 0, 404).when(F.col("doc_id") % 7 == 0, 503).otherwise(200))
    pages = pages.withColumn("html", F.when((F.col("doc_id") % 11 == 0) & (F.col("code") == 200), "<html></html>").otherwise(F.col("html")))
    return parsers.page_status(pages, pages.filter("doc_id % 3 = 0").select("url"), most=500)


def _listings(spark: SparkSession, folder: str) -> DataFrame:
    """A comment listing for each order: every line of it replies to the one before; behind returned ones replies are missing."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag").dropDuplicates(["l_orderkey", "l_linenumber"])
    rows = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct((-F.col("l_linenumber")).alias("m"), F.col("l_linenumber").alias("n"), F.col("l_linestatus").alias("s"), F.col("l_returnflag").alias("f")))).alias("lines"))
    more = F.lit(',{"kind":"more","data":{"count":2,"children":["x","y"]}}')
    one = lambda a, x: F.concat(F.lit('{"data":{"children":[{"kind":"t1","data":{"id":"'), x["n"].cast("string"), F.lit('","body":"'), x["s"], F.lit('","replies":'), a, F.lit("}}"), F.when(x["f"] == "R", more).otherwise(""), F.lit("]}}"))
    return rows.select(F.col("l_orderkey").alias("post_id"), F.concat(F.lit("[{},"), F.aggregate("lines", F.lit('""'), one), F.lit("]")).alias("payload"))


_LINES = "l as (select l_orderkey as post, l_linenumber, l_linestatus, l_returnflag, cast(row_number() over (partition by l_orderkey order by l_linenumber) - 1 as int) as depth from (select distinct on (l_orderkey, l_linenumber) * from lineitem))"


@query(f"with {_LINES} select post, depth as position, cast(l_linenumber as varchar) as id, depth, l_linestatus as body, 0 as unloaded from l union all select post, null, null, depth, null, 2 from l where l_returnflag = 'R'")
def thread_flatten(spark, folder):
    return parsers.comments(_listings(spark, folder)).select("post", "position", "id", "depth", "body", "unloaded")


def _members(spark: SparkSession, folder: str) -> DataFrame:
    """Types of parts as categories, their brands as subcategories with the parts; sizes and part numbers below the brands."""
    part = table(spark, folder, "part").withColumns({"size": F.concat(F.lit("size "), F.col("p_size").cast("string")), "number": F.col("p_partkey").cast("string")})
    link = lambda a, b, c: part.select(F.col(a).alias("category"), F.col(b).alias("title"), F.lit(c).alias("is_category")).distinct()
    return reduce(DataFrame.unionByName, [link("p_type", "p_brand", True), link("p_brand", "p_name", False), link("p_brand", "size", True), link("size", "number", False), link("p_type", "size", False)])


_ROOTS = "roots as (select min(p_type) as a, max(p_type) as z, median(p_size) as m from part)"


def _roots(spark: SparkSession, folder: str) -> list[str]:
    return list(table(spark, folder, "part").agg(F.min("p_type"), F.max("p_type")).first())


@query(f"with {_ROOTS} select distinct title from (select p_name as title from part where p_brand in (select p_brand from part, roots where p_type = a) union all select 'size ' || p_size from part, roots where p_type = a)")
def category_members(spark, folder):
    return parsers.category_members(_members(spark, folder), _roots(spark, folder)[0])


@query(f"with {_ROOTS} select distinct 'wikipedia:' || z as unit_key, title from (select z, p_name as title from part, roots where p_brand in (select p_brand from part, roots where p_type = z) union all select z, 'size ' || p_size from part, roots where p_type = z)")
def category_collector(spark, folder):
    """Two categories, of which one is done."""
    first, last = _roots(spark, folder)
    done = spark.createDataFrame([(f"wikipedia:{first}",)], "unit_key string")
    return parsers.collected_categories(_members(spark, folder), [first, last], done)


@query("select 'reddit:' || event_type || ':k' || (user_id % 3) as unit_key, 't' || event_id as id, event_id % 12 as num_comments, ts as created from events where event_type in ('click', 'view') and user_id % 3 in (0, 1) and not (event_type = 'view' and user_id % 3 = 1) and event_id % 12 >= 5 and event_id % 10 <> 0")
def post_search(spark, folder):
    """Posts of search files with enough comments, but for the units done; events stand for posts."""
    body = F.when(F.col("event_id") % 10 == 0, "[removed]").otherwise("text")
    post = F.struct(F.lit("t3").alias("kind"), F.struct(F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("id"), body.alias("selftext"), (F.col("event_id") % 12).alias("num_comments"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("created_utc")).alias("data"))
    files = table(spark, folder, "events").select(F.col("event_type").alias("subreddit"), F.concat(F.lit("k"), (F.col("user_id") % 3).cast("string")).alias("keyword"), F.to_json(F.struct(F.struct(F.array(post).alias("children")).alias("data"))).alias("payload"))
    done = spark.createDataFrame([("reddit:view:k1",)], "unit_key string")
    found = parsers.engaged(parsers.search_posts(files, ["click", "view"], ["k0", "k1"], done))
    return found.select("unit_key", "id", F.col("num_comments").cast("bigint").alias("num_comments"), F.col("created").cast("timestamp_ntz").alias("created"))


@query(f"with {_DOCS} select distinct 'https://x.example/' || source || '/' || (doc_id // 2) as url from d where source is not null order by url")
def sitemap_links(spark, folder):
    entry = F.concat(F.lit("<url><loc> https://x.example/"), "source", F.lit("/"), F.floor(F.col("doc_id") / 2).cast("string"), F.lit(" </loc></url>"))
    files = _docs(spark, folder).filter("source is not null").groupBy((F.col("doc_id") % 50).alias("file")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(entry), "\n"), F.lit("</urlset>")).alias("xml"))
    return parsers.sitemap_urls(files)


_PLAIN = "translate(coalesce({0}, ''), '{{}}|=[]', '')"


@query(
    f"""with {_DOCS}, t as (select doc_id, {_PLAIN.format("title")} as name, trim({_PLAIN.format("text")}) as content, doc_id % 4 as kind from d)
select 'page ' || doc_id as page, case kind when 0 then 'eat' else 'drink' end as kind, trim(name) as name, 'A place ' || content || ' here' as content, case when doc_id % 90 <> 0 then doc_id % 90 / 2.0 end as lat, cast(null as double) as lon from t where kind in (0, 1, 2) and trim(name) <> '' and length('A place ' || content || ' here') >= 30"""
)
def wiki_listings(spark, folder):
    """Listings of eating and drinking places; the kind stands in the template's name or in its type field."""
    plain = lambda c: F.translate(F.coalesce(c, F.lit("")), "{}|=[]", "")
    head = F.element_at(F.array(F.lit("eat"), F.lit("Drink"), F.lit("listing|type=drink"), F.lit("listing|type=see")), (F.col("doc_id") % 4 + 1).cast("int"))
    body = F.concat(F.lit("{{"), head, F.lit("|name="), plain("title"), F.lit("|lat="), (F.col("doc_id") % 90 / 2).cast("string"), F.lit("|long=west|content=A [[spot|place]] "), F.trim(plain("text")), F.lit(" [[here]]}}"))
    pages = _docs(spark, folder).select(F.concat(F.lit("page "), F.col("doc_id").cast("string")).alias("page"), body.alias("wikitext"))
    return parsers.listings(pages).select("page", "kind", "name", "content", "lat", "lon")


@query(f"with {_DOCS} select doc_id, regexp_replace(title, '\\s*\\([^()]*\\)$', '') as plain_title, regexp_extract(text, '\\b1\\d{{4}}\\b') as first_zip, case when text is not null then doc_id % 90 / 2.0 end as article_lat, case when text is not null then -(doc_id % 180) / 2.0 end as article_lon from d")
def article_fields(spark, folder):
    """Title, first zip and coordinates of articles."""
    coordinates = F.concat(F.lit(" {{Coord|"), (F.col("doc_id") % 90 / 2).cast("string"), F.lit("| "), (-F.col("doc_id") % 180 / 2).cast("string"), F.lit("|display=title}}"))
    return parsers.articles(_docs(spark, folder).withColumn("text", F.concat("text", coordinates))).select("doc_id", "plain_title", "first_zip", "article_lat", "article_lon")


@query(
    "select id, insight_id, regexp_extract(lower(trim(verdict)), '^\\w*') as verdict, coalesce(array_to_string(list_sort(list_transform(list_filter(map_entries(field_verdicts), lambda e: regexp_full_match(e.key, '[a-z_]+') and regexp_full_match(e.value, '[a-z]+')), lambda e: e.key || '=' || e.value)), '|'), '') as fields "
    "from (select distinct on (id) * from extraction_reviews) where insight_id is not null and regexp_extract(lower(trim(verdict)), '^\\w*') in ('correct', 'partial', 'wrong')"
)
def ingested_verdicts(spark, folder):
    """Review files, one for each submission, read back."""
    rows = table(spark, folder, "extraction_reviews").dropDuplicates(["id"])
    sound = F.filter(F.map_entries("field_verdicts"), lambda e: e["key"].rlike("^[a-z_]+$") & e["value"].rlike("^[a-z]+$"))
    fields = F.array_join(F.transform(F.coalesce(sound, F.array().cast("array<struct<key: string, value: string>>")), lambda e: F.concat_ws("=", e["key"], e["value"])), " ")
    files = rows.select(F.concat(F.lit("# batch\n### insight "), F.col("insight_id").cast("string"), F.lit("\n\n> text\n\nverdict: "), F.coalesce("verdict", F.lit("")), F.lit("\nfields: "), fields, F.lit("\nnotes: "), F.col("id").cast("string"), F.lit("\n")).alias("value"))
    found = parsers.verdict_blocks(files)
    return found.select(F.col("notes").cast("bigint").alias("id"), "insight_id", "verdict", F.array_join(F.array_sort(F.transform(F.map_entries("field_verdicts"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "|").alias("fields"))


_FEED = f"case when lat <> 0 and not isnan(lat) then lat end as lat, case when lon <> 0 and not isnan(lon) then lon end as lon, street, {_NORM_STREET} as street_norm, {_NORM_HOUSE} as housenumber, {_NORM_ZIP} as zip, {_NORM_PHONE} as phone"
_MAP = f"select source, source_id, name, {_NORM_NAME} as name_norm, {_FEED}, website, cuisine, case when category in ('restaurant', 'cafe', 'bar', 'pub', 'fast_food', 'ice_cream', 'food_court') then category else 'other' end as category, cast(null as varchar) as last_inspection from (select distinct on (raw_id) * from rec) where source = 'osm' and name is not null and name <> ''"
_INSPECTED = f"""select source, source_id, name, {_NORM_NAME} as name_norm, {_FEED}, cast(null as varchar) as website, cuisine, category, last_inspection from (
  select 'dohmh' as source, source_id, {_TITLE.format('name')} as name, street, housenumber, zip, phone, lat, lon, cuisine,
    coalesce(map {{'Bottled Beverages': 'other', 'Coffee/Tea': 'cafe', 'Juice, Smoothies, Fruit Salads': 'cafe', 'Bakery Products/Desserts': 'cafe', 'Donuts': 'cafe', 'Frozen Desserts': 'cafe', 'Hamburgers': 'fast_food', 'Sandwiches': 'fast_food', 'Hotdogs': 'fast_food', 'Pizza': 'fast_food', 'Chicken': 'fast_food'}}[cuisine], 'restaurant') as category,
    case when left(max(d), 10) > '1901' then left(max(d), 10) end as last_inspection
  from (select *, unnest(['1900-01-01T00:00:00', strftime(first_seen, '%Y-%m-%dT%H:%M:%S')]) as d from (select distinct on (raw_id) * from rec) where source = 'dohmh' and name is not null and name <> '')
  group by all)"""


def _map_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "rec").dropDuplicates(["raw_id"]).filter("source = 'osm'")
    # a way has a centre instead of a place of its own
    node = F.col("source_id").startswith("node")
    tags = {"name": "name", "amenity": "category", "addr:housenumber": "housenumber", "addr:street": "street", "addr:postcode": "zip", "contact:phone": "phone", "website": "website", "cuisine": "cuisine"}
    stated = F.map_filter(F.create_map(*[x for tag, c in tags.items() for x in (F.lit(tag), F.col(c))]), lambda _, v: v.isNotNull())
    where = {c: F.when(node, F.col(c)).alias(c) for c in ("lat", "lon")}
    centre = F.when(~node, F.struct("lat", "lon")).alias("center")
    return rows.select(F.split_part("source_id", F.lit("/"), F.lit(1)).alias("osm_type"), F.split_part("source_id", F.lit("/"), F.lit(2)).alias("osm_id"), *where.values(), centre, stated.alias("tags"))


def _inspection_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "rec").dropDuplicates(["raw_id"]).filter("source = 'dohmh'")
    dates = F.explode(F.array(F.lit("1900-01-01T00:00:00"), F.date_format("first_seen", "yyyy-MM-dd'T'HH:mm:ss"))).alias("inspection_date")
    text = {c: F.col(of).cast("string").alias(c) for c, of in (("camis", "source_id"), ("dba", "name"), ("building", "housenumber"), ("street", "street"), ("zipcode", "zip"), ("phone", "phone"), ("cuisine_description", "cuisine"), ("latitude", "lat"), ("longitude", "lon"))}
    return rows.select(*text.values(), F.lit("Manhattan").alias("boro"), dates)


@query(_MAP)
def map_records(spark, folder):
    """The map feed from objects with tags."""
    return feeds.osm_entities(_map_rows(spark, folder)).drop("geohash")


@query(_INSPECTED)
def inspection_records(spark, folder):
    """The inspection feed from rows of single inspections, every column."""
    return feeds.inspection_entities(_inspection_rows(spark, folder)).drop("geohash")


@query(f"select source, source_id, name_norm, category, zip from ({_MAP}) union all select source, source_id, name_norm, category, zip from ({_INSPECTED})")
def both_feeds(spark, folder):
    """Both feeds in one table."""
    both = feeds.osm_entities(_map_rows(spark, folder)).unionByName(feeds.inspection_entities(_inspection_rows(spark, folder)))
    return both.select("source", "source_id", "name_norm", "category", "zip")
