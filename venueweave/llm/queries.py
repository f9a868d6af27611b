"""Queries of the problems tagged llm, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venueweave.llm import addresses, consensus, groups, leakage, matching, packing, repetition, survivors
from venueweave.llm.repetition import STOP_WORDS
from venueweave.sources.tables import table
from venueweave.storage import Stash


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """raw_id_a, raw_id_b: pairs of one osm and one dohmh record of the same venue."""
    rec = table(spark, folder, "rec").filter(F.col("source").isin("osm", "dohmh"))
    return matching.match_records(rec).select("raw_id_a", "raw_id_b")


def p1_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with the confidence of each."""
    rec = table(spark, folder, "rec").filter(F.col("source").isin("osm", "dohmh"))
    return matching.match_records(rec).withColumn("confidence", F.round("confidence", 4))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """raw_id, group_id over the pairs decided ``matched`` whose ends are both in ``rec``."""
    pairs = table(spark, folder, "match_candidates").filter("decision = 'matched'")
    found = groups.consolidate(pairs, "left_raw_id", "right_raw_id", table(spark, folder, "rec").select("raw_id"))
    return found.select(F.col("id").alias("raw_id"), "group_id")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """insight_id, field, verdict where at least three reviewers judged."""
    votes = consensus.review_votes(table(spark, folder, "extraction_reviews"))
    best, _ = consensus.discover_truth(votes, ["insight_id", "field"])
    return best.filter("votes >= 3").select("insight_id", "field", F.col("label").alias("verdict"))


def p4_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """Consensus, number of votes and weighted agreement of every insight and field."""
    best, _ = consensus.discover_truth(consensus.review_votes(table(spark, folder, "extraction_reviews")), ["insight_id", "field"])
    return best.withColumn("agreement", F.round("agreement", 6))


def p4_reviewers(spark: SparkSession, folder: str) -> DataFrame:
    """Reliability of each reviewer: labels given, weight, error rate against the consensus."""
    _, each = consensus.discover_truth(consensus.review_votes(table(spark, folder, "extraction_reviews")), ["insight_id", "field"])
    return each.select(F.col("annotator").alias("reviewer"), "n", F.round("weight", 6).alias("weight"), F.round("error", 6).alias("error"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """raw_id_a, raw_id_b: every pair of records whose addresses denote the same building."""
    return addresses.same_building_pairs(table(spark, folder, "rec"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """venue_id, field, value: the latest real value of each attribute of each group."""
    rows = survivors.members(table(spark, folder, "rec"), table(spark, folder, "venue_sources"))
    return survivors.best_values(rows, "venue_id", survivors.rec_fields(), F.col("fetched_at"), F.col("raw_id"))


def p7_best_record(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving record of each group: most complete, then best scored, then latest."""
    rows = survivors.members(table(spark, folder, "rec"), table(spark, folder, "venue_sources"))
    best = survivors.best_record(rows, "venue_id", survivors.rec_fields(), F.col("score"), F.col("fetched_at"), F.col("raw_id"))
    return best.select("venue_id", "raw_id", "completeness")


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    """container_id, doc_id, piece, tokens, sequence: all documents packed into each kind of container."""
    return packing.packed_containers(table(spark, folder, "documents"), table(spark, folder, "containers"))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences, tokens and share of the room filled, by kind of container."""
    used = p8_packed(spark, folder).groupBy("container_id", "sequence").agg(F.sum("tokens").alias("tokens"))
    each = used.groupBy("container_id").agg(F.count("*").alias("sequences"), F.sum("tokens").alias("tokens"))
    return each.join(table(spark, folder, "containers"), "container_id").withColumn("filled", F.round(F.col("tokens") / (F.col("sequences") * F.col("capacity_tokens")), 6))


def p8_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What every packing must keep, by kind of container: rows packed, sequences over the capacity, documents whose pieces
    don't hold their tokens, pieces that aren't full though not the last, documents split without need."""
    docs = table(spark, folder, "documents").dropDuplicates(["doc_id"]).filter("doc_id is not null")
    kinds = table(spark, folder, "containers").filter("container_id is not null and capacity_tokens > 0").distinct()
    counts = packing.token_counts(docs).withColumnsRenamed({"key": "doc_id", "tokens": "all"})
    rows = Stash(packing.packed_containers(docs, kinds).join(kinds, "container_id"), "packed").df
    over = rows.groupBy("container_id", "sequence").agg((F.sum("tokens") > F.max("capacity_tokens")).cast("int").alias("over")).groupBy("container_id").agg(F.sum("over").alias("overfull"))
    size = F.col("capacity_tokens")
    each = rows.groupBy("container_id", "doc_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"), F.count_if(F.col("tokens") == size).alias("full"), F.max(size).alias("capacity"))
    each = each.join(counts, "doc_id").groupBy("container_id").agg(
        F.count("*").alias("documents"), F.count_if(F.col("tokens") != F.col("all")).alias("lost"), F.count_if(F.col("full") < F.col("pieces") - 1).alias("unfilled"), F.count_if((F.col("pieces") > 1) & (F.col("all") <= F.col("capacity"))).alias("split")
    )
    return each.join(over, "container_id")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, item_id: documents that hold at least a third of an item's report in passages of ten words or more."""
    found = leakage.leaked(table(spark, folder, "documents"), table(spark, folder, "eval_items"))
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the words and the share of the report found."""
    found = leakage.leaked(table(spark, folder, "documents"), table(spark, folder, "eval_items"))
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "words", F.round("share", 6).alias("share"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id of the documents three tenths of whose words repeat an earlier run of five words or more."""
    return repetition.breaking(table(spark, folder, "documents"), "repeated_word_ratio").select("doc_id").distinct()


def p10_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Every measure of every document, and the rules it breaks."""
    profile = repetition.quality_profile(table(spark, folder, "documents"))
    return profile.withColumns({c: F.round(c, 6) for c, kind in profile.dtypes if kind == "double"}).withColumn("failed", F.array_join("failed", "|"))


QUERIES = {f.__name__: f for f in (p1_found, p1_matches, p3_found, p4_found, p4_consensus, p4_reviewers, p6_found, p7_found, p7_best_record, p8_packed, p8_fill, p8_invariants, p9_found, p9_shares, p10_found, p10_profile)}

_MEMBERS = """
fillers(x) as (select unnest(['', '-', '--', '?', 'n/a', 'na', 'none', 'null', 'nil', 'tbd', 'tba', 'unknown', 'not listed', 'unlisted', 'coming soon', 'pending', 'yes', 'no', 'other', 'x', '.'])),
links as (
  select venue_id, raw_venue_id as raw_id, max(case when not isnan(match_score) then match_score end) as score
  from venue_sources where venue_id is not null and raw_venue_id is not null group by all),
m as (
  select l.venue_id, l.raw_id, l.score, r.fetched_at, website, last_inspection, cuisine,
    lower(trim(regexp_replace(phone, '\\s+', ' ', 'g'))) as ph, lower(trim(regexp_replace(website, '\\s+', ' ', 'g'))) as w, trim(last_inspection) as li
  from links l join rec r using (raw_id)),
n as (
  select *, regexp_replace(regexp_replace(ph, '(x|ext\\.?|extension|#)\\s*\\d+\\s*$', ''), '\\D', '', 'g') as d,
    regexp_replace(ph, '(x|ext\\.?|extension|#)\\s*\\d+\\s*$', '') as body,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(w, '^[a-z][a-z0-9+.-]*://', ''), '[/?#].*$', ''), ':\\d+$', ''), '^www\\.', ''), '\\.+$', '') as h,
    coalesce(
      case when regexp_full_match(li, '\\d{4}-\\d{2}-\\d{2}([T ].*)?') then try_cast(left(li, 10) as date) end,
      case when regexp_full_match(li, '\\d{8}') then try_cast(left(li, 4) || '-' || substr(li, 5, 2) || '-' || substr(li, 7, 2) as date) end,
      case when regexp_full_match(li, '\\d{1,2}/\\d{1,2}/\\d{4}') then cast(try_strptime(li, '%m/%d/%Y') as date) end,
      case when regexp_full_match(li, '\\d{1,2} [A-Za-z]{3} \\d{4}') then cast(try_strptime(li, '%d %b %Y') as date) end) as dt,
    lower(trim(regexp_replace(cuisine, '[\\s_]+', ' ', 'g'))) as c
  from m),
v as (
  select venue_id, raw_id, score, fetched_at,
    case when not regexp_matches(body, '[a-z]') and regexp_full_match(t, '[2-9]\\d{9}') and len(list_distinct(string_split(t, ''))) > 1 then t end as phone,
    case when w not like '%@%' and regexp_full_match(h, '[a-z0-9]([a-z0-9-]*[a-z0-9])?(\\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)*\\.[a-z][a-z0-9-]*') then h end as website,
    case when dt between date '1990-01-01' and date '2026-08-31' then cast(dt as varchar) end as last_inspection,
    case when c not in (select x from fillers) and regexp_matches(c, '[a-z]') then c end as cuisine
  from (select *, case when length(d) = 11 and d like '1%' then substr(d, 2) else d end as t from n))
"""

_STOPS = ", ".join("list_filter(ls, lambda x: x in (" + ", ".join(f"'{w}'" for w in ws) + "))" for ws in STOP_WORDS.values())
_REPEATS = """
g as (select row, unnest(range(1, len(ws) - 3)) as i, ws from w where len(ws) > 5),
h as (select row, i, ws[i:i + 4] as gram from g),
r as (select row, i from h qualify row_number() over (partition by row, gram order by i) > 1),
c as (select row, sum(least(5, coalesce(following - i, 5))) as n from (select row, i, lead(i) over (partition by row order by i) as following from r) group by row)
"""

ORACLES = {
    "p3_found": """
with recursive ids as (select distinct raw_id from rec where raw_id is not null),
e0 as (
  select distinct left_raw_id as a, right_raw_id as b from match_candidates
  where decision = 'matched' and left_raw_id <> right_raw_id and left_raw_id in (from ids) and right_raw_id in (from ids)),
e as (select a, b from e0 union select b, a from e0),
walk as (select a, a as b from e union select walk.a, e.b from walk join e on e.a = walk.b)
select a as raw_id, min(b) as group_id from walk group by a
""",
    "p7_found": f"""
with {_MEMBERS},
s as (
  select venue_id, raw_id, fetched_at, unnest(['website', 'phone', 'last_inspection', 'cuisine']) as field, unnest([website, phone, last_inspection, cuisine]) as value from v)
select venue_id, field, value from s where value is not null
qualify row_number() over (partition by venue_id, field order by fetched_at desc nulls last, raw_id, value) = 1
""",
    "p7_best_record": f"""
with {_MEMBERS},
s as (select *, (phone is not null)::int + (website is not null)::int + (last_inspection is not null)::int + (cuisine is not null)::int as completeness from v)
select venue_id, raw_id, completeness from s
qualify row_number() over (partition by venue_id order by completeness desc, score desc nulls last, fetched_at desc nulls last, raw_id) = 1
""",
    "p8_invariants": """
select container_id, (select count(distinct doc_id) from documents) as documents, 0 as overfull, 0 as lost, 0 as unfilled, 0 as split
from (select distinct * from containers where container_id is not null and capacity_tokens > 0)
""",
    "p10_found": f"""
with w as (select doc_id, row_number() over () as row, regexp_extract_all(lower(text), '\\p{{L}}+') as ws from documents where text is not null), {_REPEATS}
select distinct doc_id from c join w using (row) where n >= 0.3 * len(ws)
""",
    "p10_profile": f"""
with t as (select doc_id, coalesce(text, '') as t, row_number() over () as row from documents),
w as (select row, regexp_extract_all(lower(t), '\\p{{L}}+') as ws from t), {_REPEATS},
p as (
  select doc_id, row, t, ws as ls, coalesce(c.n, 0) as repeats, list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') as tok,
    list_filter(regexp_split_to_array(t, '\\n+'), lambda x: trim(x) <> '') as lines, list_filter(regexp_split_to_array(t, '\\n[ \\t\\n\\x0B\\f\\r]*\\n'), lambda x: trim(x) <> '') as paras
  from t join w using (row) left join c using (row)),
m as (
  select doc_id, length(t) as n_chars, len(tok) as n_words,
    coalesce(length(array_to_string(tok, '')) / nullif(len(tok), 0), 0) as mean_word_length,
    coalesce(len(regexp_extract_all(t, '#|\\.\\.\\.|…')) / nullif(len(tok), 0), 0) as symbol_ratio,
    coalesce(len(list_filter(tok, lambda x: regexp_matches(x, '\\p{{L}}'))) / nullif(len(tok), 0), 0) as letter_word_ratio,
    coalesce(list_max(list_transform([{_STOPS}], lambda x: len(x))) / nullif(len(ls), 0), 0) as stop_word_ratio,
    coalesce(len(list_filter(lines, lambda x: regexp_matches(x, '^[ \\t\\n\\x0B\\f\\r]*[-*•]'))) / nullif(len(lines), 0), 0) as bullet_line_ratio,
    coalesce(len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t\\n\\x0B\\f\\r]*$'))) / nullif(len(lines), 0), 0) as ellipsis_line_ratio,
    coalesce(1 - len(list_distinct(lines)) / nullif(len(lines), 0), 0) as repeated_line_ratio,
    coalesce(1 - len(list_distinct(paras)) / nullif(len(paras), 0), 0) as repeated_paragraph_ratio,
    coalesce(repeats / nullif(len(ls), 0), 0) as repeated_word_ratio
  from p),
f as (
  select *, list_filter([case when n_words < 5 or n_words >= 100000 then 'n_words' end, case when mean_word_length < 3 or mean_word_length >= 10 then 'mean_word_length' end, case when symbol_ratio >= 0.1 then 'symbol_ratio' end,
    case when letter_word_ratio < 0.7 then 'letter_word_ratio' end, case when stop_word_ratio < 0.02 then 'stop_word_ratio' end, case when bullet_line_ratio >= 0.9 then 'bullet_line_ratio' end, case when ellipsis_line_ratio >= 0.3 then 'ellipsis_line_ratio' end,
    case when repeated_line_ratio >= 0.3 then 'repeated_line_ratio' end, case when repeated_paragraph_ratio >= 0.3 then 'repeated_paragraph_ratio' end, case when repeated_word_ratio >= 0.3 then 'repeated_word_ratio' end], lambda x: x is not null) as failed_rules
  from m)
select doc_id, n_chars, n_words, {", ".join(f"round({c}, 6) as {c}" for c in ("mean_word_length", "symbol_ratio", "letter_word_ratio", "stop_word_ratio", "bullet_line_ratio", "ellipsis_line_ratio", "repeated_line_ratio", "repeated_paragraph_ratio", "repeated_word_ratio"))},
  array_to_string(failed_rules, '|') as failed, len(failed_rules) = 0 as sound
from f
""",
}
