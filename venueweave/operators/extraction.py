"""Insight extraction with grounding: work list, provider, verbatim evidence, fields dropped for want of it."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueweave.functions.text import norm_quote

# The vocabulary of tags, the fields that need a quote.
VIBES = [
    "casual", "upscale", "romantic", "lively", "cozy", "divey", "trendy", "classic", "family-friendly", "tourist-heavy", "locals", "quiet", "loud",
    "intimate", "spacious", "rustic", "modern", "kitschy", "no-frills", "late-night", "outdoor-seating", "counter-service", "old-school", "scene-y", "hidden-gem",
]
LEVELS = {"noise_level": ["quiet", "moderate", "loud"], "crowd_level": ["empty", "comfortable", "busy", "packed"], "sentiment": ["positive", "mixed", "negative", "neutral"]}
GROUNDED = ["vibe_tags", "noise_level", "crowd_level", "best_time", "recurring_events", "good_for"]
LISTS = ["vibe_tags", "recurring_events", "good_for"]
INSIGHT = (
    "vibe_tags array<string>, noise_level string, crowd_level string, best_time string, recurring_events array<string>, good_for array<string>, "
    "sentiment string, evidence array<struct<field: string, quote: string>>, confidence double"
)


def checked(df: DataFrame) -> DataFrame:
    """A provider's output held to the vocabulary: unknown tags are left out, a level that isn't one becomes null, a
    confidence outside 0 to 1 too, evidence without field or quote is left out; ``violations`` names the fields changed."""
    tags = F.filter(F.array_distinct("vibe_tags"), lambda t: t.isin(VIBES))
    evidence = F.filter("evidence", lambda e: e["field"].isNotNull() & e["quote"].isNotNull())
    levels = {c: F.when(F.col(c).isin(known), F.col(c)) for c, known in LEVELS.items()}
    held = {"vibe_tags": tags, **levels, "evidence": evidence, "confidence": F.when(F.col("confidence").between(0, 1), F.col("confidence"))}
    changed = F.array_compact(F.array(*[F.when(~v.eqNullSafe(F.col(c)), F.lit(c)) for c, v in held.items()]))
    return df.withColumn("violations", changed).withColumns(held)


def work_list(reviews: DataFrame, insights: DataFrame, model: str, version: str) -> DataFrame:
    """Reviews (id, text, content_hash) without a current result of this model and version, or whose text has changed."""
    done = insights.filter((F.col("model") == model) & (F.col("prompt_version") == version)).select(F.col("raw_review_id").alias("id"), F.col("content_hash").alias("_hash"), F.lit(True).alias("_done"))
    return reviews.join(done, "id", "left").filter(F.col("_done").isNull() | ~F.col("_hash").eqNullSafe(F.col("content_hash"))).drop("_hash", "_done")


def keyword_provider(text: str) -> dict:
    """A deterministic provider for tests and dry runs: the vocabulary's words as they stand in the text."""
    found = [v for v in VIBES if re.search(rf"\b{re.escape(v)}\b", text, re.IGNORECASE)]
    noise = "loud" if "loud" in found else "quiet" if "quiet" in found else None
    evidence = [{"field": "vibe_tags", "quote": m[0]} for v in found if (m := re.search(rf"[^.!?]*\b{re.escape(v)}\b[^.!?]*", text, re.IGNORECASE))]
    evidence += [{"field": "noise_level", "quote": noise}] if noise else []
    return {"vibe_tags": found, "noise_level": noise, "evidence": evidence, "confidence": 0.5 if found else 0.1}


def extract(reviews: DataFrame, provider: Callable[[str], dict] = keyword_provider, parallel: int | None = None) -> DataFrame:
    """id and the insight a provider reads from the whole of each text; ``parallel`` bounds its callers."""
    names = [c.split(" ")[0] for c in INSIGHT.replace(": ", ":").split(", ") if ":" not in c.split(" ")[0] and not c.startswith("quote")]
    kind = dict(reviews.dtypes)["id"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"], batch["text"], strict=True):
                out = provider(text or "")
                rows.append((key, *[out.get(n, [] if n in (*LISTS, "evidence") else None) for n in names]))
            yield pd.DataFrame(rows, columns=["id", *names])

    rows = reviews.select("id", "text")
    return (rows.repartition(parallel) if parallel else rows).mapInPandas(work, f"id {kind}, {INSIGHT}")


def supported(evidence: Column, text: Column) -> Column:
    """Fields with a quote that stands in the text; an empty quote supports nothing."""
    within = norm_quote(text)
    held = F.filter(evidence, lambda e: (norm_quote(F.coalesce(e["quote"], F.lit(""))) != "") & F.contains(within, norm_quote(e["quote"])))
    return F.array_distinct(F.transform(F.coalesce(held, F.array().cast("array<struct<field: string, quote: string>>")), lambda e: e["field"]))


def verbatim(evidence: Column, text: Column) -> Column:
    """True if every quote stands in the text; true without quotes."""
    within = norm_quote(text)
    return F.coalesce(F.forall(evidence, lambda e: F.coalesce((norm_quote(e["quote"]) != "") & F.contains(within, norm_quote(e["quote"])), F.lit(False))), F.lit(True))


def ground(df: DataFrame, text: str = "text") -> DataFrame:
    """Drops each grounded field without a quote in the text; adds ``dropped_fields`` and ``evidence_verbatim``."""
    df = df.withColumn("_supported", supported(F.col("evidence"), F.coalesce(text, F.lit(""))))
    stated = {c: (F.size(c) > 0) if c in LISTS else (F.coalesce(F.col(c), F.lit("")) != "") for c in GROUNDED}
    lost = {c: F.coalesce(stated[c], F.lit(False)) & ~F.array_contains("_supported", c) for c in GROUNDED}
    dropped = F.array_compact(F.array(*[F.when(lost[c], F.lit(c)) for c in GROUNDED]))
    df = df.withColumns({"dropped_fields": dropped, "evidence_verbatim": verbatim(F.col("evidence"), F.coalesce(text, F.lit("")))})
    empty = F.array().cast("array<string>")
    return df.withColumns({c: F.when(F.array_contains("dropped_fields", c), empty if c in LISTS else F.lit(None).cast("string")).otherwise(F.col(c)) for c in GROUNDED}).drop("_supported")
