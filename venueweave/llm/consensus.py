"""Consensus from several annotators' labels: confidence-aware truth discovery.

An annotator's weight is the lower chi-squared quantile at the number of their labels over the sum of their squared
distances to the current consensus, which is the reciprocal of an upper bound on their error variance: somebody with
few labels gets little weight even if all of them agree. The consensus of an item is the weighted mean of its labels
as indicator vectors; each vote is compared with the mean of the other votes, so that nobody's weight feeds on their
own votes. Consensus and weights alternate until the weights stand still; the label is the one with most weight.
Items and annotators are aggregates combined map-side: one with a third of all votes is no burden to a task.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venueweave.storage import Stash, broadcast_if_small

#: Normal quantile of half the significance level (0.05 / 2); what keeps a sum of distances from zero; rounds at most;
#: change of a weight, as a share of it, that ends them.
Z_LOW, SMOOTHING, ROUNDS, STILL = -1.959964, 0.5, 100, 0.01

VERDICTS = ["correct", "partial", "wrong"]
FIELDS = ["vibe_tags", "noise_level", "crowd_level", "best_time", "recurring_events", "good_for", "sentiment"]


def chi_squared_low(n: Column) -> Column:
    """Lower 2.5 % quantile of chi-squared with n degrees of freedom (Wilson and Hilferty), kept positive."""
    c = 2.0 / (9.0 * n)
    return F.greatest(F.lit(0.001), n * F.pow(F.greatest(F.lit(0.0), 1.0 - c + Z_LOW * F.sqrt(c)), F.lit(3.0)))


def discover_truth(votes: DataFrame, item: list[str], annotator: str = "reviewer", label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(consensus, annotators) of votes with one row for each item and annotator.

    consensus: the item columns, ``label``, ``votes`` and ``agreement``, the weighted share of votes for the label.
    annotators: ``annotator``, ``n`` labels on items with other votes, ``weight`` and mean ``error``, the squared
    distance to those votes. Equal weighted sums
    go to the label with more votes, then to the first in alphabetical order. Null labels are no votes; an empty
    table gives two empty tables.
    """
    kept = votes.select(*item, F.col(annotator).alias("annotator"), F.col(label).alias("label")).filter(F.col("annotator").isNotNull() & F.col("label").isNotNull())
    kept = Stash(kept, "votes")
    weights, change = None, None
    for left in range(ROUNDS, 0, -1):
        weighted = _weighted(kept.df, weights)
        of_item = Window.partitionBy(*item)  # over an item's distinct labels
        sums = weighted.groupBy(*item, "label").agg(F.sum("w").alias("s")).withColumns({"total": F.sum("s").over(of_item), "squares": F.sum(F.col("s") * F.col("s")).over(of_item)})
        voted = weighted.join(sums, [*item, "label"])
        own, rest = F.col("s") - F.col("w"), F.col("total") - F.col("w")
        squares = F.col("squares") - F.col("s") * F.col("s") + own * own
        voted = voted.withColumn("d", F.when(rest > 1e-9 * F.col("total"), F.greatest(F.lit(0.0), (1.0 - 2.0 * own / rest + squares / (rest * rest)) / 2.0)))
        each = voted.groupBy("annotator").agg(F.count("d").alias("n"), F.coalesce(F.sum("d"), F.lit(0.0)).alias("distance"), F.max("w").alias("old"))
        now = Stash(each.withColumn("weight", chi_squared_low(F.greatest(F.lit(1.0), F.col("n").cast("double"))) / (F.col("distance") + SMOOTHING)), "weights")
        if weights:
            weights.drop()
        weights = now
        scale = weights.df.agg(F.sum("weight"), F.sum("old")).first()
        change = weights.df.agg(F.max(F.abs(F.col("weight") * ((scale[1] or 1.0) / (scale[0] or 1.0)) / F.col("old") - 1.0))).first()[0]
        if change is None or change < STILL:
            break
        if left == 1:
            warnings.warn(f"weights still move by {change:.1%} after {ROUNDS} rounds", RuntimeWarning, stacklevel=2)
    sums = _weighted(kept.df, weights).groupBy(*item, "label").agg(F.round(F.sum("w"), 9).alias("s"), F.count("*").alias("n"))
    ranked = F.struct((-F.col("s")).alias("s"), (-F.col("n")).alias("n"), F.col("label").alias("label"))
    best = sums.groupBy(*item).agg(F.min(ranked).alias("m"), F.sum("n").alias("votes"), F.sum("s").alias("total"))
    best = best.select(*item, F.col("m.label").alias("label"), "votes", (-F.col("m.s") / F.col("total")).alias("agreement"))
    return best, weights.df.select("annotator", "n", "weight", (F.col("distance") / F.greatest(F.lit(1), F.col("n"))).alias("error"))


def _weighted(votes: DataFrame, weights: Stash | None) -> DataFrame:
    if weights is None:
        return votes.withColumn("w", F.lit(1.0))
    return votes.join(broadcast_if_small(weights).select("annotator", F.col("weight").alias("w")), "annotator")


def review_votes(reviews: DataFrame) -> DataFrame:
    """(insight_id, field, reviewer, label): the valid labels of each reviewer's latest valid submission on an insight.

    Reviewers, labels and field names are compared in lower case without outer blanks, field names with underscores.
    A submission counts if its overall verdict is valid; the latest by time, then by id. A field stated twice in one
    submission takes the alphabetically first label.
    """
    clean = lambda c: F.lower(F.trim(F.regexp_replace(c, "\\s+", " ")))
    rows = reviews.select("insight_id", clean(F.col("reviewer")).alias("reviewer"), clean(F.col("verdict")).alias("verdict"), "field_verdicts", "reviewed_at", "id")
    rows = rows.filter("insight_id is not null and reviewer is not null and reviewer != ''").filter(F.col("verdict").isin(VERDICTS))
    latest = Window.partitionBy("insight_id", "reviewer").orderBy(F.col("reviewed_at").desc_nulls_last(), F.col("id").desc_nulls_last())
    rows = rows.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1")
    overall = F.array(F.struct(F.lit("verdict").alias("field"), F.col("verdict").alias("label")))
    stated = F.transform(F.map_entries(F.coalesce("field_verdicts", F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.regexp_replace(clean(e["key"]), "[ -]+", "_").alias("field"), clean(e["value"]).alias("label")))
    stated = F.filter(stated, lambda s: s["field"].isin(FIELDS) & s["label"].isin(VERDICTS))
    votes = rows.select("insight_id", "reviewer", F.explode(F.concat(overall, stated)).alias("s")).select("insight_id", "reviewer", "s.field", "s.label")
    return votes.groupBy("insight_id", "field", "reviewer").agg(F.min("label").alias("label"))
