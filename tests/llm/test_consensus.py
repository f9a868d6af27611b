import datetime as dt
import random

from venueweave.llm.consensus import discover_truth, review_votes

VOTES = "insight_id bigint, field string, reviewer string, label string"


def test_good_annotators_outweigh_many_poor_ones(spark):
    rng = random.Random(7)
    truth = {i: rng.choice(["correct", "partial", "wrong"]) for i in range(400)}
    votes = []
    for i, label in truth.items():
        others = [x for x in ("correct", "partial", "wrong") if x != label]
        for name, right in [("good1", 0.95), ("good2", 0.95), ("poor1", 0.45), ("poor2", 0.45), ("poor3", 0.45)]:
            votes.append((i, "verdict", name, label if rng.random() < right else rng.choice(others)))
    votes += [(i, "verdict", f"once{i}", rng.choice(["correct", "partial", "wrong"])) for i in range(100)]
    best, annotators = discover_truth(spark.createDataFrame(votes, VOTES), ["insight_id", "field"])
    found = {r["insight_id"]: r["label"] for r in best.collect()}
    assert sum(found[i] == truth[i] for i in truth) / len(truth) > 0.94
    weight = {r["annotator"]: r["weight"] for r in annotators.collect()}
    assert min(weight["good1"], weight["good2"]) > 2 * max(weight["poor1"], weight["poor2"], weight["poor3"])
    assert max(w for n, w in weight.items() if n.startswith("once")) < weight["good1"]


def test_single_votes_ties_and_empty(spark):
    votes = [(1, "f", "a", "wrong"), (2, "f", "a", "wrong"), (2, "f", "b", "correct"), (3, "f", None, "wrong"), (3, "f", "a", None)]
    best, _ = discover_truth(spark.createDataFrame(votes, VOTES), ["insight_id", "field"])
    rows = {r["insight_id"]: (r["label"], r["votes"]) for r in best.collect()}
    assert rows[1] == ("wrong", 1) and rows[2][1] == 2 and 3 not in rows
    best, annotators = discover_truth(spark.createDataFrame([], VOTES), ["insight_id", "field"])
    assert best.count() == 0 and annotators.count() == 0


def test_latest_valid_submission_counts(spark):
    at = lambda d: dt.datetime(2026, 1, d)
    data = [
        (1, 7, "Ann ", "Correct", {"Vibe Tags": "wrong ", "other": "wrong", "noise-level": "?"}, at(1)),
        (2, 7, "ann", "wrong", {"VIBE_TAGS": "partial"}, at(3)),
        (3, 7, "ann", "skip", {"vibe_tags": "correct"}, at(4)),
        (4, 7, "bob", "partial", None, None),
        (5, None, "bob", "partial", None, at(1)),
        (6, 7, None, "partial", None, at(1)),
    ]
    frame = spark.createDataFrame(data, "id bigint, insight_id bigint, reviewer string, verdict string, field_verdicts map<string,string>, reviewed_at timestamp")
    assert {tuple(r) for r in review_votes(frame).select("reviewer", "field", "label").collect()} == {("ann", "verdict", "wrong"), ("ann", "vibe_tags", "partial"), ("bob", "verdict", "partial")}
