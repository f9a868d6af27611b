import random
import re

import pytest
from pyspark.sql import functions as F

from venueweave.llm import repetition


def brute(text, run=5):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    covered = set()
    seen = set()
    for i in range(len(words) - run + 1):
        gram = tuple(words[i : i + run])
        if gram in seen:
            covered.update(range(i, i + run))
        seen.add(gram)
    return (len(covered), len(words))


def test_as_brute_force(spark):
    rng = random.Random(13)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(40))) for _ in range(200)] + [None, "", "a", "a b c d e", "a a a a a a", "a b c d e, A B C D E!", "a b c d e 1 a b c d e", "Ünï çode wörter hier jetzt. ünï ÇODE wörter hier jetzt", "x y " * 4000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words = repetition.letter_words(F.coalesce("text", F.lit("")))
    found = {r[0]: (r[1], r[2]) for r in frame.select("doc_id", repetition.let(words, lambda w: repetition.repeated_words(w)), F.size(words)).collect()}
    assert found == {i: brute(t) for i, t in enumerate(texts)}


def test_threshold_and_clashes(spark):
    data = [(1, "a b c d e f g a b c d e f g", "x"), (2, "a b c d e f g h i j k l", "x"), (3, None, "x")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, repeated_share string")
    broken = repetition.breaking(frame, "repeated_word_ratio").select("doc_id", "repeated_word_ratio")
    assert [tuple(r) for r in broken.collect()] == [(1, 0.5)]
    assert repetition.breaking(frame.limit(0), "repeated_word_ratio").count() == 0


def test_profile(spark):
    frame = spark.createDataFrame([(1, "- the one\n- the two\n\nwait...\n- the one"), (2, None), (3, "The cat is on the mat and it was there for the day.")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in repetition.quality_profile(frame).collect()}
    assert rows[1]["bullet_line_ratio"] == pytest.approx(0.75) and rows[1]["ellipsis_line_ratio"] == pytest.approx(0.25) and rows[1]["repeated_line_ratio"] == pytest.approx(0.25)
    assert rows[2]["n_words"] == 0 and not rows[2]["sound"] and rows[3]["sound"] and rows[3]["stop_word_ratio"] == pytest.approx(10 / 13, abs=0.1)
    custom = repetition.quality_profile(frame, thresholds=[("n_chars", 10, None)])
    assert {r["doc_id"]: r["failed"] for r in custom.collect()} == {1: [], 2: ["n_chars"], 3: []}


def test_no_user_function_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    plan = repetition.quality_profile(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
