import random

import numpy as np

from venueweave.llm.leakage import align, leaked


def texts(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    report = [rng.choice(words) for _ in range(90)]
    return rng, words, report


def items(spark, reports):
    lead, ask = "Read the report and answer the question.", "What did they say about it?"
    return spark.createDataFrame([(i, f"{lead} {' '.join(r)}. {ask}", "x") for i, r in enumerate(reports)], "item_id bigint, text string, key string")


def test_leaks_and_near_misses(spark):
    rng, words, report = texts(9)
    other = texts(10)[2]
    fill = lambda n: " ".join(rng.choice(["tea", "cake", "good", "bad", "noise"]) for _ in range(n))
    noisy = list(report)
    for at in range(7, 90, 9):
        noisy[at] = "changed"
    parts = f"{fill(30)} {' '.join(report[:20])} {fill(15)} {' '.join(report[40:58])} {fill(5)}"
    docs = [
        (1, f"{fill(50)} {' '.join(report)} {fill(40)}"),
        (2, " ".join(noisy).upper().replace(" ", ",\n")),
        (3, parts),
        (4, "<p>" + "</b> <b>".join(report[10:50]) + "</p>"),
        (5, f"{fill(60)} {' '.join(report[:9])} {fill(20)} {' '.join(report[30:39])} {fill(9)} {' '.join(report[50:59])} {fill(4)} {' '.join(report[70:79])}"),  # short quotations
        (6, " ".join(report[:24])),  # under a third
        (7, "Read the report and answer the question. What did they say about it? " + fill(100)),
        (8, None),
        (9, ""),
        (10, " ".join(w if i % 2 else "x" for i, w in enumerate(report))),
        (11, fill(20000) + " " + " ".join(report) + " " + fill(20000)),
        (12, " ".join(report) + " " + " ".join(other)),
        (1, f"{' '.join(report)}"),
    ]
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, item string")
    rows = [(r["key"], r["item"]) for r in leaked(frame, items(spark, [report, other, report[:2]])).collect()]
    assert sorted(rows) == [(1, 0), (2, 0), (3, 0), (4, 0), (11, 0), (12, 0), (12, 1)]


def test_reports_that_many_items_share(spark):
    """Three items of one report, and five that differ in a word each, are all found at their full share."""
    rng, words, report = texts(13)
    variants = [[*report[:15 * i + 7], f"other{i}", *report[15 * i + 8 :]] for i in range(5)]
    docs = spark.createDataFrame([(1, " ".join(report)), (2, "tea " * 200 + " ".join(report[10:60]))], "doc_id bigint, text string")
    same = {(r["key"], r["item"]): r["share"] for r in leaked(docs, items(spark, [report] * 3)).collect()}
    assert {k: v for k, v in same.items() if k[0] == 1} == {(1, i): 1.0 for i in range(3)} and {k for k in same if k[0] == 2} == {(2, i) for i in range(3)}
    near = {(r["key"], r["item"]): r["share"] for r in leaked(docs, items(spark, variants)).collect()}
    assert set(near) == {(d, i) for d in (1, 2) for i in range(5)} and min(near[1, i] for i in range(5)) > 0.95


def test_empty_tables(spark):
    _, _, report = texts(11)
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    assert leaked(docs.limit(0), items(spark, [report])).count() == 0
    assert leaked(docs, items(spark, [report]).limit(0)).count() == 0


def slow(doc, item):
    """Best plain local alignment score by the textbook recurrence."""
    best, h = 0, [[0] * (len(doc) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(doc) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if doc[j - 1] == item[i - 1] else -2), h[i - 1][j] - 2, h[i][j - 1] - 2)
            best = max(best, h[i][j])
    return best


def test_alignment_as_the_recurrence():
    rng = random.Random(12)
    for _ in range(30):
        item = [rng.randrange(40) for _ in range(30)]
        doc = [rng.randrange(40) for _ in range(25)] + item[3 : 3 + rng.randrange(5, 25)] + [rng.randrange(40) for _ in range(10)]
        held = align(np.array(doc), np.array(item))
        assert (held >= 10) == (slow(doc, item) >= 10) or abs(slow(doc, item) - 10) <= 2


def test_alignment_counts_passages():
    item = np.arange(60)
    assert align(item.copy(), item) == 60
    assert align(np.array([*range(30, 60), *range(30)]), item) == 60
    assert align(np.array([*range(20), 99, *range(20, 40)]), item) == 40
    assert align(np.array([*range(9), -1, *range(20, 29)]), item) == 0
