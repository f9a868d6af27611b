"""Evaluation texts leaking into training text: rare n-gram seeds, then Smith-Waterman alignment.

The seeds are the rarest n-grams of each report: those that one or two reports hold, and the next rarest where these are
few, as with copies of a report; phrases that many reports share tell nothing about which of them leaked. Reports of equal
words are one report. Every document's n-grams are joined with them; documents that share as many seeds as the shortest passage must
are aligned with the report, word by word, wherever a passage may reach from an n-gram they share. An alignment tolerates
an occasional changed, missing or added word; passages are taken out one after another until none of the least length is
left. A document leaks an item if such passages hold the least share of the item's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venueweave.storage import Stash, broadcast_if_small, spread

#: Words of a seed; reports up to which an n-gram they share is rare; least share of a report's n-grams that are seeds, the
#: next rarest making up for it; seeds that a passage of ten words holds if one of them is changed; pairs a task aligns.
SEED, SHARED_BY, SEED_PART, LEAST_SEEDS, PAIRS_PER_TASK = 4, 2, 0.35, 3, 500
#: Least n-grams of any kind that a leak leaves whole, per word of the report: three of ten words, over a third of them, less
#: a fifth for repeated ones.
LEFT_WHOLE = 0.08
#: Scores of an equal word, of a changed one and of one left out; least words of a passage; least share of an item's words.
MATCH, CHANGE, GAP, PASSAGE, SHARE = 1, -2, -2, 10, 1.0 / 3.0


def plain_words(text: Column) -> Column:
    """Words of a text: runs of letters and digits in lower case, tags and entities dropped, accents and apostrophes kept apart."""
    bare = F.regexp_replace(F.regexp_replace(text, "<[^<>]{1,200}>", " "), "&(?:[a-zA-Z]{2,8}|#\\d{1,6});", " ")
    return F.regexp_extract_all(F.lower(bare), F.lit("[\\p{L}\\p{N}\\p{M}]+"), F.lit(0))


def report_words(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words): the words of each item's report: its sentences without the instruction before and the question behind.

    The first sentence is the instruction, the last one the question; an item of fewer than three sentences is taken whole.
    """
    parts = F.split(F.trim(F.col(text)), "(?<=[.?!])\\s+")
    report = F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, 2, F.greatest(F.lit(1), F.size(parts) - 2)), " ")).otherwise(F.col(text))
    return items.filter(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).alias("item"), plain_words(report).alias("words")).filter("size(words) > 0").distinct()


def _grams(words: Column, n: int) -> Column:
    """Hash of each run of n words, in order."""
    gram = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, F.element_at(F.transform(F.array(words), gram), 1))


def align(doc: np.ndarray, item: np.ndarray) -> int:
    """Words of the item in passages of the document, by repeated local alignment. -1 in ``doc`` parts what isn't adjacent."""
    free, doc, found = np.ones(len(item), bool), doc.copy(), 0
    n = len(doc)
    reach = np.arange(n + 1) * -GAP
    while True:
        score = np.zeros((len(item) + 1, n + 1), np.int32)
        for i, word in enumerate(item):
            if not free[i]:
                continue  # a taken word parts the item: its row stays zero
            row = np.zeros(n + 1, np.int32)
            row[1:] = np.maximum(score[i, :-1] + np.where(doc == word, MATCH, CHANGE), score[i, 1:] + GAP)
            np.maximum(row, 0, out=row)
            row[1:][doc < 0] = 0
            score[i + 1] = np.maximum.accumulate(row + reach) - reach
            score[i + 1, 1:][doc < 0] = 0
        best = int(score.max())
        i, j = (int(x) for x in np.unravel_index(int(score.argmax()), score.shape))
        if best < PASSAGE * MATCH // 2:
            return found
        rows, columns, equal = [], [], 0
        while i and j and score[i, j] > 0:
            if score[i, j] == score[i - 1, j - 1] + (MATCH if doc[j - 1] == item[i - 1] else CHANGE):
                equal += doc[j - 1] == item[i - 1]
                rows.append(i - 1)
                columns.append(j - 1)
                i, j = i - 1, j - 1
            elif score[i, j] == score[i - 1, j] + GAP:
                rows.append(i - 1)
                i -= 1
            elif score[i, j] == score[i, j - 1] + GAP:
                columns.append(j - 1)
                j -= 1
            else:
                break
        if equal >= PASSAGE:
            found += equal
        free[rows] = False
        doc[columns] = -1
        if not rows or not free.any():
            return found


def _near(words: np.ndarray, report: np.ndarray, n_known: int) -> np.ndarray:
    """The document's words that a passage through an n-gram shared with the report can reach, -1 where one was left out; none
    if fewer n-grams are shared than any leak leaves whole.

    From an n-gram on, a passage holds each word of the report once at most, and every gap costs two of them.
    """
    base = n_known + 1
    code = lambda w: sum(w[k : len(w) - SEED + 1 + k] * base**k for k in range(SEED))
    if len(words) < SEED or len(report) < SEED:
        return words[:0]
    known = np.minimum(words, n_known)
    whole = np.convolve(known == n_known, np.ones(SEED, int), "valid") == 0
    codes = code(known)
    at = np.flatnonzero(whole & np.isin(codes, code(report)))
    if len(np.unique(codes[at])) < LEFT_WHOLE * len(report):
        return words[:0]
    reach = len(report) + len(report) // 2 + 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.maximum(0, at - reach), 1)
    np.add.at(edge, np.minimum(len(words), at + SEED + reach), -1)
    keep = np.cumsum(edge[:-1]) > 0
    # one mark parts what isn't adjacent
    return np.where(keep, words, -1)[keep | np.concatenate(([False], keep[:-1]))]


def leaked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item, words, share): the documents that hold at least the least share of an item's report in passages.

    Null and empty texts leak nothing; items without words are left out; a document or an item that occurs twice
    counts once; other columns are ignored. Whole texts are searched.
    """
    named = Stash(report_words(items, item, item_text), "items")
    reports = Stash(named.df.groupBy("words").agg(F.min("item").alias("report")), "reports")
    grams = reports.df.select("report", F.explode(F.array_distinct(_grams(F.col("words"), SEED))).alias("gram"))
    sharing = grams.withColumn("shared", F.count("*").over(Window.partitionBy("gram")))
    of_report = Window.partitionBy("report")
    ranked = sharing.withColumns({"before": F.rank().over(of_report.orderBy("shared")) - 1, "all": F.count("*").over(of_report)})
    seeds = Stash(ranked.filter((F.col("shared") <= SHARED_BY) | (F.col("before") < SEED_PART * F.col("all"))).select("report", "gram", "all"), "seeds")
    worded = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), plain_words(F.col(text)).alias("words"))
    each = worded.select("key", F.explode(F.array_distinct(_grams(F.col("words"), SEED))).alias("gram"))
    hits = each.join(broadcast_if_small(seeds), "gram")
    pairs = hits.groupBy("key", "report").agg(F.count_distinct("gram").alias("seeds"), F.max("all").alias("all"))
    pairs = Stash(pairs.filter(F.col("seeds") >= F.least(F.lit(LEAST_SEEDS), F.col("all"))).select("key", "report"), "pairs")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null")
    texts = texts.join(broadcast_if_small(Stash(pairs.df.select("key").distinct(), "keys")), "key", "left_semi").distinct()
    chosen = Stash(texts.select("key", plain_words(F.col("text")).alias("words")).join(pairs.df, "key"), "chosen")
    chosen = spread(chosen, PAIRS_PER_TASK).join(broadcast_if_small(reports).withColumnRenamed("words", "wanted"), "report")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, i, words, report in zip(batch["key"], batch["report"], batch["words"], batch["wanted"], strict=True):
                known = {w: n for n, w in enumerate(dict.fromkeys(report))}
                numbers = np.array([known[w] for w in report], dtype=np.int64)
                held = align(_near(np.array([known.get(w, 1_000_000) for w in words], dtype=np.int64), numbers, len(known)), numbers)
                rows.append((k, i, held, held / len(report)))
            yield pd.DataFrame(rows, columns=["key", "report", "words", "share"])

    kinds = dict(chosen.dtypes)
    found = chosen.select("key", "report", "words", "wanted").mapInPandas(work, f"key {kinds['key']}, report {kinds['report']}, words bigint, share double")
    found = found.filter(F.col("share") >= SHARE).groupBy("key", "report").agg(F.max("words").alias("words"), F.max("share").alias("share"))
    same = named.df.join(reports.df, "words").select("report", "item")
    return found.join(broadcast_if_small(Stash(same, "same")), "report").groupBy("key", "item").agg(F.max("words").alias("words"), F.max("share").alias("share"))
