"""Several values packed in one field: the cheapest dialect by description length, then one row for each value.

A dialect is a set of delimiter kinds, with or without quoting. Splitting a field costs the code lengths of the
value boundaries it makes: of the end of a value after the word before the delimiter, and of the word behind it as the
first of a value. Not splitting costs the literal delimiter and the code length of the second word following the first
inside a value. The code lengths come from the word pairs of all fields that hold no delimiter, counted by one
distributed aggregation. The lengths of a dialect add up over its kinds, so the cheapest of all 2^k sets is found
exactly, kind by kind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueweave.functions.text import let, replace_all
from venueweave.storage import Stash, spread

#: Bits for naming a delimiter kind in the dialect, for an exception in the dialect, for a quoted value.
KIND_BITS, ESCAPE_BITS, QUOTE_BITS = 3.0, 3.0, 2.0
#: Bits for a delimiter that stands in a value: names do hold commas, slashes and words, hardly ever the other marks.
LITERAL_BITS, ODD_LITERAL_BITS = 4.0, 9.0
_COMMON = ["comma", "slash", "word"]
#: Weight, in words, of the prior in a word's code lengths; share of words that end a value in that prior.
PRIOR_WORDS, PRIOR_END = 2.0, 0.3
#: Words that make up at most this share of all words, or were seen once, count as one of two classes, with and without a
#: possessive ending.
RARE_SHARE = 3e-5
#: Fields that a task takes apart.
FIELDS_PER_TASK = 50_000

_WORDED = r"aka|a/k/a|dba|d/b/a|fka|f/k/a"
_MAY_SPLIT = r'(?i)["|;/,·•\t\r\n]|\s(?:aka|a/k/a|dba|d/b/a|fka|f/k/a)\s'
_LEX = re.compile(
    rf"(?P<word>(?<!\S)(?:{_WORDED})(?!\S))"
    r"|(?P<atom>(?<![^\W_])\d+/\d+|(?<![^\s(])[^\W\d_]/(?:[^\W\d_](?![^\W_])(?:/[^\W\d_](?![^\W_]))?)?(?![^\W_]))"
    r"|(?P<mark>//|[|;/,·•\t\n]|\r\n?)",
    re.IGNORECASE,
)
_KINDS = {"|": "bar", ";": "semicolon", "/": "slash", "//": "slashes", ",": "comma", "·": "middot", "•": "bullet", "\t": "tab", "\n": "line", "\r": "line", "\r\n": "line"}
_QUOTED = re.compile(r'[ \u00a0]*"((?:[^"]|"")*)"[ \u00a0]*')


def _lex(text: str, quoting: bool) -> tuple[list[str], list[str], int]:
    """(pieces, the kind of delimiter between each two, number of quoted pieces)."""
    pieces, kinds, quoted, at, begin = [], [], 0, 0, 0
    while True:
        if quoting and not text[begin:at].strip() and (m := _QUOTED.match(text, at)):
            rest = m.end()
            ends = rest == len(text) or (k := _LEX.match(text, rest)) and not k["atom"]
            if ends:
                quoted += 1
                at = rest
        m = _LEX.search(text, at)
        while m and m["atom"]:
            m = _LEX.search(text, m.end())
        if not m:
            pieces.append(text[begin:])
            return pieces, kinds, quoted
        pieces.append(text[begin : m.start()])
        kinds.append("word" if m["word"] else _KINDS[m["mark"]])
        at = begin = m.end()


def _unquote(piece: str, quoting: bool) -> str:
    piece = piece.strip()
    if quoting and (m := _QUOTED.fullmatch(piece)):
        return m[1].replace('""', '"').strip()
    return piece


def _word(text: str, last: bool) -> str:
    """First or last word of a piece as it is counted: lower case, digits alike, outer punctuation dropped."""
    parts = text.lower().split()
    return re.sub(r"\d", "9", (parts[-1] if last else parts[0]).strip("\"'.,()")) if parts else ""


def _counted(text: Column) -> Column:
    """A field with its words as they are counted: lower case, digits alike, outer punctuation dropped."""
    text = F.lower(F.regexp_replace(text, "\\s+", " "))
    text = let(text, lambda v: F.when(v.rlike("\\d"), F.regexp_replace(v, "\\d", "9")).otherwise(v))
    outer = (("(^| )[\"'.,()]+", "$1"), ("[\"'.,()]+( |$)", "$1"))
    return F.trim(let(text, lambda v: F.when(v.rlike("[\"'.,()]"), replace_all(v, *outer)).otherwise(v)))


def _class_of(c: Column) -> Column:
    return F.when(c.endswith("'s"), F.lit("?'s")).otherwise(F.lit("?"))


def word_pairs(fields: DataFrame) -> DataFrame:
    """(first, second, n) over all fields; '^' starts and '$' ends a value."""
    framed = fields.select(F.split(F.concat(F.lit("^ "), _counted(F.col("text")), F.lit(" $")), " ").alias("w"))
    framed = framed.select(F.slice("w", 1, F.size("w") - 1).alias("first"), F.slice("w", 2, F.size("w") - 1).alias("second"))
    pairs = framed.select(F.explode(F.arrays_zip("first", "second")).alias("p"))
    return pairs.groupBy("p.first", "p.second").agg(F.count("*").alias("n"))


def _with_bits(marks: DataFrame, counted: DataFrame) -> DataFrame:
    """Code lengths at each delimiter: ``end`` after the word before, ``start`` with the word behind, ``inner`` of the two as neighbours."""
    counted = Stash(counted, "pairs").df
    rare = max(1, int(RARE_SHARE * (counted.agg(F.sum("n")).first()[0] or 0)))
    common = Stash(counted.groupBy(F.col("second").alias("word")).agg(F.sum("n").alias("n")).filter(F.col("n") > rare).select("word"), "words").df.unionByName(counted.sparkSession.sql("select '^' as word"))

    def classed(df: DataFrame, c: str) -> DataFrame:
        known = df.join(common.select(F.col("word").alias(c), F.lit(True).alias("known")), c, "left")
        return known.withColumn(c, F.when(F.col("known") | (F.col(c) == ""), F.col(c)).otherwise(_class_of(F.col(c)))).drop("known")

    pairs = Stash(classed(classed(counted, "first"), "second").groupBy("first", "second").agg(F.sum("n").alias("n")), "pairs").df
    marks = classed(classed(marks, "before"), "after")
    ends = pairs.groupBy(F.col("first").alias("before")).agg(F.sum("n").alias("n_before"), F.sum(F.when(F.col("second") == "$", F.col("n"))).alias("n_end"))
    starts = pairs.groupBy(F.col("second").alias("after")).agg(F.sum("n").alias("n_after"), F.sum(F.when(F.col("first") == "^", F.col("n"))).alias("n_start"))
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_words"), F.coalesce(F.sum(F.when(F.col("first") == "^", F.col("n"))), F.lit(0)).alias("n_values"))
    both = pairs.select(F.col("first").alias("before"), F.col("second").alias("after"), F.col("n").alias("n_both"))
    out = marks.join(ends, "before", "left").join(starts, "after", "left").join(both, ["before", "after"], "left").crossJoin(F.broadcast(total))  # total: one row
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_before", "n_end", "n_after", "n_start", "n_both")}
    share = PRIOR_WORDS * (n["n_after"] + 0.5) / (F.col("n_words") + 1.0)
    bits = {
        "end": -F.log2((n["n_end"] + PRIOR_WORDS * PRIOR_END) / (n["n_before"] + PRIOR_WORDS)),
        "start": -F.log2((n["n_start"] + share) / (F.col("n_values") + PRIOR_WORDS)),
        "inner": -F.log2((n["n_both"] + share) / (n["n_before"] + PRIOR_WORDS)),
    }
    return out.withColumns(bits).drop("n_before", "n_end", "n_after", "n_start", "n_both", "n_words", "n_values")


def split_values(df: DataFrame, key: str = "raw_id", text: str = "name") -> DataFrame:
    """(key, pos, value, n_values): every non-empty value of every field, ``pos`` counting from 1.

    A null or blank field gives no row; a field without delimiters gives itself, trimmed. Repeated rows count once;
    a key with several texts gives the values of each. Other columns are ignored. Bare delimiters give no row.
    """
    fields = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("key is not null and text is not null and trim(text) != ''").distinct()
    fields = Stash(fields.withColumn("may_split", F.col("text").rlike(_MAY_SPLIT)), "fields").df  # read three times
    plain = fields.filter("not may_split").drop("may_split")
    packed = spread(Stash(fields.filter("may_split").drop("may_split"), "packed"), FIELDS_PER_TASK)

    def lex(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, value in zip(batch["key"], batch["text"], strict=True):
                for quoting in (False, True) if '"' in value else (False,):
                    pieces, kinds, quoted = _lex(value, quoting)
                    shown = [_unquote(p, quoting) for p in pieces]
                    fixed = QUOTE_BITS * quoted if quoting else LITERAL_BITS * value.count('"')
                    rows.append((k, value, quoting, -1, "", "", "", fixed))
                    free = ["" if quoting and _QUOTED.fullmatch(p) else v for p, v in zip(pieces, shown, strict=True)]
                    rows += [(k, value, quoting, i, kind, _word(free[i], True), _word(free[i + 1], False), 0.0) for i, kind in enumerate(kinds)]
            yield pd.DataFrame(rows, columns=["key", "text", "quoting", "i", "kind", "before", "after", "fixed"])

    kind_of = dict(df.select(F.col(key).alias("key")).dtypes)["key"]
    marks = packed.mapInPandas(lex, f"key {kind_of}, text string, quoting boolean, i int, kind string, before string, after string, fixed double")
    marks = _with_bits(Stash(marks, "marks").df, word_pairs(plain))
    # an empty or quoted piece beside the delimiter needs no code to start or end, and is odd inside a value
    odd_before, odd_after = F.col("before") == "", F.col("after") == ""
    split = F.when(odd_before, 0.0).otherwise(F.col("end")) + F.when(odd_after, 0.0).otherwise(F.col("start"))
    literal = F.when(F.col("kind").isin(_COMMON), LITERAL_BITS).otherwise(ODD_LITERAL_BITS)
    whole = literal + F.when(odd_before | odd_after, 2 * LITERAL_BITS + F.when(odd_after, 0.0).otherwise(F.col("start"))).otherwise(F.col("inner"))
    marks = marks.withColumn("split", split).withColumn("whole", whole)
    marks = marks.withColumn("cut", F.col("split") <= F.col("whole") + ESCAPE_BITS)
    by_kind = marks.groupBy("key", "text", "quoting", "kind").agg(
        (KIND_BITS + F.sum(F.least(F.col("split"), F.col("whole") + ESCAPE_BITS))).alias("used"),
        F.sum("whole").alias("unused"),
        F.sum("fixed").alias("fixed"),
        F.collect_list(F.when(F.col("cut"), F.col("i"))).alias("at"),
    )
    real, takes = F.col("kind") != "", F.col("used") < F.col("unused")
    dialects = by_kind.groupBy("key", "text", "quoting").agg(
        F.sum(F.when(real, F.least("used", "unused")).otherwise(F.col("fixed"))).alias("bits"),
        F.array_sort(F.flatten(F.collect_list(F.when(real & takes, F.col("at"))))).alias("at"),
    )
    best = dialects.groupBy("key", "text").agg(F.min_by(F.struct("quoting", "at"), F.struct("bits", ~F.col("quoting"))).alias("d"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, value, quoting, at in zip(batch["key"], batch["text"], batch["quoting"], batch["at"], strict=True):
                rows.append((k, _values(value, quoting, set(at))))
            yield pd.DataFrame(rows, columns=["key", "values"])

    parsed = best.select("key", "text", "d.quoting", "d.at").mapInPandas(parse, f"key {kind_of}, values array<string>")
    many = parsed.select("key", F.size("values").alias("n_values"), F.posexplode("values").alias("pos", "value")).select("key", (F.col("pos") + 1).alias("pos"), "value", "n_values")
    one = plain.select("key", F.lit(1).alias("pos"), F.trim("text").alias("value"), F.lit(1).alias("n_values"))
    return one.unionByName(many)


def _values(text: str, quoting: bool, at: set[int]) -> list[str]:
    """The field cut at the chosen delimiters; the others stay as they are written."""
    pieces, kinds, _ = _lex(text, quoting)
    begin, where, found = 0, 0, []
    for i, piece in enumerate(pieces):
        end = where + len(piece)
        if i == len(kinds):
            found.append(text[begin:])
            break
        m = _LEX.match(text, end)
        if i in at:
            found.append(text[begin:end])
            begin = m.end()
        where = m.end()
    return [v for v in (_unquote(p, quoting) for p in found) if v]
