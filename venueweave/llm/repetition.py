"""Repetition inside a single document, and a table of quality thresholds compiled into one projection.

Everything is built of Spark's own expressions: no user function, no shuffle, one pass over the text. The words are
hashed, runs of five become one hash each, sorted with their positions; a run whose neighbour in that order is equal
has occurred earlier. That costs n log n for a text of n words, whatever its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 5

#: Frequent words of several languages, by which running text is told from lists and code.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "on", "as", "was", "at"],
    "es": ["el", "la", "de", "que", "y", "en", "un", "una", "los", "las", "se", "por", "con", "para", "es", "del", "no"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "est", "que", "en", "du", "pour", "dans", "pas", "qui", "sur"],
    "de": ["der", "die", "das", "und", "ist", "in", "den", "von", "zu", "mit", "ein", "eine", "nicht", "auf", "es", "im", "für"],
    "it": ["il", "la", "di", "che", "e", "un", "una", "per", "non", "in", "con", "del", "le", "si", "da", "sono", "i"],
    "pt": ["o", "a", "de", "que", "e", "do", "da", "em", "um", "uma", "para", "com", "não", "os", "as", "no", "na"],
}

#: (metric, least, most) that a sound document keeps to; null where a side is open. One row, one rule.
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("n_words", 5, 100_000),
    ("mean_word_length", 3, 10),
    ("symbol_ratio", None, 0.1),
    ("letter_word_ratio", 0.7, None),
    ("stop_word_ratio", 0.02, None),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
    ("repeated_line_ratio", None, 0.3),
    ("repeated_paragraph_ratio", None, 0.3),
    ("repeated_word_ratio", None, 0.3),
]


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def letter_words(text: Column) -> Column:
    """Runs of letters, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit("\\p{L}+"), F.lit(0))


def repeated_words(words: Column, run: int = RUN) -> Column:
    """Number of words that lie in runs of ``run`` or more words that already occurred earlier in the array."""

    def covered(hashes: Column) -> Column:
        last = F.size(hashes) - run + 1
        starts = F.sequence(F.lit(1), last)
        grams = F.transform(starts, lambda i: F.struct(F.xxhash64(*[F.element_at(hashes, i + k) for k in range(run)]).alias("g"), i.alias("i")))

        def of_sorted(s: Column) -> Column:
            pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s)), lambda a, b: F.when(a["g"] == b["g"], b["i"]))
            return let(F.array_sort(F.array_compact(pairs)), of_positions)

        def of_positions(p: Column) -> Column:
            gaps = F.zip_with(F.slice(p, 1, F.greatest(F.lit(0), F.size(p) - 1)), F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(run), b - a))
            return F.when(F.size(p) == 0, 0).otherwise(F.aggregate(gaps, F.lit(run), lambda n, g: n + g))

        return F.when(F.size(hashes) <= run, 0).otherwise(let(F.array_sort(grams), of_sorted))

    return let(F.transform(words, lambda w: F.xxhash64(w)), covered)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def metrics(text: Column) -> dict[str, Column]:
    """Length, symbol, stop-word, line and repetition measures of a text; a null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    tokens = F.filter(F.split(text, "\\s+"), lambda w: w != "")
    n = F.size(tokens)
    lines = F.filter(F.split(text, "\\n+"), lambda x: F.trim(x) != "")
    paragraphs = F.filter(F.split(text, "\\n\\s*\\n"), lambda x: F.trim(x) != "")
    # the language that explains most words counts, whatever the row says it is
    stops = [F.array(*[F.lit(w) for w in ws]) for ws in STOP_WORDS.values()]
    letters = letter_words(text)
    return {
        "n_chars": F.length(text),
        "n_words": n,
        "mean_word_length": _share(F.length(F.array_join(tokens, "")).cast("double"), n),
        "symbol_ratio": _share(F.size(F.regexp_extract_all(text, F.lit("#|\\.\\.\\.|…"), F.lit(0))).cast("double"), n),
        "letter_word_ratio": _share(F.size(F.filter(tokens, lambda w: w.rlike("\\p{L}"))).cast("double"), n),
        "stop_word_ratio": let(letters, lambda ws: F.greatest(*[_share(F.size(F.filter(ws, lambda w: F.array_contains(stop, w))).cast("double"), F.size(ws)) for stop in stops])),
        "bullet_line_ratio": _share(F.size(F.filter(lines, lambda x: x.rlike("^\\s*[-*•]"))).cast("double"), F.size(lines)),
        "ellipsis_line_ratio": _share(F.size(F.filter(lines, lambda x: x.rlike("(?:\\.\\.\\.|…)\\s*$"))).cast("double"), F.size(lines)),
        "repeated_line_ratio": 1.0 - _share(F.size(F.array_distinct(lines)).cast("double"), F.size(lines)) - F.when(F.size(lines) == 0, 1.0).otherwise(0.0),
        "repeated_paragraph_ratio": 1.0 - _share(F.size(F.array_distinct(paragraphs)).cast("double"), F.size(paragraphs)) - F.when(F.size(paragraphs) == 0, 1.0).otherwise(0.0),
        "repeated_word_ratio": let(letters, lambda w: _share(repeated_words(w).cast("double"), F.size(w))),
    }


def quality_profile(df: DataFrame, key: str = "doc_id", text: str = "text", thresholds: list[tuple[str, float | None, float | None]] = THRESHOLDS) -> DataFrame:
    """key, every metric, ``failed`` (the names of the rules a text breaks, in table order) and ``sound``.

    Null and empty texts have no words and break the rules on length; copies of a row are rows of their own; other
    columns are left out, so names may clash.
    """
    rows = df.select(F.col(key).alias(key), *[m.alias(name) for name, m in metrics(F.col(text)).items()])
    broken = []
    for name, least, most in thresholds:
        low = F.lit(False) if least is None else F.col(name) < least
        high = F.lit(False) if most is None else F.col(name) >= most
        broken.append(F.when(low | high, F.lit(name)))
    return rows.withColumn("failed", F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")).withColumn("sound", F.size("failed") == 0)


def breaking(df: DataFrame, rule: str, key: str = "doc_id", text: str = "text", thresholds: list[tuple[str, float | None, float | None]] = THRESHOLDS) -> DataFrame:
    """(key, the rule's metric) of the documents that break a rule of the table; of the table only that row is compiled."""
    profile = quality_profile(df, key, text, [row for row in thresholds if row[0] == rule])
    return profile.filter(F.array_contains("failed", rule)).select(key, rule)
