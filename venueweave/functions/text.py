"""Text folding and normalising as built-in column expressions (no Python in the plan)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words left out of a normalised venue name.
NAME_STOP_WORDS = ["the", "inc", "llc", "corp", "co", "ltd", "nyc", "ny", "restaurant", "rest"]

# Street words and their short forms.
STREET_WORDS = {
    "west": "w",
    "east": "e",
    "north": "n",
    "south": "s",
    "avenue": "ave",
    "av": "ave",
    "street": "st",
    "boulevard": "blvd",
    "place": "pl",
    "square": "sq",
    "road": "rd",
    "drive": "dr",
    "lane": "ln",
    "parkway": "pkwy",
    "terrace": "ter",
    "court": "ct",
    "plaza": "plz",
    "saint": "st",
}


def _accent_table() -> tuple[str, str]:
    """Letters whose compatibility decomposition starts with one ASCII character and goes on with marks only."""
    source, target = [], []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        parts = unicodedata.normalize("NFKD", chr(code))
        if ord(parts[0]) < 128 and all(unicodedata.combining(mark) for mark in parts[1:]):
            source.append(chr(code))
            target.append(parts[0])
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def replace_all(c: Column | str, *rules: tuple[str, str]) -> Column:
    """Regular-expression replacements applied in turn."""
    return reduce(lambda out, rule: F.regexp_replace(out, F.lit(rule[0]), F.lit(rule[1])), rules, col(c))


def strip_accents(c: Column | str) -> Column:
    return F.translate(col(c), _ACCENTED, _PLAIN)


def fold_ascii(c: Column | str) -> Column:
    """Apostrophes dropped, accents removed, what is left beyond ASCII dropped, lower case. Null stays null."""
    return F.lower(replace_all(strip_accents(replace_all(c, ("[’']", ""))), ("[^\\x00-\\x7F]", "")))


def fold_text(c: Column | str) -> Column:
    """``fold_ascii`` of a plain column; texts that are ASCII already are spared the search for accents."""
    text = col(c)
    return F.when(F.octet_length(text) == F.length(text), F.lower(F.replace(text, F.lit("'"), F.lit("")))).otherwise(fold_ascii(text))


def words(c: Column | str) -> Column:
    """The blank-separated words of a text; an empty array for a blank or null one."""
    parts = F.split(F.trim(replace_all(F.coalesce(col(c), F.lit("")), ("\\s+", " "))), " ")
    return F.filter(parts, lambda w: w != "")


def norm_name(c: Column | str) -> Column:
    """Venue name without store numbers, punctuation and stop words; '' for null."""
    clean = replace_all(fold_text(F.coalesce(col(c), F.lit(""))), ("#\\s*\\d+\\b", " "), ("&", " and "), ("[^a-z0-9 ]+", " "))
    return F.array_join(F.filter(words(clean), lambda w: ~w.isin(NAME_STOP_WORDS)), " ")


def norm_street(c: Column | str) -> Column:
    """Street with ordinals as numbers and street words shortened; '' for null."""
    clean = replace_all(fold_text(F.coalesce(col(c), F.lit(""))), ("[^a-z0-9 ]+", " "), ("\\b(\\d+)(st|nd|rd|th)\\b", "$1"))
    short = F.create_map(*[F.lit(x) for pair in STREET_WORDS.items() for x in pair])
    return F.array_join(F.transform(words(clean), lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def norm_housenumber(c: Column | str) -> Column:
    """First word of the house number, letters, digits and hyphens only; '' where none is left."""
    return replace_all(F.coalesce(F.try_element_at(words(fold_text(c)), F.lit(1)), F.lit("")), ("[^a-z0-9-]", ""))


def norm_phone(c: Column | str) -> Column:
    """Ten digits, a leading country 1 dropped; '' for anything else."""
    digits = replace_all(F.coalesce(col(c), F.lit("")), ("\\D", ""))
    ten = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    return F.when(F.length(ten) == 10, ten).otherwise("")


def norm_zip(c: Column | str) -> Column:
    """The five leading digits of the trimmed text, or ''."""
    return F.regexp_extract(F.trim(F.coalesce(col(c), F.lit(""))), "^\\d{5}", 0)


def title_case(c: Column | str) -> Column:
    """A capital after every character that is no letter, as in ``Mcsorley'S``."""
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit("(\\p{L}+|\\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substr(r, F.lit(2)))), "")


def strip(c: Column | str) -> Column:
    """Without white space at either end."""
    return replace_all(c, ("^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$", ""))


def norm_quote(c: Column | str) -> Column:
    """Straight quotes, single blanks, lower case, trimmed."""
    return F.lower(F.trim(replace_all(F.translate(col(c), "“”‘’", "\"\"''"), ("\\s+", " "))))


def street_split(c: Column | str) -> tuple[Column, Column]:
    """(house number, street) of a one-line address: the text before the first comma, its leading number apart."""
    line = F.trim(F.split_part(F.coalesce(col(c), F.lit("")), F.lit(","), F.lit(1)))
    number = F.regexp_extract(line, "^(\\d+\\S*)\\s+", 1)
    return number, F.when(number != "", F.regexp_replace(line, "^\\d+\\S*\\s+", "")).otherwise(line)


def url_slug(c: Column | str) -> Column:
    """Last path segment of an address."""
    return F.element_at(F.split(F.regexp_replace(col(c), "/+$", ""), "/"), -1)


def content_hash(*columns: Column | str) -> Column:
    """SHA-256 over a canonical JSON array of the columns; null and '' differ."""
    return F.sha2(F.to_json(F.array(*[F.coalesce(F.to_json(F.struct(col(c).cast("string").alias("v"))), F.lit("{}")) for c in columns])), 256)
