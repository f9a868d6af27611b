"""Parts of a postal address out of house number, street and zip, whichever field they stand in (built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueweave.functions.text import col, fold_ascii, replace_all

#: Street types with the ways they are written.
STREET_TYPES = {
    "st": ["street", "st", "str", "strt"],
    "ave": ["avenue", "ave", "av", "avn", "aven"],
    "sq": ["square", "sq", "sqr"],
    "blvd": ["boulevard", "blvd", "blv", "boul"],
    "pl": ["place", "pl", "plc"],
    "rd": ["road", "rd"],
    "ln": ["lane", "ln", "la"],
    "ter": ["terrace", "ter", "terr"],
    "plz": ["plaza", "plz", "plza"],
    "ct": ["court", "ct", "crt"],
    "pkwy": ["parkway", "pkwy", "pky", "pkway"],
    "dr": ["drive", "dr", "drv"],
    "hwy": ["highway", "hwy"],
    "way": ["way"],
    "aly": ["alley", "aly"],
}
DIRECTIONS = {"n": ["n", "north"], "s": ["s", "south"], "e": ["e", "east"], "w": ["w", "west"]}

_UNITS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth"]
_TEENS = ["tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth"]
_TENS = ["twent", "thirt", "fort", "fift", "sixt", "sevent", "eight", "ninet"]
#: Ordinal words up to ninety-ninth, as the one word the tokens are joined to.
ORDINALS = (
    {w: i + 1 for i, w in enumerate(_UNITS)}
    | {w: i + 10 for i, w in enumerate(_TEENS)}
    | {t + "ieth": 10 * (i + 2) for i, t in enumerate(_TENS)}
    | {t + "y" + u: 10 * (i + 2) + k + 1 for i, t in enumerate(_TENS) for k, u in enumerate(_UNITS)}
)


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


_TYPE_OF = {form: kind for kind, forms in STREET_TYPES.items() for form in forms}
_TYPE_WORDS = "|".join(_TYPE_OF)
_WAY_WORDS = "|".join(form for forms in DIRECTIONS.values() for form in forms)
_UNIT = (
    "[,\\s]+(?:fl|floor|ste|suite|unit|apt|room|rm)\\b\\.?\\s*#?\\s*[a-z0-9]+\\s*$"
    "|[,\\s]+\\d+(?:st|nd|rd|th)\\s+(?:floor|fl)\\b\\.?\\s*$"
    "|[,\\s]+#\\s*[a-z0-9]+\\s*$"
    "|[,\\s]+(?:rear|front|upstairs|basement)\\s*$"
)
_NUMBER = "^\\s*(?:no\\.?\\s*|nr\\.?\\s*|#\\s*)?0*(\\d+(?:-\\d+)?)\\s*-?\\s*([a-z]?)\\s*$"
_ZIP = "(?:^|[,\\s]+)(\\d{5})(?:-\\d{4})?\\s*$"


def stated_number(c: Column | str) -> Column:
    """House number with its letter out of its own field, '' where that states none."""
    stated = F.coalesce(col(c), F.lit(""))
    shown = F.lower(fold_ascii(stated))
    return F.when(stated.rlike("^[1-9][0-9]*$"), stated).when(F.trim(stated) == "", "").otherwise(F.concat(F.regexp_extract(shown, _NUMBER, 1), F.regexp_extract(shown, _NUMBER, 2)))


def stated_zip(c: Column | str) -> Column:
    """Zip out of its own field, '' where that states none."""
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), "(\\d{5})", 1)


def with_address(df: DataFrame, housenumber: str = "housenumber", street: str = "street", zip_: str = "zip", prefix: str = "a_") -> DataFrame:
    """Adds number (with its letter), direction, base name, type and zip, each '' where it is not stated.

    The number may stand in the street (before or behind the name), the zip at the end of the street; floors, suites
    and units are dropped; ordinals become numbers; '216-A', '106 A', '#10' and '0168A' lose their trimmings. A filter
    on the result is best put behind a written table: pushed down, it would parse every row twice.
    """
    s, n, t = f"{prefix}s", f"{prefix}n", f"{prefix}t"
    # most rows need none of the costly rewriting: each step is guarded by a cheap test
    text = F.coalesce(col(street), F.lit(""))
    folded = F.when(text.rlike("[^ A-Za-z0-9.,#-]"), F.lower(fold_ascii(text))).otherwise(F.lower(text))
    folded = F.when(folded.contains("("), replace_all(folded, ("\\([^)]*\\)", " "))).otherwise(folded)
    df = df.withColumn(s, folded).withColumn(f"{prefix}zs", F.when(F.col(s).rlike("\\d\\s*$"), F.regexp_extract(s, _ZIP, 1)).otherwise(""))
    simple = F.col(f"{prefix}p")
    df = df.withColumn(f"{prefix}p", F.col(s).rlike("^[a-z]* ?[a-z]*[.]?$"))
    df = df.withColumn(s, F.when(F.col(f"{prefix}zs") != "", replace_all(s, ("\\bny\\s+\\d{5}(?:-\\d{4})?\\s*$", " "), (_ZIP, " "))).otherwise(F.col(s)))
    df = df.withColumn(t, F.when(simple, F.rtrim(F.translate(F.col(s), ".", ""))).otherwise(replace_all(s, (_UNIT, " "))))
    unit = F.when(F.col(t) != F.col(s), replace_all(t, (_UNIT, " "))).otherwise(F.col(t))
    df = df.withColumn(s, F.trim(F.when(simple, F.col(t)).otherwise(replace_all(unit, ("[^a-z0-9 ]+", " "), ("\\s+", " ")))))
    df = df.withColumn(n, stated_number(housenumber))
    front = f"^0*(\\d+)([a-z]?) (?!(?:{_TYPE_WORDS})\\b)(?=.*[a-z0-9])"
    back = " 0*(\\d+)([a-z]?)$"
    seek = F.col(n) == ""
    df = df.withColumn(f"{prefix}l", F.when(seek & F.col(s).rlike(front), replace_all(s, (front + ".*$", "$1$2"))).otherwise(""))
    df = df.withColumn(f"{prefix}k", F.when(seek & (F.col(f"{prefix}l") == "") & F.col(s).rlike(back), replace_all(s, ("^.*" + back, "$1$2"))).otherwise(""))
    bare = F.when(F.col(f"{prefix}l") != "", replace_all(s, (front, ""))).when(F.col(f"{prefix}k") != "", replace_all(s, (back, ""))).otherwise(F.col(s))
    df = df.withColumns({s: bare, n: F.concat(n, f"{prefix}l", f"{prefix}k")})
    joined = replace_all(s, ("\\b(\\d+)(?:st|nd|rd|th)\\b", "$1"), (f"\\b({'|'.join(t + 'y' for t in _TENS)}) ({'|'.join(_UNITS)})\\b", "$1$2"))
    ordinals = _lookup({k: str(v) for k, v in ORDINALS.items()})
    spelt = F.array_join(F.transform(F.split(joined, " "), lambda w: F.coalesce(F.try_element_at(ordinals, w), w)), " ")
    df = df.withColumn(t, F.when(F.col(s).rlike("(?:th|first|second|third)\\b"), spelt).when(F.col(s).rlike("\\d"), joined).otherwise(F.col(s)))
    # the last type that isn't the first word; the first direction; what is left is the name
    types = _lookup(_TYPE_OF)
    last = F.substring_index(t, " ", -1)
    df = df.withColumn(f"{prefix}p", F.col(t).rlike("^[a-z]{3,} [a-z]+$") & ~F.col(t).rlike(f"^(?:{_WAY_WORDS}) | (?:{_WAY_WORDS})$"))
    plain = F.col(f"{prefix}p")
    found = F.regexp_extract(t, f" ({_TYPE_WORDS})(?= |$)(?!.* (?:{_TYPE_WORDS})(?: |$))", 1)
    several = F.instr(t, " ") > 0
    df = df.withColumn(f"{prefix}type", F.when(~several, "").when(plain, F.coalesce(F.try_element_at(types, last), F.lit(""))).otherwise(F.coalesce(F.try_element_at(types, found), F.lit(""))))
    base = F.trim(replace_all(t, (f" (?:{_TYPE_WORDS})(?= |$)", ""), (f"(?:^| )(?:{_WAY_WORDS})(?= |$)", "")))
    base = F.when(~several | (plain & (F.col(f"{prefix}type") == "")), F.col(t)).when(plain, F.substring_index(t, " ", 1)).when(base != "", base).otherwise(F.col(t))
    way = F.when(several & ~plain, F.substring(F.regexp_extract(t, f"(?:^| )({_WAY_WORDS})(?= |$)", 1), 1, 1)).otherwise("")
    zip_own = stated_zip(zip_)
    return df.withColumns(
        {f"{prefix}number": F.col(n), f"{prefix}way": way, f"{prefix}base": base, f"{prefix}zip": F.when(zip_own != "", zip_own).otherwise(F.col(f"{prefix}zs"))}
    ).drop(s, n, t, f"{prefix}zs", f"{prefix}l", f"{prefix}k", f"{prefix}p")
