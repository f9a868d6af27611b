"""Reading the real value out of a dirty attribute: phone, web host, date, named cuisine. Null where none is stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from venueweave.functions.text import col, let, replace_all

#: Texts that stand for "no value", compared in lower case without outer blanks.
FILLERS = ["", "-", "--", "?", "n/a", "na", "none", "null", "nil", "tbd", "tba", "unknown", "not listed", "unlisted", "coming soon", "pending", "yes", "no", "other", "x", "."]


def _plain(c: Column | str) -> Column:
    return F.lower(F.trim(replace_all(col(c), ("\\s+", " "))))


def phone_value(c: Column | str) -> Column:
    """Ten digits of a number that can work: no extension, no country code, not one digit repeated, area code 2 to 9."""
    bare = let(F.lower(col(c)), lambda v: F.when(v.rlike("[x#]"), F.regexp_replace(v, "(?:x|ext\\.?|extension|#)\\s*\\d+\\s*$", "")).otherwise(v))
    digits = F.regexp_replace(bare, "[\\s().+/-]+", "")
    return let(digits, lambda d: F.when(d.rlike("^1?[2-9]\\d{9}$") & ~d.rlike("^1?(\\d)\\1{9}$"), F.substring(d, -10, 10)))


def web_host(c: Column | str) -> Column:
    """Lower-case host without scheme, leading www. or path; an e-mail address or a bare scheme is none."""
    text = _plain(c)
    host = replace_all(text, ("^[a-z][a-z0-9+.-]*://", ""), ("[/?#].*$", ""), (":\\d+$", ""), ("^www\\.", ""), ("\\.+$", ""))
    return F.when(~text.contains("@") & host.rlike("^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)*\\.[a-z][a-z0-9-]*$"), host)


def date_value(c: Column | str, first: str = "1990-01-01", last: str = "2026-08-31") -> Column:
    """A date from ``first`` to ``last`` read from ISO (with or without time), yyyymmdd, mm/dd/yyyy or 'd Mon yyyy'."""
    text = F.trim(col(c))
    date = F.coalesce(
        F.when(text.rlike("^\\d{4}-\\d{2}-\\d{2}([T ].*)?$"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")),
        F.when(text.rlike("^\\d{8}$"), F.try_to_date(text, "yyyyMMdd")),
        F.when(text.rlike("^\\d{1,2}/\\d{1,2}/\\d{4}$"), F.try_to_date(text, "M/d/yyyy")),
        F.when(text.rlike("^\\d{1,2} [A-Za-z]{3} \\d{4}$"), F.try_to_date(F.initcap(text), "d MMM yyyy")),
    )
    return F.when((date >= F.lit(first).cast("date")) & (date <= F.lit(last).cast("date")), date)


def cuisine_value(c: Column | str) -> Column:
    """Named cuisine in lower case with single blanks; filler is none."""
    text = F.lower(F.trim(replace_all(col(c), ("[\\s_]+", " "))))
    return F.when(~text.isin(FILLERS) & text.rlike("[a-z]"), text)
