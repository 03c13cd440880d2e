"""Free-text periods such as "Mar 2017 – Now"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names of both languages and the words for an open end.
MONTHS = {
    1: ["januari", "january", "jan"], 2: ["februari", "february", "feb"], 3: ["maret", "march", "mar"],
    4: ["april", "apr"], 5: ["mei", "may"], 6: ["juni", "june", "jun"], 7: ["juli", "july", "jul"],
    8: ["agustus", "august", "agu", "ags", "aug"], 9: ["september", "sep", "sept"],
    10: ["oktober", "october", "okt", "oct"], 11: ["november", "nov"], 12: ["desember", "december", "des", "dec"],
}
ONGOING = r"(?i)\b(now|present|sekarang|current|ongoing)\b"
SEPARATOR = r"\s*[–—]\s*|\s+-\s+"


def _month(name: Column) -> Column:
    entries = [x for number, names in MONTHS.items() for n in names for x in (F.lit(n), F.lit(number))]
    return F.try_element_at(F.create_map(*entries), name)


def parse_date(token: Column) -> Column:
    """A year, a month with a year, or an ISO date; else null."""
    t = F.lower(F.trim(token))
    year = F.regexp_extract(t, r"^(\d{4})$", 1).try_cast("int")
    month = _month(F.regexp_extract(t, r"^([a-z]+)\.?\s+\d{4}$", 1))
    month_year = F.regexp_extract(t, r"^[a-z]+\.?\s+(\d{4})$", 1).try_cast("int")
    return F.coalesce(
        F.when(year.isNotNull(), F.make_date(year, F.lit(1), F.lit(1))),
        F.when(month.isNotNull(), F.make_date(month_year, month, F.lit(1))),
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), t.substr(1, 10).try_cast("date")),
    )


def parse_period(text: Column) -> Column:
    """struct(start_date, end_date, is_ongoing). An end without a year takes the first
    year in the text."""
    s = F.trim(F.coalesce(text, F.lit("")))
    parts = F.split(F.regexp_replace(s, SEPARATOR, " | "), r"\|")
    first, second = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    ongoing = F.coalesce(second.rlike(ONGOING), F.lit(False))
    borrowed = parse_date(F.concat_ws(" ", second, F.nullif(F.regexp_extract(s, r"\b(\d{4})\b", 1), F.lit(""))))
    end = F.when(~ongoing, F.coalesce(parse_date(second), borrowed))
    return F.struct(parse_date(first).alias("start_date"), end.alias("end_date"), ongoing.alias("is_ongoing"))


def full_years(start: Column, as_of: Column) -> Column:
    """Whole years of 365.25 days; null without a start."""
    return F.floor(F.datediff(as_of, start) / 365.25)
