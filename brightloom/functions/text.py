"""Text helpers as columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: punctuation that names are compared without.
NAME_PUNCTUATION = r"[.,/#!$%^&*;:{}=\-_`~()]"


@cache
def _accent_table() -> tuple[str, str]:
    """Precomposed lower-case letters and the base letter they decompose to."""
    src, dst = [], []
    for cp in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFD", chr(cp))
        if len(parts) > 1 and all("̀" <= c <= "ͯ" for c in parts[1:]):
            src.append(chr(cp))
            dst.append(parts[0])
    return "".join(src), "".join(dst)


def strip_accents(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, *_accent_table()), "[̀-ͯ]", "")


def normalize_name(name: Column) -> Column:
    """Form in which names are compared: lower case, single blanks, no punctuation or
    accents. A missing name becomes the empty text."""
    low = F.lower(F.coalesce(name.cast("string"), F.lit("")))
    spaced = F.regexp_replace(F.regexp_replace(low, r"^\s+|\s+$", ""), r"\s+", " ")
    return F.trim(strip_accents(F.regexp_replace(spaced, NAME_PUNCTUATION, "")))


def filled(text: Column) -> Column:
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(text.cast("string")), F.lit(""))


def join_non_empty(parts: Sequence[Column], separator: str = "  ") -> Column:
    return F.concat_ws(separator, *[filled(p) for p in parts])


def title_case(text: Column) -> Column:
    """Upper-case the first letter of each word and leave the rest as it is."""
    words = F.split(F.coalesce(text, F.lit("")), "(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])")
    return F.array_join(F.transform(words, lambda w: F.when(
        w.rlike("^[a-z]"), F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))).otherwise(w)), "")


def truncate(text: Column, limit: int) -> Column:
    s = F.coalesce(text, F.lit(""))
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(s.substr(1, limit - 1), F.lit("…")))


def extract_year(text: Column) -> Column:
    """First free-standing four-digit number, or the empty text."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"\b(\d{4})\b", 1)


def month_year(day: Column) -> Column:
    return F.date_format(day, "MMMM, yyyy")


def infer_provider(text: Column) -> Column:
    """Short text without sentence punctuation reads as an organisation; else empty."""
    s = F.trim(F.coalesce(text, F.lit("")))
    return F.when((F.length(s) <= 40) & ~s.rlike("[.!?]"), s).otherwise("")
