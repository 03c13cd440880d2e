"""Column rules for the sales domain."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Product categories and their keywords, tried in this order.
PRODUCT_RULES: list[tuple[str, list[str]]] = [
    ("POSTAGE", ["postage"]),
    ("BAGS", ["bag"]),
    ("HOMEWARE", ["holder", "box", "sign", "clock", "frame", "rack"]),
    ("DECOR", ["heart", "decoration", "garland", "candle", "light"]),
    ("KITCHEN", ["kitchen", "cake", "mug", "teapot", "plate", "bowl"]),
    ("STATIONERY", ["card", "paper", "pencil", "notebook", "wrap"]),
    ("APPAREL", ["jumbo", "shirt", "scarf", "hat"]),
]


def keyword_category(
    text: Column, rules: Sequence[tuple[str, Sequence[str]]] = PRODUCT_RULES, default: str = "OTHER"
) -> Column:
    """First rule with any keyword inside the lower-cased text."""
    low = F.lower(text)
    hits = [
        F.when(low.rlike("|".join(re.escape(w) for w in words)), F.lit(label))
        for label, words in rules
    ]
    return F.coalesce(*hits, F.lit(default))


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")
