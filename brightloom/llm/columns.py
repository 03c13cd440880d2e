"""Names for helper columns beside columns of any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spare(docs: DataFrame, *names: str) -> list[str]:
    """The given names, with underscores added until no column of docs has them (Spark's
    names do not tell capitals apart)."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_hash(docs: DataFrame) -> Column:
    """The same number for rows that are equal in all columns."""
    return F.xxhash64(*[docs[f"`{c}`"] for c in docs.columns])
