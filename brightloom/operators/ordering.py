"""Order-dependent results without one fat task.

Ranks, running totals, row numbers and exact quantiles all need a total order.
A plain window puts a whole group in one task, which fails when one key holds a
large share of the rows. Here rows are always cut in range slices of (keys,
order); the slices' totals (one row per key and slice) give each slice its
offset, and only the work inside a slice runs in one task. Spark's own
partitioning decides the number of slices: adaptive execution folds a small
table into one slice, so the plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.session import stage


def _slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows in range slices of (keys, order), written once so that slice ids stay put.

    The random last key spreads rows that are equal in every other key; such rows are
    interchangeable, so it does not change the result.
    """
    spread = (
        df.withColumn("_tie", F.rand(7))
        .repartitionByRange(*[F.col(k) for k in keys], *order, F.col("_tie"))
        .withColumn("_slice", F.spark_partition_id())
    )
    return stage(spread)


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in on:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def _with_offsets(sliced: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Attach, per key, the totals of all earlier slices as ``_before_<name>``."""
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = sliced.groupBy(*keys, "_slice").agg(*[c.alias(n) for n, c in totals.items()])
    offsets = per_slice.select(
        *keys, "_slice",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in totals],
    )
    on = [*keys, "_slice"]
    return sliced.join(offsets, _null_safe(sliced, offsets, on)).select(
        sliced["*"], *[offsets[f"_before_{n}"] for n in totals]
    )


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """1-based position within ``keys`` in ``order``."""
    sliced = _with_offsets(_slices(df, keys, order), keys, {"n": F.count(F.lit(1))})
    w = Window.partitionBy(*keys, "_slice").orderBy(*order, F.col("_tie"))
    return sliced.withColumn(name, F.row_number().over(w) + F.col("_before_n")).drop(
        "_before_n", "_slice", "_tie"
    )


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: dict[str, str], keys: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums ``{new: column}``. Rows must be unique in (keys, order):
    aggregate to distinct order values first. The input is materialised once."""
    sliced = _with_offsets(
        _slices(df, keys, order), keys, {c: F.sum(c) for c in dict.fromkeys(sums.values())}
    )
    w = (
        Window.partitionBy(*keys, "_slice").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    out = sliced.withColumns(
        {new: F.sum(c).over(w) + F.col(f"_before_{c}") for new, c in sums.items()}
    )
    return out.drop("_slice", "_tie", *[f"_before_{c}" for c in set(sums.values())])


def value_ranks(
    df: DataFrame, value: str, keys: Sequence[str] = (), descending: bool = False,
) -> DataFrame:
    """One row per distinct non-null value: ``ties``, ``rank_min``, ``rank_avg`` and the
    group's ``n``. Equal rows are folded into counts before anything is ordered."""
    folded = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("ties"))
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    run = running_totals(folded, [order], {"_upto": "ties"}, keys)
    if keys:
        totals = run.groupBy(*keys).agg(F.sum("ties").alias("n"))
        run = run.join(totals, _null_safe(run, totals, keys)).select(run["*"], totals["n"])
    else:
        run = run.withColumn("n", run.agg(F.sum("ties")).scalar())
    return run.select(
        *keys, value, "ties", "n",
        (F.col("_upto") - F.col("ties") + 1).alias("rank_min"),
        (F.col("_upto") - (F.col("ties") - 1) / 2).alias("rank_avg"),
    )


def quantiles(
    df: DataFrame, value: str, probs: dict[str, float], keys: Sequence[str] = (),
) -> DataFrame:
    """Exact linear-interpolated quantiles ``{name: p}``, one row per key.

    ``percentile`` keeps all distinct values of a group in one buffer; this keeps
    them in slices and picks the two neighbours of each position.
    """
    ranks = value_ranks(df, value, keys)
    first = F.col("rank_min") - 1
    last = F.col("rank_min") + F.col("ties") - 2
    aggs = [F.max("n").alias("n")]
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n") - 1)
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (first <= at) & (at <= last)
            aggs.append(F.max(F.when(hit, F.col(value))).cast("double").alias(f"_{side}_{name}"))
    picked = ranks.groupBy(*keys).agg(*aggs)

    def between(name: str, p: float) -> Column:
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (lo + (hi - lo) * (pos - F.floor(pos))).alias(name)

    return picked.select(*keys, "n", *[between(n, p) for n, p in probs.items()])
