"""Data-quality checks. Each returns a result table (one row per check, column or
violation); ``raise_on`` turns violations into an error. Row-level inputs are read once
per check and leave as small aggregates."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.ordering import quantiles
from brightloom.session import shared_dir


class QualityError(ValueError):
    """A check failed; the message says how many findings there are and where all of them are."""


def raise_on(violations: DataFrame, title: str) -> None:
    """Raise if there is any violation. All are written to the shared folder; the message has
    their exact number, that place and, to read at once, the first few."""
    path = f"{shared_dir(violations.sparkSession)}/violations-{uuid.uuid4().hex}"
    violations.write.parquet(path)
    found = violations.sparkSession.read.schema(violations.schema).parquet(path)
    if n := found.count():
        first = "\n".join(f"  - {r}" for r in found.take(20))
        raise QualityError(f"{title}: {n} findings, all in {path}; the first:\n{first}")


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise QualityError(f"missing columns: {missing}")


def long_row(one_row: DataFrame, columns: Sequence[str], name: str, value: str, ids: Sequence[str] = ()) -> DataFrame:
    """Turn the columns of a one-row aggregate into rows."""
    return one_row.unpivot(list(ids), list(columns), name, value)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return long_row(counts, columns, "column_name", "null_count")


def _blank(df: DataFrame, c: str) -> Column:
    empty = F.col(c).isNull()
    kind = dict(df.dtypes)[c]
    if kind == "string":
        return empty | F.col(c).rlike(r"^\s*$")
    return empty | F.isnan(c) if kind in ("double", "float") else empty


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percent per column; blank text counts as missing."""
    cols = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(_blank(df, c)).alias(c) for c in cols]
    )
    pct = F.when(F.col("_n") > 0, F.round(F.col("missing_count") * 100.0 / F.col("_n"), 2))
    return long_row(counts, cols, "column_name", "missing_count", ["_n"]).select(
        "column_name", "missing_count", pct.alias("missing_pct")
    )


def duplicate_keys(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows beyond the first per key, one output row per table."""
    return union_all([
        df.groupBy(*keys).count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))
        .select(F.lit(name).alias("check_name"), "duplicates")
        for name, (df, keys) in tables.items()
    ])


def duplicate_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    cols = [c for c in df.columns if c not in ignore]
    return duplicate_keys({"rows": (df, cols)}).select(F.col("duplicates").alias("duplicate_rows"))


def missing_references(fact: DataFrame, refs: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Distinct fact keys without a member: ``{name: (fact column, dimension, its key)}``."""
    return union_all([
        fact.select(F.col(col).alias("_k")).distinct()
        .join(dim.select(F.col(key).alias("_k")).distinct(), "_k", "left_anti")
        .agg(F.count(F.lit(1)).alias("missing_keys"))
        .select(F.lit(name).alias("reference"), "missing_keys")
        for name, (col, dim, key) in refs.items()
    ])


def orphans(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no member; null keys are orphans too."""
    return fact.join(dim.select(F.col(key).alias(column)), column, "left_anti")


def warehouse_suite(
    fact: DataFrame, refs: dict[str, tuple[str, DataFrame, str]], key: Sequence[str],
    measures: Sequence[str],
) -> DataFrame:
    """Named values with a verdict: fact rows must exist, everything else must be 0."""
    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("check_name"), F.col("value").cast("long").alias("value"))

    n = F.count(F.lit(1)).alias("value")
    any_null = reduce(lambda a, b: a | b, [F.col(m).isNull() for m in measures])
    whole = fact.agg(F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("nulls")).select(F.inline(F.array(
        F.struct(F.lit("fact rows").alias("check_name"), F.col("rows").alias("value")),
        F.struct(F.lit("null measures").alias("check_name"), F.col("nulls").alias("value")))))
    parts = [
        whole,
        *[named(orphans(fact, c, dim, k).agg(n), f"missing {name}") for name, (c, dim, k) in refs.items()],
        named(fact.groupBy(*key).count().filter("count > 1").agg(n), "duplicate facts"),
    ]
    ok = F.when(F.col("check_name") == "fact rows", F.col("value") > 0).otherwise(F.col("value") == 0)
    return union_all(parts).withColumn("ok", ok)


def contract_violations(df: DataFrame, dataset: str, contract: dict) -> DataFrame:
    """All violations of one contract as rows.

    ``contract``: ``{"required_columns": [...], "validation": {column: {min, max,
    unique_count_min, unique_count_max}}}``. Distinct counts need a shuffle and are only
    computed for the columns that ask for them.
    """
    missing = [c for c in contract["required_columns"] if c not in df.columns]
    rules = {c: r for c, r in contract.get("validation", {}).items() if c in df.columns}
    aggs, checks = [F.count(F.lit(1)).alias("_rows")], []
    if not missing:
        checks.append((F.col("_rows") == 0, F.lit("no rows")))
    for c, r in rules.items():
        num = F.expr(f"try_cast(`{c}` AS DOUBLE)")
        if "unique_count_min" in r or "unique_count_max" in r:
            aggs.append(F.count_distinct(F.col(c)).alias(f"{c}:distinct"))
            seen = F.col(f"`{c}:distinct`")
            if "unique_count_min" in r:
                checks.append((seen < r["unique_count_min"],
                               F.format_string(f"{c}: %d distinct values, minimum {r['unique_count_min']}", seen)))
            if "unique_count_max" in r:
                checks.append((seen > r["unique_count_max"],
                               F.format_string(f"{c}: %d distinct values, maximum {r['unique_count_max']}", seen)))
        if "min" in r or "max" in r:
            aggs += [
                F.min(num).alias(f"{c}:min"), F.max(num).alias(f"{c}:max"),
                F.count_if(F.col(c).isNull()).alias(f"{c}:null"),
                F.count_if(num.isNull()).alias(f"{c}:nonnum"),
            ]
            checks.append(((F.col(f"`{c}:nonnum`") > 0) & (F.col(f"`{c}:null`") == 0),
                           F.lit(f"{c}: non-numeric values")))
            if "min" in r:
                checks.append((F.col(f"`{c}:min`") < r["min"], F.lit(f"{c}: below {r['min']}")))
            if "max" in r:
                checks.append((F.col(f"`{c}:max`") > r["max"], F.lit(f"{c}: above {r['max']}")))
    texts = [F.lit(f"missing column {c}") for c in missing]
    texts += [F.when(bad, text) for bad, text in checks]
    found = F.array_compact(F.array(*texts)) if texts else F.array().cast("array<string>")
    return df.agg(*aggs).select(
        F.lit(dataset).alias("dataset"), F.explode(found).alias("violation")
    )


def contract_batch(datasets: dict[str, tuple[DataFrame, dict]]) -> DataFrame:
    """Pass or fail per dataset with the number of violations."""
    found = union_all([contract_violations(df, name, c) for name, (df, c) in datasets.items()])
    names = found.sparkSession.createDataFrame([(n,) for n in datasets], "dataset string")
    per = found.groupBy("dataset").agg(F.count(F.lit(1)).alias("violations"))
    return names.join(per, "dataset", "left").select(
        "dataset", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"),
        F.when(F.col("violations").isNull(), "pass").otherwise("fail").alias("status"),
    )


def merged_table_violations(
    df: DataFrame, entity: str, expected: int, ranges: dict[str, tuple[float, float]]
) -> DataFrame:
    """Duplicate entities, wrong entity count, values out of range (nulls are fine)."""
    present = {c: r for c, r in ranges.items() if c in df.columns}
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_distinct(entity).alias("_d")]
    aggs += [F.count_if(~F.col(c).between(lo, hi)).alias(f"_{c}") for c, (lo, hi) in present.items()]
    texts = [
        F.when(F.col("_n") > F.col("_d"), F.lit(f"duplicate {entity}")),
        F.when(F.col("_n") != expected, F.format_string(f"expected {expected} rows, got %d", "_n")),
        *[F.lit(f"missing column {c}") for c in ranges if c not in present],
        *[F.when(F.col(f"_{c}") > 0, F.lit(f"{c}: outside {lo} to {hi}")) for c, (lo, hi) in present.items()],
    ]
    return df.agg(*aggs).select(F.explode(F.array_compact(F.array(*texts))).alias("violation"))


def invalid_categories(df: DataFrame, allowed: dict[str, Sequence[str]]) -> DataFrame:
    """Distinct values outside the allowed list, with their counts."""
    cols = [c for c in allowed if c in df.columns]
    per_value = union_all([
        df.filter(F.col(c).isNotNull() & ~F.col(c).cast("string").isin(list(allowed[c])))
        .groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(c).alias("column_name"), "value", "rows")
        for c in cols
    ])
    return per_value


def impossible_values(df: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Per column its min and max and the limit it breaks, the lower one first."""
    aggs = [f(F.col(c).cast("double")).alias(f"{c}:{n}") for c in limits for n, f in (("min", F.min), ("max", F.max))]
    rows = []
    for c, (lo, hi) in limits.items():
        mn, mx = F.col(f"`{c}:min`"), F.col(f"`{c}:max`")
        verdict = F.when(mn < lo, F.lit("below minimum")) if lo is not None else F.when(F.lit(False), "")
        if hi is not None:
            verdict = verdict.when(mx > hi, F.lit("above maximum"))
        rows.append(F.struct(F.lit(c).alias("column_name"), mn.alias("min_value"), mx.alias("max_value"),
                             verdict.otherwise("ok").alias("verdict")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def label_balance(df: DataFrame, label: str) -> DataFrame:
    per = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.sum("n")).scalar()
    return per.withColumn("pct", F.round(F.col("n") * 100.0 / total, 2))


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """Values beyond 1.5 interquartile ranges from the quartiles."""
    edges = quantiles(df, column, {"q1": 0.25, "q3": 0.75}).select(
        F.struct(
            (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("low"),
            (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("high"),
        )
    ).scalar()
    b = df.select(F.col(column).cast("double").alias("v"), edges.alias("b"))
    return b.agg(
        F.count_if((F.col("v") < F.col("b.low")) | (F.col("v") > F.col("b.high"))).alias("outliers"),
        F.count(F.lit(1)).alias("n"), F.max("b.low").alias("low"), F.max("b.high").alias("high"),
    ).select(
        F.lit(column).alias("column_name"), "outliers",
        F.round(F.col("outliers") * 100.0 / F.col("n"), 2).alias("outlier_pct"),
        F.round("low", 2).alias("low"), F.round("high", 2).alias("high"),
    )


def conflicting_keys(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys with more than one distinct value tuple; they are reported, not removed."""
    return (
        df.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("variants"), F.sum("_rows").alias("rows"))
        .filter("variants > 1")
    )


def drop_exact_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(columns))


def join_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each key with the side(s) it occurs on."""
    l = left.select(key).distinct().withColumn("_l", F.lit(True))
    r = right.select(key).distinct().withColumn("_r", F.lit(True))
    side = (
        F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only").otherwise("right_only")
    )
    return l.join(r, key, "full_outer").select(key, side.alias("side"))


def require_both_sides(left: DataFrame, right: DataFrame, key: str) -> None:
    raise_on(join_sides(left, right, key).filter("side <> 'both'"), "one-sided keys")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
