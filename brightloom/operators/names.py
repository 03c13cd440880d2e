"""Canonical entity names: variant tables, standardising, coverage, crosswalks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.quality import union_all
from brightloom.session import cut

AGGREGATE_CODE = 9999  # Fixed value: the code of the national total, not an entity.


def name_key(name: Column) -> Column:
    return F.lower(F.trim(name))


def build_variants(entities: DataFrame, code: str, name: str, aliases: DataFrame) -> DataFrame:
    """(canonical_name, code, variant) rows: the canonical form, its known aliases, and
    the form without blanks and dots where that differs. ``aliases`` has
    (canonical_name, variant)."""
    canon = entities.filter(F.col(code) != AGGREGATE_CODE).select(
        F.initcap(F.trim(name)).alias("canonical_name"), F.col(code).alias("code"))
    squashed = F.regexp_replace("canonical_name", "[ .]", "")
    return union_all([
        canon.withColumn("variant", F.col("canonical_name")),
        canon.join(aliases, "canonical_name").select("canonical_name", "code", "variant"),
        canon.withColumn("variant", squashed).filter(squashed != F.col("canonical_name")),
    ])


def variant_map(variants: DataFrame, order: str) -> DataFrame:
    """(name_key, canonical_name); for a repeated key the last row wins."""
    return variants.groupBy(name_key(F.col("variant")).alias("name_key")).agg(
        F.max_by("canonical_name", F.struct(order, "canonical_name")).alias("canonical_name"))


def standardize(df: DataFrame, name: str, variants: DataFrame) -> DataFrame:
    """Replace names by their canonical form and drop rows that name no entity."""
    keyed = df.withColumn("name_key", name_key(F.col(name)))
    return keyed.join(variants, "name_key").withColumn(name, F.col("canonical_name")).drop(
        "name_key", "canonical_name")


def standardize_strict(df: DataFrame, name: str, variants: DataFrame) -> DataFrame:
    """As ``standardize``, but an unknown name is an error when read."""
    keyed = df.withColumn("name_key", name_key(F.col(name))).join(variants, "name_key", "left")
    known = F.coalesce("canonical_name", F.raise_error(
        F.concat(F.lit("unknown name: "), F.coalesce(F.col(name), F.lit("null")))).cast("string"))
    return keyed.withColumn(name, known).drop("name_key", "canonical_name")


def unknown_names(df: DataFrame, name: str, variants: DataFrame) -> DataFrame:
    """What ``standardize_strict`` fails on: each unknown spelling and how many rows have it."""
    spelled = df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).withColumn("name_key", name_key(F.col(name)))
    same = spelled["name_key"].eqNullSafe(variants["name_key"]) & spelled["name_key"].isNotNull()
    return spelled.join(variants, same, "left_anti").select(name, "n")


def cleaning_report(df: DataFrame, name: str, variants: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Row counts of a cleaning run: in, not an entity, exact repeats, out. Equal rows
    are folded to one with a count, so a heavily repeated row costs no more than one."""
    matched = df.withColumn("name_key", name_key(F.col(name))).join(variants, "name_key", "left")
    rest = [k for k in keys if k != name]
    folded = matched.groupBy("canonical_name", *rest, *values).agg(F.count(F.lit(1)).alias("copies"))
    hit = F.col("canonical_name").isNotNull()
    out = folded.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.when(~hit, F.col("copies"))), F.lit(0)).alias("rows_not_entity"),
        F.coalesce(F.sum(F.when(hit, F.col("copies") - 1)), F.lit(0)).alias("rows_repeated"),
    )
    return out.withColumn("rows_out", F.col("rows_in") - F.col("rows_not_entity") - F.col("rows_repeated"))


def coverage(df: DataFrame, entity: str, year: str, canonical: DataFrame) -> DataFrame:
    """Entities present and missing against the canonical list, and the years seen. The
    lists hold entity names and years, both bounded by the reference tables."""
    pairs = cut(df.select(entity, year).distinct())
    seen = pairs.select(entity).distinct()
    absent = canonical.select(entity).distinct().join(seen, entity, "left_anti")
    years = pairs.select(year).distinct().agg(F.concat_ws(",", F.sort_array(F.collect_list(F.col(year)))).alias("years_present"))
    missing = absent.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.concat_ws(",", F.sort_array(F.collect_list(entity))).alias("names"))).scalar()
    present = seen.agg(F.count(F.lit(1))).scalar()
    return years.withColumn("_m", missing).select(
        present.alias("n_present"), F.col("_m.n").alias("n_missing"),
        F.col("_m.names").alias("missing_names"), "years_present")


def crosswalk(df: DataFrame, entity: str, own: DataFrame, parents: DataFrame, target: str) -> DataFrame:
    """Own ``target`` where there is one, else that of the parent. ``own`` has
    (entity, target), ``parents`` has (entity, parent_target)."""
    return (
        df.join(own, entity, "left").join(parents, entity, "left")
        .withColumn(target, F.coalesce(F.col(target), F.col("parent_target"))).drop("parent_target")
    )


def latest_value(df: DataFrame, entity: str, year: str, values: Sequence[str], prefix: str) -> DataFrame:
    """Newest row per entity; the first value is named ``prefix``, its year ``<prefix>_year``."""
    names = [prefix, *values[1:]]
    row = F.struct(year, *values)
    return df.groupBy(entity).agg(F.max_by(row, row).alias("_r")).select(
        entity, *[F.col(f"_r.{v}").alias(n) for v, n in zip(values, names)], F.col(f"_r.{year}").alias(f"{prefix}_year"))


def merge_latest(spine: DataFrame, entity: str, datasets: dict[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Left-join the newest values of every dataset to the entity list."""
    out = spine
    for prefix, (df, year, values) in datasets.items():
        out = out.join(latest_value(df, entity, year, values, prefix), entity, "left")
    return out


def last_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """The n newest distinct periods and their range text."""
    newest = df.select(period).distinct().orderBy(F.desc(period)).limit(n)
    return newest.agg(
        F.count(F.lit(1)).alias("periods"),
        F.concat_ws(":", F.min(period).cast("string"), F.max(period).cast("string")).alias("period_range"))
