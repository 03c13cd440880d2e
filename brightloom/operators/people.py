"""People records from several sources: matching, priority, de-duplication, nesting."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.functions.periods import full_years, parse_period
from brightloom.functions.text import filled, infer_provider, normalize_name
from brightloom.operators.ordering import row_numbers
from brightloom.operators.quality import union_all

# File-name patterns and the number of log rows kept.
FORM_FILE = r"(?i)employee\s*form"
CV_FILE = r"(?i)\bcv\b|curriculum\s*vitae"
IDENTITY_FILE = r"(?i)\b(ktp|npwp|kk|birth\s*cert(?:ificate)?|family\s*card|akte|akta)\b"
LOG_ROWS = 2000


@dataclass(frozen=True)
class FieldRule:
    """Sources in order of trust, and what stands in when none has a value."""

    sources: tuple[str, ...]
    default: str | None = None
    default_label: str = "default"


def priority_merge(sources: dict[str, tuple[DataFrame, str]], rules: dict[str, FieldRule]) -> DataFrame:
    """One row per person with each field from its best source and the source's name.

    ``sources`` gives each source's table and its name column. All sources are stacked
    and folded by the normalised name in one shuffle; a person found in any source is in
    the result. A repeated name in one source keeps the largest value of each field.
    """
    stacked = union_all([
        df.select(
            normalize_name(F.col(name)).alias("person"), F.lit(label).alias("_source"),
            *[(filled(F.col(f)) if f in df.columns else F.lit(None).cast("string")).alias(f) for f in rules])
        for label, (df, name) in sources.items()
    ]).filter(F.col("person") != "")
    best = stacked.groupBy("person").agg(*[
        F.max(F.when(F.col("_source") == s, F.col(f))).alias(f"{f}|{s}") for f, r in rules.items() for s in r.sources])
    out = []
    for f, r in rules.items():
        cols = [F.col(f"`{f}|{s}`") for s in r.sources]
        out.append(F.coalesce(*cols, F.lit(r.default)).alias(f))
        label = F.lit(r.default_label)
        for s, c in reversed(list(zip(r.sources, cols))):
            label = F.when(c.isNotNull(), s).otherwise(label)
        out.append(label.alias(f"{f}_source"))
    return best.select("person", *out)


def years_of_experience(df: DataFrame, person: str, period: str, as_of: Column) -> DataFrame:
    """Full years since the earliest readable start; null without any."""
    start = F.min(parse_period(F.col(period)).getField("start_date"))
    return df.groupBy(person).agg(full_years(start, as_of).alias("years"))


def merge_trainings(form: DataFrame, sheet: DataFrame, person: str) -> DataFrame:
    """Form entries before sheet entries; the first of each (name, year) per person stays.

    Both have (person, name, year, pos); the form has ``provider``, the sheet ``output``,
    from which a provider is read. Keeping the first is an aggregate, so a key repeated
    many times is folded before the shuffle.
    """
    year = F.coalesce(F.trim(F.col("year").cast("string")), F.lit(""))
    both = form.select(
        person, "name", year.alias("year"), F.coalesce("provider", F.lit("")).alias("provider"),
        F.lit("training").alias("type"), F.lit(0).alias("src"), "pos",
    ).unionByName(sheet.select(
        person, "name", year.alias("year"), infer_provider(F.col("output")).alias("provider"),
        F.when(F.col("name").rlike("(?i)certif"), "certification").otherwise("training").alias("type"),
        F.lit(1).alias("src"), "pos"))
    first = F.min(F.struct("src", "pos", "name", "provider", "type"))
    return both.groupBy(person, normalize_name(F.col("name")).alias("name_key"), "year").agg(first.alias("f")).select(
        person, "name_key", "year", "f.name", "f.provider", "f.type")


def order_projects(df: DataFrame, person: str, tie: Sequence[str]) -> DataFrame:
    """Position per person: open ones first, then the latest end (or start), then the
    latest start. ``df`` has start_date, end_date, is_ongoing."""
    end = F.when(F.col("is_ongoing"), F.lit("9999-12-31").cast("date")).otherwise(F.coalesce("end_date", "start_date"))
    order = [end.desc_nulls_last(), F.col("start_date").desc_nulls_last(), *[F.col(c) for c in tie]]
    return row_numbers(df, [person], order, "position")


def best_candidates(
    files: DataFrame, owner: str, name: str, kind: str, position: str, native: str,
    form: str = FORM_FILE, cv: str = CV_FILE, identity: str = IDENTITY_FILE,
) -> DataFrame:
    """Best form and best old CV per owner: identity papers are never used, the native
    type beats the others, then the first position."""
    role = F.when(F.col(name).rlike(form), "form").when(F.col(name).rlike(cv), "existing_cv")
    usable = files.filter(~F.col(name).rlike(identity)).withColumn("role", role).filter("role IS NOT NULL")
    rank = F.struct((F.col(kind) != native).cast("int").alias("k"), F.col(position).alias("p"))
    return usable.groupBy(owner, "role").agg(F.min_by(F.struct(name, kind), rank).alias("f")).select(owner, "role", "f.*")


def additive_sync(existing: DataFrame, discovered: DataFrame, name: str, flag: str) -> DataFrame:
    """Append names that are not there yet under their normalised form, unflagged."""
    key = normalize_name(F.col(name))
    fresh = discovered.select(name).withColumn("_k", key).groupBy("_k").agg(F.min(name).alias(name))
    new = fresh.join(existing.select(key.alias("_k")), "_k", "left_anti").select(name, F.lit(False).alias(flag))
    return existing.select(name, flag).unionByName(new)


def run_summary(results: DataFrame) -> DataFrame:
    """Counts by status of a batch whose items carry ``status`` and ``error``; the error
    text is the smallest of each status, the items themselves stay in ``results``."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("items"), F.min("error").alias("first_error"))


def attempt(name: str, source: str, kind: str) -> tuple[Column, Column]:
    """A value read from text as ``kind`` without stopping the batch, and why it failed (null
    if it did not): a text that cannot be read gives null and an error, a null text is null."""
    value = F.col(source).try_cast(kind)
    failed = F.col(source).isNotNull() & value.isNull()
    return value.alias(name), F.when(failed, F.concat(F.lit(f"{name}: cannot read '"), F.col(source), F.lit(f"' as {kind}")))


def run_items(items: DataFrame, item: str, skip: Column, reads: dict[str, tuple[str, str]], required: Sequence[str] = ()) -> DataFrame:
    """The log of a batch run, one row per item: its name, SUCCESS, FAILED or SKIPPED, the
    error, and what was read. ``reads`` is {name: (text column, type)}; all errors of an item
    are told, in that order, and so is every required value that is not there. One bad item
    never stops the others; a failed or skipped one has no values."""
    tries = {name: attempt(name, source, kind) for name, (source, kind) in reads.items()}
    absent = [F.when(F.col(reads[name][0]).isNull(), F.lit(f"{name}: missing")) for name in required]
    error = F.nullif(F.concat_ws("; ", *[e for _, e in tries.values()], *absent), F.lit(""))
    skipped = F.coalesce(skip, F.lit(False))
    logged = items.select(F.col(item), F.when(~skipped, error).alias("error"), skipped.alias("_skipped"), *[v for v, _ in tries.values()])
    status = F.when(F.col("_skipped"), "SKIPPED").when(F.col("error").isNotNull(), "FAILED").otherwise("SUCCESS")
    return logged.withColumn("status", status).select(
        item, "status", "error", *[F.when(F.col("status") == "SUCCESS", F.col(name)).alias(name) for name in reads])


def retain_newest(df: DataFrame, order: Sequence[Column], rows: int = LOG_ROWS) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def detect_groups(headers: Sequence[str], anchor: str, fields: dict[str, str], stop: str | None = None) -> list[dict[str, int]]:
    """Column positions of each repeating group: a group starts at a header matching the
    anchor and ends before the next one, or before the first header matching ``stop``."""
    starts = [i for i, h in enumerate(headers) if re.search(anchor, h, re.I)]
    ends = [*starts[1:], len(headers)]
    if stop is not None and starts:
        stops = [i for i, h in enumerate(headers) if re.search(stop, h, re.I)]
        ends[-1] = next((i for i in stops if i > starts[-1]), len(headers))
    groups = []
    for a, b in zip(starts, ends):
        found = {}
        for f, pattern in fields.items():
            hit = next((i for i in range(a, b) if re.search(pattern, headers[i], re.I)), None)
            if hit is not None:
                found[f] = hit
        groups.append(found)
    return groups


def unpivot_groups(df: DataFrame, ids: Sequence[str], groups: Sequence[dict[str, int]], name: str = "name") -> DataFrame:
    """One row per filled group; a group without a name is empty. Positions refer to
    ``df.columns``; fields a group lacks are null."""
    fields = list(dict.fromkeys(f for g in groups for f in g))
    cols = df.columns
    rows = [
        F.struct(F.lit(n + 1).alias("group_no"), *[
            (filled(F.col(f"`{cols[g[f]]}`")) if f in g else F.lit(None).cast("string")).alias(f) for f in fields])
        for n, g in enumerate(groups)
    ]
    return df.select(*ids, F.inline(F.array(*rows))).filter(F.col(name).isNotNull())


def select_nested(
    df: DataFrame, projects: Sequence[str] | None = None, skills: Sequence[str] | None = None, trainings: Sequence[str] | None = None
) -> DataFrame:
    """Keep chosen entries of the nested lists; skill groups left empty are dropped. A
    choice of None keeps the list as it is."""
    def chosen(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    out = df
    if projects is not None:
        out = out.withColumn("projects", F.filter("projects", lambda p: F.array_contains(chosen(projects), p["name"])))
    if trainings is not None:
        out = out.withColumn("trainings", F.filter("trainings", lambda p: F.array_contains(chosen(trainings), p["name"])))
    if skills is not None:
        kept = F.transform("skills", lambda g: F.struct(
            g["category"].alias("category"),
            F.filter(g["values"], lambda v: F.array_contains(chosen(skills), v)).alias("values")))
        out = out.withColumn("skills", F.filter(kept, lambda g: F.size(g["values"]) > 0))
    return out


def flatten_skills(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.explode("skills").alias("g")).select(key, "g.category", F.explode("g.values").alias("skill"))
