"""Composite index of entities: direction, scaling, dimensions, weights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.session import cut

# Dimensions, directions and default weights of the index.
SOCIO = "socioeconomic_vulnerability"
EDUCATION = "education_access"
SOCIO_COLUMNS = ["poverty_rate", "ipm", "expenditure_per_capita"]
EDUCATION_COLUMN = "participation_rate"
DIRECTIONS = {
    "poverty_rate": "higher_is_worse", "ipm": "higher_is_better",
    "expenditure_per_capita": "higher_is_better", "participation_rate": "higher_is_better",
}
MIN_EXPLAINED = 0.5


@dataclass(frozen=True)
class IndexSpec:
    """How the score is put together. ``columns`` asks for the principal component of
    several indicators, ``indicator`` takes a single one."""

    indicator: str | None = "expenditure_per_capita"
    columns: tuple[str, ...] = ()
    weights: dict[str, float] = field(default_factory=lambda: {SOCIO: 0.5, EDUCATION: 0.5})
    with_education: bool = True


PCA_SPEC = IndexSpec(indicator=None, columns=tuple(SOCIO_COLUMNS))


def align(df: DataFrame, directions: dict[str, str] | None = None) -> DataFrame:
    """Turn every configured column so that higher is worse."""
    spec = DIRECTIONS if directions is None else directions
    absent = [c for c in spec if c not in df.columns]
    unknown = {c: d for c, d in spec.items() if d not in ("higher_is_worse", "higher_is_better")}
    if absent or unknown:
        raise ValueError(f"cannot align: absent columns {absent}, unknown directions {unknown}")
    return df.withColumns({c: -F.col(c) for c, d in spec.items() if d == "higher_is_better"})


def scale_diagnostics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: min, max, present and missing counts."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("double").alias(f"{c}:min"), F.max(c).cast("double").alias(f"{c}:max"),
                 F.count(c).alias(f"{c}:n"), F.count_if(F.col(c).isNull()).alias(f"{c}:null")]
    rows = [
        F.struct(F.lit(c).alias("indicator"), F.col(f"`{c}:min`").alias("min_value"),
                 F.col(f"`{c}:max`").alias("max_value"), F.col(f"`{c}:n`").alias("n_present"),
                 F.col(f"`{c}:null`").alias("n_missing"))
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale present values to 0 … 1; nulls stay null; a constant column is an error."""
    span = df.agg(F.struct(*[
        F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns
    ])).scalar()
    out = df.withColumn("_span", span)
    scaled = {}
    for c in columns:
        lo, hi = F.col(f"_span.{c}.lo"), F.col(f"_span.{c}.hi")
        ok = F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).when(
            hi <= lo, F.raise_error(F.lit(f"{c}: zero variance")).cast("double"))
        scaled[c] = F.when(F.col(c).isNotNull(), ok)
    return out.withColumns(scaled).drop("_span")


def weighted_score(weights: dict[str, float]) -> Column:
    """Weights are rescaled over the dimensions present; no dimension gives null."""
    num, den = F.lit(0.0), F.lit(0.0)
    for d, w in weights.items():
        num = num + F.coalesce(F.col(d) * F.lit(w), F.lit(0.0))
        den = den + F.when(F.col(d).isNotNull(), F.lit(w)).otherwise(0.0)
    return num / F.nullif(den, F.lit(0.0))


def effective_weights(weights: dict[str, float]) -> dict[str, Column]:
    den = F.lit(0.0)
    for d, w in weights.items():
        den = den + F.when(F.col(d).isNotNull(), F.lit(w)).otherwise(0.0)
    return {f"weight_{d}": F.when(F.col(d).isNotNull(), F.lit(w) / den) for d, w in weights.items()}


def completeness(dimensions: Sequence[str]) -> Column:
    absent = F.array_compact(F.array(*[F.when(F.col(d).isNull(), F.lit(d)) for d in dimensions]))
    return F.when(F.size(absent) == 0, "full").otherwise(
        F.concat(F.lit("partial: "), F.array_join(absent, ", "), F.lit(" unavailable")))


def fit_component(df: DataFrame, columns: Sequence[str], min_explained: float = MIN_EXPLAINED) -> dict:
    """First principal component of the complete rows: means, loadings (their sum is
    not negative) and explained share. Only these few numbers reach the driver."""
    complete = cut(df.select(*columns).dropna("any"))
    means = complete.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in columns]).first()
    if not means["_n"]:
        raise ValueError(f"no row is complete in {list(columns)}")
    vectors = VectorAssembler(inputCols=list(columns), outputCol="x").transform(complete)
    model = PCA(k=1, inputCol="x", outputCol="pc").fit(vectors)
    explained = float(model.explainedVariance[0])
    if explained < min_explained:
        raise ValueError(f"first component explains {explained:.3f} of the variance, below {min_explained}")
    loadings = [float(v) for v in model.pc.toArray()[:, 0]]
    sign = -1.0 if sum(loadings) < 0 else 1.0
    return {
        "loadings": {c: sign * v for c, v in zip(columns, loadings)},
        "means": {c: float(means[c]) for c in columns},
        "explained": explained, "n": int(means["_n"]),
    }


def component_score(fit: dict) -> Column:
    """Projection of the centred row; null if any indicator is."""
    out = F.lit(0.0)
    for c, loading in fit["loadings"].items():
        out = out + (F.col(c) - fit["means"][c]) * loading
    return out


def dimension_scores(df: DataFrame, spec: IndexSpec) -> DataFrame:
    """Both dimensions on 0 … 1, higher is worse. The indicator columns are replaced by
    their aligned, scaled form."""
    used = [spec.indicator] if spec.indicator else list(spec.columns)
    if spec.with_education:
        used = [*used, EDUCATION_COLUMN]
    scaled = min_max(align(df, {c: d for c, d in DIRECTIONS.items() if c in df.columns}), used)
    if spec.indicator:
        out = scaled.withColumn(SOCIO, F.col(spec.indicator))
    else:
        frozen = cut(scaled)
        fit = fit_component(frozen, spec.columns)
        out = min_max(frozen.withColumn(SOCIO, component_score(fit)), [SOCIO])
    edu = F.col(EDUCATION_COLUMN) if spec.with_education else F.lit(None).cast("double")
    return out.withColumn(EDUCATION, edu)


def score(df: DataFrame, entity: str, spec: IndexSpec = IndexSpec()) -> DataFrame:
    """One row per entity: dimensions, score, completeness and reach."""
    weights = {d: w for d, w in spec.weights.items() if spec.with_education or d != EDUCATION}
    dims = dimension_scores(df, spec)
    return dims.select(
        entity, SOCIO, EDUCATION, weighted_score(weights).alias("npi"),
        completeness(list(weights)).alias("data_completeness"),
        (F.col("population") * F.col("stunting_rate") / 100).alias("estimated_children_affected"),
        "stunting_rate", "stunting_category",
    )
