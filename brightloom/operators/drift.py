"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators.ordering import quantiles
from brightloom.operators.quality import union_all
from brightloom.session import stage

# Smallest share and the status limits.
EPSILON = 1e-6
WARNING_PSI = 0.10
DRIFT_PSI = 0.25
MISSING = "__MISSING__"


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct quantile edges per numeric feature (equal width where fewer than three).
    At most ``bins + 1`` numbers per feature reach the driver; features without two
    distinct values are left out."""
    probs = {f"q{i}": i / bins for i in range(bins + 1)}
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features]))).filter("v IS NOT NULL")
    out = {}
    for row in quantiles(long, "v", probs, ["feature"]).collect():
        edges = sorted({row[q] for q in probs})
        if len(edges) == 2:
            lo, hi = edges
            edges = [lo + (hi - lo) * i / bins for i in range(bins + 1)]
        if len(edges) >= 3:
            out[row["feature"]] = edges
    return out


def _bin(value: Column, edges: Sequence[float]) -> Column:
    """Index of the right-closed bin; the outer bins are open."""
    out = F.when(value <= edges[1], 0)
    for i, e in enumerate(edges[2:-1], start=1):
        out = out.when(value <= e, i)
    return out.when(value.isNotNull(), len(edges) - 2)


def shares(df: DataFrame, edges: dict[str, list[float]], categorical: Sequence[str]) -> DataFrame:
    """(feature, kind, bucket, share), all features in one pass."""
    rows = [
        F.struct(F.lit(f).alias("feature"), F.lit("numeric").alias("kind"), _bin(F.col(f).cast("double"), e).cast("string").alias("bucket"))
        for f, e in edges.items() if f in df.columns
    ] + [
        F.struct(F.lit(f).alias("feature"), F.lit("categorical").alias("kind"),
                 F.coalesce(F.col(f).cast("string"), F.lit(MISSING)).alias("bucket"))
        for f in categorical if f in df.columns
    ]
    counts = (
        df.select(F.inline(F.array(*rows))).filter("bucket IS NOT NULL")
        .groupBy("feature", "kind", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("feature").agg(F.sum("n").alias("t"))
    return counts.join(totals, "feature").select("feature", "kind", "bucket", (F.col("n") / F.col("t")).alias("share"))


PROFILE = "feature string, kind string, type string, edges array<double>, bucket string, share double"


def save_profile(reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str], path: str) -> None:
    """Write what later batches are compared with, once, to a path that must not exist yet:
    per feature its kind, type, edges, and the share of every bucket."""
    kept = stage(reference.select(*numeric, *categorical))
    edges = bin_edges(kept, numeric)
    types = F.create_map(*[F.lit(x) for f in kept.schema for x in (f.name, f.dataType.simpleString())])
    known = F.create_map(*[x for f, e in edges.items() for x in (F.lit(f), F.array(*[F.lit(v) for v in e]))]) if edges else F.lit(None).cast("map<string,array<double>>")
    rows = shares(kept, edges, categorical).withColumns({"type": types[F.col("feature")], "edges": F.try_element_at(known, F.col("feature"))})
    rows.select("feature", "kind", "type", "edges", "bucket", "share").write.mode("errorifexists").parquet(path)


class Profile:
    """A written profile: shares and edges of its features."""

    def __init__(self, spark: SparkSession, path: str):
        self.shares = spark.read.schema(PROFILE).parquet(path)
        found = self.shares.groupBy("feature", "kind").agg(F.first("edges").alias("edges")).collect()  # a row a feature
        self.edges = {r["feature"]: list(r["edges"]) for r in found if r["kind"] == "numeric"}
        self.categorical = [r["feature"] for r in found if r["kind"] == "categorical"]

    def of(self, batch: DataFrame) -> DataFrame:
        """The batch's shares of the profile's buckets, in one scan."""
        return shares(batch, self.edges, self.categorical)

    def compare(self, batch: DataFrame, expected: dict[str, str] | None = None) -> DataFrame:
        """``psi`` of a batch; a column that is there but all null has drifted."""
        return psi(self.shares.select("feature", "kind", "bucket", "share"), self.of(batch), expected, batch.columns)


def psi(
    reference: DataFrame, current: DataFrame, expected: dict[str, str] | None = None, present: Sequence[str] = (),
) -> DataFrame:
    """Stability index and status per feature. ``expected`` ({feature: kind}) names the
    features that must be there; absent ones get status ``missing``. ``present`` names the
    current table's columns: a column that is there but all null has drifted, not gone."""
    r, c = reference.alias("r"), current.alias("c")
    both = r.join(c, ["feature", "kind", "bucket"], "full_outer").select(
        "feature", "kind", F.greatest(F.coalesce("r.share", F.lit(0.0)), F.lit(EPSILON)).alias("e"),
        F.greatest(F.coalesce("c.share", F.lit(0.0)), F.lit(EPSILON)).alias("a"),
        (F.col("c.share").isNotNull() | F.col("feature").isin(list(present))).alias("seen"))
    per = both.groupBy("feature", "kind").agg(
        F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi"), F.max("seen").alias("seen"))
    status = F.when(~F.col("seen"), "missing").when(F.col("psi") >= DRIFT_PSI, "drift").when(
        F.col("psi") >= WARNING_PSI, "warning").otherwise("stable")
    out = per.select("feature", "kind", F.when(F.col("seen"), F.round("psi", 6)).alias("psi"), status.alias("status"))
    if expected:
        known = out.sparkSession.createDataFrame(list(expected.items()), "feature string, kind string")
        absent = known.join(out, ["feature", "kind"], "left_anti").select(
            "feature", "kind", F.lit(None).cast("double").alias("psi"), F.lit("missing").alias("status"))
        out = union_all([out, absent])
    return out


def unseen(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Categories of the current table that the reference never had."""
    cat = "kind = 'categorical'"
    return current.filter(cat).join(reference.filter(cat).select("feature", "bucket"), ["feature", "bucket"], "left_anti").select(
        "feature", F.col("bucket").alias("category"))


def summary(report: DataFrame) -> DataFrame:
    def listed(status: str) -> Column:
        hit = F.array_sort(F.collect_set(F.when(F.col("status") == status, F.col("feature"))))
        return F.array_join(hit, ",")

    return report.agg(
        F.max(F.col("status") == "drift").alias("drift_detected"), F.round(F.coalesce(F.max("psi"), F.lit(0.0)), 6).alias("max_psi"),
        listed("drift").alias("drifted_features"), listed("warning").alias("warning_features"))
