"""Copies of documents so that each source comes near its target, by pivotal rounding.

Targets: sources in code-point order, null last, weigh 1, 2, 3, 1, 2, ...; they share the
total size by weight. A target stops at ``most`` times its source's size; the excess is
shared anew by weight until no target is above its bound. With the bounds sorted by bound
over weight this has a closed form, a running sum over one row per source.

Rounding: every document of a source asks for target / size copies. The whole part is taken;
the fractions are rounded dependently. Documents stand in order of size, and a binary tree
pairs neighbours: two fractional probabilities meet, mass moves at random from one to the
other until one is integral, and the other goes up the tree as the pair's residual. So the
number of copies is right to one document, expectations are kept, and as neighbours are
alike in size, so are the sizes taken.

The residual of a subtree is the fraction of its sum, whatever the draws below it. As all
documents of a source have the same probability, it follows from the number of documents
below. A document therefore works out its own way up the tree from its position alone: each
pair's draw is a hash of seed, source and place in the tree, so both sides and every rerun
agree. Only the positions need a shuffle. Masses are integers of 2 ** -28, so nothing is
lost by rounding.

Nulls and odd input: a null text has size 0; documents of size 0 are documents like others.
A source without any size has target 0. Equal rows are interchangeable. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.columns import row_hash, spare
from brightloom.operators.ordering import row_numbers
from brightloom.session import stage

#: Unit of probability mass.
UNIT = 1 << 28
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: float = 3.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, docs, target) from (source, size). One row per source is ordered
    in one task; the number of sources bounds it."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")))
    by = by.withColumn("bound", F.lit(float(most)) * F.col("source_size"))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    open_weight = F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    # the level rises while sources stop below it and falls afterwards
    by = by.withColumn("level", left / open_weight)
    by = by.withColumn("target", F.least(F.max("level").over(everything) * F.col("weight"), F.col("bound")))
    return by.select("source", "source_size", "docs", "target")


def _uniform(seed: int, *parts: Column) -> Column:
    """A number from 0 to 1 (exclusive) that hangs on the arguments alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def pivotal(place: Column, docs: Column, mass: Column, group: Column, seed: int) -> Column:
    """1 or 0 for the document at ``place`` (from 0) of ``docs`` in its group, each of which
    has probability ``mass`` / UNIT, rounded by the tree of pairs."""
    levels = F.when(docs > 1, F.sequence(F.lit(1), F.ceil(F.log2(docs.cast("double")) + 0.001).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )

    def meet(state: Column, level: Column) -> Column:
        width = F.expr("bigint(1)") * F.pow(F.lit(2.0), level).cast("long")
        half = F.expr("bigint(1)") * F.pow(F.lit(2.0), level - 1).cast("long")
        node = F.floor(place / width).cast("long")
        middle = node * width + half
        left = F.pmod((F.least(middle, docs) - node * width) * mass, F.lit(UNIT))
        right = F.pmod(F.greatest(F.least(middle + half, docs) - middle, F.lit(0)) * mass, F.lit(UNIT))
        both = left + right
        draw = _uniform(seed, group, level, node)
        # one of the two goes on: below 1 as the sum, else as what is over 1
        left_on = F.when(both < UNIT, draw * both < left).otherwise(draw * (2 * UNIT - both) >= UNIT - right)
        alone = middle >= docs
        mine = place < middle
        on = alone | (mine == left_on)
        settled = F.when(both < UNIT, 0).otherwise(1)
        return F.when(~state.live, state).otherwise(
            F.struct(on.alias("live"), F.when(on, F.lit(0)).otherwise(settled).alias("copy"))
        )

    start = F.struct(F.lit(True).alias("live"), F.lit(0).alias("copy"))
    state = F.aggregate(levels, start, meet)
    root = _uniform(seed, group, F.lit(-1)) * UNIT < F.pmod(docs * mass, F.lit(UNIT))
    return F.when(state.live, root.cast("int")).otherwise(state.copy)


def mix(sizes: DataFrame, most: float = 3.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 9) -> DataFrame:
    """(doc_id, row_hash, source, size) to the same rows with source_size, target, copies and
    taken (copies times size)."""
    frozen = stage(sizes)
    aims = targets(frozen, most, weights)
    placed = row_numbers(frozen, ["source"], [F.col(c) for c in ("size", "doc_id", "row_hash")], "place")
    joined = placed.join(aims, placed.source.eqNullSafe(aims.source)).select(placed["*"], "source_size", "docs", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("long"))
    mass = F.floor((F.col("rate") - F.col("whole")) * UNIT).cast("long")
    joined = joined.withColumn("mass", mass).withColumn(
        "copies", F.col("whole") + pivotal(F.col("place") - 1, F.col("docs"), F.col("mass"), F.col("source"), seed)
    )
    return joined.select(
        "doc_id", "row_hash", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash, source, size); equal rows have equal hashes."""
    return docs.select(
        F.col("doc_id").cast("long"), row_hash(docs).alias("row_hash"), "source",
        word_count(F.col("text")).alias("size"),
    )


def take(docs: DataFrame, most: float = 3.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 9) -> DataFrame:
    """The mixed documents: each as often as its copies say, columns as they came."""
    taken = mix(sized(docs), most, weights, seed).groupBy("doc_id", "row_hash").agg(F.sum("copies").cast("int").alias("copies"))
    own_id, own_hash, hashed, times, copy = spare(docs, "_id", "_row", "_hash", "_copies", "_copy")
    taken = taken.filter("copies > 0").select(F.col("doc_id").alias(own_id), F.col("row_hash").alias(own_hash), F.col("copies").alias(times))
    one = docs.withColumn(hashed, row_hash(docs)).dropDuplicates(["doc_id", hashed])
    met = one.join(taken, one.doc_id.cast("long").eqNullSafe(taken[own_id]) & (one[hashed] == taken[own_hash]))
    return met.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[f"`{c}`" for c in docs.columns])
