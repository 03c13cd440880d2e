"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A document is its words (``[^\\x20\\x09-\\x0D]+``) weighted by their counts. Sample i draws for
every word, from hashes of word and i, two gamma numbers r and c of shape 2 and a uniform b.
With t = floor(ln w / r + b), the word's claim is ln a = ln c - r (t - b + 1); the least claim
wins and the sample is the pair of word and t. Two texts agree in a sample with a probability
of their generalised Jaccard similarity, the sum of minima over the sum of maxima of weights.
A fingerprint is ``SAMPLES`` samples of 32 bits as hexadecimal text.

Texts are shuffled once by document. Words are folded to counts and counts to least claims
where they are, as running minima of 64-bit numbers that hold claim and sample.

Nulls and odd input: a null text is empty; a text without words has the fingerprint of
zeros, alike with another of these and with no other. Documents follow each other by
descending doc_id, null last, equal ids by a hash of the text; rows equal in both are one
document and get equal results. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.ordering import row_numbers
from brightloom.session import cut

#: Samples of a fingerprint.
SAMPLES = 32
#: Claims are kept to 2 ** -22.
SCALE = 1 << 22

_NONE = -(1 << 63)  # orders a null doc_id below all others


def _unit(bits: Column, k: int) -> Column:
    """The k-th 21 bits of a hash as a number strictly between 0 and 1."""
    part = F.shiftrightunsigned(bits, 21 * k).bitwiseAND(F.lit((1 << 21) - 1))
    return (part.cast("double") + 0.5) / F.lit(float(1 << 21))


def claim(term: Column, ln_weight: Column, sample: int) -> Column:
    """Claim (upper 32 bits) and sample (lower 32 bits) of a word, as one number to minimise."""
    one, two = F.xxhash64(term, F.lit(sample)), F.xxhash64(F.lit(sample), term)
    r = -F.ln(_unit(one, 0) * _unit(one, 1))
    ln_c = F.ln(-F.ln(_unit(two, 0) * _unit(two, 1)))
    b = _unit(one, 2)
    t = F.floor(ln_weight / r + b)
    claimed = F.floor((ln_c - r * (t - b + 1)) * SCALE) + (1 << 30)
    low = F.lit((1 << 32) - 1)
    return claimed * (1 << 32) + (two.bitwiseAND(low) + t * 0x9E3779B1).bitwiseAND(low)  # a full hash could overflow


def fingerprints(words: DataFrame, keys: list[str], versions: int) -> DataFrame:
    """(keys, word, version, times) to (keys, samples_0, samples_1, ...): per version of a text
    an array of SAMPLES numbers, null without words. ``times`` says how often the table holds
    each row. The keys should already partition the table; then nothing is shuffled. The
    draws of a word serve all versions."""
    counts = [F.sum((F.col("version") == v).cast("long")).alias(f"n{v}") for v in range(versions)]
    terms = words.withColumn("term", F.xxhash64("word")).groupBy(*keys, "term").agg(*counts, F.first("times").alias("times"))
    logs = [F.ln(F.when(F.col(f"n{v}") > 0, F.col(f"n{v}") / F.col("times"))).alias(f"w{v}") for v in range(versions)]
    least = terms.select(*keys, "term", *logs).groupBy(*keys).agg(*[
        F.min(claim(F.col("term"), F.col(f"w{v}"), i)).alias(f"s{v}_{i}") for i in range(SAMPLES) for v in range(versions)
    ])
    low = F.lit((1 << 32) - 1)
    return least.select(*keys, *[
        F.when(F.col(f"s{v}_0").isNotNull(), F.array(*[F.col(f"s{v}_{i}").bitwiseAND(low) for i in range(SAMPLES)])).alias(f"samples_{v}")
        for v in range(versions)
    ])


def as_text(samples: Column) -> Column:
    whole = F.concat_ws("", F.transform(samples, lambda x: F.lpad(F.hex(x), 8, "0")))
    return F.when(samples.isNull(), F.lit("0" * 8 * SAMPLES)).otherwise(F.lower(whole))


def likeness(one: Column, two: Column) -> Column:
    """Share of equal samples."""
    same = F.aggregate(F.zip_with(one, two, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    both = F.when(one.isNull() & two.isNull(), F.lit(1.0)).when(one.isNull() | two.isNull(), F.lit(0.0))
    return both.otherwise(same / F.lit(float(SAMPLES)))


def edited_beside_next(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has its last third replaced by the beginning of the next
    document's."""
    text = F.coalesce("text", F.lit(""))
    table = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("key"), text.alias("text"))
    table = table.withColumn("hash", F.xxhash64("text"))

    slim = table.groupBy("key", "hash").agg(F.count(F.lit(1)).alias("times"), F.max(F.length("text")).cast("long").alias("n"))
    placed = cut(row_numbers(slim, [], [F.col("key").desc(), F.col("hash")], "place"))
    total = placed.count()
    after = placed.select((F.pmod(F.col("place") - 2, F.lit(max(total, 1))) + 1).alias("place"), F.col("key").alias("next_key"), F.col("hash").alias("next_hash"))
    pairs = cut(placed.join(after, "place").select("key", "hash", "n", "times", F.floor(F.col("n") / 3).cast("int").alias("third"), "next_key", "next_hash"))

    wanted = pairs.select(
        F.col("next_key").alias("key"), F.col("next_hash").alias("hash"), F.col("key").alias("for_key"), F.col("hash").alias("for_hash"), "third"
    )
    heads = table.join(wanted, ["key", "hash"]).select(
        F.col("for_key").alias("key"), F.col("for_hash").alias("hash"), F.substring("text", F.lit(1), F.col("third")).alias("head")
    ).dropDuplicates(["key", "hash"])
    kept = pairs.select("key", "hash", "n", "third", "times")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n") - F.col("third")).cast("int")), F.col("head"))
    both = table.join(kept, ["key", "hash"]).join(heads, ["key", "hash"]).withColumn("edited", edited)

    versions = both.withColumn("v", F.explode(F.array(
        F.struct(F.lit(0).alias("version"), F.col("text").alias("text")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("text"))
    ))).select("key", "hash", "times", F.col("v.version").alias("version"), F.col("v.text").alias("text"))
    words = versions.select("key", "hash", "times", "version", F.explode(F.split("text", "[\\x20\\x09-\\x0D]+")).alias("word")).filter("word <> ''")
    shas = both.select("key", "hash", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    # one job, so that the texts are shuffled once for both
    done = cut(shas.join(fingerprints(words, ["key", "hash"], 2), ["key", "hash"], "left"))
    following = done.select(F.col("key").alias("next_key"), F.col("hash").alias("next_hash"), F.col("samples_0").alias("following"))
    following = following.dropDuplicates(["next_key", "next_hash"])
    out = done.join(pairs.select("key", "hash", "n", "next_key", "next_hash"), ["key", "hash"]).join(following, ["next_key", "next_hash"], "left")
    own, new = F.col("samples_0"), F.col("samples_1")
    return out.select(
        F.when(F.col("key") != _NONE, F.col("key")).alias("doc_id"), F.col("n").alias("n_chars"), "edited_sha256",
        as_text(own).alias("fingerprint"), as_text(new).alias("edited_fingerprint"),
        likeness(own, new).alias("near_edited"), likeness(own, F.col("following")).alias("near_next"),
    )
