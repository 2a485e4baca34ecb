"""Mixing sources to target weights by Poisson replication.

A source's size is its characters plus one for each document. A source that
shall make up the share ``w`` of an output of size ``total`` is repeated at the
rate ``w * total / size``. How often a document appears is a Poisson number with
that mean, inverted from a hash of its id: the first count whose cumulative
probability exceeds the hash as a number in [0, 1). Rates above 32 are drawn as
sums of several smaller Poisson numbers, each from a hash of its own. Documents
are exploded by their counts and shuffled globally: each copy goes to a
partition by a random key and is sorted by it there.

Without given weights a source weighs the square root of its size. A null
source is a source of its own; with given weights, sources that are not listed
do not appear. Null and empty texts have one unit of size. Repeated rows are
drawn alike; a null id is hashed like an empty one. An empty table gives an
empty result. ``copy`` and ``shuffle_key`` replace input columns of those names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import text_of
from tracelake.plans.joins import lookup_join

SEED = "mix"
# The largest mean that is drawn at once; beyond it the number is a sum of draws.
LARGEST_MEAN = 32.0


def hashed_fraction(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def cumulative(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, ... up to where nothing is left."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    first = F.exp(-mean)
    start = F.struct((-mean).alias("log"), first.alias("sum"), F.array(first).alias("all"))

    def add(so_far: Column, n: Column) -> Column:
        log = so_far["log"] + F.log(mean) - F.log(n.cast("double"))
        total = so_far["sum"] + F.exp(log)
        return F.struct(
            log.alias("log"), total.alias("sum"), F.array_append(so_far["all"], total).alias("all")
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, add, lambda s: s["all"])


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None, total: float | None) -> DataFrame:
    """``mix_key, draws, cdf`` of each source."""
    sizes = docs.groupBy("mix_key").agg(
        F.sum(F.char_length("mix_text") + 1).cast("double").alias("size")
    )
    if weights is None:
        weighed = sizes.withColumn("weight", F.sqrt("size"))
    else:
        listed = docs.sparkSession.createDataFrame(
            [(_key_of(k), float(w)) for k, w in weights.items() if w > 0] or [("", 0.0)],
            "mix_key string, weight double",
        ).where("weight > 0")
        weighed = sizes.join(listed, "mix_key")
    sums = weighed.agg(F.sum("weight").alias("all_weight"))
    sums = sums.crossJoin(sizes.agg(F.sum("size").alias("all_size")))  # one row each
    rate = F.col("weight") / F.col("all_weight") * F.coalesce(F.lit(total), F.col("all_size")) / F.col("size")
    return (
        weighed.crossJoin(F.broadcast(sums))
        .withColumn("rate", rate)
        .withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN)).cast("int"))
        .select("mix_key", "draws", cumulative(F.col("rate") / F.col("draws")).alias("cdf"))
    )


def _key_of(source: str | None) -> str:
    return "" if source is None else f"s{source}"


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    *,
    total: float | None = None,
    key: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
    seed: str = SEED,
) -> DataFrame:
    """Copies of the rows of ``docs``, with ``copy`` from 1 on and ``shuffle_key``.

    Which partition a copy is in, and where it stands there, is random; the rows
    of the written partitions one after the other are a global shuffle.
    """
    source = F.col(f"`{key}`").cast("string")
    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    kept = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("mix_key"),
        name.alias("mix_id"),
    )
    measured = docs.select(
        F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("mix_key"),
        text_of(text).alias("mix_text"),
    )
    found = lookup_join(rows, rates(measured, weights, total), ["mix_key"], spread_by="mix_id")

    fractions = F.transform(
        F.sequence(F.lit(1), F.col("draws")),
        lambda draw: hashed_fraction(F.lit(seed), F.col("mix_id"), draw.cast("string")),
    )
    count = F.aggregate(
        fractions, F.lit(0), lambda so_far, u: so_far + F.size(F.filter("cdf", lambda c: c <= u))
    )
    copies = found.select("row", "mix_id", count.alias("count")).where("count > 0")
    copies = copies.select("row", "mix_id", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    order = F.md5(
        F.concat_ws(":", F.lit(seed), F.lit("order"), "mix_id", F.col("copy").cast("string")).cast("binary")
    )
    keyed = copies.select("row.*", "copy", order.alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
