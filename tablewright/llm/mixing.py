"""Mixing sources to target weights by Poisson replication, in DataFrame expressions only.

Each document is copied N times, N drawn from a Poisson distribution whose mean is its source's target repetition. The
draw inverts the distribution at a number hashed from the seed and the document, so a lost task repeats the same draw.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import col, fresh
from tablewright.session import cut_lineage

#: Target weights are the sources' sizes to this power: 1 leaves the mixture, 0 makes all sources equal.
ALPHA = 0.5
SEED = 17
#: With more sources than this their distributions are joined by a shuffle instead of a broadcast (about 5 MB).
MAX_BROADCAST_SOURCES = 10_000


def tempered_weights(sizes: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """source, weight from source, size."""
    return sizes.select("source", F.pow(F.col("size").cast("double"), F.lit(alpha)).alias("weight"))


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Characters of each source; a null source is a source of its own."""
    size = F.sum(F.coalesce(F.length(col(text)), F.lit(0)).cast("long"))
    return docs.groupBy(col(source).alias("source")).agg(size.alias("size"))


def repetition(sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """source, rate: how often each document is wanted, so that sources get their weights and the total stays.

    A source without a weight is left out of the mixture (rate 0). A source without characters keeps its rows (rate 1).
    Weights of a source listed more than once add up, null counts as 0, and a source that no document has is ignored.
    A weight that is negative or no finite number ends the job.
    """
    given = F.coalesce(F.col("weight").cast("double"), F.lit(0.0))
    bad = F.raise_error(F.concat(F.lit("a weight must be finite and not negative: "), given.cast("string"))).cast("double")
    fair = F.when((given >= 0) & (given < float("inf")), given).otherwise(bad)
    targets = weights.groupBy(F.col("source").alias("target")).agg(F.sum(fair).alias("weight"))
    both = sizes.join(targets, F.col("source").eqNullSafe(F.col("target")), "left")
    rows = both.select("source", F.col("size").cast("double").alias("size"), F.coalesce("weight", F.lit(0.0)).cast("double").alias("weight"))
    sums = rows.agg(
        F.sum("size").alias("s"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("w"),
    ).first()
    total, weight = sums["s"] or 0.0, sums["w"] or 0.0
    rate = F.when(F.col("size") <= 0, 1.0)
    rate = rate.otherwise(F.col("weight") / weight * total / F.col("size")) if weight > 0 else rate.otherwise(0.0)
    return rows.select("source", rate.alias("rate"))


def cumulative(rate: Column) -> Column:
    """The Poisson distribution's cumulative sums from 0 on, until less than 1e-16 is left."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")

    def step(acc, k):
        lt = acc["lt"] + F.log(rate / k)
        total = F.element_at(acc["sums"], -1) + F.exp(lt)
        return F.struct(lt.alias("lt"), F.concat(acc["sums"], F.array(total)).alias("sums"))

    first = F.struct((-rate).alias("lt"), F.array(F.exp(-rate)).alias("sums"))
    sums = F.aggregate(F.sequence(F.lit(1), last), first, step, lambda acc: acc["sums"])
    return F.when(rate > 0, sums).otherwise(F.array(F.lit(1.0)))


def hashed(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, seed: int = SEED, doc_id: str = "doc_id", source: str = "source",
    text: str = "text", alpha: float = ALPHA,
) -> DataFrame:
    """Copies of the rows of ``docs`` in random order, with the columns copy (from 1 on) and shuffle_key.

    ``weights`` has source and weight; without it sizes are tempered by ``alpha``. Rows with the same id, or with none,
    are drawn alike. Empty texts are drawn like any others; an empty table gives an empty table. Rows go to partitions
    by their hashed key and are sorted by it there, which is a random order over all sources.
    """
    sizes = cut_lineage(source_sizes(docs, source, text))
    rates = cut_lineage(repetition(sizes, tempered_weights(sizes, alpha) if weights is None else weights))
    key, sums, copy, order = fresh(docs, "mix_source", "mix_sums", "copy", "shuffle_key")
    side = rates.select(F.col("source").alias(key), cumulative(F.col("rate")).alias(sums))
    if rates.count() <= MAX_BROADCAST_SOURCES:
        side = F.broadcast(side)
    drawn = F.conv(F.substring(hashed(seed, col(doc_id)), 1, 13), 16, 10).cast("double") / math.pow(16, 13)
    joined = docs.join(side, col(source).eqNullSafe(col(key)))
    n = F.size(F.filter(col(sums), lambda c: c <= drawn))
    copies = joined.withColumn(copy, n).drop(key, sums).where(col(copy) > 0)
    copies = copies.withColumn(copy, F.explode(F.sequence(F.lit(1), col(copy))))
    copies = copies.withColumn(order, hashed(seed, F.lit("order"), col(doc_id), col(copy)))
    return copies.repartition(col(order)).sortWithinPartitions(col(order), col(copy))
