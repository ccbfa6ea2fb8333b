"""Approximate nearest neighbours through tables of random projections.

A table cuts unit vectors by several projections into steps of one width; vectors that fall into the same steps share a
bucket, and a pair is compared only where it shares a bucket. How many projections, how wide, and how many tables
follow from a bounded sample: the distances of its neighbours and of all others give the share of neighbours that is
found and the pairs that it costs, and the cheapest setting that reaches the wanted recall is taken. With more rows,
pairs cost more and neighbours are closer, so that tables get finer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ordered import top_per_group
from tablewright.operators.vectors import SIDE_VALUES, as_matrix, block_hits, each_slot, nearest, side_rows, slot, unit_rows

#: Queries whose neighbours are searched exactly to choose the tables, and corpus rows that stand for all others.
SAMPLE = 200
#: Work of a row in a table next to comparing one pair.
ROW_COST = 40.0
WIDTHS = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
MOST_TABLES = 2000


def projections(count: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """``count`` normal directions and offsets between 0 and 1, the same on every machine and in SQL.

    Row j has, from the uniform numbers sin(k) * 10000 - floor(sin(k) * 10000), normal ones by Box and Muller.
    """
    k = np.arange(1, count * (2 * dimensions + 1) + 1, dtype=np.float64).reshape(count, -1)
    u = np.sin(k) * 10_000
    u -= np.floor(u)
    first, second = u[:, :dimensions], u[:, dimensions : 2 * dimensions]
    return np.sqrt(-2 * np.log(np.maximum(first, 1e-12))) * np.cos(2 * math.pi * second), u[:, -1]


@dataclass(frozen=True)
class Tables:
    """``tables`` tables of ``cuts`` projections each, in steps of ``width`` between unit vectors."""

    tables: int
    cuts: int
    width: float

    def buckets(self):
        """Pandas UDF: the bucket of a vector in each table, as text."""
        tables, cuts, width = self.tables, self.cuts, self.width

        @F.pandas_udf("array<string>")
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for vectors in batches:
                if not len(vectors):
                    yield pd.Series([], dtype=object)
                    continue
                unit = unit_rows(as_matrix(vectors))
                directions, offsets = projections(tables * cuts, unit.shape[1])
                steps = np.floor(unit @ directions.T / width + offsets).astype(np.int64).reshape(len(unit), tables, cuts)
                yield pd.Series([[f"{t}:" + ",".join(map(str, row)) for t, row in enumerate(one)] for one in steps.tolist()])

        return found


def shared_step(distance: np.ndarray, width: float) -> np.ndarray:
    """The chance that two vectors at this distance fall into one step of a projection."""
    r = width / np.maximum(distance, 1e-9)
    below = np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in np.ravel(r)]).reshape(np.shape(r))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - np.exp(-(r**2) / 2))


def choose_tables(near: np.ndarray, other: np.ndarray, rows: int, recall: float) -> Tables:
    """The cheapest tables that find the wanted share of neighbours at the distances ``near``, among ``rows`` rows."""
    best = None
    for width in WIDTHS:
        p, q = shared_step(near, width), shared_step(other, width)
        for cuts in range(1, 33):
            miss = 1 - np.minimum(p**cuts, 1 - 1e-12)
            low, high = 1, MOST_TABLES
            if 1 - (miss**high).mean() < recall:
                break
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if 1 - (miss**middle).mean() >= recall else (middle + 1, high)
            cost = low * (ROW_COST + rows * (q**cuts).mean())
            if best is None or cost < best[0]:
                best = (cost, Tables(low, cuts, width))
    return best[1]


def fit_tables(queries: DataFrame, corpus: DataFrame, k: int, recall: float = 0.93) -> Tables:
    """Tables for this corpus, from SAMPLE queries and SAMPLE corpus rows with the least hashed ids.

    The sample's queries meet the whole corpus once, which is linear in its rows.
    """
    least = lambda df, c: df.orderBy(F.xxhash64(c), c).limit(SAMPLE)
    asked = least(queries.select("query_id", "vector"), "query_id")
    scores = np.array([r["score"] for r in nearest(asked, corpus, k, "cosine").select("score").collect()])
    a = as_matrix(pd.Series([r["vector"] for r in asked.collect()]))
    b = as_matrix(pd.Series([r["vector"] for r in least(corpus.select("corpus_id", "vector"), "corpus_id").collect()]))
    apart = lambda cosine: np.sqrt(np.maximum(2 - 2 * np.asarray(cosine), 0))
    return choose_tables(apart(scores), apart(unit_rows(a) @ unit_rows(b).T).ravel(), corpus.count(), recall)


def nearest_by_tables(
    queries: DataFrame, corpus: DataFrame, k: int, tables: Tables, block_rows: int = 4096, digits: int = 6,
    side_values: int = SIDE_VALUES,
) -> DataFrame:
    """The k best by cosine among the corpus rows that share a bucket with a query: query_id, rank, corpus_id, score.

    A crowded bucket is cut into sides that a task can hold, as many as its rows need, so a bucket may hold any share of them.
    Small buckets, of which there are far more, are dealt to tasks together.
    """
    n_corpus, side = side_rows(corpus, block_rows, side_values)
    cores = queries.sparkSession.sparkContext.defaultParallelism
    parts = max(4 * cores, math.ceil(n_corpus * tables.tables / side))
    part = F.pmod(F.xxhash64("bucket", "q", "c"), F.lit(parts)).alias("part")
    one = F.concat_ws("/", "bucket", "q", "c").alias("bucket")
    find = tables.buckets()
    asked = queries.select("query_id", "vector", F.explode(find("vector")).alias("bucket"))
    known = corpus.select("corpus_id", "vector", F.explode(find("vector")).alias("bucket"))
    blocks = lambda n: F.ceil(F.count(F.lit(1)) / side).alias(n)
    met = known.groupBy("bucket").agg(blocks("c_blocks")).join(asked.groupBy("bucket").agg(blocks("q_blocks")), "bucket")
    left = asked.join(met, "bucket").select(
        "query_id", "vector", "bucket", slot("query_id", F.col("q_blocks")).alias("q"), each_slot(F.col("c_blocks")).alias("c")
    )
    right = known.join(met, "bucket").select(
        "corpus_id", "vector", "bucket", slot("corpus_id", F.col("c_blocks")).alias("c"), each_slot(F.col("q_blocks")).alias("q")
    )
    left, right = (df.select(name, "vector", part, one).repartition(parts, "part") for df, name in ((left, "query_id"), (right, "corpus_id")))
    # a pair may share many buckets
    found = block_hits(left, right, ["part"], k, "cosine", digits).distinct()
    return top_per_group(found, ["query_id"], [F.col("score").desc(), "corpus_id"], k).select(
        "query_id", "rank", "corpus_id", "score"
    )


def search(queries: DataFrame, corpus: DataFrame, k: int, recall: float = 0.93) -> DataFrame:
    """Approximate nearest neighbours by cosine, with tables chosen for the corpus."""
    return nearest_by_tables(queries, corpus, k, fit_tables(queries, corpus, k, recall))
