"""Nearest neighbours: exact search in blocks, and search in the closest cells only.

Queries and corpus are cut into sides of bounded size. A task holds one side of
each, multiplies them tile by tile and passes on the best k per query, so pairs
are never emitted, no task holds a whole table, and a row is copied once per side
that it meets, not once per tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import l2_normalize
from tablewright.operators.ordered import top_per_group
from tablewright.operators.split import hash_sample

METRICS = ("dot", "cosine", "l2")
PAIRS_PER_TASK = 16
#: Rows of each side whose scores exist at one time.
TILE = 1024
#: Numbers of each side that a task holds at one time, and rows, as each takes some hundred bytes besides its numbers.
SIDE_VALUES, SIDE_ROWS = 1 << 22, 1 << 17


def as_matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms > 0, norms, 1.0)


def best_of_steps(
    asked: np.ndarray, known: np.ndarray, order: np.ndarray, steps: list, k: int, metric: str, digits: int, tile: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and rounded score of the k best columns per row; larger is better, equal scores by ``order``.

    A step is an array of rows and one of columns that meet; with two more arrays, the labels of all rows and of all
    columns, only those of equal labels meet. Scores are computed tile by tile; only those that reach a row's k-th best
    so far are rounded and ranked.
    """
    if metric == "cosine":
        asked, known = unit_rows(asked), unit_rows(known)
    distance = metric == "l2"
    unit = 10.0**-digits
    if distance:
        square, length = (known**2).sum(axis=1), (asked**2).sum(axis=1)
        # products of long vectors lose digits; distances are computed again from differences
        blur = 1e-14 * known.shape[1] * (length + square.max(initial=0.0))
    score = np.full((len(asked), k), -np.inf)
    column = np.full((len(asked), k), -1, dtype=np.int64)

    def reach(rows: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """What a product must reach to be rounded to the floor or more."""
        if not distance:
            return floor - 0.51 * unit
        return -((unit * 0.51 - floor) ** 2) - blur[rows]

    def rounded(rows: np.ndarray, columns: np.ndarray, raw: np.ndarray) -> np.ndarray:
        if distance:
            parts = [
                np.sqrt(((asked[rows[i : i + tile]] - known[columns[i : i + tile]]) ** 2).sum(axis=1))
                for i in range(0, len(rows), tile)
            ]
            raw = -np.concatenate(parts) if parts else raw
        return np.round(raw, digits) + 0.0

    for of_rows, of_columns, *labels in steps:
        for i in range(0, len(of_rows), tile):
            rows = of_rows[i : i + tile]
            left = asked[rows]
            for j in range(0, len(of_columns), tile):
                columns = of_columns[j : j + tile]
                raw = left @ known[columns].T
                if distance:
                    raw *= 2
                    raw -= square[columns]
                    raw -= length[rows][:, None]
                if labels:
                    raw[labels[0][rows][:, None] != labels[1][columns]] = -np.inf
                low = reach(rows, score[rows, k - 1])
                r, c = np.nonzero((raw >= low[:, None]) & (raw > -np.inf) if labels else raw >= low[:, None])
                if len(r) > 4 * k * len(rows) and len(columns) > k:
                    # the tile alone may tell more than what was found before
                    kth = np.partition(raw, len(columns) - k, axis=1)[:, len(columns) - k]
                    own = -np.sqrt(np.maximum(blur[rows] - kth, 0.0)) if distance else kth
                    low = np.maximum(low, reach(rows, own - 0.51 * unit))
                    r, c = np.nonzero((raw >= low[:, None]) & (raw > -np.inf) if labels else raw >= low[:, None])
                if not len(r):
                    continue
                value = rounded(rows[r], columns[c], raw[r, c])
                r, c = rows[r], columns[c]
                floor, last = score[r, k - 1], column[r, k - 1]
                better = (last < 0) | (value > floor) | ((value == floor) & (order[c] < order[last]))
                r, c, value = r[better], c[better], value[better]
                touched = np.unique(r)
                have_row, have_place = np.nonzero(column[touched] >= 0)
                have_row = touched[have_row]
                r, c, value = (
                    np.concatenate([r, have_row]), np.concatenate([c, column[have_row, have_place]]),
                    np.concatenate([value, score[have_row, have_place]]),
                )
                by = np.lexsort((order[c], -value, r))
                r, c, value = r[by], c[by], value[by]
                place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
                keep = place < k
                score[r[keep], place[keep]] = value[keep]
                column[r[keep], place[keep]] = c[keep]
    row, place = np.nonzero(column >= 0)
    return row, column[row, place], score[row, place]


def bucket_steps(rows: pd.Series, columns: pd.Series, batch: int = 256) -> list:
    """Rows and columns of equal buckets meet. Small buckets share a step, so that steps are few."""
    labels = pd.factorize(pd.concat([rows, columns], ignore_index=True))[0]
    of_row, of_column = labels[: len(rows)], labels[len(rows) :]
    row, column = np.argsort(of_row, kind="stable"), np.argsort(of_column, kind="stable")
    both = np.intersect1d(of_row, of_column)
    bounds = np.array([
        np.searchsorted(x[by], both, side) for x, by in ((of_row, row), (of_column, column)) for side in ("left", "right")
    ]).T.tolist()
    steps, first = [], 0
    for i in range(1, len(bounds) + 1):
        a, _, c, _ = bounds[first]
        if i < len(bounds) and bounds[i][1] - a <= batch and bounds[i][3] - c <= batch:
            continue
        step = (row[a : bounds[i - 1][1]], column[c : bounds[i - 1][3]])
        steps.append(step if i - first == 1 else (*step, of_row, of_column))
        first = i
    return steps


def steps_of(queries: pd.DataFrame, corpus: pd.DataFrame) -> list:
    """All rows with all columns, but queries that list cells, or have a bucket, with the columns of these only."""
    every, columns = np.arange(len(queries)), np.arange(len(corpus))
    if "bucket" in queries:
        return bucket_steps(queries["bucket"], corpus["bucket"])
    if "cells" not in queries:
        return [(every, columns)]
    lengths = np.array([len(c) for c in queries["cells"]])
    steps = [(every[lengths == 0], columns)]
    if lengths.any():
        row, probed = np.repeat(every, lengths), np.concatenate([np.asarray(c, dtype=np.int64) for c in queries["cells"]])
        cell = corpus["cell"].to_numpy()
        steps += [(row[probed == one], columns[cell == one]) for one in np.unique(probed)]
    return steps


def best_in_block(
    queries: pd.DataFrame, corpus: pd.DataFrame, k: int, metric: str, digits: int, tile: int = TILE
) -> pd.DataFrame:
    """The k best corpus rows per query; equal rounded scores by corpus id."""
    ids = corpus["corpus_id"].to_numpy()
    order = np.empty(len(ids), dtype=np.int64)
    order[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    row, column, score = best_of_steps(
        as_matrix(queries["vector"]), as_matrix(corpus["vector"]), order, steps_of(queries, corpus), k, metric, digits, tile
    )
    return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[row], "corpus_id": ids[column], "score": score})


def block_hits(
    queries: DataFrame, corpus: DataFrame, keys: list[str], k: int, metric: str, digits: int, tile: int = TILE
) -> DataFrame:
    """Run the block kernel on every pair of sides with equal keys: the best k of each."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("corpus_id", corpus.schema["corpus_id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])

    def kernel(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "corpus_id": [], "score": []})
        return best_in_block(left, right, k, metric, digits, tile)

    return queries.groupBy(*keys).cogroup(corpus.groupBy(*keys)).applyInPandas(kernel, schema)


def merge_blocks(
    queries: DataFrame, corpus: DataFrame, keys: list[str], pairs: int, k: int, metric: str, digits: int, tile: int = TILE
) -> DataFrame:
    """The best k of all pairs of sides with equal keys, of which there are so many."""
    cores = queries.sparkSession.sparkContext.defaultParallelism
    # pairs are small but slow, so they must not be coalesced by size; spare partitions keep two of them apart
    tasks = max(min(4 * pairs, max(8 * cores, 400)), math.ceil(pairs / PAIRS_PER_TASK))
    found = block_hits(queries.repartition(tasks, *keys), corpus.repartition(tasks, *keys), keys, k, metric, digits, tile)
    ranked = top_per_group(found, ["query_id"], [F.col("score").desc(), "corpus_id"], k)
    if metric == "l2":
        ranked = ranked.withColumn("score", -F.col("score"))
    return ranked.select("query_id", "rank", "corpus_id", "score")


def slot(column: str, slots: int | Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(slots) if isinstance(slots, int) else slots)


def each_slot(slots: int | Column) -> Column:
    last = F.lit(slots - 1) if isinstance(slots, int) else slots - 1
    return F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))


def side_rows(vectors: DataFrame, block_rows: int, side_values: int) -> tuple[int, int]:
    """How many vectors there are, and how many of them a task holds: ``side_values`` numbers, SIDE_ROWS rows at most, ``block_rows`` at least."""
    known = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("length")).first()
    return known["n"], max(block_rows, min(SIDE_ROWS, side_values // max(1, known["length"] or 1)))


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = "cosine",
    block_rows: int = 4096,
    digits: int = 6,
    side_values: int = SIDE_VALUES,
    tile: int = TILE,
) -> DataFrame:
    """Exact top-k of the corpus for every query: query_id, rank, corpus_id, score.

    Inputs are ``(query_id, vector)`` and ``(corpus_id, vector)``. Scores are
    rounded before ranking, so ties are well defined. A task holds a side of
    ``side_values`` numbers, or of ``block_rows`` rows where that is more.
    """
    n_queries, query_side = side_rows(queries, block_rows, side_values)
    n_corpus, corpus_side = side_rows(corpus, block_rows, side_values)
    query_blocks = max(1, math.ceil(n_queries / query_side))
    corpus_blocks = max(1, math.ceil(n_corpus / corpus_side))
    # few large sides would leave cores idle
    cores = queries.sparkSession.sparkContext.defaultParallelism
    query_blocks = max(query_blocks, math.ceil(2 * cores / corpus_blocks))
    left = queries.select(
        "query_id", "vector", slot("query_id", query_blocks).alias("q"), each_slot(corpus_blocks).alias("c")
    )
    right = corpus.select(
        "corpus_id", "vector", slot("corpus_id", corpus_blocks).alias("c"), each_slot(query_blocks).alias("q")
    )
    return merge_blocks(left, right, ["q", "c"], query_blocks * corpus_blocks, k, metric, digits, tile)


def fit_cells(corpus: DataFrame, cells: int, sample_fraction: float = 1.0, seed: int = 42) -> np.ndarray:
    """Centres of ``cells`` clusters of the unit-length vectors; zero vectors may be among them."""
    sample = corpus if sample_fraction >= 1 else hash_sample(corpus, ["corpus_id"], sample_fraction, seed)
    features = sample.select(array_to_vector(l2_normalize("vector")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(features)
    return unit_rows(np.array(model.clusterCenters()))


def closest_cells(centres: np.ndarray, n: int):
    """Pandas UDF: the n closest cells of a vector."""
    wanted = min(n, len(centres))

    @F.pandas_udf("array<int>")
    def cells(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            near = np.argsort(-(as_matrix(vectors) @ centres.T), axis=1, kind="stable")[:, :wanted]
            yield pd.Series([row.astype(np.int32) for row in near])

    return cells


def deal_cells(sizes: dict[int, int], cells: int, rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First part and number of parts of each cell, and all parts: of so many rows, or of one row of a crowded cell's cut.

    Small cells share a part, a crowded one has several of its own, an empty one has none.
    """
    first, count = np.full(cells, -1), np.zeros(cells, dtype=np.int64)
    parts, filled = 0, rows
    for cell in range(cells):
        size = sizes.get(cell, 0)
        if size > rows:
            first[cell], count[cell] = parts, math.ceil(size / rows)
            parts, filled = parts + count[cell], rows
        elif size:
            if filled + size > rows:
                parts, filled = parts + 1, 0
            first[cell], count[cell], filled = parts - 1, 1, filled + size
    return first, count, int(parts)


def probed_parts(centres: np.ndarray, n: int, first: np.ndarray, count: np.ndarray):
    """Pandas UDF: the parts that hold a vector's n closest cells, each followed by these cells, or alone if all count."""
    wanted = min(n, len(centres))

    @F.pandas_udf("array<array<int>>")
    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            near = np.argsort(-(as_matrix(vectors) @ centres.T), axis=1, kind="stable")[:, :wanted] if len(vectors) else []
            out = []
            for cells in near:
                shared: dict[int, list[int]] = {}
                for cell in cells.tolist():
                    if count[cell] == 1:
                        shared.setdefault(int(first[cell]), []).append(cell)
                    else:
                        shared |= {int(first[cell]) + i: [] for i in range(int(count[cell]))}
                out.append([[part, *some] for part, some in shared.items()])
            yield pd.Series(out, dtype=object)

    return parts


def nearest_in_cells(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    centres: np.ndarray,
    probes: int = 4,
    metric: str = "cosine",
    block_rows: int = 4096,
    digits: int = 6,
    side_values: int = SIDE_VALUES,
    tile: int = TILE,
) -> DataFrame:
    """Top-k among the corpus rows of each query's closest cells.

    With ``probes`` equal to the number of cells the result is exact. Small cells
    are dealt to tasks together and crowded ones are cut, so a cell may hold any
    share of the rows and a query is sent once to all of its cells in a task.
    Only one size per cell reaches the driver.
    """
    placed = corpus.select("corpus_id", "vector", closest_cells(centres, 1)("vector")[0].alias("cell"))
    n_queries, query_side = side_rows(queries, block_rows, side_values)
    _, corpus_side = side_rows(corpus, block_rows, side_values)
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    first, count, parts = deal_cells(sizes, len(centres), corpus_side)
    cores = queries.sparkSession.sparkContext.defaultParallelism
    query_blocks = max(1, math.ceil(n_queries / query_side), math.ceil(2 * cores / max(1, parts)))
    every = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda part: F.array(part)) if parts else F.array().cast("array<array<int>>")
    # a query of all cells need not list them
    probed = every if probes >= len(centres) else probed_parts(centres, probes, first, count)("vector")
    left = queries.select("query_id", "vector", slot("query_id", query_blocks).alias("q"), F.explode(probed).alias("probe")).select(
        "query_id", "vector", "q", F.col("probe")[0].alias("part"), F.expr("slice(probe, 2, size(probe))").alias("cells")
    )
    deals = placed.sparkSession.createDataFrame(
        [(cell, int(first[cell]), int(count[cell])) for cell in range(len(centres)) if count[cell]], "cell int, first int, count int"
    )
    # one row per cell
    right = placed.join(F.broadcast(deals), "cell").select(
        "corpus_id", "vector", "cell", (F.col("first") + slot("corpus_id", F.col("count")).cast("int")).alias("part"),
        each_slot(query_blocks).alias("q"),
    )
    return merge_blocks(left, right, ["part", "q"], query_blocks * max(1, parts), k, metric, digits, tile)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that were found."""
    hit = found.select("query_id", "corpus_id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query_id", "corpus_id"], "left").agg(
        F.count(F.lit(1)).alias("wanted"),
        F.count("hit").alias("found"),
        (F.count("hit") / F.count(F.lit(1))).alias("recall"),
    )
