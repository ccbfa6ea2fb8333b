"""Implicit ALS for fewer items than the rank: the numbers of Spark's ALS, from systems as large as the items are many.

Where Y holds the item factors, a user's normal equations ``(Y' D Y + c I) x = Y' w`` have the solution ``x = Y' v`` with
``(D Y Y' + c I) v = w``, which has a row per item instead of one per factor. All items fit on the driver, so a pass over the
users gives what the next item factors need, and nothing is shuffled. As in Spark, factors are rounded to 32 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers of the users' systems that exist at one time.
VALUES = 1 << 21
#: Rows in which the sums over users reach the driver.
SUMS = 4


@dataclass(frozen=True)
class Factors:
    """Tables (id, features), as a model of Spark has them; the users' are computed from the items' when read."""

    userFactors: DataFrame
    itemFactors: DataFrame


def item_ids(shares: DataFrame, rank: int) -> list[int] | None:
    """The items in order, if they are fewer than the rank."""
    found = [r[0] for r in shares.select("item_id").distinct().limit(rank).collect()]
    return sorted(found) if len(found) < rank else None


def user_rows(shares: DataFrame) -> DataFrame:
    """A row per user: user_id, rated, rates. Save it, as every iteration reads it."""
    pairs = F.collect_list(F.struct("item_id", F.col("proportion_of_orders").cast("float").alias("rate")))
    return shares.groupBy("user_id").agg(pairs.alias("x")).select(
        "user_id", F.col("x.item_id").alias("rated"), F.col("x.rate").alias("rates")
    )


@dataclass(frozen=True)
class Job:
    """What all steps of a fit share."""

    items: np.ndarray
    rank: int
    alpha: float
    reg: float

    def parts(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, VALUES // max(len(self.items), self.rank) ** 2)
        for batch in batches:
            yield from (batch.slice(i, step) for i in range(0, len(batch), step))

    def confidence(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per user and item: confidence above one, the right side of the equations, and how often it was rated above zero."""
        rated, rates = batch.column("rated"), batch.column("rates").flatten().to_numpy().astype(np.float64)
        row = np.repeat(np.arange(len(batch)), rated.value_lengths().to_numpy())
        cell = row * len(self.items) + np.searchsorted(self.items, rated.flatten().to_numpy())
        more = self.alpha * np.abs(rates)
        return tuple(
            np.bincount(cell, x, minlength=len(batch) * len(self.items)).reshape(len(batch), -1)
            for x in (more, np.where(rates > 0, 1 + more, 0.0), (rates > 0).astype(float))
        )

    def users(self, known: np.ndarray, more: np.ndarray, right: np.ndarray, rated: np.ndarray) -> np.ndarray:
        """User factors from the item factors."""
        root = np.sqrt(1 + more)
        left = root[:, :, None] * (known @ known.T) * root[:, None, :]
        at = np.arange(len(known))
        left[:, at, at] += self.reg * rated.sum(axis=1)[:, None]
        return ((root * np.linalg.solve(left, (right / root)[:, :, None])[:, :, 0]) @ known).astype(np.float32)

    def sums(self, found: np.ndarray, more: np.ndarray, right: np.ndarray, rated: np.ndarray) -> np.ndarray:
        """What the items' equations need of these users, in one row: squares, squares per item, right sides, counts."""
        found = found.astype(np.float64)
        squares = [found.T @ found]
        for i in range(len(self.items)):
            rows = np.flatnonzero(more[:, i])
            squares.append((found[rows] * more[rows, i][:, None]).T @ found[rows])
        return np.concatenate([np.ravel(squares), np.ravel(right.T @ found), rated.sum(axis=0)])

    def solve(self, sums: np.ndarray) -> np.ndarray:
        """Item factors from the sums over all users."""
        m, r = len(self.items), self.rank
        squares, right, rated = np.split(sums, [(m + 1) * r * r, (m + 1) * r * r + m * r])
        squares, right = squares.reshape(m + 1, r, r), right.reshape(m, r)
        left = squares[0] + squares[1:] + self.reg * rated[:, None, None] * np.eye(r)
        return np.linalg.solve(left, right[:, :, None])[:, :, 0].astype(np.float32)


def added(rows: Iterable[np.ndarray]) -> np.ndarray | None:
    total = None
    for row in rows:
        total = row.copy() if total is None else np.add(total, row, out=total)
    return total


def summed(users: DataFrame, job: Job, known: np.ndarray | None) -> np.ndarray:
    """The sums over all users, with factors from the item factors or, without these, as they stand in ``features``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in job.parts(batches):
            of = job.confidence(batch)
            found = job.users(known, *of) if known is not None else batch.column("features").flatten().to_numpy().reshape(len(batch), -1)
            yield job.sums(found, *of)

    def packed(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    read = lambda batches: (np.frombuffer(x.as_py()) for batch in batches for x in batch.column("sums"))
    parts = users.mapInArrow(lambda batches: packed(added(rows(batches))), "sums binary")
    few = parts.repartition(SUMS).mapInArrow(lambda batches: packed(added(read(batches))), "sums binary")
    return added(np.frombuffer(r["sums"]) for r in few.collect())


def fit(als: ALS, shares: DataFrame, users: DataFrame, items: list[int]) -> Factors:
    """The model that ``als`` fits to the shares, whose users and their items stand in ``users``."""
    job = Job(np.array(items, dtype=np.int64), als.getRank(), als.getAlpha(), als.getRegParam())
    # without iterations Spark returns the factors that it starts from; the items' do not count, as they are replaced first
    start = als.copy().setMaxIter(0).setFinalStorageLevel("DISK_ONLY").fit(shares)
    first = users.join(start.userFactors, F.col("id") == F.col("user_id")).select("rated", "rates", "features")
    known = job.solve(summed(first, job, None))
    for _ in range(als.getMaxIter() - 1):
        known = job.solve(summed(users, job, known.astype(np.float64)))
    last = known.astype(np.float64)

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in job.parts(batches):
            found = job.users(last, *job.confidence(batch))
            ends = np.arange(len(batch) + 1, dtype=np.int32) * job.rank
            yield pa.RecordBatch.from_arrays([batch.column("user_id"), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], ["id", "features"])

    table = "id int, features array<float>"
    return Factors(
        users.mapInArrow(factors, table),
        shares.sparkSession.createDataFrame([(i, [float(x) for x in row]) for i, row in zip(items, known)], table),
    )
