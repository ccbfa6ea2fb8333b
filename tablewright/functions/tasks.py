"""Calling slow or flaky functions from inside tasks."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import wraps

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def retrying(
    errors: tuple[type[BaseException], ...] = (Exception,),
    max_retries: int = 5,
    first_delay: float = 1.0,
    max_delay: float = 32.0,
    factor: float = 2.0,
    jitter: bool = True,
    sleep: Callable[[float], None] = time.sleep,
):
    """Retry with growing pauses; the last error is raised after ``max_retries`` retries."""

    def decorate(fn):
        @wraps(fn)
        def call(*args, **kwargs):
            pause = first_delay
            for _ in range(max_retries):
                try:
                    return fn(*args, **kwargs)
                except errors:
                    spread = random.uniform(0.5, 1.5) if jitter else 1.0
                    sleep(min(max_delay, pause * spread))
                    pause = min(max_delay, pause * factor)
            return fn(*args, **kwargs)

        return call

    return decorate


def map_concurrently(
    df: DataFrame, column: str, fn: Callable, result: str, result_type: T.DataType, threads: int = 16
) -> DataFrame:
    """Add ``fn(value)`` as a column, running a bounded pool of threads in each task.

    Meant for calls that wait, such as fetching a page. The order of rows within a
    batch is kept, and batches stream through.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(result, result_type)])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for batch in batches:
                yield batch.assign(**{result: list(pool.map(fn, batch[column]))})

    return df.mapInPandas(work, schema)
