"""Per-minute usage of a request log that arrives late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.serving import usage_per_minute

# fixed value: the log may trail its requests by up to an hour
LATENESS = "60 minutes"


def stream_usage(requests: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Usage per minute of a streamed log; a minute is closed once the lateness has passed."""
    timed = requests.withColumn("ts", F.col("ts").cast("timestamp"))
    return usage_per_minute(timed.withWatermark("ts", lateness))


def accepted_requests(requests: DataFrame, key: str, lateness: str = LATENESS) -> DataFrame:
    """A streamed log without repeated requests, and without rows that come after the lateness has passed.

    A batch's rows are late by the newest time that had been seen when the batch before it began. A request's key is remembered for as long as a repetition may still arrive, so state does not grow with the log.
    """
    timed = requests.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", lateness).dropDuplicatesWithinWatermark([key])


def write_usage(usage: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed minutes to a Parquet table."""
    query = (
        usage.writeStream.trigger(availableNow=True).format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path).start()
    )
    query.awaitTermination()
    return query
