"""Streams over the append-only failure log: counts, windows with late data, and the retry state of each item."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def log_stream(spark: SparkSession, path: str, schema: T.StructType | str, format: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(format).load(path)


def windowed(events: DataFrame, ts: str, width: str, keys: list, late: str | None = None) -> DataFrame:
    """Events of each window of time and key. late: how late an event may come (streams only)."""
    if late is not None:
        events = events.withWatermark(ts, late)
    out = events.groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n")


def retry_states(events: DataFrame, item: str, order: str, most: int = 3, timeout: str | None = None) -> DataFrame:
    """A stream of (item, order, attempt, action), one row for each failure as in ledger.attempts; an item's count is kept across
    batches and restarts by the checkpoint. Within a batch an item's failures count by their order."""
    kind, at = (events.schema[c].dataType.simpleString() for c in (item, order))
    most = max(1, most)

    def step(key, batches: Iterator, state: GroupState):
        import pandas as pd

        before = state.get[0] if state.exists else 0
        times = sorted(x for b in batches for x in b[order])
        state.update(((before + len(times)) % most,))
        attempt = [(before + i) % most + 1 for i in range(len(times))]
        yield pd.DataFrame({item: [key[0]] * len(times), order: times, "attempt": attempt, "action": ["dead_letter" if n == most else "retry" for n in attempt]})

    return events.groupBy(item).applyInPandasWithState(step, f"`{item}` {kind}, `{order}` {at}, attempt long, action string", "n long", "append", timeout or GroupStateTimeout.NoTimeout)


def export_finished(stream: DataFrame, path: str, checkpoint: str, domain: str, finished: Column):
    """Writes the finished rows of each micro-batch by domain and batch: earlier batches' rows of a domain stay, and a batch that runs
    again replaces its own alone."""

    def write(batch: DataFrame, number: int) -> None:
        own = batch.where(finished).withColumn("_batch", F.lit(number))
        own.write.partitionBy(domain, "_batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
