"""Incremental runs: only files that came since the last run are read, results are appended once.

Windows over the event stream are an addition of this engine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_new_files(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Process what is new under ``source`` and stop; the checkpoint remembers what was done."""
    stream = spark.readStream.schema(schema).parquet(source)

    def append(batch: DataFrame, number: int) -> None:
        # a batch that is run again after a failure replaces what it wrote before
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def event_windows(events: DataFrame, length: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts and sums per window and event type; rows later than ``late`` don't count on a stream."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    return timed.groupBy(F.window("ts", length), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def user_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user: events at most ``gap`` apart."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    return timed.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))


class _FirstWins(StatefulProcessor):
    """Hands on the first row of its key, of a batch the one of the least order, and nothing ever after."""

    def __init__(self, columns: list[str], order: list[str]):
        self.columns, self.order = columns, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "ord long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.seen.exists():
            return
        best = None
        for part in rows:
            least = part.sort_values(self.order, kind="stable").head(1)
            best = least if best is None else pd.concat([best, least]).sort_values(self.order, kind="stable").head(1)
        if best is not None:
            self.seen.update((int(best["ord"].iloc[0]),))
            yield best[self.columns]

    def close(self) -> None:
        pass


def first_triples(triples: DataFrame) -> DataFrame:
    """The first triple of each (image, head, relation, tail), without regard to case, on a stream of batches.

    What was handed on is kept as state, a row per key, so a triple that comes again in a later batch, or after a restart
    from the checkpoint, doesn't come out again. A batch gives the triple of the least ``ord``, as the batch operator does.
    Needs the RocksDB state store (``use_state_store``).
    """
    keys = [F.lower(c).alias(f"_{c}") for c in ("head", "relation", "tail")]
    wide = triples.select("*", *keys)
    out = wide.groupBy("img_id", "_head", "_relation", "_tail").transformWithStateInPandas(
        statefulProcessor=_FirstWins(triples.columns, ["ord", "head", "relation", "tail"]), outputStructType=triples.schema, outputMode="append", timeMode="none"
    )
    return out


def new_requests(requests: DataFrame, late: str | None = None) -> DataFrame:
    """Each (api, key) of a stream of requests once. ``late`` bounds the state: repeats count as such if they come within
    that time of the first (column ``asked_at``); without it every key is kept."""
    slim = requests.select("api", "key", "payload", *(["asked_at"] if late else []))
    return slim.withWatermark("asked_at", late).dropDuplicatesWithinWatermark(["api", "key"]) if late else slim.dropDuplicates(["api", "key"])


def use_state_store(spark: SparkSession) -> None:
    """Keep state on disk with changelogs, as large states need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def append_stream(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append what is new to ``target`` and stop; each batch is written exactly once."""
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
