"""Change events as a stream: each micro-batch is stored once and current filings follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sakuin.operators import replay


def append_events(events: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Store a stream of change events below `log`, one folder per micro-batch: a batch that is sent again replaces its own folder."""

    def store(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(["id"]).write.mode("overwrite").parquet(f"{log}/batch={number}")

    return events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_filings(base: DataFrame, log: DataFrame) -> DataFrame:
    """Filings after all stored events; an event that came in two batches counts once."""
    return replay.replay(base, log.dropDuplicates(["code", "id"]))
