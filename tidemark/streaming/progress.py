"""Run statistics of streams, from every progress event of a run."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators.ordered import neighbour_row

_EVENTS = "query_id string, run_id string, batch_id bigint, started_at string, input_rows bigint, duration_ms bigint"


class ProgressLog(StreamingQueryListener):
    """Appends the progress events of all streams of a session to a table, as they come.

    A query itself remembers its last events only. Used as a context: events are written in blocks of ``every``, when a
    query ends, and at the end of the context, which first waits until the ends of all queries it saw start have come in.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 200, patience: float = 60.0):
        self.spark, self.path, self.every, self.patience = spark, path, every, patience
        self._held: list[tuple] = []
        self._running: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._change:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        row = (p["id"], p["runId"], p["batchId"], p["timestamp"], p["numInputRows"], p["durationMs"].get("triggerExecution"))
        with self._change:
            self._held.append(row)
            full = len(self._held) >= self.every
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._change:
            self._running.discard(str(event.runId))
            self._change.notify_all()

    def flush(self) -> None:
        """Append what is held; what cannot be written stays held."""
        with self._change:
            rows, self._held = self._held, []
        if rows:
            try:
                self.spark.createDataFrame(rows, _EVENTS).coalesce(1).write.mode("append").parquet(self.path)
            except Exception:
                with self._change:
                    self._held = rows + self._held
                raise

    def __enter__(self) -> ProgressLog:
        self.spark.createDataFrame([], _EVENTS).write.mode("append").parquet(self.path)
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # Events travel on a bus of their own and may come in after the query has returned.
        with self._change:
            self._change.wait_for(lambda: not self._running, self.patience)
        self.spark.streams.removeListener(self)
        self.flush()

    def read(self) -> DataFrame:
        """Events with ``started_at`` and ``completed_at`` as timestamps."""
        rows = self.spark.read.schema(_EVENTS).parquet(self.path)
        start = F.col("started_at").try_cast("timestamp")
        return rows.withColumn("started_at", start).withColumn("completed_at", F.timestamp_add("MILLISECOND", F.col("duration_ms"), start))


def run_statistics(events: DataFrame) -> DataFrame:
    """Per run: batches and rows, mean seconds from one start to the next, least, greatest and mean seconds of a batch.

    Events of batches without rows count as batches only where they ran; a run of one batch has no gap.
    """
    marked = neighbour_row(events, ["run_id"], ["batch_id", "started_at"], ["started_at"])
    gap = F.timestamp_diff("MILLISECOND", F.col("previous_started_at"), F.col("started_at")) / 1000
    seconds = F.timestamp_diff("MILLISECOND", F.col("started_at"), F.col("completed_at")) / 1000
    return marked.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("input_rows").alias("input_rows"), F.max("input_rows").alias("largest_batch"),
        F.min("input_rows").alias("smallest_batch"), F.avg(gap).alias("mean_gap"), F.min(seconds).alias("min_seconds"),
        F.max(seconds).alias("max_seconds"), F.avg(seconds).alias("mean_seconds"))
