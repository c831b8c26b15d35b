"""Structured Streaming jobs: landing, routing, merging and measuring streams.

Any source with the record schema fits (a message-queue connector on a cluster, a folder of
files here). Batch and stream share the same DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.buckets import BucketedFolder
from tidemark.operators.changes import DELETED, SEQUENCE, apply_changes_state, current_rows
from tidemark.operators.incremental import StateFolder
from tidemark.operators.ordered import latest_by_key
from tidemark.session import file_count

# Column names and types of a message-stream record.
RECORD_DDL = (
    "stream string, data binary, partitionKey string, shardId string, sequenceNumber string, "
    "approximateArrivalTimestamp timestamp_ntz"
)


def stream_files(
    spark: SparkSession, path: str, ddl: str, fmt: str = "parquet", glob: str = "*", files_per_batch: int | None = None
) -> DataFrame:
    """Endless read of a folder; files whose name misses the pattern are ignored."""
    reader = spark.readStream.format(fmt).schema(ddl).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start_position(stream: DataFrame, position: str, arrival: str = "approximateArrivalTimestamp") -> DataFrame:
    """``earliest`` keeps all records, any other text is the arrival time to start at.

    ``latest`` is the time at which the job is started, so the caller passes that time.
    """
    if position == "earliest":
        return stream
    return stream.filter(F.col(arrival) >= F.lit(position).cast("timestamp_ntz"))


def bronze(records: DataFrame) -> DataFrame:
    """Landing projection: payload as text beside its provenance columns."""
    return records.select(
        "stream",
        "data",
        F.col("data").cast("string").alias("data_str"),
        "partitionKey",
        "shardId",
        "sequenceNumber",
        "approximateArrivalTimestamp",
    )


def to_records(df: DataFrame, stream: str, payload: Column, key: Column, sequence: Column, arrival: Column) -> DataFrame:
    """Wrap rows as message-stream records."""
    return df.select(
        F.lit(stream).alias("stream"),
        payload.cast("binary").alias("data"),
        key.cast("string").alias("partitionKey"),
        F.concat(F.lit("shard-"), F.pmod(F.xxhash64(key), F.lit(4)).cast("string")).alias("shardId"),
        F.lpad(sequence.cast("string"), 20, "0").alias("sequenceNumber"),
        arrival.alias("approximateArrivalTimestamp"),
    )


def json_pass_through(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Sink records: key and an ISO-8601 JSON text of the projected columns."""
    body = F.to_json(F.struct(*columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return df.select(F.col(key), body.alias("value"))


def spread_by_element(df: DataFrame) -> DataFrame:
    """Distribute records by a hash of the whole element, so that a hot key spreads like any other."""
    return df.repartition(F.xxhash64(*df.columns))


def run_available(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything that is available now to a file sink, exactly once, then stop."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_each_batch(
    df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class MergedTable:
    """Type-1 state of a stream: a compacted base in hash buckets plus one small delta folder per micro-batch.

    A micro-batch writes only its own latest row per key, so its cost follows the batch and not
    the table. Reading merges base and deltas; ``compact`` folds the deltas into the base now and then and rewrites
    only the buckets that they touch. A replayed batch overwrites its own delta folder and so changes nothing; folding
    a delta again, after a job that died, changes nothing either.

    Deleted keys stay as tombstones, so that a late older row cannot bring them back. With ``lateness`` seconds, a bucket
    that is rewritten drops tombstones whose first sequence column, a timestamp, lies further back than that from the newest
    row folded; rows may then not come later than this.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], sequence: Sequence[str], delete_when: Column,
        buckets: int | None = None, lateness: int | None = None,
    ):
        self.spark, self.keys, self.sequence, self.delete_when = spark, list(keys), list(sequence), delete_when
        self.lateness = lateness
        self.deltas = f"{path.rstrip('/')}/deltas"
        self.base = BucketedFolder(spark, f"{path.rstrip('/')}/base", keys, buckets or file_count(spark))
        self._folded = StateFolder(spark, f"{path.rstrip('/')}/folded")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        reduced = apply_changes_state(batch, self.keys, self.sequence, self.delete_when)
        reduced.write.mode("overwrite").parquet(f"{self.deltas}/batch_id={batch_id}")

    def folded(self) -> int:
        """The last batch that the base holds."""
        return max(self._folded.versions().values(), default=-1)

    def _newer(self) -> DataFrame:
        return self.spark.read.parquet(self.deltas).filter(F.col("batch_id") > self.folded()).drop("batch_id")

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_by_key(rows, self.keys, [F.col(SEQUENCE).desc(), F.col(DELETED).desc()])

    def state(self) -> DataFrame:
        """Latest row per key with tombstones."""
        base = self.base.read()
        if base is not None and not self.delta_batches():
            return base
        newer = self._newer()
        return self._latest(newer if base is None else base.unionByName(newer))

    def compact(self, batch_id: int) -> list[int]:
        """Fold the deltas up to this batch into the base; returns the buckets rewritten.

        Deltas that were folded one compaction earlier are removed, so a reader that began before this one finds its files.
        """
        before, batches = self.folded(), self.delta_batches()
        if batch_id <= before:
            return []
        deltas = self.spark.read.parquet(self.deltas).filter((F.col("batch_id") > before) & (F.col("batch_id") <= batch_id)).drop("batch_id")

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            rows = self._latest(old.unionByName(new))
            if self.lateness is None:
                return rows
            at = F.col(SEQUENCE)[self.sequence[0]]
            newest = deltas.agg(F.max(at)).scalar()
            return rows.filter(~F.col(DELETED) | (at >= F.timestamp_add("SECOND", F.lit(-self.lateness), newest)))

        touched = self.base.rewrite(deltas, combine)
        self._folded.commit(self.spark.createDataFrame([(batch_id,)], "batch_id bigint"), batch_id, keep=2)
        self._folded.remove(f"{self.deltas}/batch_id={old}" for old in batches if 0 <= old <= before)
        return touched

    def delta_batches(self) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in self._folded.names(self.deltas) if name.startswith("batch_id="))

    def current(self) -> DataFrame:
        return current_rows(self.state())


def merge_stream(
    feed: DataFrame, table: MergedTable, checkpoint: str, compact_every: int = 50, mode: str = "append"
) -> DataFrame:
    """Type-1 merge of a stream: deletes, late rows and replays give the batch result.

    With ``mode="update"`` the feed may be a windowed aggregate whose open windows still grow. A
    source without files gives an empty table.
    """
    # An empty delta before the first batch carries the schema.
    table.add(table.spark.createDataFrame([], feed.schema), -1)

    def work(batch: DataFrame, batch_id: int) -> None:
        table.add(batch, batch_id)
        if (batch_id + 1) % compact_every == 0:
            table.compact(batch_id)

    run_each_batch(feed, work, checkpoint, mode)
    return table.current()


def throughput(records: DataFrame, time: str, payload: str, every: str = "1 minute") -> DataFrame:
    """Rows and payload bytes per tumbling window."""
    return (
        records.groupBy(F.window(time, every).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.octet_length(payload)).alias("n_bytes"))
        .select(F.col("w.start").alias("window_start"), "n_rows", "n_bytes")
    )


def stream_throughput(
    records: DataFrame, time: str, payload: str, path: str, checkpoint: str, every: str = "1 minute"
) -> DataFrame:
    """``throughput`` of a stream, however late a row comes.

    Each micro-batch writes its own sums under its number, so a replay overwrites itself and no
    state and no watermark is needed; reading adds the sums of all batches up.
    """
    spark = records.sparkSession

    def work(batch: DataFrame, batch_id: int) -> None:
        throughput(batch, time, payload, every).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    work(spark.createDataFrame([], records.schema), -1)
    run_each_batch(records, work, checkpoint)
    return spark.read.parquet(path).groupBy("window_start").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Progress events of a query as rows: batch, time, input rows, run duration in ms, and the
    seconds since the batch before. A query keeps a bounded number of them."""
    rows = [
        (p["batchId"], p["timestamp"], p["numInputRows"], p["durationMs"].get("triggerExecution"))
        for p in query.recentProgress
    ]
    raw = spark.createDataFrame(rows, "batch_id bigint, at string, input_rows bigint, duration_ms bigint")
    timed = raw.withColumn("at", F.col("at").try_cast("timestamp"))
    gap = F.timestamp_diff("MILLISECOND", F.lag("at").over(Window.orderBy("batch_id", "at")), F.col("at")) / 1000
    return timed.withColumn("seconds_since_previous", gap)
