"""Tables in hash-bucket partitions: a merge reads and rewrites only the buckets that its batch touches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import merge_upsert

BUCKET = "bucket"


def bucket_number(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


class BucketedFolder:
    """A parquet folder whose partitions are hash buckets of the keys; their number is fixed when it is made.

    ``rewrite`` replaces the buckets of a batch by Spark's dynamic partition overwrite: new files are staged, then put in
    place of the old ones, bucket by bucket. Where a job dies between two buckets, running it again with the same batch
    gives the same rows, as long as ``combine`` does (a merge by key does). Other buckets keep their files.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _exists(self) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def read(self, schema: str | None = None) -> DataFrame | None:
        """All rows without the bucket number; None before the first write."""
        if not self._exists():
            return None
        return self._rows().drop(BUCKET)

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def rewrite(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Put ``combine(old rows, batch)`` in place of the buckets that ``batch`` touches; returns their numbers.

        At most ``buckets`` numbers reach the driver. The shuffle deals by bucket and key hash, so that one
        bucket is written by several tasks where it is large.
        """
        number = bucket_number(self.keys, self.buckets)
        touched = sorted(r[BUCKET] for r in batch.select(number.alias(BUCKET)).distinct().collect())
        if not touched:
            return []
        if self._exists():
            # A literal list prunes partitions: other buckets are not even listed for reading.
            old = self._rows().filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        else:
            old = batch.limit(0)
        rows = combine(old, batch).withColumn(BUCKET, number)
        rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        return touched

    def merge(self, batch: DataFrame, order: Sequence[Column]) -> list[int]:
        """Upsert by key; of several batch rows with a key the first by ``order`` counts."""
        return self.rewrite(batch, lambda old, new: merge_upsert(old, new, self.keys, order))

    def files(self) -> dict[int, set[str]]:
        """Names of the files of each bucket."""
        rows = self._rows().groupBy(BUCKET).agg(F.collect_set(F.col("_metadata.file_name")).alias("names")).collect()
        return {r[BUCKET]: set(r["names"]) for r in rows}
