"""Type-2 history tables: ``valid_from``, ``valid_to``, ``updated_at``, ``scd_id`` per version."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = ["scd_id", "updated_at", "valid_from", "valid_to"]


def _version(rows: DataFrame, keys: Sequence[str], changed_at: Column) -> DataFrame:
    identity = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], changed_at.cast("string"))
    return rows.select(
        "*",
        F.md5(identity).alias("scd_id"),
        changed_at.alias("updated_at"),
        changed_at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def initial_snapshot(source: DataFrame, keys: Sequence[str], changed_at: Column) -> DataFrame:
    return _version(source, keys, changed_at.cast("timestamp_ntz"))


def _move(
    open_rows: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    changed: Column,
    changed_at: Column,
    asof: Column,
    close_deleted: bool,
) -> DataFrame:
    """What one run makes of the open versions: open ones, and those it closes.

    ``changed`` compares source columns with open versions (``__h_`` prefix).
    """
    data = [c for c in open_rows.columns if c not in META]
    open_rows = open_rows.select(*[F.col(c).alias(f"__h_{c}") for c in open_rows.columns], F.lit(True).alias("__open"))
    # The grouping shuffles by the keys, which the join needs anyway; a repeated key fails the run.
    rest = F.struct(*[c for c in data if c not in keys], changed_at.cast("timestamp_ntz").alias("__at"))
    repeated = F.raise_error(F.concat(F.lit("source key repeats: "), F.to_json(F.struct(*keys))))
    present = F.when(F.count(F.lit(1)) > 1, repeated.cast("boolean")).otherwise(F.lit(True))
    incoming = source.select(*keys, rest.alias("__rest")).groupBy(*keys).agg(F.first("__rest").alias("__rest"), present.alias("__in"))
    incoming = incoming.select(*keys, "__rest.*", "__in")
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"__h_{k}"))
    both = open_rows.join(incoming, condition, "full_outer")
    had, has = F.col("__open").isNotNull(), F.col("__in").isNotNull()
    differs = had & has & F.coalesce(changed, F.lit(False))
    gone = had & ~has & F.lit(close_deleted)
    end = F.when(differs, F.col("__at")).when(gone, asof.cast("timestamp_ntz"))
    identity = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.col("__at").cast("string"))
    old = F.struct(
        *[F.col(f"__h_{c}").alias(c) for c in data],
        *[F.col(f"__h_{c}").alias(c) for c in META[:3]],
        end.alias("valid_to"),
    )
    new = F.struct(
        *[F.col(c) for c in data],
        F.md5(identity).alias("scd_id"),
        F.col("__at").alias("updated_at"),
        F.col("__at").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    versions = F.array_compact(F.array(F.when(had, old), F.when(has & (~had | differs), new)))
    return both.select(F.explode(versions).alias("v")).select("v.*").select(*data, *META)


def _advance(history: DataFrame, *run) -> DataFrame:
    """One snapshot run over a whole history: closed versions pass through."""
    data = [c for c in history.columns if c not in META]
    closed = history.filter(F.col("valid_to").isNotNull())
    return closed.select(*data, *META).unionByName(_move(history.filter(F.col("valid_to").isNull()), *run))


def _later() -> Column:
    return F.col("__at") > F.col("__h_updated_at")


def _differs(check: Sequence[str]) -> Column:
    changed = F.lit(False)
    for c in check:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"__h_{c}"))
    return changed


def snapshot_by_timestamp(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    updated_at: str,
    asof: Column,
    close_deleted: bool = True,
) -> DataFrame:
    """New version when the source row carries a later ``updated_at`` than the open version."""
    return _advance(history, source, keys, _later(), F.col(updated_at), asof, close_deleted)


def snapshot_by_columns(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    check: Sequence[str],
    asof: Column,
    close_deleted: bool = True,
) -> DataFrame:
    """New version when any checked column differs, nulls compared as values."""
    return _advance(history, source, keys, _differs(check), asof, asof, close_deleted)


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would break a snapshot run; must be empty."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Rows valid at a moment: ``valid_from <= t < valid_to``."""
    at = moment.cast("timestamp_ntz")
    return history.filter(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    ).drop(*META)


def as_of_offset(history: DataFrame, now: Column, seconds: int) -> DataFrame:
    """Rows valid ``seconds`` before ``now``."""
    return as_of(history, F.timestamp_add("SECOND", F.lit(-seconds), now.cast("timestamp_ntz")))


def before_change(history: DataFrame, keys: Sequence[str], scd_id: Column | str) -> DataFrame:
    """State just before the version ``scd_id`` (a text or a scalar) began; without such a version no row."""
    wanted = F.lit(scd_id) if isinstance(scd_id, str) else scd_id
    start = history.filter(F.col("scd_id") == wanted).agg(F.max("valid_from")).scalar()
    return history.filter(
        (F.col("valid_from") < start) & (F.col("valid_to").isNull() | (F.col("valid_to") >= start))
    ).drop(*META)


class HistoryTable:
    """A type-2 history on disk whose open and closed versions are partitions of their own.

    Every run has a folder ``run=n`` with the parts ``state=open`` (all versions open after it) and ``state=closed`` (those it
    closed). A run reads the open part of the run before and writes its own folder; closed versions are written once and neither
    read nor touched again, so a run's work follows the open rows, however long the history. Spark's commit marker, written
    last, publishes a run: one that failed half-way is not seen, and the next run writes over it. The history is every closed
    part and the newest open one. ``data`` are the fields without those of a version; with ``at`` (the column that says
    when a row changed) versions follow it, else the columns ``check``. One run at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, data: T.StructType, keys: Sequence[str], at: str | None = None, check: Sequence[str] = (),
    ):
        if (at is None) == (not check):
            raise ValueError("name the column of the change time, or the columns to compare")
        self.spark, self.path, self.keys, self.at, self.check = spark, path.rstrip("/"), list(keys), at, list(check)
        self.data = T.StructType([T.StructField(f.name, f.dataType) for f in data])
        times = [T.StructField(name, T.TimestampNTZType()) for name in META[1:]]
        self._schema = T.StructType([*self.data, T.StructField("scd_id", T.StringType()), *times])

    def _folder(self, run: int):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path if run < 0 else f"{self.path}/run={run}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self) -> list[int]:
        """Numbers of the published runs."""
        root, files = self._folder(-1)
        names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
        numbers = sorted(int(n[4:]) for n in names if re.fullmatch(r"run=\d+", n))
        marker = self.spark._jvm.org.apache.hadoop.fs.Path
        return [n for n in numbers if files.exists(marker(self._folder(n)[0], "_SUCCESS"))]

    def _part(self, run: int, state: str) -> DataFrame:
        """One part; a run without rows of that state has no such folder."""
        folder, files = self._folder(run)
        path = f"{self.path}/run={run}/state={state}"
        if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path)):
            return self.spark.read.schema(self._schema).parquet(path)
        return self.spark.createDataFrame([], self._schema)

    def open_rows(self) -> DataFrame:
        """The versions open now; reads no closed one."""
        done = self.runs()
        return self._part(done[-1], "open") if done else self.spark.createDataFrame([], self._schema)

    def closed_rows(self) -> DataFrame:
        done = self.runs()
        if not done:
            return self.spark.createDataFrame([], self._schema)
        every = self.spark.read.schema(T.StructType([*self._schema, T.StructField("run", T.IntegerType()), T.StructField("state", T.StringType())]))
        rows = every.parquet(self.path).filter((F.col("state") == "closed") & F.col("run").isin(done))
        return rows.drop("run", "state")

    def rows(self) -> DataFrame:
        return self.closed_rows().unionByName(self.open_rows())

    def run(self, source: DataFrame, asof: Column, close_deleted: bool = True, keep_open: int = 2) -> int:
        """Take one state of the source in; returns the number of the run.

        A key that repeats in the source fails the run, and nothing of it is published. The open parts of the last
        ``keep_open`` runs stay for readers that have begun; older ones are removed. An empty source closes every version
        (or none without ``close_deleted``).
        """
        if keep_open < 1:
            raise ValueError("the newest open part has to stay")
        done = self.runs()
        source = source.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.data])
        changed, at = (_later(), F.col(self.at)) if self.at else (_differs(self.check), asof)
        moved = _move(self.open_rows(), source, self.keys, changed, at, asof, close_deleted)
        number = (done[-1] if done else 0) + 1
        state = F.when(F.col("valid_to").isNull(), F.lit("open")).otherwise(F.lit("closed"))
        moved.withColumn("state", state).write.mode("overwrite").partitionBy("state").parquet(f"{self.path}/run={number}")
        for old in [*done, number][:-keep_open]:
            folder, files = self._folder(old)
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder, "state=open"), True)
        return number

    def files(self, state: str) -> set[str]:
        """Paths of the files of all closed versions, or of the open ones."""
        done = self.runs()
        kept = done if state == "closed" else done[-1:]
        return {name for run in kept for name in self._part(run, state).inputFiles()}
