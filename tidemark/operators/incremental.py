"""Incremental loads: affected keys, load log, high-water marks, schema policy, current-state folders."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import split_join


def affected_keys(changes: Sequence[tuple[DataFrame, Column, Column]], key: str) -> DataFrame:
    """Distinct keys touched by any source: each item is (rows joined to the key, key column, changed when).

    One filter and one map-side distinct per source instead of a single join with a long OR.
    """
    out = None
    for rows, key_col, changed in changes:
        part = rows.filter(changed).select(key_col.alias(key)).distinct()
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def recompute_affected(
    target: DataFrame, keys: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Rows of untouched keys from ``target`` and freshly computed rows of the touched keys."""
    return split_join(target, keys, [key], "left_anti").unionByName(compute(keys))


def retain(df: DataFrame, expired: Column) -> DataFrame:
    """Rewrite without the rows that a retention rule calls expired."""
    return df.filter(~F.coalesce(expired, F.lit(False)))


def align_schema(target: DataFrame, incoming: DataFrame, policy: str = "append_new_columns") -> DataFrame:
    """Union under a schema policy: add columns the target lacks, or fail on any difference."""
    if policy == "fail":
        if dict(target.dtypes) != dict(incoming.dtypes):
            raise ValueError(f"schema changed: {target.dtypes} -> {incoming.dtypes}")
        return target.unionByName(incoming)
    if policy != "append_new_columns":
        raise ValueError(f"unknown schema policy {policy}")
    clash = {c for c, t in incoming.dtypes if dict(target.dtypes).get(c, t) != t}
    if clash:
        raise ValueError(f"column types changed: {sorted(clash)}")
    return target.unionByName(incoming, allowMissingColumns=True)


def log_run(log: DataFrame, run: DataFrame) -> DataFrame:
    """Append a run record; a first run of a table also gets its opening entry (null time)."""
    keys = ["project", "environment", "table_name"]
    opening = run.select(*keys).distinct().join(log.select(*keys).distinct(), keys, "left_anti")
    opening = opening.withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    return log.unionByName(opening.select(*log.columns)).unionByName(run.select(*log.columns))


def purge_log(log: DataFrame, asof: Column, purge_day: int = 3, updated_at: str = "updated_at") -> DataFrame:
    """On the purge day of a month keep only that month's records; on other days keep all."""
    keep = (F.dayofmonth(asof) != purge_day) | (F.trunc(F.col(updated_at).cast("date"), "month") == F.trunc(asof, "month"))
    return log.filter(keep)


def window_extract(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Rows of the half-open mark window [start, end)."""
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


class StateFolder:
    """Current-state parquet folder with numbered versions and a pointer written last.

    A reader resolves the pointer, so it sees the old or the new version and never a half-written
    one. The pointer names the batch that made the version: a replayed batch is skipped. The last
    ``keep`` versions stay readable for as-of reads.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._fs_path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        where = self._fs_path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def remove(self, paths: Iterable[str]) -> None:
        for path in paths:
            self._fs.delete(self._fs_path(path), True)

    def versions(self) -> dict[int, int]:
        """Committed versions to the batch that wrote each of them."""
        found = [re.fullmatch(r"v=(\d+),batch=(-?\d+)", n) for n in self.names(f"{self.path}/_commits")]
        return {int(m.group(1)): int(m.group(2)) for m in found if m}

    def read(self, version: int | None = None) -> DataFrame | None:
        committed = self.versions()
        eligible = [v for v in committed if version is None or v <= version]
        if not eligible:
            return None
        return self.spark.read.parquet(f"{self.path}/v={max(eligible)}")

    def commit(
        self, df: DataFrame, batch_id: int, keep: int | None = None, gate: Callable[[DataFrame], bool] | None = None
    ) -> bool:
        """Write the next version and publish it. A ``gate`` judges the written rows; what it refuses is removed."""
        committed = self.versions()
        if committed and max(committed.values()) >= batch_id >= 0:
            return False
        version = max(committed, default=0) + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        if gate and not gate(self.spark.read.schema(df.schema).parquet(f"{self.path}/v={version}")):
            self.remove([f"{self.path}/v={version}"])
            return False
        self._fs.mkdirs(self._fs_path(f"{self.path}/_commits"))
        self._fs.createNewFile(self._fs_path(f"{self.path}/_commits/v={version},batch={batch_id}"))
        if keep:
            for old in sorted(committed)[: max(0, len(committed) + 1 - keep)]:
                self.remove([f"{self.path}/_commits/v={old},batch={committed[old]}", f"{self.path}/v={old}"])
        return True


class HighWaterMark:
    """Mark kept as a small text folder; published only after the extract succeeded."""

    def __init__(self, spark: SparkSession, path: str):
        self._state = StateFolder(spark, path)
        self.spark = spark

    def current(self, default: str) -> str:
        marks = self._state.read()
        return marks.first()["mark"] if marks is not None else default

    def publish(self, mark: str) -> None:
        self._state.commit(self.spark.createDataFrame([(mark,)], "mark string"), batch_id=-1, keep=2)
