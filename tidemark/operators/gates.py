"""Publish a table only when its checks pass: row rules counted while it is written, table checks on what was written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.incremental import StateFolder
from tidemark.operators.quality import RowRule, not_unique, orphans

_SUMMARY = "check string, column string, failures bigint, severity string"


@dataclass(frozen=True)
class TableCheck:
    """A check of a whole table: ``count`` gives one row with ``failures``, and ``severity`` where it differs."""

    check: str
    column: str
    count: Callable[[DataFrame], DataFrame]
    severity: str = "error"


def unique(column: str, severity: str = "error") -> TableCheck:
    """Values that several rows hold."""
    return TableCheck("unique", column, lambda df: not_unique(df, column).agg(F.count(F.lit(1)).alias("failures")), severity)


def relationship(column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> TableCheck:
    """Rows whose value no parent row has."""
    return TableCheck(
        "relationships", column, lambda df: orphans(df, column, parent, parent_column).agg(F.count(F.lit(1)).alias("failures")), severity)


def fresh(column: str, asof: Column, warn_hours: float, error_hours: float) -> TableCheck:
    """One failure when the newest value is older than ``warn_hours``; beyond ``error_hours``, or without any value, an error."""

    def count(df: DataFrame) -> DataFrame:
        newest = df.agg(F.max(column).cast("timestamp_ntz").alias("newest"))
        hours = F.timestamp_diff("MICROSECOND", F.col("newest"), asof.cast("timestamp_ntz")) / F.lit(3.6e9)
        late = F.col("newest").isNull() | (hours > warn_hours)
        severity = F.when(F.col("newest").isNull() | (hours > error_hours), F.lit("error")).otherwise(F.lit("warn"))
        return newest.select(late.cast("bigint").alias("failures"), severity.alias("severity"))

    return TableCheck("freshness", column, count)


def publish_checked(
    table: StateFolder, df: DataFrame, batch_id: int, rules: Sequence[RowRule], checks: Sequence[TableCheck] = (), keep: int | None = None
) -> DataFrame:
    """Write ``df`` as the table's next version, publish it unless an error check fails, and return the summary.

    Summary: ``check``, ``column``, ``failures``, ``severity``, ``passed``, ``published``. The row rules are metrics of the
    very scan that writes the rows; table checks read the written version, so what is checked is what is published. A refused
    version is removed, and readers never see it. A batch that is published already is not written again: its
    summary is that of the published rows.
    """
    watched = Observation(f"gate-{batch_id}")
    counts = [F.count_if(F.coalesce(r.fails, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)]
    summary: list[tuple] = []

    def gate(written: DataFrame) -> bool:
        found = watched.get if counts else {}
        summary.extend((r.check, r.column, int(found[f"r{i}"]), r.severity) for i, r in enumerate(rules))
        for c in checks:
            row = c.count(written).first().asDict()
            summary.append((c.check, c.column, row["failures"], row.get("severity", c.severity)))
        return not any(failures and severity == "error" for _, _, failures, severity in summary)

    published = table.commit(df.observe(watched, *counts) if counts else df, batch_id, keep=keep, gate=gate)
    if not summary:
        # A replayed batch: nothing was written, so the metrics are gathered from the published rows.
        current = table.read()
        row = current.agg(*counts).first() if counts else None
        summary.extend((r.check, r.column, row[i], r.severity) for i, r in enumerate(rules))
        for c in checks:
            one = c.count(current).first().asDict()
            summary.append((c.check, c.column, one["failures"], one.get("severity", c.severity)))
        published = True
    out = table.spark.createDataFrame(summary, _SUMMARY)
    return out.select("*", (F.col("failures") == 0).alias("passed"), F.lit(published).alias("published"))
