"""Data checks. Each check returns its failing rows; ``summarise`` reports many in one table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import split_join


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by several rows, with their row counts.

    Long texts are compared by hash first: only values whose hash repeats are shuffled whole, and
    the exact grouping of those settles hash collisions.
    """
    present = df.filter(F.col(column).isNotNull()).select(column)
    if dict(df.dtypes)[column] == "string":
        hashed = present.withColumn("__hash", F.xxhash64(column))
        repeated = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__hash")
        present = split_join(hashed, repeated, ["__hash"], "left_semi")
    return present.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*accepted)).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    present = child.filter(F.col(column).isNotNull())
    return present.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def not_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 1)


def any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    condition = F.lit(False)
    for c in columns or df.columns:
        condition = condition | F.col(c).isNull()
    return df.filter(condition)


def freshness(df: DataFrame, column: str, asof: Column, warn_hours: float, error_hours: float) -> DataFrame:
    """One row: newest value, age in hours and pass / warn / error."""
    newest = df.agg(F.max(column).cast("timestamp_ntz").alias("newest"))
    age = F.timestamp_diff("MICROSECOND", F.col("newest"), asof.cast("timestamp_ntz")) / F.lit(3.6e9)
    status = (
        F.when(F.col("newest").isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return newest.select("newest", age.alias("age_hours"), status.alias("status"))


@dataclass(frozen=True)
class RowRule:
    """A per-row rule; ``fails`` is true on a bad row."""

    check: str
    column: str
    fails: Column
    severity: str = "error"


def summarise(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules in one pass over the table: check, column, failures, severity, passed."""
    counted = df.agg(*[F.count_if(r.fails).alias(f"f{i}") for i, r in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(
                F.lit(r.check).alias("check"),
                F.lit(r.column).alias("column"),
                F.col(f"f{i}").alias("failures"),
                F.lit(r.severity).alias("severity"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*", (F.col("r.failures") == 0).alias("passed"))


def gate(summary: DataFrame) -> list[str]:
    """Raise when a check of severity ``error`` failed; return the failed warnings. Summary rows are few."""
    failed = summary.filter(~F.col("passed")).collect()
    errors = [f"{r['check']}({r['column']}): {r['failures']}" for r in failed if r["severity"] == "error"]
    if errors:
        raise ValueError("; ".join(errors))
    return [f"{r['check']}({r['column']}): {r['failures']}" for r in failed]


# Detector patterns of the personal-data scan, each with a text that every hit
# contains (a cheap test before the pattern runs). The left border of a number is checked behind
# its first digit, so the scan skips other characters quickly.
DETECTORS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "@"),
    "phone": (r"\+?[0-9]{1,3}[ -]?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}", ""),
    "card": (r"[0-9](?<![0-9][0-9])[0-9]{3}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}(?![0-9])", ""),
    "ip_address": (r"[0-9](?<![0-9][0-9])[0-9]{0,2}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])", "."),
    "national_id": (r"[0-9](?<![0-9][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9])", "-"),
}


def _hits(column: str, pattern: str, needle: str) -> Column:
    found = F.col(column).rlike(pattern)
    return F.contains(F.col(column), F.lit(needle)) & found if needle else found


def scan_personal_data(
    objects: dict[str, DataFrame],
    detectors: dict[str, tuple[str, str]] | None = None,
    sample: int = 0,
    key: str | None = None,
) -> DataFrame:
    """Hits per object, text column and detector. ``sample`` = 0 scans every row.

    One pass per object: every (column, detector) pair is a conditional count of the same scan.
    """
    detectors = detectors or DETECTORS
    parts = []
    for name, df in objects.items():
        texts = [c for c, t in df.dtypes if t == "string"]
        if not texts:
            continue
        if sample:
            df = df.orderBy(F.md5(F.col(key or texts[0]).cast("string")), *texts).limit(sample)
        pairs = [(c, d) for c in texts for d in detectors]
        counts = [F.count_if(_hits(c, *detectors[d])).alias(f"h{i}") for i, (c, d) in enumerate(pairs)]
        counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
        rows = [
            F.struct(
                F.lit(name).alias("object"),
                F.lit(c).alias("column"),
                F.lit(d).alias("detector"),
                F.col(f"h{i}").alias("hits"),
                F.col("n_rows"),
            )
            for i, (c, d) in enumerate(pairs)
        ]
        parts.append(counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def scan_delta(scan: DataFrame, previous: DataFrame) -> DataFrame:
    """Findings that are new or whose hit count changed since the previous scan."""
    keys = ["object", "column", "detector"]
    known = previous.select(*keys, F.col("hits").alias("__old"))
    return scan.join(known, keys, "left").filter(~F.col("hits").eqNullSafe(F.col("__old"))).drop("__old")
