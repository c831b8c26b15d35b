"""Entitlement views from control rows, scope resolution, registry changes, usage and layout reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import merge_upsert
from tidemark.operators.ordered import running_sums
from tidemark.session import cut_lineage


def entitled_view(
    df: DataFrame,
    columns: Sequence[str] | None,
    tenant_column: str | None = None,
    tenants: Sequence | None = None,
    extra_filter: str | None = None,
) -> DataFrame:
    """What one control row shares: its columns, its tenants (rows without a tenant are shared), its filter."""
    if tenant_column is not None and tenants is not None:
        df = df.filter(F.col(tenant_column).isin(*tenants) | F.col(tenant_column).isNull())
    if extra_filter:
        df = df.filter(F.expr(extra_filter))
    return df.select(*columns) if columns else df


def resolve_scope(control: DataFrame, requested: dict[str, str | Sequence[str]]) -> DataFrame:
    """Distinct control entries in scope; each level is ``*`` or an explicit list."""
    scope = control
    for column, wanted in requested.items():
        if wanted != "*":
            names = [wanted] if isinstance(wanted, str) else list(wanted)
            scope = scope.filter(F.upper(F.col(column)).isin(*[n.upper() for n in names]))
    return scope.select(*requested).distinct()


def access_defaults(requests: DataFrame, default_role: str) -> DataFrame:
    """Fill what an access request leaves open about its target.

    Database: the entity and the last part (between underscores) of the source database; schema and table: those of the
    source; roles: ``default_role``. A null or empty database, schema or role is open; a table only where it is null,
    since a schema request has an empty one. Null entities and sources leave their defaults null.
    """
    filled = {
        "target_database": F.concat("entity", F.lit("_"), F.substring_index("source_database", "_", -1)),
        "target_schema": F.col("source_schema"),
        "access_roles": F.lit(default_role),
    }
    out = requests.withColumns({c: F.when(F.coalesce(F.col(c), F.lit("")) == "", d).otherwise(F.col(c)) for c, d in filled.items()})
    return out.withColumn("target_table", F.coalesce("target_table", "source_table"))


def registry_upsert(
    registry: DataFrame, requests: DataFrame, catalog: DataFrame, order: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Apply access requests to a registry: (new registry, request statuses).

    Columns: entity, schema_name, table_name, access_type (SCHEMA or TABLE). A request is refused
    when its source is not in the catalog, or when the entity already holds the other access type
    on that schema. Where it holds none, the first valid request by the columns ``order`` (without
    them, or at a tie, a schema request) decides, and later ones of the other type are refused. An
    accepted schema request replaces what the entity held on the schema by one entry per table of it.
    """
    held = registry.groupBy("entity", "schema_name").agg(F.max("access_type").alias("held_type"))
    tables = catalog.select("schema_name", "table_name").distinct()
    schemas = tables.select("schema_name").distinct().withColumn("schema_known", F.lit(True))
    known = tables.withColumn("table_known", F.lit(True))
    checked = requests.join(schemas, "schema_name", "left").join(known, ["schema_name", "table_name"], "left")
    valid = checked.filter("schema_known and (access_type = 'SCHEMA' or table_known)")
    leading = valid.groupBy("entity", "schema_name").agg(
        F.min_by("access_type", F.struct(*order, "access_type")).alias("leading_type"))
    judged = (
        checked.join(held, ["entity", "schema_name"], "left")
        .join(leading, ["entity", "schema_name"], "left")
        .withColumn("held_type", F.coalesce("held_type", "leading_type"))
        .withColumn(
            "status",
            F.when(F.col("schema_known").isNull(), F.lit("INVALID SCHEMA"))
            .when((F.col("access_type") == "TABLE") & F.col("table_known").isNull(), F.lit("INVALID TABLE"))
            .when((F.col("access_type") == "SCHEMA") & (F.col("held_type") == "TABLE"), F.lit("TABLE ACCESS EXISTS"))
            .when((F.col("access_type") == "TABLE") & (F.col("held_type") == "SCHEMA"), F.lit("SCHEMA ACCESS EXISTS"))
            .otherwise(F.lit("ACCEPTED")),
        )
    )
    columns = ["entity", "schema_name", "table_name", "access_type"]
    accepted = judged.filter("status = 'ACCEPTED'")
    by_schema = accepted.filter("access_type = 'SCHEMA'").drop("table_name").join(tables, "schema_name").select(*columns)
    by_table = accepted.filter("access_type = 'TABLE'").select(*columns)
    keys = ["entity", "schema_name", "table_name"]
    fresh = by_schema.unionByName(by_table)
    replaced = accepted.filter("access_type = 'SCHEMA'").select("entity", "schema_name").distinct()
    kept = registry.select(*columns).join(replaced, ["entity", "schema_name"], "left_anti").select(*columns)
    return (
        merge_upsert(kept, fresh, keys, [F.col("access_type")]),
        judged.select(*columns, "status"),
    )


def file_ranges(df: DataFrame, key: str) -> DataFrame:
    """Per-file min and max of a layout key (reads the key column only)."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_rows")
    )


def range_overlap(ranges: DataFrame, bucket: Column | None = None, low: str = "low", high: str = "high") -> DataFrame:
    """Per file: ``overlaps`` (other files its range meets), ``depth`` (files covering its start), ``is_constant``.

    A sweep over range ends, never pairs: files starting at or before my end, less those ending
    before my start. The ranges, one row per file, are kept in a checkpoint: the table behind
    them is read once. ``bucket``, a monotone expression over ``at``, is taken from callers that still give one; the sweep
    samples its own ranges.
    """
    ranges = cut_lineage(ranges)
    ends = ranges.select(
        F.explode(
            F.array(
                F.struct(F.col(low).alias("at"), F.lit(1).alias("start"), F.lit(0).alias("stop")),
                F.struct(F.col(high).alias("at"), F.lit(0).alias("start"), F.lit(1).alias("stop")),
            )
        ).alias("e"),
    ).select("e.*")
    points = ends.groupBy("at").agg(F.sum("start").alias("start"), F.sum("stop").alias("stop"))
    swept = running_sums(points, [], ["at"], {"started": "start", "stopped": "stop"}).select(
        "at", "started", (F.col("stopped") - F.col("stop")).alias("ended_before")
    )
    at_low = swept.select(F.col("at").alias(low), F.col("started").alias("__s_low"), F.col("ended_before").alias("__e_low"))
    at_high = swept.select(F.col("at").alias(high), F.col("started").alias("__s_high"))
    return (
        ranges.join(at_low, low)
        .join(at_high, high)
        .withColumn("overlaps", F.col("__s_high") - F.col("__e_low") - 1)
        .withColumn("depth", F.col("__s_low") - F.col("__e_low"))
        .withColumn("is_constant", F.col(low) == F.col(high))
        .drop("__s_low", "__e_low", "__s_high")
    )


def depth_histogram(overlap: DataFrame) -> DataFrame:
    return overlap.groupBy("depth").agg(F.count(F.lit(1)).alias("n_files"))


def write_clustered(df: DataFrame, path: str, by: Sequence[Column], files: int) -> None:
    """Rewrite in key order so that file ranges barely overlap and scans can skip files."""
    df.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
