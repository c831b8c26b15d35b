"""Change data: envelopes, type-1 apply with tombstones, merges, change streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import latest_by_key
from tidemark.operators.skew import split_join

METADATA_DDL = "struct<`schema-name`:string,`table-name`:string,operation:string>"
SEQUENCE = "__sequence"
DELETED = "__deleted"


def _parse_once(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Adds a parsed column through a generator: later filters on it cannot repeat the parse."""
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def parse_metadata(df: DataFrame, payload: str = "data_str") -> DataFrame:
    """Adds ``schema_name``, ``table_name``, ``operation`` from the envelope's metadata block."""
    rows = _parse_once(df, F.from_json(F.col(payload), f"struct<metadata:{METADATA_DDL}>"), "__m")
    meta = F.col("__m.metadata")
    return rows.select(
        "*",
        meta["schema-name"].alias("schema_name"),
        meta["table-name"].alias("table_name"),
        meta["operation"].alias("operation"),
    ).drop("__m")


def route(df: DataFrame, schema: str, table: str, data_ddl: str, payload: str = "data_str") -> DataFrame:
    """Rows of one source table with their parsed ``data`` block.

    The cheap metadata filter comes first, so only the routed rows pay for the full parse.
    """
    routed = parse_metadata(df, payload).filter((F.col("schema_name") == schema) & (F.col("table_name") == table))
    parsed = _parse_once(routed, F.from_json(F.col(payload), f"struct<data:{data_ddl}>"), "__d")
    return parsed.withColumn("data", F.col("__d.data")).drop("__d")


def split_null_payload(df: DataFrame, data: str = "data") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows by presence of the parsed payload."""
    return df.filter(F.col(data).isNotNull()), df.filter(F.col(data).isNull())


def _sequenced(feed: DataFrame, sequence: Sequence[str], delete_when: Column) -> DataFrame:
    return feed.select(
        "*", F.struct(*sequence).alias(SEQUENCE), F.coalesce(delete_when, F.lit(False)).alias(DELETED)
    )


def apply_changes_state(
    feed: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    delete_when: Column,
    state: DataFrame | None = None,
) -> DataFrame:
    """Latest row per key including tombstones, after adding ``feed`` to ``state``.

    Deleted keys stay as tombstones with their sequence, so an older row that arrives in a later
    batch cannot bring the key back. The result does not depend on arrival order or batch split.
    """
    rows = _sequenced(feed, sequence, delete_when)
    if state is not None:
        rows = state.unionByName(rows, allowMissingColumns=True)
    return latest_by_key(rows, keys, [F.col(SEQUENCE).desc(), F.col(DELETED).desc()])


def current_rows(state: DataFrame, except_cols: Sequence[str] = ()) -> DataFrame:
    return state.filter(~F.col(DELETED)).drop(SEQUENCE, DELETED, *except_cols)


def apply_changes(
    feed: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    delete_when: Column,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """Type-1 current state of a whole feed."""
    return current_rows(apply_changes_state(feed, keys, sequence, delete_when), except_cols)


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Replace rows of the target by the latest batch row of the same key, add new keys."""
    fresh = latest_by_key(batch, keys, order)
    kept = split_join(target, fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh)


def insert_first_wins(
    target: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Insert that ignores keys already present, in the target or earlier in the batch."""
    fresh = latest_by_key(batch, keys, order)
    if target is None:
        return fresh
    return target.unionByName(split_join(fresh, target.select(*keys), keys, "left_anti"))


def append_newer(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Source rows above the target's greatest ``column``; all of them when the target is empty."""
    high = target.agg(F.max(column)).scalar()
    return source.filter(high.isNull() | (F.col(column) > high))


def change_stream(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes between two states of a table, with ``action`` and ``is_update``.

    An update shows as a DELETE of the old row and an INSERT of the new row, both flagged.
    """
    columns = list(after.columns)
    values = [c for c in columns if c not in keys]
    old = before.select(*[F.col(c).alias(f"__o_{c}") for c in columns], F.lit(True).alias("__has_old"))
    new = after.select(*columns, F.lit(True).alias("__has_new"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"__o_{k}"))
    both = old.join(new, condition, "full_outer")
    same = F.lit(True)
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"__o_{c}"))
    had, has = F.col("__has_old").isNotNull(), F.col("__has_new").isNotNull()
    old_row = F.struct(*[F.col(f"__o_{c}").alias(c) for c in columns], F.lit("DELETE").alias("action"))
    new_row = F.struct(*[F.col(c) for c in columns], F.lit("INSERT").alias("action"))
    return (
        both.filter(~(had & has & same))
        .withColumn("is_update", had & has)
        .select("is_update", F.explode(F.array_compact(F.array(F.when(had, old_row), F.when(has, new_row)))).alias("r"))
        .select(*[F.col(f"r.{c}").alias(c) for c in columns], F.col("r.action").alias("action"), "is_update")
    )
