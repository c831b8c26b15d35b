"""Registry of named queries, each with an optional equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import Tables


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, directory: str) -> DataFrame:
        return plain_types(self.build(Tables(spark, directory)))


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Entry(build, sql)
        return build

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Report columns as bigint, double, string or boolean so that engines compare alike."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        out.append(col.alias(field.name))
    return df.select(*out)
