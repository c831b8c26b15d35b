"""Small reports over lists of tables: row counts, emptiness, existence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.governance import union_all


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()]
    )


def non_empty_report(spark: SparkSession, views: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """(view, status, message): ``filled``, ``empty`` or ``error``. One probe row per view is read."""
    found = []
    for name, load in views.items():
        try:
            found.append((name, "empty" if load().isEmpty() else "filled", None))
        except PySparkException as problem:
            found.append((name, "error", str(problem).splitlines()[0]))
    return spark.createDataFrame(found, "view_name string, status string, message string")


def validate_requests(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """VALID, INVALID SCHEMA or INVALID TABLE per (schema_name, table_name) request.

    A null table asks for the whole schema.
    """
    tables = catalog.select("schema_name", "table_name").distinct()
    schemas = tables.select("schema_name").distinct().withColumn("__schema", F.lit(True))
    known = tables.withColumn("__table", F.lit(True))
    status = (
        F.when(F.col("__schema").isNull(), F.lit("INVALID SCHEMA"))
        .when(F.col("table_name").isNotNull() & F.col("__table").isNull(), F.lit("INVALID TABLE"))
        .otherwise(F.lit("VALID"))
    )
    return (
        requests.join(schemas, "schema_name", "left")
        .join(known, ["schema_name", "table_name"], "left")
        .withColumn("status", status)
        .drop("__schema", "__table")
    )
