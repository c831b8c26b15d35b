"""Small helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_dir

#: Pattern of a word, for Java and RE2: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the cluster's shared scratch folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, label: str, column: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, bucketed by ``column``: aggregations and joins on it need no shuffle.

    ``df`` should come out of ``repartition(n, column)`` with n the shuffle width; each task then writes one bucket.
    """
    spark = df.sparkSession
    name = f"tidemark_{label}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column)
    writer.option("path", scratch_dir(spark, f"llm-{label}")).format("parquet").saveAsTable(name)
    out = spark.table(name)
    # The plan has the files and their buckets by now; only the name goes.
    spark.sql(f"DROP TABLE {name}")
    return out


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly over the cluster before work on the CPU; long texts and hot sources do not pile up."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def sample_keys(df: DataFrame, group: str, key: str, rows: int) -> list[tuple]:
    """(group, hash, key) of the ``rows`` distinct keys with the smallest hashes in each group, in this order.

    One scan estimates the distinct keys of each group, a second takes those below a bound of the hash that leaves room for
    chance and the estimate's error. So no group is one task's work, repeated keys merge before they move, and about ``rows`` +
    8 sqrt(``rows``) keys a group reach the driver. Rows without group or key are left out; an empty table gives nothing.
    """
    known = df.select(F.col(group).alias("g"), F.col(key).alias("k")).where(F.col("g").isNotNull() & F.col("k").isNotNull())
    sizes = known.groupBy("g").agg(F.approx_count_distinct("k", 0.02).alias("n")).collect()
    if not sizes:
        return []
    room = 1.1 * (rows + 8 * rows ** 0.5 + 20)
    bounds = []
    for r in sizes:
        reach = min(1.0, room / max(1, r["n"])) if r["n"] > 2 * room else 1.0
        bounds += [F.lit(r["g"]), F.lit(min(2 ** 63 - 1, -(2 ** 63) + int(reach * 2 ** 64)))]
    near = known.withColumn("h", F.xxhash64("k")).where(F.col("h") <= F.create_map(*bounds)[F.col("g")]).distinct()
    found: dict = {}
    for r in sorted(near.collect(), key=lambda r: (r["g"], r["h"], r["k"])):
        found.setdefault(r["g"], []).append((r["g"], r["h"], r["k"]))
    return [entry for entries in found.values() for entry in entries[:rows]]


def slices(batches: Iterator[pa.RecordBatch], chars: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Batches cut into parts of about ``chars`` characters, with the texts of their last column; a text stays whole."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        at, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= chars or i + 1 == len(texts):
                yield batch.slice(at, i + 1 - at), texts[at : i + 1]
                at, size = i + 1, 0


def append_columns(
    df: DataFrame, inputs: Sequence[str], outputs: str, make: Callable[[], Callable[..., list[list]]], rows: int = 256,
    arrow: bool = False,
) -> DataFrame:
    """``df`` with columns computed in Python from the columns ``inputs``, batch by batch through Arrow.

    ``make`` runs once per task and returns a function from lists (one per input) to lists (one per
    column of the schema string ``outputs``); with ``arrow`` the inputs stay Arrow arrays. Columns of ``df`` named as an output are replaced.
    """
    added = T._parse_datatype_string(outputs)
    names = {f.name.lower() for f in added}
    kept = [c for c in df.columns if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in kept] + list(added))
    # Inputs travel under names of their own, since outputs may replace them.
    plain = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(inputs)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        function = make()
        types = [to_arrow_type(f.dataType) for f in added]
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                columns = [part.column(len(kept) + i) for i in range(len(inputs))]
                columns = columns if arrow else [c.to_pylist() for c in columns]
                made = function(*columns)
                arrays = [part.column(i) for i in range(len(kept))]
                arrays += [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return plain.mapInArrow(work, schema)
