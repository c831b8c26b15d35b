"""File readers and writers with provenance. Schemas are always declared, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import between_marks
from tidemark.operators.skew import split_join

MAX_BROADCAST_HEADERS = 50_000


def _numbered_in_file(df: DataFrame) -> DataFrame:
    """Row number inside each file.

    Rows are numbered per file split (bounded by the split size), then shifted by the row counts
    of the file's earlier splits, so a huge file never meets in one task.
    """
    rows = df.withColumn("__pos", F.monotonically_increasing_id())
    inside = Window.partitionBy("__file", "__block").orderBy("__pos")
    before = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"))
    shift = counts.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return (
        rows.withColumn("__rn", F.row_number().over(inside))
        .join(shift, ["__file", "__block"])
        .withColumn("row_number", F.col("__rn") + F.col("__shift"))
        .drop("__rn", "__shift", "__pos", "__block")
    )


def land_json(spark: SparkSession, path: str, landed_at: str, glob: str = "*.json") -> DataFrame:
    """Raw landing rows: file_name, row_number, landed_at, payload (one JSON text per line)."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    raw = reader.text(path).select(
        F.col("value").alias("payload"),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
    )
    return _numbered_in_file(raw).select(
        F.col("__file").alias("file_name"),
        "row_number",
        F.lit(landed_at).cast("timestamp_ntz").alias("landed_at"),
        "payload",
    )


def read_skipping_bad_files(spark: SparkSession, path: str, ddl: str) -> tuple[DataFrame, DataFrame]:
    """(rows of clean files, bad files with their bad record counts): one bad record drops its file."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    record = F.from_json("value", f"{ddl}, _bad string", options)
    rows = lines.select(F.col("_metadata.file_path").alias("file_name"), record.alias("r"))
    bad = rows.filter(F.col("r._bad").isNotNull()).groupBy("file_name").agg(F.count(F.lit(1)).alias("bad_records"))
    clean = split_join(rows, bad.select("file_name"), ["file_name"], "left_anti")
    return clean.select("file_name", "r.*").drop("_bad"), bad


def read_json_array(spark: SparkSession, path: str, ddl: str, document_per_file: bool = False) -> DataFrame:
    """Rows of documents whose top level is an array; one document per line, or one per file."""
    return spark.read.schema(ddl).json(path, multiLine=document_per_file)


def read_delimited(
    spark: SparkSession,
    path: str,
    ddl: str,
    sep: str = ",",
    header_rows: int = 0,
    encoding: str = "UTF-8",
    quote: str = '"',
    malformed: str = "DROPMALFORMED",
) -> DataFrame:
    """Delimited text. With several header rows the first rows of each file's first split are cut."""
    options = dict(sep=sep, encoding=encoding, quote=quote, mode=malformed)
    if header_rows <= 1:
        return spark.read.schema(ddl).csv(path, header=bool(header_rows), enforceSchema=True, **options)
    typed = T.StructType.fromDDL(ddl)
    texts = ", ".join(f"`{f.name}` string" for f in typed.fields)
    options["mode"] = "PERMISSIVE"
    raw = spark.read.schema(f"{texts}, _bad string").option("columnNameOfCorruptRecord", "_bad").csv(path, **options)
    raw = raw.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    raw = raw.withColumn("__pos", F.monotonically_increasing_id())
    # The k-th smallest position of a file's first split marks the end of its header.
    first = raw.filter("__block = 0").select("__file", "__pos")
    limited = first.withColumn("__rn", F.row_number().over(Window.partitionBy("__file").orderBy("__pos")))
    header = limited.filter(F.col("__rn") <= header_rows).select("__file", "__pos")
    if len(raw.inputFiles()) * header_rows <= MAX_BROADCAST_HEADERS:
        header = F.broadcast(header)  # so many rows at most; otherwise the join is shuffled
    body = raw.join(header, ["__file", "__pos"], "left_anti")
    if malformed == "DROPMALFORMED":
        body = body.filter(F.col("_bad").isNull())
    return body.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in typed.fields])


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """file_name, content: each file as one value."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_name"), F.col("value").alias("content"))
    )


def read_gzip_lines(spark: SparkSession, path: str, partitions: int) -> DataFrame:
    """Lines of gzip files. Such files do not split, so the lines are spread again after the read."""
    return spark.read.text(path).repartition(partitions)


def read_labelled_folder(spark: SparkSession, path: str, ddl: str, left: str, right: str, fmt: str = "parquet") -> DataFrame:
    """A folder of files as one table, with ``label`` cut from each file path between two markers."""
    rows = spark.read.schema(ddl).format(fmt).option("recursiveFileLookup", "true").load(path)
    return rows.withColumn("label", between_marks(F.col("_metadata.file_path"), left, right))


def inline_table(spark: SparkSession, rows: Sequence[tuple], ddl: str, index: str | None = None) -> DataFrame:
    """Constant table, optionally with a running index from 0. A local relation: no job, known size."""
    fields = T.StructType.fromDDL(ddl).fields
    if index:
        rows = [(*r, i) for i, r in enumerate(rows)]
        fields = [*fields, T.StructField(index, T.IntegerType())]
    args = {f"v{i}_{j}": v for i, row in enumerate(rows) for j, v in enumerate(row)}
    values = ", ".join("(" + ", ".join(f":v{i}_{j}" for j in range(len(fields))) + ")" for i in range(len(rows)))
    names = ", ".join(f"`{f.name}`" for f in fields)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})", args=args)
    return table.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replace a target folder by the rows of a source, then read it back under the same schema."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Truncate and refill an external table, keeping its definition."""
    df.write.option("truncate", "true").jdbc(url, table, mode="overwrite", properties=properties or {})


def latest_modified_file(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """The newest file over many folders; only listings are read, never contents."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(folders))
    return listing.select("path", "modificationTime", "length").agg(
        F.max_by(F.struct("path", "modificationTime", "length"), F.struct("modificationTime", "path")).alias("f")
    ).select("f.*")


def chunk_items(df: DataFrame, items: str, size: int, chunk: str = "chunk", name: str = "items") -> DataFrame:
    """Split an array column into numbered chunks of at most ``size`` items, one row per chunk."""
    total = F.size(F.col(items))
    starts = F.when(total > 0, F.sequence(F.lit(0), F.floor((total - 1) / size).cast("int")))
    others = [c for c in df.columns if c != items]
    cut = df.select(*others, F.col(items).alias("__items"), F.explode(starts).alias(chunk))
    return cut.withColumn(name, F.slice("__items", F.col(chunk) * size + 1, F.lit(size))).drop("__items")


def merge_json(spark: SparkSession, paths: Sequence[str], ddl: str) -> DataFrame:
    """Many JSON files and folders as one dataset."""
    return spark.read.schema(ddl).option("recursiveFileLookup", "true").json(list(paths))


def head_lookup(documents: DataFrame, people: Column, units: Column, keys: Sequence[str]) -> DataFrame:
    """Normalise a nested document: explode people and units, join each person to the unit's head."""
    person = documents.select(*keys, F.explode(people).alias("p")).select(*keys, "p.name", "p.unit")
    unit = documents.select(*keys, F.explode(units).alias("u")).select(*keys, F.col("u.unit").alias("unit"), "u.head")
    return person.join(unit, [*keys, "unit"], "left")
