"""Cosine retrieval over vector columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_dir

BLOCK_VALUES = 131_072  # numbers of one packed block: 1 MB


def _rows_to_matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64")


def cosine_to(vector: Column | str, query: Sequence[float]) -> Column:
    """Cosine similarity of a vector column to one given vector, in double precision.

    Null for a missing or an all-zero vector.
    """
    given = np.asarray(query, dtype="float64")
    if not np.linalg.norm(given) > 0:
        raise ValueError("the query vector has no direction")
    given = given / np.linalg.norm(given)

    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        out = np.full(len(batch), np.nan)
        present = batch.notna().to_numpy()
        if present.any():
            matrix = _rows_to_matrix(batch[present])
            size = np.linalg.norm(matrix, axis=1)
            out[present] = np.divide(matrix @ given, size, out=np.full(len(size), np.nan), where=size > 0)
        return pd.Series(out)

    return F.nanvl(score(F.col(vector) if isinstance(vector, str) else vector), F.lit(None).cast("double"))


def similar_rows(df: DataFrame, vector: str, query: Sequence[float], at_least: float) -> DataFrame:
    return df.withColumn("similarity", cosine_to(vector, query)).filter(F.col("similarity") >= at_least)


def top_k(df: DataFrame, vector: str, query: Sequence[float], k: int, key: str, above: float = 0.0) -> DataFrame:
    """The k best rows above a floor: every task keeps its own best k, then the few are merged."""
    scored = df.withColumn("similarity", cosine_to(vector, query)).filter(F.col("similarity") > above)
    return scored.orderBy(F.col("similarity").desc(), F.col(key)).limit(k)


def assemble_context(ranked: DataFrame, text: str, key: str, separator: str = "\n") -> DataFrame:
    """One row: quote-escaped texts joined in rank order, and the ids used. Input is a top-k."""
    escaped = F.replace(F.col(text), F.lit("'"), F.lit("''"))
    item = F.struct((-F.col("similarity")).alias("order"), F.col(key).alias("key"), escaped.alias("text"))
    items = F.sort_array(F.collect_list(item))
    return ranked.agg(items.alias("items")).select(
        F.array_join(F.transform("items", lambda i: i["text"]), separator).alias("context"),
        F.array_join(F.transform("items", lambda i: i["key"].cast("string")), ",").alias("ids"),
    )


def _pack(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows of a table as blocks of unit vectors: keys and one matrix each, at most ``BLOCK_VALUES`` numbers (or one row).

    Rows without key, vector or direction (null or non-finite entries, length zero) are left out. The blocks are written
    to the shared scratch folder, so a task that runs again finds the same ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def blocks(width: int, finish: bool) -> Iterator[pa.RecordBatch]:
            keys, matrix = (np.concatenate(part) for part in zip(*waiting[width]))
            rows = max(1, BLOCK_VALUES // width)
            end = len(keys) if finish else len(keys) - len(keys) % rows
            for at in range(0, end, rows):
                part = slice(at, min(at + rows, end))
                yield pa.RecordBatch.from_pylist(
                    [{"width": width, "keys": keys[part].tobytes(), "matrix": matrix[part].tobytes()}], schema=packed)
            waiting[width] = [(keys[end:], matrix[end:])]

        packed = pa.schema([("width", pa.int32()), ("keys", pa.binary()), ("matrix", pa.binary())])
        for batch in batches:
            widths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for width in np.unique(widths[widths > 0]).astype(int):
                part = batch.filter(pa.array(widths == width))
                matrix = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
                with np.errstate(invalid="ignore", over="ignore"):
                    size = np.linalg.norm(matrix, axis=1)
                good = np.isfinite(size) & (size > 0)
                keys = part.column(0).to_numpy(zero_copy_only=False).astype("int64")[good]
                waiting.setdefault(width, []).append((keys, matrix[good] / size[good, None]))
                yield from blocks(width, False)
        for width in waiting:
            yield from blocks(width, True)

    plain = df.select(F.col(key).cast("bigint").alias("k"), F.col(vector).alias("v")).filter("k IS NOT NULL AND v IS NOT NULL")
    schema = "width int, keys binary, matrix binary"
    path = scratch_dir(df.sparkSession, "vector-blocks")
    plain.mapInArrow(run, schema).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _lanes(parallel: int, corpus: int, queries: int) -> tuple[int, int]:
    """Into how many lanes corpus and queries are dealt, so that the copies sent add up to least.

    Each lane of the one meets each lane of the other in a task of its own: the corpus is sent once per query lane, the
    queries once per corpus lane. For ``parallel`` tasks the sum is least where corpus lanes / query lanes = corpus / queries.
    """
    first = min(corpus, parallel, max(1, round((parallel * corpus / queries) ** 0.5)))
    return first, min(queries, max(1, -(-parallel // first)))


def batch_top_k(
    corpus: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, query_vector: str, k: int
) -> DataFrame:
    """Exact top-k for many queries: (query_id, key, similarity, rank).

    Both tables are packed into blocks of bounded size and dealt into lanes; a task multiplies the blocks of one corpus lane
    with those of one query lane, block by block. It holds two blocks, their product and k hits per query of the block, however
    many rows either table has; neither passes through the driver. Per query and task k rows are left, of which Spark keeps
    the best. Ids are integers; equal scores fall to the smaller id. Rows without id, vector or direction take
    no part. Query ids should not repeat; corpus rows that do are hits of their own. Vectors of different length are refused.
    """
    schema = T.StructType(
        [T.StructField("query_id", T.LongType()), T.StructField(key, T.LongType()), T.StructField("similarity", T.DoubleType())]
    )
    spark = corpus.sparkSession
    left, right = _pack(corpus, key, vector), _pack(queries, query_key, query_vector)
    widths = left.select("width").unionByName(right.select("width")).distinct().limit(2).collect()
    if len(widths) > 1:
        raise ValueError("vectors of different length")
    many, asked = left.count(), right.count()
    if not many or not asked:
        return spark.createDataFrame([], schema).withColumn("rank", F.lit(None).cast("int"))
    rows, columns = _lanes(int(spark.conf.get("spark.sql.shuffle.partitions")), many, asked)

    def lane(lanes: int):
        return F.pmod(F.xxhash64("keys", "matrix"), F.lit(lanes)).cast("int")

    def tile(row, column):
        return row * F.lit(columns) + column

    every_column, every_row = F.sequence(F.lit(0), F.lit(columns - 1)), F.sequence(F.lit(0), F.lit(rows - 1))
    left = left.select("keys", "matrix", lane(rows).alias("row"), F.explode(every_column).alias("column"))
    right = right.select("width", F.col("keys").alias("asked"), F.col("matrix").alias("questions"),
                         lane(columns).alias("column"), F.explode(every_row).alias("row"))
    # A sort-merge join reads the queries' side once and keeps the corpus lane in a buffer that spills.
    met = right.select("width", "asked", "questions", tile(F.col("row"), F.col("column")).alias("tile")).hint("merge").join(
        left.select("keys", "matrix", tile(F.col("row"), F.col("column")).alias("tile")), "tile")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, which, names, scores = None, None, None, None, None

        def found() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(asked[which]), pa.array(names), pa.array(scores)], names=["query_id", key, "similarity"])

        for batch in batches:
            for i in range(batch.num_rows):
                width, block, questions, keys, matrix = (batch.column(c)[i] for c in ("width", "asked", "questions", "keys", "matrix"))
                block = block.as_py()
                if block != at:  # the pairs of one block of queries follow each other
                    if at is not None:
                        yield found()
                    at, asked = block, np.frombuffer(block, "int64")
                    question = np.frombuffer(questions.as_buffer(), "float64").reshape(-1, width.as_py())
                    which, names, scores = np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0)
                    floor = np.full(len(asked), -np.inf)
                ids = np.frombuffer(keys.as_buffer(), "int64")
                fresh = np.frombuffer(matrix.as_buffer(), "float64").reshape(len(ids), -1) @ question.T
                limit = floor
                if len(fresh) >= k:
                    limit = np.maximum(floor, np.partition(fresh, len(fresh) - k, axis=0)[len(fresh) - k])
                row, column = np.nonzero(fresh >= limit)
                which, names = np.concatenate([which, column]), np.concatenate([names, ids[row]])
                scores = np.concatenate([scores, fresh[row, column]])
                order = np.lexsort((names, -scores, which))
                which, names, scores = which[order], names[order], scores[order]
                place = np.arange(len(which)) - np.searchsorted(which, which, side="left")
                last = place == k - 1
                floor[which[last]] = scores[last]
                which, names, scores = which[place < k], names[place < k], scores[place < k]
        if at is not None:
            yield found()

    candidates = met.drop("tile").mapInArrow(best, schema)
    ranked = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), F.col(key))
    return candidates.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
