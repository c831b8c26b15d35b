"""Top-N members, samples and sequence ids."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_number
from tidemark.operators.ordered import number_rows


def top_members(df: DataFrame, member: str, measure: Column, n: int) -> DataFrame:
    """Members whose total is among the n greatest; ties with the n-th stay in.

    The n-th total comes from a limited sort (no single-task ranking of all members). Both uses
    of the totals read the same shuffle.
    """
    totals = df.filter(F.col(member).isNotNull()).groupBy(member).agg(measure.alias("__total"))
    floor = totals.select("__total").orderBy(F.col("__total").desc()).limit(n).agg(F.min("__total")).scalar()
    return totals.filter(F.col("__total") >= floor)


def rows_of_top_members(df: DataFrame, member: str, measure: Column, n: int) -> DataFrame:
    return df.join(top_members(df, member, measure, n).select(member), member, "left_semi")


def top_one(df: DataFrame, member: str, measure: Column) -> DataFrame:
    """The single leading member; equal totals fall to the smallest member."""
    totals = df.groupBy(member).agg(measure.alias("total"))
    return totals.orderBy(F.col("total").desc(), F.col(member)).limit(1)


def sample_percent(df: DataFrame, percent: float, key: Sequence[str], salt: str = "") -> DataFrame:
    """Repeatable row sample: a row is in when its key hash falls below the rate."""
    return df.filter(hash_number(*key, salt=salt) < F.lit(int(percent / 100 * 2**32)))


def sample_blocks(df: DataFrame, percent: float, block: Column | None = None, salt: str = "") -> DataFrame:
    """Repeatable block sample: whole file splits are in or out.

    ``block`` names a row's block; by default its file name and the split's offset in the file.
    """
    meta = F.col("_metadata")
    if block is None:
        block = F.concat_ws(":", F.substring_index(meta["file_path"], "/", -1), meta["file_block_start"].cast("string"))
    return df.filter(hash_number(block, salt=salt) < F.lit(int(percent / 100 * 2**32)))


def sample_partitions(df: DataFrame, partition: str, percent: float, salt: str = "") -> DataFrame:
    """Repeatable block sample over a partitioned folder: whole partitions are in or out, and those out are never opened.

    The partitions come from the file listing that Spark holds anyway; the chosen ones enter the plan as literals, which
    prune files at planning.
    """
    spark = df.sparkSession
    mark = re.compile(rf"/{re.escape(partition)}=([^/]*)/")
    names = sorted({unquote(m.group(1)) for path in df.inputFiles() if (m := mark.search(path))})
    blocks = spark.createDataFrame([(n,) for n in names], "block string")
    chosen = [r["block"] for r in blocks.filter(hash_number(F.col("block"), salt=salt) < F.lit(int(percent / 100 * 2**32))).collect()]
    return df.filter(F.col(partition).cast("string").isin(chosen))


def sequence_ids(
    df: DataFrame, order: Sequence[str], start: int = 1, increment: int = 1, name: str = "id"
) -> DataFrame:
    """Dense ids in a total order, numbered range by range."""
    numbered = number_rows(df, [], order, "__n")
    return numbered.withColumn(name, F.lit(start) + (F.col("__n") - 1) * F.lit(increment)).drop("__n")
