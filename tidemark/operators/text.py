"""Text jobs over whole documents: replacements, rewriting, extraction, record stitching."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_col, whole_part
from tidemark.operators.ordered import last_marked


def replace_in_order(value: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements applied one after the other; a result may be replaced again.

    The list is folded over an array, so that the expression does not nest as deep as it is long.
    """
    if not pairs:
        return as_col(value)
    table = F.array(*[F.struct(F.lit(old).alias("old"), F.lit(new).alias("new")) for old, new in pairs])
    return F.aggregate(table, as_col(value), lambda text, p: F.replace(text, p["old"], p["new"]))


def replace_longest_first(value: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    return replace_in_order(value, sorted(pairs, key=lambda p: -len(p[0])))


def rewrite(value: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Regular-expression rules in order; patterns without look-around."""
    out = as_col(value)
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def replace_block_and_append(df: DataFrame, text: str, old: str, new: str, footer: str) -> DataFrame:
    """Replace a block where present, always append the footer; ``replaced`` tells which rows had it."""
    body = F.replace(F.col(text), F.lit(old), F.lit(new))
    return df.withColumn("replaced", F.contains(F.col(text), F.lit(old))).withColumn(
        text, F.concat(body, F.lit("\n"), F.lit(footer.strip()))
    )


# A template call: double braces, any case and spacing, two texts in either quote, of which the second names the table.
_QUOTED = r"""(?:'[^']+'|"[^"]+")"""
SOURCE_CALL = rf"""(?i)\{{\{{-?\s*source\s*\(\s*{_QUOTED}\s*,\s*['"]([^'"]+)['"]\s*\)\s*-?\}}\}}"""
# A table reference: the whole run of characters after the word, up to blanks, brackets or list marks.
TABLE_WORD = r"(?i)(?:FROM|JOIN)(?<![A-Za-z0-9_](?:FROM|JOIN))\s+([^\s(),;]+)"


def referenced_tables(df: DataFrame, name: str, text: str) -> DataFrame:
    """Distinct (name, table) pairs named by template calls or after FROM / JOIN words.

    JOIN also covers its LEFT, RIGHT, INNER and CROSS forms. Sub-queries do not match; a name with
    other characters than word characters and dots is no table, nor are the words AS and TABLE. A
    table function gives the name before its bracket.
    """
    calls = F.regexp_extract_all(F.col(text), F.lit(SOURCE_CALL), F.lit(1))
    words = F.transform(
        F.filter(
            F.regexp_extract_all(F.col(text), F.lit(TABLE_WORD), F.lit(1)),
            lambda w: w.rlike(r"^[A-Za-z0-9_.]+$"),
        ),
        lambda w: F.regexp_replace(w, r"\.", ""),
    )
    named = df.select(F.col(name), F.explode(F.array_distinct(F.concat(calls, words))).alias("table_name"))
    return named.filter((F.col("table_name") != "") & ~F.upper("table_name").isin("AS", "TABLE")).distinct()


def tokens_with_prefix(df: DataFrame, name: str, text: str, prefix: str) -> DataFrame:
    """Distinct (name, token): words that start with ``prefix``, every holder of a token kept."""
    # The border is checked behind the literal prefix, so the scan looks for the literal alone.
    literal = re.escape(prefix)
    pattern = rf"{literal}(?<![A-Za-z0-9_]{literal})[A-Za-z0-9_]*"
    found = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    return df.select(F.col(name), F.explode(found).alias("token")).distinct()


# Terminal colour codes and the success line of a model run.
COLOUR_CODE = r"\x1b\[[0-9;]*m"
RUN_LINE = r"sql (?:table|view|incremental) model ([A-Za-z0-9_.]+) .*SUCCESS [0-9]+ in ([0-9]+(?:\.[0-9]+)?)s"


def mine_run_log(lines: DataFrame, line: str, slower_than: float) -> DataFrame:
    """(model, seconds) of table, view and incremental runs that took longer than the threshold."""
    plain = F.regexp_replace(F.col(line), COLOUR_CODE, "")
    hit = lines.select("*", plain.alias("__plain"))
    return (
        hit.filter(F.col("__plain").rlike(RUN_LINE))
        .withColumn("model", F.regexp_extract("__plain", RUN_LINE, 1))
        .withColumn("seconds", F.regexp_extract("__plain", RUN_LINE, 2).cast("double"))
        .filter(F.col("seconds") > slower_than)
        .drop("__plain")
    )


def stitch_records(
    lines: DataFrame, file: str, line_no: str, line: str, marker: str = "88", cut: int = 3, ranges: int | None = None
) -> DataFrame:
    """Glue continuation lines (starting with ``marker``) onto the record before them.

    A continuation loses its first ``cut`` characters and outer blanks. Leading continuations
    without a record form one of their own. Rows of a long file stay spread: the start of the
    record is carried forward from range to range, and the only gather is one record's own lines.
    """
    continues = F.startswith(F.col(line), F.lit(marker))
    body = F.when(continues, F.trim(F.substr(F.col(line), F.lit(cut + 1)))).otherwise(F.col(line))
    rows = lines.select(file, line_no, body.alias("__body"), (~continues).alias("__starts"))
    starts = F.when(F.col("__starts"), F.col(line_no))
    rows = last_marked(rows, [file], [line_no], starts, "__start", ranges)
    pieces = F.transform(F.sort_array(F.collect_list(F.struct(line_no, "__body"))), lambda p: p["__body"])
    records = rows.groupBy(file, F.col("__start").alias("first_line")).agg(F.array_join(pieces, "").alias("record"))
    return records.filter(F.col("record") != "")


def section_between(value: Column | str, open_tag: str, close_tag: str) -> Column:
    """Text between two tags, any case, across lines; null when absent."""
    pattern = rf"(?is){re.escape(open_tag)}(.*?){re.escape(close_tag)}"
    return F.get(F.regexp_extract_all(as_col(value), F.lit(pattern), F.lit(1)), F.lit(0))
