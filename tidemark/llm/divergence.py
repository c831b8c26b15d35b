"""How the sources of a language differ in their words: shared vocabulary, pairwise distance, leading terms.

White-space chunks are counted per document, without regard to case and signs; each distinct chunk of the whole corpus is cut into terms
once, and its terms are joined back to the counts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored, stored_by, table
from tidemark.operators.skew import split_join

#: A term: letters A-Z and everything beyond ASCII, taken from UTF-8 bytes; ASCII lower-casing leaves other bytes alone.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")

#: Letters A-Z lower-cased and all signs as one, so that chunks of the same terms are one chunk; white space parts them as before.
_SAME = bytes(b if b in b" \t\n\r\x0b\x0c" or TERM.match(bytes([b])) else ord(".") for b in range(256)).lower()

_PARTS = 1_000_000_000
_BITS = 24  # the filter of the second pass: 2 MB whatever the corpus
_TILE_TERMS, _TILE_SOURCES = 2048, 256  # a tile of shares takes 8 MB


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and number of each chunk of all texts, and the distinct chunks by number.

    A sign before a blank is left out: no term begins, ends or changes by this.
    """
    plain = pa.array([t.encode("utf-8", "replace").translate(_SAME).replace(b". ", b" ") for t in texts], pa.string())
    cut = pc.ascii_split_whitespace(plain)
    coded = cut.flatten().dictionary_encode()
    code, text = coded.indices.to_numpy(), np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy())
    # Blanks at the ends of a text leave empty strings.
    empty = pc.index(coded.dictionary, "").as_py()
    used = code != empty
    return text[used], code[used].astype(np.int64), coded.dictionary


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each occurs."""
    values = np.sort(values)
    at = np.flatnonzero(np.diff(values, prepend=-1))
    return values[at], np.diff(at, append=len(values))


def count_chunks(docs: DataFrame, held: int = 1 << 24) -> DataFrame:
    """``lang``, ``source``, ``chunk``, ``docs`` (rows that have it) and ``n`` (occurrences), summed over all rows.

    ``docs`` has lang, source and text without nulls. Chunks that differ in case A-Z, in which signs they have or in a sign
    before a blank only are one. A task counts about ``held`` characters and those of one more document at a time, then hands
    its sums on; Spark adds them up, dealt by chunk as all later steps want them. A chunk
    has one row per task, group and so many characters at most, so a frequent one is no burden.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        numbers: dict = {}
        of: list[int] = []

        def out():
            text, code, chunks = _coded(texts)
            # One row, then one group and chunk, as one number each.
            group, size = np.array(of, np.int64), max(1, len(chunks))
            cells, n = _counted(group[text] * size + code)
            mine = _counted(text * size + code)[0]
            _, rows = _counted(group[mine // size] * size + mine % size)
            langs, sources = (pa.array([g[i] for g in numbers], pa.string()) for i in (0, 1))
            for a in range(0, len(cells), 1 << 16):
                at, some = cells[a : a + (1 << 16)] // size, cells[a : a + (1 << 16)] % size
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(at)), sources.take(pa.array(at)), chunks.take(pa.array(some)),
                     pa.array(rows[a : a + (1 << 16)]), pa.array(n[a : a + (1 << 16)])],
                    names=["lang", "source", "chunk", "docs", "n"])
            texts.clear()
            of.clear()
            numbers.clear()

        size = 0
        for batch, some in slices(batches, held):
            of += [numbers.setdefault(g, len(numbers)) for g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            texts += some
            size += sum(map(len, some))
            if size > held:
                yield from out()
                size = 0
        if texts:
            yield from out()

    made = docs.select("lang", "source", "text").mapInArrow(work, "lang string, source string, chunk string, docs bigint, n bigint")
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return made.repartition(width, "chunk").groupBy("lang", "source", "chunk").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def chunk_terms(chunks: DataFrame) -> DataFrame:
    """``lang``, ``chunk``, ``docs``, ``term`` and ``times``. Equal chunks must lie side by side in one partition: each is cut once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, cut = None, []
        for batch in batches:
            at, terms, times = [], [], []
            for i, chunk in enumerate(batch.column(1).to_pylist()):
                if chunk != last:
                    found = TERM.findall(chunk.encode().lower())
                    last, cut = chunk, list(Counter(found).items()) if len(found) > 1 else [(found[0], 1)] if found else []
                for term, n in cut:
                    at.append(i)
                    terms.append(term)
                    times.append(n)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns), pa.array(terms, pa.string()), pa.array(times, pa.int64())], names=["lang", "chunk", "docs", "term", "times"])

    return chunks.select("lang", "chunk", "docs").mapInArrow(work, "lang string, chunk string, docs bigint, term string, times bigint")


def _filter_bits(chunks: DataFrame) -> bytes:
    """A byte for each of 2**24 hashes of a chunk, 1 where some chunk has it; 2**18 longs at most reach the driver."""
    bucket = F.crc32(F.col("chunk").cast("binary")).bitwiseAND(F.lit(2**_BITS - 1))
    packed = chunks.select(bucket.alias("b")).groupBy(F.floor(F.col("b") / 64).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits")).collect()
    words = np.zeros(2**_BITS // 64, np.int64)
    words[[r["at"] for r in packed]] = [r["bits"] for r in packed]
    return words.astype("<i8").tobytes()


def _exact_counts(docs: DataFrame, doubtful: DataFrame) -> DataFrame:
    """``lang``, ``term`` and ``docs``, the distinct rows that hold a term of ``doubtful`` (lang, chunk, term)."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(doubtful))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen = np.unpackbits(np.frombuffer(bits.value, np.uint8), bitorder="little")
        number = TaskContext.get().partitionId() << 40
        for batch, texts in slices(batches):
            text, code, chunks = _coded(texts)
            hit = seen[np.array([zlib.crc32(c.encode()) & (2**_BITS - 1) for c in chunks.to_pylist()], np.int64)] > 0
            held, size = hit[code] if len(code) else np.zeros(0, bool), max(1, len(chunks))
            found = _counted(text[held] * size + code[held])[0]
            at = pa.array(found // size)
            yield pa.RecordBatch.from_arrays([pa.array(number + found // size), batch.column(0).take(at), chunks.take(pa.array(found % size))], names=["doc", "lang", "chunk"])
            number += len(texts)

    # A row is numbered within its own task, so a task that runs again gives it the same number.
    hits = docs.select("lang", "text").mapInArrow(work, "doc bigint, lang string, chunk string")
    found = hits.join(doubtful, ["lang", "chunk"]).select("doc", "lang", "term").distinct()
    return found.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("docs"))


def _share(count: Column, total: Column, size: Column, smooth: int) -> Column:
    """1 + floor(10**9 * (count + smooth) / (total + smooth * size)) in exact decimals; 0 without a vocabulary."""
    whole = (count + F.lit(smooth)).cast("decimal(20,0)") * F.lit(_PARTS).cast("decimal(10,0)")
    base = (total + F.lit(smooth) * size).cast("decimal(20,0)")
    # ``div`` on decimals is exact; a division would round to its scale.
    return F.when(size > 0, F.lit(1).cast("bigint") + F.call_function("div", whole, F.when(size > 0, base))).otherwise(F.lit(0).cast("bigint"))


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` of all ordered pairs of a language's sources.

    Shares lie in tiles of terms by sources; a term that a source lacks has the share ``zero`` of that source.
    A tile adds up |p - q| - |zero_p - zero_q| over its terms, which is 0 for terms that both lack, so only terms
    that occur are looked at. Memory is that of a tile, however many terms and sources there are.
    """
    by = F.col("number").alias("number"), F.floor(F.col("number") / _TILE_SOURCES).cast("int").alias("block")
    ordered = groups.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    sizes = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / _TILE_SOURCES).cast("int").alias("blocks"), F.max("size").alias("all_terms"))
    sizes = sizes.withColumn("spans", F.greatest(F.lit(1), F.ceil(F.col("all_terms") / _TILE_TERMS)).cast("int"))
    members = stored(ordered.join(sizes, "lang").select("lang", "source", "zero", "size", "blocks", "spans", *by), "members")
    tiles = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = split_join(cells.select("lang", "source", "term", "p"), members, ["lang", "source"]).select(
        "lang", "number", "block", "term", "p", F.pmod(F.xxhash64("term"), "spans").cast("int").alias("span"), tiles)
    every = members.select("lang", "number", "block", "zero", "spans", tiles).select(
        "lang", "number", "block", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("spans") - 1)).alias("span"), "other")
    placed = rows.unionByName(every).select("lang", "span", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "number", "term", "p")

    def tile(part: pa.Table) -> pa.Table:
        numbers, shares = part["number"].to_numpy(), part["p"].to_numpy()
        terms = part["term"].combine_chunks().dictionary_encode()
        at = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        low, high = part["i"][0].as_py(), part["j"][0].as_py()
        members_ = at < 0
        order = np.argsort(numbers[members_])
        sources, zero = numbers[members_][order], shares[members_][order]
        grid = np.tile(zero, (len(terms.dictionary), 1))
        grid[at[~members_], np.searchsorted(sources, numbers[~members_])] = shares[~members_]
        left, right = np.flatnonzero(sources // _TILE_SOURCES == low), np.flatnonzero(sources // _TILE_SOURCES == high)
        a, b, value = [], [], []
        for k in left:
            others = right[right > k]
            a.append(np.full(len(others), sources[k]))
            b.append(sources[others])
            value.append(np.abs(grid[:, [k]] - grid[:, others]).sum(0) - len(grid) * np.abs(zero[k] - zero[others]))
        lang = part["lang"][0].as_py()
        a, b, value = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (a, b, value))
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "part": value})

    sums = placed.groupBy("lang", "span", "i", "j").applyInArrow(tile, "lang string, a bigint, b bigint, part bigint")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    for side in "ab":
        named = members.select("lang", F.col("number").cast("bigint").alias(side), F.col("source").alias(f"source_{side}"), F.col("zero").alias(f"zero_{side}"), *(["size"] if side == "a" else []))
        sums = split_join(sums, named, ["lang", side])
    value = F.col("part") + F.col("size") * F.abs(F.col("zero_a") - F.col("zero_b"))
    both = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    return sums.select("lang", both.alias("pair"), value.alias("value")).select("lang", "pair.source", "pair.item", "value")


def source_divergence(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 30, smooth: int = 5, top: int = 50
) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank`` of every group of ``docs``.

    Terms are runs of letters A-Z (lower-cased) and of characters beyond ASCII. A language keeps the terms in at
    least ``min_docs`` of its rows; each row is a document, also one with a repeated or null key. A group's share of
    a kept term is one part and its smoothed share in parts of 10**9, rounded down. ``pair``: the sum of the absolute
    differences of two sources' shares over all kept terms, for each other source. ``term``: the ``top`` terms of a
    group whose share exceeds the language's most. Ranks count from 1, greater values first, then the item by bytes.

    Null text, lang or source is the empty string; a group without terms still has its pairs, a language without
    kept terms pairs of value 0; an empty table gives no row. Ties of value are ordered by the item, so repeats are
    equal. Other columns are not read.

    The number of documents of a term lies between the largest and the sum of its chunks' numbers. Only where the
    minimum lies between these two does a second pass count rows; chunks enter it through a filter of fixed size,
    whose false hits the join removes.
    """
    read = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = stored_by(count_chunks(read), "chunk_counts", "chunk")
    # The buckets bring all rows of a chunk together, without a shuffle.
    chunks = counts.groupBy("lang", "chunk").agg(F.sum("docs").alias("docs")).sortWithinPartitions("chunk")
    posted = stored(chunk_terms(chunks), "chunk-terms")
    bounds = posted.groupBy("lang", "term").agg(F.sum("docs").alias("most"), F.max("docs").alias("least")).where(F.col("most") >= min_docs)
    posted = stored(split_join(posted.select("lang", "chunk", "term", "times"), bounds.select("lang", "term", "least"), ["lang", "term"]), "candidates")
    sure = posted.where(F.col("least") >= min_docs)
    doubtful = posted.where(F.col("least") < min_docs)
    counted = stored(_exact_counts(read, doubtful.select("lang", "chunk", "term")).where(F.col("docs") >= min_docs), "counted")
    wanted = stored(sure.unionByName(doubtful.join(counted.select("lang", "term"), ["lang", "term"], "left_semi")), "wanted")
    kept = wanted.select("lang", "term").distinct()
    uses = counts.select("chunk", "lang", "source", "n").join(
        wanted.select("chunk", F.col("lang").alias("own"), "term", "times").hint("shuffle_hash"), "chunk").where("lang = own")
    cells = stored(uses.groupBy("lang", "source", "term").agg(F.sum(F.col("n") * F.col("times")).alias("n")), "cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = read.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("size", F.lit(0)).alias("size"))
    groups = stored(groups.withColumn("zero", _share(F.lit(0), F.col("total"), F.col("size"), smooth)), "groups")
    own = split_join(cells, groups.select("lang", "source", "total", "size"), ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("total"), F.col("size"), smooth))
    own = stored(own.select("lang", "source", "term", "p"), "shares")

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(own, groups).withColumn("rank", F.row_number().over(ranked))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("size").alias("size"))
    general = cells.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(whole, "lang").select(
        "lang", "term", _share(F.col("n"), F.col("total"), F.col("size"), smooth).alias("q"))
    terms = split_join(own, general, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    # Spark cuts each task to the leading terms of a group before the shuffle.
    terms = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    order = "lang", "source", "part", "item", "value", "rank"
    return pairs.withColumn("part", F.lit("pair")).select(*order).unionByName(terms.withColumn("part", F.lit("term")).select(*order))


def op11_divergence(spark, sf_dir):
    """Distance of each source from the others of its language, and its leading terms."""
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES = {"op11_divergence": op11_divergence}
SQL = {
    "op11_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
o AS MATERIALIZED (SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS size FROM k GROUP BY lang),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
f AS MATERIALIZED (SELECT lang, source, term, coalesce(n, 0) AS n,
      1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (coalesce(total, 0) + 5 * size) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN t USING (lang, source)),
l AS MATERIALIZED (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(total) + 5 * any_value(size)) AS q
      FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS total FROM c GROUP BY lang) USING (lang) GROUP BY lang, term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM f JOIN l USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""
}
