"""N-gram Jaccard join by a partition of the hashed universe into segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, slices, stored, table
from tidemark.llm.links import linked_groups
from tidemark.operators.skew import split_join

#: 64-bit words of a set's parities.
_PARITY = 4
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; both by the rules of byte strings."""
    return (text or "").encode("utf-8", "replace").lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


class Shingler:
    """64-bit hashes of the distinct word n-grams of texts, sorted; keeps about ``cached`` word hashes."""

    def __init__(self, n: int, cached: int = 300_000):
        self.n, self.cached, self.known = n, cached, _Words()

    def many(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The sets of all texts, one behind the other, and the bounds between them."""
        if len(self.known) > self.cached:
            self.known.clear()
        words = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        total = int(sizes.sum())
        hashes = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.uint64, total)
        # Texts of fewer words are one gram of all their words.
        widths = np.minimum(sizes, self.n)
        grams = np.where(sizes > 0, sizes - widths + 1, 0)
        owner = np.repeat(np.arange(len(texts)), grams)
        first = (np.cumsum(sizes) - sizes)[owner] + np.arange(len(owner)) - (np.cumsum(grams) - grams)[owner]
        width = widths[owner]
        mixed = width.astype(np.uint64)
        for i in range(self.n):
            at = first if i == 0 else first[width > i]
            held = slice(None) if len(at) == len(first) else width > i
            mixed[held] = _mix(mixed[held] * np.uint64(_ODD[0]) + hashes[at + i] * np.uint64(_ODD[1]) + np.uint64(_ODD[2]))
        ends = np.cumsum(grams)
        for low, high in zip((ends - grams).tolist(), ends.tolist()):
            mixed[low:high].sort()
        new = np.ones(len(mixed), bool)
        new[1:] = (mixed[1:] != mixed[:-1]) | (owner[1:] != owner[:-1])
        return mixed[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(texts)))]).astype(np.int64)

    def __call__(self, text: str | None) -> np.ndarray:
        return self.many([text])[0]


class Bands:
    """Size bands and, for each, how its sets are cut and indexed.

    Sets of a band and the next differ in at most ``h`` elements if they link (``percent`` of the
    union shared). Of ``m`` segments, ``d`` are also indexed by all their one-deletions: a segment
    counts 1 if it must be equal and 2 if one element may differ. With m + d > h at least one
    segment agrees, so no link is lost. Among these (m, d) the cheapest is taken: rows written plus
    false candidates expected when two unrelated sets agree on an element by chance ``agree``. The choice
    moves cost only, never a link.
    """

    def __init__(self, percent: int, sets: int, agree: float):
        self.percent, self.sets, self.agree = percent, max(2, sets), agree
        self.starts, self.plans = [1], {}

    def largest(self, size: int) -> int:
        """Largest set that can link with one of this size."""
        return size * 100 // self.percent

    def of(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(self.largest(self.starts[-1]) + 1)
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def plan(self, band: int) -> tuple[int, int]:
        if band not in self.plans:
            self.of(self.starts[-1] if band + 2 > len(self.starts) else 1)
            while len(self.starts) < band + 2:
                self.of(self.starts[-1])
            low, top = self.starts[band], self.starts[band + 1] - 1
            both = top + self.largest(top)
            h = both * (100 - self.percent) // (100 + self.percent)
            best = None
            for m in range(h // 2 + 1, h + 2):
                d = h + 1 - m
                each = low / m
                false = self.sets * self.agree**each * (m - d + d * (1 + each / self.agree))
                cost = m + d * each + false
                if best is None or cost < best[0]:
                    best = cost, m, d
            self.plans[band] = best[1:]
        return self.plans[band]


def signatures(hashes: np.ndarray, bounds: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index keys of sets that lie one behind the other, the set of each, and its roles: home band or the one below, full segment or one-deletion."""
    size = np.diff(bounds)
    known = {n: bands.of(n) for n in np.unique(size[size > 0]).tolist()}
    own = np.array([known.get(n, -1) for n in size.tolist()], np.int64)
    place, element = _mix(hashes ^ np.uint64(_ODD[2])), _mix(hashes + np.uint64(_ODD[1]))
    owner = np.repeat(np.arange(len(size)), size)
    keys, sets, home, full = [], [], [], []
    for below in (0, 1):
        band = own - below
        plans = {b: bands.plan(b) for b in np.unique(band[band >= 0]).tolist()}
        m, d = np.array([plans.get(b, (0, 0)) for b in band.tolist()], np.int64).reshape(-1, 2).T
        held = slice(None) if (m > 0).all() else (m > 0)[owner]
        mine, parts = owner[held], element[held]
        segment = place[held] % m[mine].astype(np.uint64)
        at = (np.cumsum(m) - m)[mine] + segment.astype(np.int64)
        sums = np.zeros(int(m.sum()), np.uint64)
        np.add.at(sums, at, parts)
        whose = np.repeat(np.arange(len(size)), m)
        number = (np.arange(len(sums)) - (np.cumsum(m) - m)[whose]).astype(np.uint64)
        salt = _mix(number + (band[whose] + 1).astype(np.uint64) * np.uint64(_ODD[0]))
        shorter = segment < d[mine].astype(np.uint64)  # segments are cut by hash, so any d of them are alike
        less = at[shorter]
        for keys_, sets_, is_full in ((_mix(sums ^ salt), whose, True), (_mix((sums[less] - parts[shorter]) ^ salt[less]), mine[shorter], False)):
            keys.append(keys_)
            sets.append(sets_)
            home.append(np.full(len(keys_), below == 0))
            full.append(np.full(len(keys_), is_full))
    return np.concatenate(keys).view(np.int64), np.concatenate(sets), np.concatenate(home), np.concatenate(full)


def parities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each of some sets that lie one behind the other, which of 64 * ``_PARITY`` bins hold an odd number of its elements.

    Two sets' parities differ in no more bins than there are elements in just one of the sets.
    """
    size = np.diff(bounds)
    bins = _mix(hashes + np.uint64(_ODD[2])) % np.uint64(64 * _PARITY)
    out = np.zeros((len(size), _PARITY), np.uint64)
    np.bitwise_xor.at(out, (np.repeat(np.arange(len(size)), size), (bins >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bins & np.uint64(63)))
    return out.view(np.int64)


def wide_parities(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The same for each set in as many bins as it has elements or up to twice as many, a power of two from 64 on."""
    size = np.diff(bounds)
    bins = 1 << np.ceil(np.log2(np.maximum(size, 64))).astype(np.int64)
    ends = np.cumsum(bins)
    at = _mix(hashes + np.uint64(_ODD[0])).view(np.int64) & np.repeat(bins - 1, size)
    odd = np.packbits(np.bincount(at + np.repeat(ends - bins, size), minlength=int(bins.sum())).astype(np.uint8) & 1, bitorder="little").tobytes()
    return [odd[a:b] for a, b in zip(((ends - bins) // 8).tolist(), (ends // 8).tolist())]


def differing(x: bytes, y: bytes) -> int:
    """Bins in which two sets' ``wide_parities`` differ, the larger folded to the size of the smaller: no more than elements in just one of them."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def chance_agreement(texts: DataFrame, number: int, elements, sample: int) -> float:
    """The chance that an element of one set is in another, over about ``sample`` of ``number`` sets spread by their hash."""
    share = max(1, -(-1_000_000 * sample // max(1, number)))
    few = texts.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share)
    counts = few.select("text").mapInArrow(elements, "element bigint").groupBy("element").agg(F.count(F.lit(1)).alias("c"))
    met = counts.agg(F.sum(F.expr("c * (c - 1D)")).alias("pairs"), F.sum("c").alias("all")).first()
    sets = min(sample, number)
    found = met["pairs"] / met["all"] / (sets - 1) if met["all"] and sets > 1 else 0.0
    return min(0.3, max(1e-4, found))


def jaccard_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 3, percent: int = 90, sample: int = 500
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Two rows link when their sets of distinct word ``n``-grams share ``percent`` of the union;
    a text of fewer words is one element. Equal sets are joined by their digest, so copies cost one
    row each; distinct sets meet in the segment index and are verified on the words themselves.
    ``component_id`` is the smallest key reachable. Null and empty texts, and texts of blanks only,
    have no element and link with nothing. Rows with a null key are left out of groups: their
    component is null. Repeated rows come out as often as they come in; a key with several texts has a row and a
    group for each of them. Keys are integers. Other columns are not read. How the index is cut is chosen by about
    ``sample`` texts; links do not depend on it.
    """
    import hashlib

    odd = [f"odd{i}" for i in range(_PARITY)]

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingler(n)
        for part, texts_ in slices(batches, 1 << 19):
            hashes, bounds = cut.many(texts_)
            raw, ends = memoryview(hashes.tobytes()), (8 * bounds).tolist()
            prints = [hashlib.blake2b(raw[a:b], digest_size=16).digest() if b > a else None for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_pydict({"id": part.column(0), "n": pa.array(np.diff(bounds)), "print": pa.array(prints, pa.binary()), "hash": part.column(1), "wide": pa.array(wide_parities(hashes, bounds), pa.binary()), **dict(zip(odd, map(pa.array, parities(hashes, bounds).T)))})

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingler(n)
        for _, texts_ in slices(batches, 1 << 19):
            yield pa.RecordBatch.from_arrays([pa.array(cut.many(texts_)[0].view(np.int64))], names=["element"])

    source = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("hash", F.xxhash64("text"))
    sets = stored(source.select("id", "hash", "text").mapInArrow(shingle, "id bigint, n bigint, print binary, hash bigint, wide binary, " + ", ".join(f"{c} bigint" for c in odd)), "sets")
    # A class is known by 64 bits of its digest; it keeps the smallest key and one text of that key, whatever else the key has.
    classes = sets.where("print is not null and id is not null").groupBy("print").agg(F.min("id").alias("rep"), F.min_by("hash", "id").alias("hash"), *[F.min(c).alias(c) for c in ("n", "wide", *odd)])
    classes = stored(classes.withColumn("class", F.xxhash64("print")), "classes")
    # Repeated rows of a class meet where it was joined, so each text is shuffled once.
    named = classes.select(F.col("rep").alias("id"), "hash", "class")
    picked = source.repartition("id", "hash").join(named.repartition("id", "hash"), ["id", "hash"])
    texts = picked.groupBy("id", "hash", "class").agg(F.min("text").alias("text"))
    texts = stored(texts.select(F.col("class").alias("id"), "text"), "texts")
    number = classes.count()
    bands = Bands(percent, number, chance_agreement(texts, number, elements, sample))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingler(n)
        for part, texts_ in slices(batches, 1 << 19):
            keys, owner, home, full = signatures(*cut.many(texts_), bands)
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(keys), part.column(0).take(pa.array(owner)), pa.array(home), pa.array(full)], names=["key", "id", "home", "full"])

    def near(x: Column, y: Column) -> Column:
        unlike = sum((F.bit_count(x[c].bitwiseXOR(y[c])) for c in odd[1:]), F.bit_count(x[odd[0]].bitwiseXOR(y[odd[0]])))
        # Sets that link differ in at most this share of their elements; their sizes and parities differ in no more.
        return F.greatest(unlike, F.abs(x["n"] - y["n"])) * (100 + percent) <= (x["n"] + y["n"]) * (100 - percent)

    def verify(pairs: DataFrame) -> DataFrame:
        def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, *wide = (c.to_pylist() for c in batch.columns[2:])
                hits = [differing(x, y) * (100 + percent) <= size * (100 - percent) for size, x, y in zip(sizes, *wide)]
                yield batch.select(["a", "b"]).filter(pa.array(hits, pa.bool_()))

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last: tuple = (None, None)

            def grams(t):
                w = words_of(t)
                k = min(n, len(w))
                return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

            for batch in batches:
                hits = []
                for tx, ty in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                    if last[0] != tx:
                        last = tx, grams(tx)
                    x, y = last[1], grams(ty)
                    shared = len(x & y)
                    hits.append(bool(shared) and 100 * shared >= percent * (len(x) + len(y) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(hits, pa.bool_()))

        # Texts are fetched only for pairs whose wide parities, far smaller than the texts, leave a link possible.
        for s in "ab":
            pairs = pairs.join(classes.select(F.col("class").alias(s), F.col("n").alias(f"n_{s}"), F.col("wide").alias(f"wide_{s}")), s)
        pairs = pairs.select("a", "b", F.expr("n_a + n_b"), "wide_a", "wide_b").mapInArrow(likely, "a bigint, b bigint")
        left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        # Written first, so that Spark knows how few they are and need not shuffle texts to meet them.
        return stored(pairs, "pairs").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(exact, "a bigint, b bigint")

    members = texts.mapInArrow(index, "key bigint, id bigint, home boolean, full boolean")
    groups = linked_groups(members, verify, classes.select(F.col("class").alias("id"), F.struct("n", *odd).alias("trait")), near).withColumnsRenamed({"id": "class", "comp": "root"})
    rooted = classes.join(groups, "class", "left").select("print", "rep", F.coalesce("root", "class").alias("root"))
    # Representatives are the smallest keys of their classes, so the smallest representative is the group's.
    named = split_join(rooted, rooted.groupBy("root").agg(F.min("rep").alias("least")), ["root"]).select("print", "least")
    out = split_join(sets, named, ["print"], "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id"))


def op5_jaccard(spark, sf_dir):
    """Size of every document's set and the smallest document reachable by links."""
    return jaccard_groups(table(spark, sf_dir, "documents"))


def stage_near_duplicates(spark, docs, sf_dir):
    """Keep one document of each group (five-word shingles, 80 percent): that of the smallest id; rows with equal id all stay or go."""
    groups = jaccard_groups(docs, n=5, percent=80)
    mark = fresh(docs, "gone")
    gone = groups.where("component_id <> doc_id").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[mark], "left_anti")


QUERIES = {"op5_jaccard": op5_jaccard}
SQL = {
    "op5_jaccard": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN list_aggregate(words, 'string_agg', ' ') ELSE words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] END AS g
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, min(r.y)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = w.doc_id GROUP BY w.doc_id
"""
}
