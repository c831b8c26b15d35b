"""Benchmark decontamination: latent retrieval of passages, then cosine, common subsequence and answer checks."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, slices, stored, table

WIDTH = 1 << 16


def words_of(text: str | None) -> list[str]:
    """Words in lower case without signs at their ends."""
    import re

    return re.findall(r"\w+", (text or "").lower())


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point belongs to a word, and a random factor for each place of a word."""
    return np.array([chr(c).isalnum() or c == 95 for c in range(0x110000)]), np.random.default_rng(11).integers(0, 2**64, 1024, np.uint64) | np.uint64(1)


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and where each text ends; the words of ``words_of``."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    letter, factors = _letters()
    inside = np.take(letter, points, mode="clip")
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in low]) - 1)
    if not len(starts):
        return np.zeros(0, np.uint64), ends
    at = np.cumsum(sizes) - sizes
    place = np.arange(at[-1] + sizes[-1], dtype=np.int32)
    place -= np.repeat(at.astype(np.int32), sizes)
    h = points[inside].astype(np.uint64)
    h += np.uint64(1)
    h *= np.take(factors, place & 1023, mode="clip")
    h = np.add.reduceat(h, at)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29)), ends


def features_of(hashes: np.ndarray) -> np.ndarray:
    """Numbers of words below ``WIDTH``."""
    return (hashes >> np.uint64(48)).astype(np.int32)


def tf_idf(features: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their weights, of length 1."""
    ids, counts = np.unique(features, return_counts=True)
    x = (1 + np.log(counts)) * weights[ids]
    return ids, x / np.linalg.norm(x)


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence of words, bit-parallel over ``b``."""
    places: dict[str, int] = {}
    for i, w in enumerate(b):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for w in a:
        if m := places.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(b) - bin(row).count("1")


def pieces(words, window: int) -> list:
    """An item as a whole, and if it is longer than ``window``, its windows of that size at half steps up to its end."""
    last = len(words) - window
    return [words, *(words[a : a + window] for a in [*range(0, last, max(1, window // 2)), last] if last > 0)]


def run_hashes(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the run of ``n`` words at each of the places ``at``."""
    out = np.zeros(len(at), np.uint64)
    for i in range(n):
        out = (out + hashes[at + i] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Verbatim:
    """Exact lookup of word sequences by the hash of their first words."""

    def __init__(self, sequences: list[list[str]], hashes: list[np.ndarray], first: int = 8):
        self.sequences, starts = sequences, {}
        for i, h in enumerate(hashes):
            n = min(first, len(h))
            of, begins = starts.setdefault(n, ({}, np.zeros((n, WIDTH), bool)))
            of.setdefault(int(run_hashes(h, np.zeros(1, np.int64), n)[0]), []).append(i)
            begins[np.arange(n), features_of(h[:n])] = True
        self.starts = {n: (np.array(sorted(of), np.uint64), of, begins) for n, (of, begins) in starts.items()}

    def __call__(self, texts: list[str | None], hashes: np.ndarray, features: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs (text, sequence) where the sequence stands in the text word for word."""
        first, words = np.r_[0, ends[:-1]], functools.lru_cache(1)(lambda d: words_of(texts[d]))
        for n, (known, of, begins) in self.starts.items():
            at = np.flatnonzero(begins[0][features[: max(0, len(features) - n + 1)]])
            for i in range(1, n):
                at = at[begins[i][features[at + i]]]
            of_text = np.searchsorted(ends, at, "right")
            whole = at + n <= ends[of_text]
            at, of_text = at[whole], of_text[whole]
            runs = run_hashes(hashes, at, n)
            hit = known[np.minimum(np.searchsorted(known, runs), len(known) - 1)] == runs
            for a, d, run in zip(at[hit].tolist(), of_text[hit].tolist(), runs[hit].tolist()):
                for i in of[run]:
                    if words(d)[a - first[d] : a - first[d] + len(self.sequences[i])] == self.sequences[i]:
                        yield d, i


def fitting_rows(source: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, np.ndarray, int, int]:
    """``own`` and ``features`` (two bytes a word) of all that the axes are fitted on, stored, and figures of these.

    The rows are the words of all texts in passages of ``window``, one after the other, and all pieces of all items (``own``).
    The figures: inverse passage frequency of each feature over the passages of all texts, their number, and that of the pieces.
    """
    spark, row = source.sparkSession, "own boolean, features binary"

    def rows(own: bool | None, features: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        ends = features.itemsize * np.r_[starts, len(features)].astype(np.int32)
        bags = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(features)])
        return pa.RecordBatch.from_arrays([pa.array([own] * len(starts), pa.bool_()), bags], names=["own", "features"])

    def figures(found: np.ndarray, passages: int, own_pieces: int) -> pa.RecordBatch:
        """A row without ``own``: in how many passages of a task each feature is, the passages, the pieces."""
        return rows(None, np.r_[found, passages, own_pieces].astype("<i8"), np.zeros(1, np.int64))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(WIDTH, np.int64), 0
        for _, texts in slices(batches, 1 << 19):
            hashes, ends = hashed_words(texts)
            sizes = np.diff(ends, prepend=0)
            cuts = -(-sizes // window)
            number = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            features, starts = features_of(hashes).astype("<u2"), np.repeat(ends - sizes, cuts) + number * window
            bounds = np.r_[starts, len(features)]
            for a in range(0, len(starts), 1 << 16):
                some = bounds[a : a + (1 << 16) + 1]
                found += np.bincount(distinct_words(np.diff(some), features[some[0] : some[-1]])[0], minlength=WIDTH)
            n += len(starts)
            yield rows(False, features, starts)
        yield figures(found, n, 0)

    def item_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for _, texts in slices(batches):
            made = [p for t in texts for p in pieces(features_of(hashed_words([t])[0]), window) if len(p)]
            n += len(made)
            if made:
                yield rows(True, np.concatenate(made).astype("<u2"), np.cumsum([0, *map(len, made[:-1])]))
        yield figures(np.zeros(WIDTH), 0, n)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(x, "<i8") for batch in batches for x in batch.column(0).to_pylist())
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["features"])

    all_rows = stored(source.select("t").mapInArrow(passages, row).union(items.select("t").mapInArrow(item_pieces, row)), "fitting")
    sums = all_rows.where("own is null").select("features").coalesce(spark.sparkContext.defaultParallelism).mapInArrow(add, "features binary")
    *counts, n, own_pieces = sum(np.frombuffer(r["features"], "<i8") for r in sums.collect()).tolist()
    weights = np.log((n + 1) / (np.array(counts) + 1)).astype(np.float32) + 0.01
    return all_rows.where("own is not null"), weights, n, own_pieces


def rows_of_words(batches: Iterator[pa.RecordBatch], words: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``own``, number of words and features, end to end, of rows; as many rows at once as have about ``words`` words, at most 2^16.

    ``features`` are those of ``fitting_rows`` or an array.
    """
    held, size, some = [], 0, 1 << 14

    def joined() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*held))

    for batch in (b.slice(a, some) for b in batches for a in range(0, b.num_rows, some)):
        bags = batch.column("features")
        if pa.types.is_list(bags.type):
            sizes, features = bags.value_lengths().to_numpy(zero_copy_only=False), bags.flatten().to_numpy()
        else:
            bags = bags.to_pylist()
            sizes, features = np.array([len(x) // 2 for x in bags], np.int64), np.frombuffer(b"".join(bags), "<u2")
        held.append((batch.column("own").to_numpy(zero_copy_only=False), sizes, features))
        size += len(features)
        if size >= words or len(held) == 4:
            yield joined()
            held, size = [], 0
    if size:
        yield joined()


def distinct_words(sizes: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, row and count of the distinct features of each of at most 2^16 rows, by feature and row."""
    keys = np.sort(features.astype(np.uint32) << np.uint32(16) | np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes))
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return (keys[new] >> np.uint32(16)).astype(np.int64), (keys[new] & np.uint32(0xFFFF)).astype(np.int64), np.diff(new, append=len(keys))


def starting_rows(rows: DataFrame, passages: int, own_pieces: int, sample: int) -> DataFrame:
    """About ``sample`` passages and about ``sample`` pieces of ``rows``, drawn by a bound of their hash, equal ones once; stored."""

    def bound(n: int) -> Column:
        return F.lit(min(2**63 - 1, -(2**63) + int(min(1.0, sample / max(1, n)) * 2**64)))

    drawn = rows.where(F.xxhash64("features") <= F.when(F.col("own"), bound(own_pieces)).otherwise(bound(passages)))
    return stored(drawn.distinct(), "start")


def packed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of floats in two bytes each, and a factor for each row."""
    out, factors = np.empty(rows.shape, np.float16), np.empty((len(rows), 1), np.float32)
    for a in range(0, len(rows), 2048):
        some = rows[a : a + 2048]
        factors[a : a + 2048] = np.maximum(np.abs(some).max(axis=1, initial=0), 1e-30)[:, None]
        out[a : a + 2048] = some / factors[a : a + 2048]
    return out, factors


def unpacked(rows: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return rows.astype(np.float32) * factors


def add_rows(total: np.ndarray, seen: np.ndarray, f: np.ndarray, row: np.ndarray, x: np.ndarray, z: np.ndarray) -> None:
    """Add ``x`` times row ``row`` of ``z`` to row ``f`` of ``total`` and mark it as ``seen``; entries are sorted by ``f``."""
    cuts = np.flatnonzero(np.diff(f, prepend=-1))
    many, f = np.diff(cuts, append=len(f)), f[cuts]
    seen[f] = True
    often = many > 16
    for n, a, b in zip(f[often].tolist(), cuts[often].tolist(), (cuts + many)[often].tolist()):
        for c in range(a, b, 1024):
            d = min(b, c + 1024)
            total[n] += np.dot(x[c:d], z.take(row[c:d], axis=0))
    # The others many at once: the first entry of each, then the second.
    rest = np.flatnonzero(~often)
    rest = rest[np.argsort(-many[rest], kind="stable")]
    for a in range(0, len(rest), 256):
        some = rest[a : a + 256]
        sums = np.zeros((len(some), z.shape[1]), np.float32)
        for i in range(int(many[some[0]])):
            at = cuts[some[many[some] > i]] + i
            sums[: len(at)] += z.take(row[at], axis=0) * x[at][:, None]
        total[f[some]] += sums


def latent_axes(
    rows: DataFrame, weights: np.ndarray, rank: int, rounds: int = 2, extra: int = 16, start: DataFrame | None = None,
    own_weight: float = 1.0, seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the features (0: on no axis) and, by these, what a word adds to the latent vector of its passage.

    A randomised SVD of the TF-IDF vectors of all ``rows`` (``features``; those that are ``own`` count ``own_weight`` times) keeps
    the ``rank`` leading axes. Each round multiplies ``rank`` + ``extra`` vectors over the features with the matrix and its transpose:
    a task goes through its rows once, and Spark adds the products of the tasks up, a block of features at a time. ``rounds`` on
    ``start`` (once each; by default on ``rows`` themselves) lead to ``rank`` of the vectors for the last one, the others stay random; it is on
    all ``rows``, and its products give the axes, by the Nystroem formula. A matrix of ``WIDTH`` by ``rank`` + ``extra`` comes to the driver each round, whatever the
    number of rows. Axes are scaled by the root of their singular values, so that what all passages share does not outweigh the rest.
    """
    spark = rows.sparkSession
    span, shape = 2048, "block int, used binary, sums binary, factors binary"
    # Within, features are numbered from the most frequent one on, so that what is read most lies together.
    order = np.argsort(weights, kind="stable")
    number = np.argsort(order)

    def sent(block: int, used: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        parts = [used.astype("<i4"), *packed(sums)]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *(pa.array([x.tobytes()]) for x in parts)], names=["block", "used", "sums", "factors"])

    def received(part) -> tuple[np.ndarray, np.ndarray]:
        used = np.frombuffer(part["used"], "<i4")
        return used, unpacked(np.frombuffer(part["sums"], "<f2").reshape(len(used), -1), np.frombuffer(part["factors"], "<f4")[:, None])

    def opened(basis: list) -> np.ndarray:
        """The vectors of ``basis``, and random ones for those missing, the same in every task; a row for each feature."""
        known = basis[0][1].shape[1] if basis else 0
        out = np.zeros((WIDTH, rank + extra), np.float32)
        for used, *vectors in basis:
            out[used, :known] = unpacked(*vectors)
        out[:, known:] = np.random.default_rng(seed).standard_normal((WIDTH, rank + extra - known), np.float32) / WIDTH**0.5
        return out

    def product(over: DataFrame, basis: list) -> np.ndarray:
        given = spark.sparkContext.broadcast((weights[order], number, basis))
        own_times = np.float32(own_weight if over is rows else 1)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, of, vectors = given.value
            axes = opened(vectors)
            total, seen = np.zeros_like(axes), np.zeros(WIDTH, bool)
            for own, sizes, features in rows_of_words(batches):
                features = of[features]
                f, row, counts = distinct_words(sizes, features)
                x = counts * w[f]
                norm = np.sqrt(np.bincount(row, x * x, len(sizes)))
                x = (x / norm[row]).astype(np.float32)
                each = (w[features] / np.repeat(norm, sizes)).astype(np.float32)
                z, ends = np.zeros((len(sizes), axes.shape[1]), np.float32), np.cumsum(sizes)
                for i, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist())):
                    if a < b:
                        np.dot(each[a:b], axes.take(features[a:b], axis=0), out=z[i])
                if own_times != 1:
                    z[own] *= own_times
                add_rows(total, seen, f, row, x, z)
            for block in range(0, WIDTH, span):
                used = np.flatnonzero(seen[block : block + span]) + block
                if len(used):
                    yield sent(block, used, total[used])

        def add(part: pa.Table) -> pa.Table:
            block, total, seen = part.column("block")[0].as_py(), np.zeros((span, rank + extra)), np.zeros(span, bool)
            for used, sums in map(received, part.to_pylist()):
                total[used - block] += sums
                seen[used - block] = True
            used = np.flatnonzero(seen)
            return pa.Table.from_batches([sent(block, used + block, total[used])])

        plain = over.select("features", F.col("own") if "own" in over.columns else F.lit(False).alias("own"))
        # A task's sums, up to 36 MB, may be larger than its rows; so there are no more tasks than run at once, each of many rows.
        tasks = plain.coalesce(min(spark.sparkContext.defaultParallelism, 1 + over.count() // (1 << 18))).mapInArrow(work, shape)
        out = np.zeros((WIDTH, rank + extra), np.float32)
        for r in tasks.groupBy("block").applyInArrow(add, shape).toLocalIterator():
            used, sums = received(r)
            out[used] = sums
        given.destroy()
        return out

    def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return sum(a[i : i + span].T.astype(np.float64) @ b[i : i + span] for i in range(0, WIDTH, span))

    def root(square: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Values of a symmetric matrix above ``least`` of the largest, falling, and their vectors over the values' roots."""
        values, turn = np.linalg.eigh((square + square.T) / 2)
        kept = [i for i in np.argsort(-values) if values[i] > least * values.max(initial=0)]
        return values[kept], turn[:, kept] / np.sqrt(values[kept])

    basis = []
    for _ in range(rounds):
        sums = product(rows if start is None else start, basis)
        turn, basis = root(inner(sums, sums), 1e-10)[1][:, : rank + (0 if start else extra)].astype(np.float32), []
        for block in range(0, WIDTH, span):
            used = np.flatnonzero(sums[block : block + span].any(axis=1)) + block
            basis.append((used, *packed(sums[used] @ turn)))
        del sums
    sums = product(rows, basis)
    half = root(inner(opened(basis), sums), 1e-5)[1]
    values, turn = root(half.T @ inner(sums, sums) @ half, 1e-6)
    turn = (half @ turn[:, :rank] / values[:rank] ** 0.25).astype(np.float32)
    used = np.flatnonzero(sums.any(axis=1))
    place = np.zeros(WIDTH + 1, np.int32)
    place[order[used]] = np.arange(1, len(used) + 1)
    axes = np.zeros((len(used) + 1, turn.shape[1]), np.float32)
    for a in range(0, len(used), span):
        some = used[a : a + span]
        axes[a + 1 : a + 1 + len(some)] = sums[some] @ turn * weights[order[some]][:, None]
    return place, axes


class Passages:
    """The passages of some texts: each two neighbouring steps of words, a step after the last."""

    def __init__(self, features: np.ndarray, ends: np.ndarray, step: int):
        self.step, self.sizes = step, np.diff(ends, prepend=0)
        cuts = -(-self.sizes // step)
        first = np.cumsum(cuts) - cuts
        total = int(cuts.sum())
        # Words by steps, the last of each text filled up with ``WIDTH``; a step of nothing at the end.
        self.words = np.full((total + 1) * step, WIDTH, np.int32)
        self.words[np.arange(len(features)) + np.repeat(first * step - (ends - self.sizes), self.sizes)] = features
        self.words = self.words.reshape(-1, step)
        many = np.where(cuts > 0, np.maximum(1, cuts - 1), 0)
        self.text = np.repeat(np.arange(len(ends)), many)
        number = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        self.start, self.left = number * step, first[self.text] + number
        self.right = np.where(cuts[self.text] > 1, self.left + 1, total)

    def latent(self, place: np.ndarray, axes: np.ndarray) -> np.ndarray:
        """Latent vectors of length 1; those of passages without any known word are 0."""
        blocks, room = np.zeros((len(self.words), axes.shape[1]), np.float32), np.empty((256, axes.shape[1]), np.float32)
        for a in range(0, len(blocks), 256):
            out, at = blocks[a : a + 256], place[self.words[a : a + 256]]
            for column in at.T:
                out += np.take(axes, column, axis=0, out=room[: len(out)], mode="clip")
        both = blocks[self.left] + blocks[self.right]
        return both / np.maximum(np.sqrt(np.einsum("ij,ij->i", both, both)), 1e-30)[:, None]

    def weighted(self, weights: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in ``some``, feature and TF-IDF weight of all distinct words of the passages ``some``; vectors of length 1."""
        both = np.sort(np.concatenate([self.words[self.left[some]], self.words[self.right[some]]], axis=1), axis=1)
        wide = both.shape[1]
        new = np.ones(both.shape, bool)
        new[:, 1:] = both[:, 1:] != both[:, :-1]
        at = np.flatnonzero(new)
        counts, f = np.diff(at, append=new.size), both.ravel()[at]
        on = f < WIDTH
        at, counts, f = at[on] // wide, counts[on], f[on]
        x = (1 + np.log(np.arange(1, wide + 1))).astype(np.float32)[counts - 1] * weights[f]
        return at, f, x / np.sqrt(np.bincount(at, x * x, len(both)))[at].astype(np.float32)


class Pieces:
    """A tile of item pieces, for their cosines with passages."""

    def __init__(self, bags: list[np.ndarray], items: list[int], weights: np.ndarray, place: np.ndarray, axes: np.ndarray):
        self.items = np.array(items)
        self.vectors = np.concatenate([Passages(b, np.array([len(b)]), max(1, -(-len(b) // 2))).latent(place, axes) for b in bags])
        rows = [tf_idf(b, weights) for b in bags]
        used = np.unique(np.concatenate([ids for ids, _ in rows]))
        self.place = np.zeros(WIDTH, np.int32)
        self.place[used] = np.arange(1, len(used) + 1)
        self.dense = np.zeros((len(bags), len(used) + 1), np.float32)
        for row, (ids, x) in zip(self.dense, rows):
            row[self.place[ids]] = x

    def alike(self, passages: Passages, latent: np.ndarray, weights: np.ndarray, min_latent: float, min_cosine: float) -> Iterator[tuple[int, int, float]]:
        """(passage, item, cosine) of latent neighbours whose cosine over all words reaches ``min_cosine``."""
        p, v = np.divmod(np.flatnonzero(latent @ self.vectors.T >= min_latent), len(self.vectors))
        some, p = np.unique(p, return_inverse=True)
        if not len(some):
            return
        at, f, x = passages.weighted(weights, some)
        on = self.place[f]
        at, f, x = at[on > 0], on[on > 0], x[on > 0]
        held = np.bincount(at, minlength=len(some))
        first = np.cumsum(held) - held
        p, v = p[held[p] > 0], v[held[p] > 0]
        for a in range(0, len(p), 8192):
            near, piece = p[a : a + 8192], v[a : a + 8192]
            n = held[near]
            cuts = np.cumsum(n) - n
            entry = np.arange(int(n.sum())) + np.repeat(first[near] - cuts, n)
            cosine = np.add.reduceat(x[entry] * self.dense[np.repeat(piece, n), f[entry]], cuts)
            for i in np.flatnonzero(cosine >= min_cosine).tolist():
                yield int(some[near[i]]), int(self.items[piece[i]]), float(cosine[i])


def merged(hits: list[tuple[int, int, float]], reach: int) -> list[tuple[int, int, float]]:
    """Hits that start at most ``reach`` words after the first of them, as one."""
    out = []
    for a, b, c in sorted(hits):
        if out and a - out[-1][0] <= reach:
            out[-1] = out[-1][0], max(b, out[-1][1]), max(c, out[-1][2])
        else:
            out.append((a, b, c))
    return out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id",
    window: int = 48, rank: int = 256, min_cosine: float = 0.35, min_common: float = 0.7, min_paraphrase: float = 0.5,
    answer_words: int = 6, block: int = 2048, min_latent: float = 0.25, sample: int = 2048, lookup: bool = True,
) -> DataFrame:
    """Pairs ``key``, ``item_key`` with ``cosine`` (largest) and ``common`` (largest share of the item's words).

    Texts are cut into passages of ``window`` words, each starting half a window after the last, and
    again of a quarter of that for items of fewer words. Items longer than ``window`` are cut as well,
    and a passage like one of their pieces or like the whole leads to the whole item. Passages and pieces
    are projected on the ``rank`` leading axes of a randomised SVD of the TF-IDF vectors (frequencies over all passages of all
    texts) of all passages of all texts, one after the other, and of all pieces, which together weigh as much as the passages or
    more; about ``sample`` of each only start its iteration. All passages are compared with all pieces; those of a latent cosine of ``min_latent`` are candidates. Candidates are verified: the cosine over all words
    must reach ``min_cosine``, and on the passage with the words around it (an item's length each way; near hits of a long item at once)
    the longest common subsequence must
    hold ``min_common`` of the item's words, or ``min_paraphrase`` with its answer, the last
    ``answer_words`` words, found in order to four fifths. With ``lookup`` an item of any length that stands in
    a text word for word is found without these bounds as well, with ``cosine`` and ``common`` 1. Items are taken in blocks of about ``block`` pieces, all
    against all passages. Null and empty texts and items without a word leak nothing; rows with null
    keys are matched as others; repeated rows count once; other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").alias("t"))
    items = benchmark.select(F.col(f"`{item_key}`").cast("bigint").alias("item"), F.col(f"`{item_text}`").alias("t")).where(F.col("t").rlike(r"[\p{L}\p{N}_]")).distinct()
    words_in = F.size(F.split("t", r"[^\p{L}\p{N}_]+"))
    n = items.agg(F.sum(1 + F.floor(words_in * F.when(words_in > window, 2).otherwise(0) / window))).first()[0] or 0
    none = spark.createDataFrame([], f"`{key}` bigint, `{item_key}` bigint, cosine double, common double")
    if not n:
        return none
    rows, weights, passages, own_pieces = fitting_rows(source, items, window)
    start = starting_rows(rows, passages, own_pieces, sample)
    place, axes = latent_axes(rows, weights, rank, start=start, own_weight=max(1.0, passages / max(1, own_pieces)))
    axes = packed(axes)
    model = spark.sparkContext.broadcast((weights, place, *axes))
    blocks = max(1, -(-n // block))
    numbered = items.withColumn("part", F.pmod(F.xxhash64("item", "t"), F.lit(blocks)))
    found = None
    for part in range(blocks):
        chosen = sorted(((r["item"], r["t"]) for r in numbered.where(F.col("part") == part).collect() if words_of(r["t"])), key=repr)
        if not chosen:
            continue
        shared = spark.sparkContext.broadcast(chosen)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (w, place, *packed_axes), held = model.value, shared.value
            axes = unpacked(*packed_axes)
            words, hashes = [words_of(t) for _, t in held], [hashed_words([t])[0] for _, t in held]
            verbatim = Verbatim(words, hashes) if lookup else lambda *_: ()
            # Tiles of pieces that are searched in passages of one step.
            small, tiles = max(1, window // 4), {}
            for step, some in ((max(1, window // 2), [i for i, x in enumerate(words) if len(x) >= small]), (max(1, small // 2), [i for i, x in enumerate(words) if len(x) < small])):
                mine = [(i, p) for i in some for p in pieces(features_of(hashes[i]), window)]
                if mine:
                    tiles[step] = [Pieces([p for _, p in mine[a : a + 256]], [i for i, _ in mine[a : a + 256]], w, place, axes) for a in range(0, len(mine), 256)]

            for batch, texts in slices(batches, 1 << 19):
                codes, ends = hashed_words(texts)
                features, best, hits = features_of(codes), {}, {}
                for pair in verbatim(texts, codes, features, ends):
                    best[pair] = 1.0, 1.0
                for step, groups in tiles.items():
                    passages = Passages(features, ends, step)
                    latent = passages.latent(place, axes)
                    for group in groups:
                        for p, i, c in group.alike(passages, latent, w, min_latent, min_cosine):
                            d, a = int(passages.text[p]), int(passages.start[p])
                            hits.setdefault((d, i), []).append((a, min(int(passages.sizes[d]), a + 2 * step), c))
                last, doc = None, []
                for (d, i), some in sorted(hits.items()):
                    if d != last:
                        last, doc = d, words_of(texts[d])
                    size, answer = len(words[i]), words[i][-answer_words:]
                    for a, b, c in merged(some, size // 2 if size > window else 0):
                        near = doc[max(0, a - size) : b + size]
                        share = common_length(near, words[i]) / size
                        if share >= min_common or share >= min_paraphrase and common_length(near, answer) >= 0.8 * len(answer):
                            old = best.get((d, i), (0.0, 0.0))
                            best[d, i] = max(old[0], c), max(old[1], share)
                if best:
                    keys = batch.column(0).to_pylist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([keys[d] for d, _ in best], pa.int64()), pa.array([held[i][0] for _, i in best], pa.int64()),
                        pa.array([min(1.0, c) for c, _ in best.values()], pa.float64()), pa.array([s for _, s in best.values()], pa.float64()),
                    ], names=["k", "item", "cosine", "common"])

        made = source.mapInArrow(work, "k bigint, item bigint, cosine double, common double")
        found = made if found is None else found.union(made)
    if found is None:
        return none
    one = found.groupBy("k", "item").agg(F.max("cosine").alias("cosine"), F.max("common").alias("common"))
    return one.select(F.col("k").alias(key), F.col("item").alias(item_key), "cosine", "common")


def op4_decontaminate(spark, sf_dir):
    """Documents that hold a benchmark item, word for word or reworded."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage_benchmark(spark, docs, sf_dir):
    """Drop the documents that hold a benchmark item."""
    mark = fresh(docs, "leaking")
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks[mark]), "left_anti")


QUERIES = {"op4_decontaminate": op4_decontaminate}
SQL: dict[str, str] = {}
