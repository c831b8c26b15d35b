"""Document probability by a lattice of subwords: all segmentations of each word, summed in log space."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import remainder, slices, stored, table

MARK = "▁"
_FLOOR = 1e-12


class Pieces:
    """Pieces of an existing vocabulary with log probabilities, and the word lattice over them."""

    def __init__(self, pieces: dict[str, float], byte_score: float, end_score: float):
        self.scores, self.byte_score, self.end_score = pieces, byte_score, end_score
        self.longest = max(map(len, pieces), default=1)

    def edges(self, word: str) -> list[list[tuple[int, str | None, float]]]:
        """For each end, the pieces that end there: (start, piece or None for spelled bytes, score)."""
        s, scores, out = MARK + word, self.scores, [[]]
        for end in range(1, len(s) + 1):
            found = []
            for start in range(max(0, end - self.longest), end):
                piece = s[start:end]
                if (score := scores.get(piece)) is not None:
                    found.append((start, piece, score))
            # Bytes spell what the vocabulary lacks, so every word has a segmentation.
            if s[end - 1] not in scores:
                found.append((end - 1, None, self.byte_score * len(s[end - 1].encode("utf-8", "replace"))))
            out.append(found)
        return out

    def forward(self, edges) -> list[float]:
        exp, log = math.exp, math.log
        alpha = [0.0]
        for found in edges[1:]:
            ways = [alpha[start] + score for start, _, score in found]
            top = max(ways)
            alpha.append(top if len(ways) == 1 else top + log(sum([exp(w - top) for w in ways])))
        return alpha

    def score(self, word: str) -> float:
        """Natural log of the marginal probability of a word."""
        return self.forward(self.edges(word))[-1]

    def expected(self, word: str, weight: float, into: Counter) -> None:
        """Add the expected uses of each piece in ``weight`` occurrences of a word."""
        edges = self.edges(word)
        alpha = self.forward(edges)
        beta = [-math.inf] * len(alpha)
        beta[-1] = 0.0
        for end in range(len(alpha) - 1, 0, -1):
            if beta[end] == -math.inf:
                continue
            for start, piece, score in edges[end]:
                through = beta[end] + score
                into[piece or ""] += weight * math.exp(alpha[start] + through - alpha[-1])
                beta[start] = through if beta[start] == -math.inf else float(np.logaddexp(beta[start], through))


class Lattices:
    """The word lattice of ``Pieces`` over many words at once; words of one length share their steps.

    Sums run over probabilities, not their logarithms; the few words that would leave the range of a double, or
    are longer than ``LONG`` characters, go through ``Pieces`` one by one.
    """

    LONG, BLOCK, LEAST = 40, 2048, 1e-200

    def __init__(self, pieces: Pieces):
        self.pieces, self.names = pieces, list(pieces.scores)
        keys, sizes = np.zeros(len(self.names), np.uint64), np.array([len(p) for p in self.names], np.int64)
        for size in np.unique(sizes).tolist():
            alike = np.flatnonzero(sizes == size)
            keys[alike] = self._hash(self._codes([self.names[i] for i in alike.tolist()], size))
        order = np.argsort(keys)
        self.keys, self.number = keys[order], order
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces of the vocabulary have one hash")
        self.chance = np.exp(np.array([pieces.scores[p] for p in self.names], np.float64))
        # By a hash's first bits, the place of the first piece with these, or -1; pieces of like bits lie one behind the other.
        bits = (self.keys >> np.uint64(44)).astype(np.int64)
        self.places = np.full(1 << 20, -1, np.int32)
        self.places[bits[::-1]] = np.arange(len(bits), dtype=np.int32)[::-1]
        self.alike = int(np.bincount(bits).max(initial=0))
        self.byte = math.exp(pieces.byte_score)

    @staticmethod
    def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    @classmethod
    def _hash(cls, codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for i in range(codes.shape[1]):
            h = cls._step(h, codes[:, i])
        return cls._end(h, codes.shape[1])

    @staticmethod
    def _end(h: np.ndarray, size: int) -> np.ndarray:
        return (h ^ np.uint64(size << 40)) * np.uint64(0xC2B2AE3D27D4EB4F)

    @staticmethod
    def _codes(words: list[str], size: int) -> np.ndarray:
        raw = "".join(words).encode("utf-32-le", "surrogatepass")
        return np.frombuffer(raw, "<u4").reshape(len(words), size).astype(np.uint64)

    def _edges(self, codes: np.ndarray) -> list[list[tuple[int, np.ndarray | None, np.ndarray | None, np.ndarray]]]:
        """For each end: (start, rows, numbers, chances) of its pieces; (end - 1, None, None, chances) where bytes spell a character."""
        n, out = codes.shape[1], [[] for _ in range(codes.shape[1] + 1)]
        grown = np.zeros(codes.shape, np.uint64)
        for size in range(1, min(n, self.pieces.longest) + 1):
            # Each substring's hash is its beginning's, one character on.
            grown = self._step(grown[:, : n - size + 1], codes[:, size - 1 :])
            h = self._end(grown, size)
            place = self.places[(h >> np.uint64(44)).astype(np.int64)]
            row, start = np.nonzero(place >= 0)
            found, at = h[row, start], place[row, start]
            for _ in range(1, self.alike):
                at = np.minimum(at + (self.keys[at] < found), len(self.keys) - 1)
            held = self.keys[at] == found
            row, start, number = row[held], start[held], self.number[at[held]]
            order = np.argsort(start, kind="stable")
            cuts = np.searchsorted(start[order], np.arange(n - size + 2))
            for s in range(n - size + 1):
                some = order[cuts[s] : cuts[s + 1]]
                if len(some):
                    out[s + size].append((s, row[some], number[some], self.chance[number[some]]))
            if size == 1:
                spelled = np.ones(codes.shape, bool)
                spelled[row, start] = False
                width = 1 + (codes > 0x7F).astype(int) + (codes > 0x7FF) + (codes > 0xFFFF)
                # A lone surrogate is written as a question mark.
                width[(codes >= 0xD800) & (codes <= 0xDFFF)] = 1
                for s in np.flatnonzero(spelled.any(axis=0)).tolist():
                    out[s + 1].append((s, None, None, np.where(spelled[:, s], self.byte ** width[:, s].astype(float), 0.0)))
        return out

    def _blocks(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Places of words of one length with their characters; None for those that ``Pieces`` takes."""
        sizes = np.array([len(w) for w in words], np.int64)
        for size in np.unique(sizes).tolist():
            places = np.flatnonzero(sizes == size)
            for i in range(0, len(places), self.BLOCK):
                some = places[i : i + self.BLOCK]
                if size >= self.LONG:
                    yield some, None
                else:
                    yield some, self._codes([MARK + words[j] for j in some.tolist()], size + 1)

    @staticmethod
    def _forward(edges, rows: int) -> np.ndarray:
        alpha = np.zeros((len(edges), rows))
        alpha[0] = 1.0
        for end in range(1, len(edges)):
            for start, row, _, chance in edges[end]:
                if row is None:
                    alpha[end] += alpha[start] * chance
                else:
                    alpha[end, row] += alpha[start, row] * chance
        return alpha

    def score_many(self, words: list[str]) -> np.ndarray:
        """``Pieces.score`` of each word."""
        out = np.zeros(len(words))
        for places, codes in self._blocks(words):
            total = np.zeros(len(places)) if codes is None else self._forward(self._edges(codes), len(places))[-1]
            good = total > self.LEAST
            out[places[good]] = np.log(total[good])
            for j in places[~good].tolist():
                out[j] = self.pieces.score(words[j])
        return out

    def expected_many(self, words: list[str], weights: np.ndarray, sums: np.ndarray, others: Counter) -> None:
        """Adds what ``Pieces.expected`` adds for each word: to ``sums`` by the piece's place, else to ``others``."""
        for places, codes in self._blocks(words):
            if codes is None:
                good = np.zeros(len(places), bool)
            else:
                edges = self._edges(codes)
                alpha = self._forward(edges, len(places))
                good = alpha[-1] > self.LEAST
                beta = np.zeros_like(alpha)
                beta[-1] = np.where(good, np.asarray(weights, float)[places] / np.where(good, alpha[-1], 1.0), 0.0)
                for end in range(len(edges) - 1, 0, -1):
                    for start, row, number, chance in edges[end]:
                        if row is None:
                            through = beta[end] * chance
                            others[""] += float((alpha[start] * through).sum())
                            beta[start] += through
                        else:
                            through = beta[end, row] * chance
                            np.add.at(sums, number, alpha[start, row] * through)
                            beta[start, row] += through
            for j in places[~good].tolist():
                self.pieces.expected(words[j], float(weights[j]), others)


def read_pieces(path: str) -> Pieces:
    """Pieces of a vocabulary file; its scores order them, and the start weights fall with that order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    plain.sort(key=lambda i: (-model.get_score(i), i))
    weights = {model.id_to_piece(i): 1 / (rank + 100) for rank, i in enumerate(plain)}
    return _normal(weights, 0.01 * sum(weights.values()), 0.01 * sum(weights.values()))


def _normal(weights: dict[str, float], bytes_: float, ends: float) -> Pieces:
    total = sum(weights.values()) + bytes_ + ends
    return Pieces({p: math.log(max(w / total, _FLOOR)) for p, w in weights.items()}, math.log(max(bytes_ / total / 256, _FLOOR)), math.log(max(ends / total, _FLOOR)))


def count_tokens(docs: DataFrame, text: str = "text", flush: int = 200_000) -> DataFrame:
    """``word``, ``c`` over all texts; counted per task before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            made = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
            counts.clear()
            return made

        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update((t or "").encode("utf-8", "replace").lower().split())
                if len(counts) > flush:
                    yield out()
        if counts:
            yield out()

    return docs.select(F.col(f"`{text}`")).mapInArrow(work, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def fit_pieces(counts: DataFrame, ends: int, start: Pieces, rounds: int = 2, smooth: float = 0.1) -> Pieces:
    """Weights of the given pieces by expected counts over all segmentations of all counted words.

    Only sums per piece reach the driver, at most one row per piece of the vocabulary. ``smooth`` is
    added to each, so that no piece gets probability 0.
    """
    sc, now = counts.sparkSession.sparkContext, start
    for _ in range(rounds):
        shared = sc.broadcast(now)  # one score per piece of the vocabulary file

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            into: Counter = Counter()
            lattices = Lattices(shared.value)
            sums = np.zeros(len(lattices.names))
            for batch in batches:
                lattices.expected_many(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False), sums, into)
            for i in np.flatnonzero(sums).tolist():
                into[lattices.names[i]] += sums[i]
            if into:
                yield pa.RecordBatch.from_pydict({"piece": list(into), "n": pa.array([float(x) for x in into.values()], pa.float64())})

        sums = {r["piece"]: r["n"] for r in counts.mapInArrow(work, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        bytes_ = sums.pop("", 0.0) + smooth
        now = _normal({p: sums.get(p, 0.0) + smooth for p in now.scores}, bytes_, ends + smooth)
    return now


def score_documents(
    docs: DataFrame, learn: Column, pieces: Pieces, text: str = "text", key: str = "doc_id", often: int = 10_000, cached: int = 300_000,
) -> DataFrame:
    """Per row: key, ``learn``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Rows where ``learn`` is true teach counts and piece weights; a null there counts as false. Null
    and empty texts have the end as their only token. Without any training row the base's N, V and c are
    0: its probabilities are 0.1 / 0.1 and its score is 0. Repeated rows are scored each. Other columns are
    not read. Words of at least one in ``often`` training tokens, so at most ``often`` of them, are
    scored where the text is read; all others meet their counts in a join, in which no word is hot
    by then. The text itself is not shuffled.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(f"`{text}`").alias("t"))
    train = source.where("learn")
    counts = stored(count_tokens(train, "t"), "words")
    words, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    ends = train.count()
    n, v = (words or 0) + ends, distinct + (1 if ends else 0)
    frequent = {r["word"].encode(): r["c"] for r in counts.where(F.col("c") * often >= max(n, 1)).collect()}
    model = spark.sparkContext.broadcast((fit_pieces(counts, ends, pieces), frequent))
    below = n + 0.1 * (v + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, common = model.value
        lattices = Lattices(lattice)
        known: dict[bytes, float] = {}
        base_of = {w: math.log10((c + 0.1) / below) for w, c in common.items()}
        end = math.log10((ends + 0.1) / below)
        ten = math.log(10)
        for part, texts in slices(batches, 1 << 23):
            if len(known) > cached:
                known.clear()
            bags = [Counter((t or "").encode("utf-8", "replace").lower().split()) for t in texts]
            names = list(set().union(*bags))
            new = [w for w in names if w not in known]
            known.update(zip(new, lattices.score_many([w.decode() for w in new]).tolist()))
            sizes = np.array([len(bag) for bag in bags], np.int64)
            owner, total = np.repeat(np.arange(len(bags)), sizes), int(sizes.sum())
            place = dict(zip(names, range(len(names))))
            word = np.fromiter(map(place.__getitem__, chain.from_iterable(bags)), np.int64, total)
            times = np.fromiter(chain.from_iterable(bag.values() for bag in bags), np.int64, total)
            chance = np.fromiter(map(known.__getitem__, names), np.float64, len(names))
            often_base = np.array([base_of.get(w, math.nan) for w in names], np.float64)
            here = ~np.isnan(often_base)[word]

            def summed(values: np.ndarray, of: np.ndarray) -> np.ndarray:
                return np.bincount(of, values, len(bags))

            rows = part.column(0).to_numpy(zero_copy_only=False)
            figures = pa.StructArray.from_arrays([
                part.column(1), part.column(2), pa.array((summed(times, owner) + 1).astype(np.int64)),
                pa.array((summed(times[here], owner[here]) + int(ends > 0)).astype(np.int64)),
                pa.array(summed(times[here] * often_base[word[here]], owner[here]) + end),
                pa.array((summed(times * chance[word], owner) + lattice.end_score) / ten),
            ], names=["k", "learn", "n_tokens", "hits", "base", "score"])
            # One row for each rare word of the slice and each number of times, with the texts that hold it so often.
            rare = np.flatnonzero(~here)
            group = word[rare] * (times.max(initial=0) + 1) + times[rare]
            order = np.argsort(group, kind="stable")
            rare, starts = rare[order], np.flatnonzero(np.diff(group[order], prepend=-1))
            # A row's own figures travel under a word that no text can hold, as it has a blank.
            spelled = [names[i] for i in word[rare[starts]].tolist()] + [b" %d" % r for r in rows.tolist()]
            often_there = np.concatenate([times[rare[starts]], np.zeros(len(bags), np.int64)])
            offsets = np.concatenate([starts, len(rare) + np.arange(len(bags) + 1)])
            holders = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([rows[owner[rare]], rows])))
            at = np.arange(len(spelled)) - len(starts)
            own = pa.array(np.maximum(at, 0), pa.int64(), mask=at < 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(spelled, pa.binary()).cast(pa.string()), pa.array(often_there), holders, figures.take(own)],
                names=["word", "times", "rows", "own"])

    numbered = source.select(F.monotonically_increasing_id().alias("row"), F.col("k").cast("bigint").alias("k"), "learn", "t")
    bags = numbered.mapInArrow(work, "word string, times bigint, rows array<bigint>, own struct<k:bigint,learn:boolean,n_tokens:bigint,hits:bigint,base:double,score:double>")
    met = bags.join(counts, "word", "left").select("c", "times", "own", F.explode("rows").alias("row"))
    rare_score = F.sum(F.when(F.col("times") > 0, F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(below))).otherwise(0.0))
    one = met.groupBy("row").agg(
        F.max("own.k").alias(key), F.max("own.learn").alias("learn"), F.max("own.n_tokens").alias("n_tokens"),
        (F.max("own.hits") + F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0))).alias("n_known"),
        (F.max("own.base") + rare_score).alias("base_score"), F.max("own.score").alias("score"),
    )
    return one.select(key, "learn", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_lm(spark, sf_dir):
    """Probabilities of all documents, learnt from those whose remainder by 10 is not 0."""
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, remainder(F.col("doc_id"), 10) != 0, read_pieces(vocabulary_path()))
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op10_lm": op10_lm}
SQL: dict[str, str] = {}
