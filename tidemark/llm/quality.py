"""Quality scores by a vote of the nearest labelled texts in a latent space."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append_columns, remainder, sample_keys, table

#: Hashed words, and before them the features of their forms.
WORDS, FORMS = 4096, 4096
WIDTH = FORMS + WORDS


class Shapes:
    """Counts of hashed features of a text: its words, their forms and neighbours, and how much repeats."""

    def __init__(self, cached: int = 200_000):
        self.cached, self.known = cached, {}

    def form(self, word: str) -> str:
        """Runs of upper, lower, digit and each sign, as one character per run."""
        out = ""
        for c in word:
            kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
            if not out.endswith(kind):
                out += kind
        return out[:12]

    def terms(self, word: str) -> list[str]:
        """The word in lower case without signs; of a long one, as in scripts without blanks, its runs of three characters."""
        plain = "".join(c for c in word.lower() if c.isalnum())
        return [plain] if 0 < len(plain) <= 16 else [plain[i : i + 3] for i in range(len(plain) - 2)]

    def __call__(self, text: str | None) -> np.ndarray:
        from zlib import crc32

        vector, known, text = np.zeros(WIDTH, np.float32), self.known, text or ""
        words = text.split()
        if len(known) > self.cached:
            known.clear()
        forms, terms = [], []
        for w in words:
            f = known.get(w)
            if f is None:
                f = crc32(self.form(w).encode("utf-8", "replace")) % 1024, [FORMS + crc32(t.encode("utf-8", "replace")) % WORDS for t in self.terms(w)]
                if len(w) <= 64:
                    known[w] = f
            forms.append(f[0])
            terms += f[1]
        if terms:
            vector += np.bincount(terms, minlength=WIDTH) / len(terms)
        if forms:
            ids = np.array(forms, np.int64)
            vector[:1024] += np.bincount(ids, minlength=1024) / len(ids)
            pairs = (ids[:-1] * 1031 + ids[1:]) % 2048
            if len(pairs):
                vector[1024:3072] += np.bincount(pairs, minlength=2048) / len(pairs)
        # Steps of the logarithm of the length, and shares in tenths.
        lines = [line for line in text.split("\n") if line.strip()]
        shares = [
            min(len(words), 10 ** 6) and int(np.log2(len(words) + 1)),
            10 - round(10 * len(set(lines)) / max(1, len(lines))),
            10 - round(10 * len(set(words)) / max(1, len(words))),
            min(20, int(2 * sum(map(len, words)) / max(1, len(words)))),
        ]
        for i, s in enumerate(shares):
            vector[3072 + 32 * i + min(s, 31)] += 0.2
        return vector


class Neighbours:
    """Latent vectors of labelled texts, and the vote of the most similar."""

    def __init__(self, weights: np.ndarray, axes: np.ndarray, vectors: np.ndarray, labels: np.ndarray, k: int, sharp: float):
        self.weights, self.axes, self.vectors, self.labels, self.k, self.sharp = weights, axes, vectors, labels, k, sharp

    def project(self, features: np.ndarray) -> np.ndarray:
        latent = (np.sqrt(features) * self.weights) @ self.axes
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def score(self, features: np.ndarray) -> np.ndarray:
        """Share of label 1 among the ``k`` most similar, weighted by similarity; 0.5 without labels."""
        if not len(self.labels):
            return np.full(len(features), 0.5)
        cosine, k = self.project(features) @ self.vectors.T, min(self.k, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** self.sharp + 1e-9
        return np.clip((weight * self.labels[near]).sum(1) / weight.sum(1), 0, 1)


def fit_neighbours(
    labelled: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id",
    rows: int = 3000, rank: int = 64, k: int = 15, sharp: float = 8.0,
) -> Neighbours:
    """Latent vectors of a bounded sample: of each label the ``rows`` / 2 keys with the smallest hash.

    Their whole texts are learnt from; of several texts under a key the smallest counts. Features are weighted by
    inverse document frequency (words and the shapes of words alike), then reduced to ``rank`` axes by a randomised SVD of the sample.
    Rows without label or key teach nothing.
    """
    known = labelled.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(label).cast("int").alias("y"), F.col(key).alias("k"), F.col(text).alias("t"))
    wanted = sorted({key for _, _, key in sample_keys(known, "y", "k", rows // 2)})

    def make():
        def batch(texts):
            return [[np.flatnonzero(s).astype("<f4").tobytes() + s[s != 0].astype("<f4").tobytes() for s in map(Shapes(), texts)]]
        return batch

    if not wanted:
        return Neighbours(np.ones(WIDTH), np.zeros((WIDTH, 1)), np.zeros((0, 1)), np.zeros(0), k, sharp)
    chosen = append_columns(known.where(F.col("k").isin(wanted)).groupBy("k", "y").agg(F.min("t").alias("t")), ["t"], "features binary", make, rows=128).drop("t")
    sample = sorted(((r["k"], r["y"], bytes(r["features"])) for r in chosen.collect()))
    features = np.zeros((len(sample), WIDTH), np.float32)
    for row, (_, _, f) in zip(features, sample):
        at, value = np.frombuffer(f, "<f4").reshape(2, -1)  # numbers below WIDTH are exact
        row[at.astype(np.int64)] = np.sqrt(value)
    labels = np.array([y for _, y, _ in sample], np.float32)
    weights = (np.log((1 + len(sample)) / (1 + (features > 0).sum(0))) + 0.3).astype(np.float32)
    matrix = features * weights
    rank = min(rank, len(sample))
    probe = np.random.default_rng(7).standard_normal((len(sample), rank + 8)).astype(np.float32)
    for _ in range(3):
        q = np.linalg.qr(matrix.T @ probe)[0]
        probe = matrix @ q
    _, _, turned = np.linalg.svd(probe, full_matrices=False)
    model = Neighbours(weights, (q @ turned.T)[:, :rank].astype(np.float32), np.zeros((0, rank)), labels, k, sharp)
    model.vectors = model.project(features ** 2)
    return model


def score_quality(docs: DataFrame, model: Neighbours, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher for label 1) and ``predicted`` (1 from 0.5 on).

    Each block of texts is multiplied with all labelled vectors, so cosines are exact. Null and
    empty texts are scored by their empty features, a text of any length by all its words. Rows
    are judged one by one, so repeated rows get equal scores. Columns of ``docs`` with these names
    are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # rows * rank + width * rank floats, under 3.5 MB

    def make():
        shapes = Shapes()

        def batch(texts):
            score = shared.value.score(np.stack([shapes(t) for t in texts])).astype(float)
            return [score.tolist(), (score >= 0.5).astype(int).tolist()]

        return batch

    return append_columns(docs, [text], "score double, predicted int", make, rows=128)


def op6_quality(spark, sf_dir):
    """Quality of all documents, learnt from labelled ones whose remainder by 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = fit_neighbours(docs.where(~held).select("doc_id", "text").join(labels, "doc_id"))
    return score_quality(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


QUERIES = {"op6_quality": op6_quality}
SQL: dict[str, str] = {}
