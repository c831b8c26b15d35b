"""Source divergence, token files and whitening against brute force, and on edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, tokenfiles, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, term string, chunk string, rank int"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def brute_divergence(rows, min_docs, smooth, top):
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    uses, holders = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = pattern.findall((text or "").translate(lower))
        uses[lang or "", source or ""].update(terms)
        holders[lang or ""].update(set(terms))
    out = set()
    for lang in holders:
        kept = [t for t, n in holders[lang].items() if n >= min_docs]
        sources = [s for g, s in uses if g == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + smooth) // (total + smooth * len(kept)) for t in kept}

        p = {s: shares(uses[lang, s]) for s in sources}
        q = shares(sum((uses[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if uses[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)}
    return out


EDGE = [
    (1, "Foo, foo. (FOO) bar baz x1y2", "en", "a"), (1, "Foo, foo. (FOO) bar baz x1y2", "en", "a"), (2, "foo bar", "en", "b"),
    (3, None, "en", "c"), (4, "", None, None), (None, "foo! bar? ÄÖ äö", "en", None), (5, "ΣΑΣ σας foo 😀😀", "en", "b"), (6, "a,b;c " * 20_000, "de", "a"),
    (7, "12 34 --", "fr", "z"), (8, "one", "fr", "y"), (9, "x" * 100_000, "en", "d"), (10, "foo-bar foo_bar", "en", "d"),
]


def test_divergence_edge_rows(spark):
    got = divergence.source_divergence(documents(spark, EDGE), min_docs=2, top=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_divergence(EDGE, 2, 5, 3)
    assert divergence.source_divergence(documents(spark, EDGE).limit(0)).count() == 0


def test_divergence_chunks_of_like_terms(spark):
    rows = spark.createDataFrame([("en", "s", "The the, THE\u00c9 the! x-y X_Y\tx\x1cy"), ("en", "s", "the. ??? ...")], "lang string, source string, text string")
    got = {(r.chunk, r.docs, r.n) for r in divergence.count_chunks(rows).collect()}
    # Case, kinds of signs and a sign before a blank make no chunk of its own.
    assert {("the", 2, 4), ("the\u00c9", 1, 1), ("x.y", 1, 3)} <= got and all(not c.strip(".") for c, _, _ in got - {("the", 2, 4), ("the\u00c9", 1, 1), ("x.y", 1, 3)})


def test_divergence_doubtful_terms(spark):
    """Terms whose chunks are each below the minimum, with documents that hold several of them."""
    forms = ["{}", "{},", "({})", "{}!", "{}-{}"]
    rows = [(i, " ".join(forms[(i + j) % 5].format(f"t{j}", f"t{j}").replace(str(j), chr(97 + j)) for j in range(26) for _ in range(1 + (i + j) % 2)) + " "
             + " ".join(forms[(i * 3) % 5].format(w, w) for w in "abcdefgh"[: i % 9]), "en", f"s{i % 3}") for i in range(60)]
    got = {tuple(r) for r in divergence.source_divergence(documents(spark, rows), min_docs=30).collect()}
    assert got == brute_divergence(rows, 30, 5, 50)


def test_divergence_many_sources(spark):
    """More sources than a tile holds."""
    rows = [(i, f"alpha beta{'' if i % 3 else ' beta'} w{chr(97 + i % 20)}", "en", f"s{i:03d}") for i in range(300)]
    got = {tuple(r) for r in divergence.source_divergence(documents(spark, rows), min_docs=10, top=2).collect()}
    assert got == brute_divergence(rows, 10, 5, 2)


@pytest.fixture(scope="module")
def vocabulary():
    return tokenfiles.vocabulary_text()


def expected_ids(texts, vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


TEXTS = [
    "", None, " \n\t", "Don't STOP we'll it's 'S 3rd x2y", "ΣΑΣ Σας İstanbul ǅ", "é e ́  nbsp em\u0085nel \x1c\x1f\x00",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> <|", "日本語テキスト 한국어 हिन्दी", "😀👍🏽 ﬁ ﬀ", "Größe, (ÉTÉ) l'été's ÀB×C÷D Œuvre İi ıI ŉ ǅungla Ǆ ẞ ﬀ …, e\u0301te\u0301, =\u0338 x\u00adY ¿Qué? naïve-café_ÑANDÚ 10º «mot»", "word " * 50_000, "q" * 30_000, "퟿ ￿",
]


def test_encoder_every_character(vocabulary):
    """Each character of the basic plane alone, between letters and after punctuation."""
    texts = [f"{chr(i)} a{chr(i)}B ,{chr(i)}. {chr(i)}\u0301" for i in range(0x3000) if not 0xD800 <= i < 0xE000]
    encode = tokenfiles.Encoder(vocabulary)
    assert [[*np.frombuffer(x, encode.kind).tolist(), 2] for x in encode(texts)] == expected_ids(texts, vocabulary)


def test_encoder_like_library(vocabulary):
    for t in (tokenfiles.Encoder(vocabulary), tokenfiles.Encoder(vocabulary, cached=1)):
        assert t.chunked and t.width == 2
        for _ in range(2):
            got = [[*np.frombuffer(x, t.kind).tolist(), 2] for x in t(TEXTS)]
            assert got == expected_ids(TEXTS, vocabulary)
    from public_tokenizers import path

    whole = tokenfiles.Encoder(tokenfiles.vocabulary_text(path("byte_bpe_50k.json")))
    assert not whole.chunked and len(whole(["a b", None])) == 2


def test_token_files(spark, vocabulary, tmp_path):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(TEXTS * 3)] + [(5, "tie one"), (5, "tie two"), (-9, "negative key")] + [(77, f"hot {i % 3}") for i in range(400)]
    df = spark.createDataFrame([(k, t, "e", 1) for k, t in rows], "doc_id bigint, text string, frame string, file int")
    df.write.parquet(str(tmp_path / "docs"))
    folder = tokenfiles.write_token_files(spark.read.parquet(str(tmp_path / "docs")), vocabulary, end_id=2, folder=str(tmp_path / "tokens"), files=6)
    got = tokenfiles.read_token_files(spark, folder).orderBy("start").collect()
    want = Counter((k, tuple(ids)) for (k, _), ids in zip(rows, expected_ids([t for _, t in rows], vocabulary)))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    # Equal keys spread over files, and every document is found by itself.
    names = [r["name"] for r in tokenfiles._catalog(spark, folder).orderBy("file").collect()]
    holders, found = 0, []
    for name in names:
        with tokenfiles.TokenFile(folder, name) as f:
            hits = f.find(77)
            holders += bool(hits)
            found += [tuple(f.document(i).tolist()) for i in hits]
    assert holders > 1 and Counter(found) == Counter({ids: n for (k, ids), n in want.items() if k == 77})


def test_token_files_empty_and_damaged(spark, vocabulary, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder = tokenfiles.write_token_files(docs.limit(0), vocabulary, end_id=2)
    assert tokenfiles.read_token_files(spark, folder).count() == 0
    folder = tokenfiles.write_token_files(docs, vocabulary, end_id=2, folder=str(tmp_path / "t"), files=1)
    name = tokenfiles._catalog(spark, folder).first()["name"]
    raw = bytearray((tmp_path / "t" / name).read_bytes())
    for at, message in ((0, "not a token file"), (20, "another dictionary"), (len(raw) - 60, "damaged")):
        bad = bytearray(raw)
        bad[at] ^= 1
        (tmp_path / "t" / "bad.tok").write_bytes(bad)
        with pytest.raises(ValueError, match=message):
            tokenfiles.TokenFile(folder, "bad.tok")


def test_token_files_query(spark, vocabulary):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    at, want = 0, []
    for (key, _), ids in zip(docs, expected_ids([t for _, t in docs], vocabulary)):
        want.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in tokenfiles.op12_token_files(spark, SF).collect()) == want


def brute_whitening(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    values, basis = np.linalg.eigh(c.T @ c / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return n, ((n * x - s).astype(object) ** 2).sum(1), (x - s / n) @ basis / np.sqrt(values), values / np.trace(c.T @ c / n)


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, white, explained = brute_whitening([r.embedding for r in rows], 16)
    got = defaultdict(dict)
    for r in whitening.op13_whitening(spark, SF).collect():
        got[r.vec_id][r.component] = r
    assert len(got) == len(rows) and all(sorted(g) == list(range(1, 17)) for g in got.values())
    made = np.array([[got[r.vec_id][c].whitened for c in range(1, 17)] for r in rows])
    sign = np.sign((made * white).sum(0))
    assert np.abs(made * sign - white).max() < 1e-9
    for i, r in enumerate(rows):
        one = got[r.vec_id]
        assert one[1].n == n and one[1].deviation == deviation[i] and one[1].identity_error < 1e-9
        assert np.allclose([one[c].explained for c in range(1, 17)], explained, rtol=1e-10)


def test_whitening_edge_rows(spark):
    schema = "vec_id bigint, embedding array<float>, x int, component string"
    random = np.random.default_rng(3)
    good = [(i, random.standard_normal(5).tolist()) for i in range(40)]
    rows = good + good[:3] * 30 + [(None, good[0][1]), (90, None), (91, []), (92, [1.0, None, 0.0, 0.0, 0.0]), (93, [math.nan] + [0.0] * 4), (94, [math.inf] + [0.0] * 4), (95, [1e30] + [0.0] * 4), (96, [1.0, 2.0])]
    df = spark.createDataFrame([(k, v, 1, "z") for k, v in rows], schema)
    got = whitening.whiten(df, components=16).collect()
    stay = [(k, v) for k, v in rows if v and len(v) == 5 and not any(c is None or not math.isfinite(c) or c > 1e20 for c in v)]
    assert len(got) == 5 * len(stay) and {r.n for r in got} == {40}
    n, deviation, white, _ = brute_whitening(np.array([v for _, v in stay], np.float32), 5)
    want = Counter((k, int(d)) for (k, _), d in zip(stay, deviation))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == want
    assert max(r.identity_error for r in got) < 1e-9
    for empty in (df.limit(0), df.where("vec_id = 7"), df.where("vec_id > 89 and vec_id < 94")):
        assert whitening.whiten(empty).count() == 0


def test_whitening_low_rank_and_far_values(spark):
    random = np.random.default_rng(5)
    plane = (random.standard_normal((50, 2)) @ random.standard_normal((2, 6)) * 1e6).tolist()
    got = whitening.whiten(spark.createDataFrame(list(enumerate(plane)), "vec_id bigint, embedding array<double>"), components=2).collect()
    n, deviation, white, _ = brute_whitening(plane, 2)
    assert {(r.vec_id, r.deviation) for r in got} == {(i, int(d)) if d < 2**63 else (i, None) for i, d in enumerate(deviation)}
    assert max(r.identity_error for r in got) < 1e-6


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1, 0.5], [1] * 8, [3, 3, 3, 1, 1, 1 + 1e-9, 0, 0], [1e6, 1, 1e-3, 1e-6], list(np.geomspace(1, 1e-4, 40)), [2.0], [0, 0, 7]])
def test_components(spark, values):
    """Clustered, repeated and widely spread eigenvalues; none missed, vectors orthonormal."""
    size = len(values)
    turn, _ = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    a = (turn * np.array(values, float)) @ turn.T
    a = (a + a.T) / 2
    want = sorted((v for v in values if v > 1e-14 * max(values)), reverse=True)[:16]
    got, basis = whitening.leading_components(spark, a, 16)
    assert np.allclose(got, want, atol=1e-13 * max(values))
    assert np.abs(basis.T @ basis - np.eye(len(want))).max() < 1e-13
    assert np.abs(a @ basis - basis * got).max() < 1e-12 * max(values)


def test_inertia():
    random = np.random.default_rng(1)
    a = random.standard_normal((30, 30))
    a = a + a.T
    values = np.linalg.eigvalsh(a)
    for shift in random.uniform(-10, 10, 50):
        assert whitening.above(*whitening.tridiagonal(a), shift) == (values > shift).sum()
