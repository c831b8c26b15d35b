"""Byte-level BPE with a minimal acyclic transducer for frequent words and exact merges for the rest."""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append_columns, stored, table

# Fixed value: how the byte-level vocabulary splits a text; white space by its Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Fixed value: the characters of the Unicode property White_Space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Chunks: white space and what follows it up to the next. No match of ``PATTERN`` crosses their bounds, nor looks across.
CHUNK = f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
# Fixed value: ``PATTERN`` as it reads on ASCII, for the standard pattern module.
ASCII = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
    r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
#: White space that a cut at blanks and line ends does not serve, and the mark of a chunk that is written out whole.
UNEVEN, WHOLE = "  |\n\n| \n|\n |\x00|[" + SPACE.replace(" ", "").replace("\t-\r", "\t\x0b-\r") + "]", "\x00"
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words above this length in bytes are merged each time: neither lexicon nor cache keeps them.
LONGEST = 64
_NONE = 1 << 62


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, by the file format's rule."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges, byte strings and added tokens of a byte-level BPE file."""

    def __init__(self, raw: bytes):
        import regex

        data, symbols = json.loads(raw), _byte_symbols()
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.table = {i: bytes(symbols[c] for c in token) for token, i in vocab.items()}
        self.table |= {i: token.encode() for token, i in self.added.items()}
        self.first = [vocab[c] for c, _ in sorted(symbols.items(), key=lambda x: x[1])]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        # Rank and new id as one number, which sorts by rank.
        self.ranks = {(vocab[a], vocab[b]): rank << 32 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        pairs = sorted((a * len(self.table) + b, value) for (a, b), value in self.ranks.items())
        self.pairs, self.values = np.array(pairs, np.int64).reshape(-1, 2).T.copy()
        self._words, self._ascii = regex.compile(PATTERN).findall, re.compile(ASCII).findall
        self.chunks = re.compile(CHUNK).findall
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split if self.added else lambda text: [text]

    def words(self, chunk: str) -> list[str]:
        """The words of a text, as the vocabulary splits it."""
        # Letters only, with or without a blank before them: one word.
        if chunk.isascii() and (chunk[1:] if chunk[:1] == " " else chunk).isalpha():
            return [chunk]
        # The same with signs behind: two words.
        stem = chunk.rstrip(SIGNS)
        if len(stem) < len(chunk) and stem.isascii() and (stem[1:] if stem[:1] == " " else stem).isalpha():
            return [stem, chunk[len(stem) :]]
        return self._ascii(chunk) if chunk.isascii() else self._words(chunk)

    def keys(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Keys of the chunks of all texts, the number of keys of each text, and the order in which the texts come.

        ``chunk`` reads a key. Where blanks and line ends stand alone the texts are cut at them, all at once and without a search:
        no match of ``PATTERN`` crosses the start of white space. Other texts come last, cut as ``CHUNK`` says; a null text has no key.
        """
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, UNEVEN)
        for content in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        cut = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise(WHOLE, texts.filter(pc.invert(odd)), ""), "\n", " \n"), " ")
        others = [
            [WHOLE + c for p in self.cut(t) for c in ([WHOLE + p] if p in self.added else self.chunks(p))] for t in texts.filter(odd).to_pylist()]
        flat = pa.concat_arrays([cut.flatten(), pa.array([k for keys in others for k in keys], texts.type)])
        sizes = np.concatenate([pc.list_value_length(cut).to_numpy(), [len(keys) for keys in others]]).astype(np.int64)
        return flat, sizes, np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")

    def chunk(self, key: str) -> str | int:
        """The chunk that a key stands for, or the id of an added token."""
        if key[:1] == WHOLE:
            return self.added[key[2:]] if key[1:2] == WHOLE and key[2:] in self.added else key[1:]
        return key if key[:1] == "\n" else " " + key

    def key_words(self, keys: pa.Array) -> tuple[pa.Array, pa.Array, list[list[str | int]]]:
        """Whether a key stands for a blank with letters behind it, those words, and the words or added token of each other key."""
        plain = pc.match_substring_regex(keys, "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*$")
        chunks = [self.chunk(k) for k in keys.filter(pc.invert(plain)).to_numpy(zero_copy_only=False).tolist()]
        return plain, pc.binary_join_element_wise(" ", keys.filter(plain), ""), [[c] if isinstance(c, int) else self.words(c) for c in chunks]

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 4-byte ids of each word, as ``merge`` gives them."""
        sizes = np.array([len(w) for w in words], np.int64)
        starts, counts, ids = self.merge_all(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)
        raw = ids.astype("<i4").tobytes()
        return [raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * (starts + counts)).tolist())]

    def merge_all(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words among the bytes ``flat``: start and number of the ids of each, and all ids; words of like length step together."""
        made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        width = 1
        while width < LONGEST:
            low, width = width if width > 1 else 0, width * 2
            if len(rows := np.flatnonzero((sizes > low) & (sizes <= width))):
                self._merge_block(flat, starts, sizes, rows, width, made)
        for i in np.flatnonzero(sizes > LONGEST).tolist():
            ids = self.merge(flat[starts[i] : starts[i] + sizes[i]].tobytes())
            made.append((np.array([i]), np.array([len(ids)]), np.array(ids, np.int64)))
        counts, at = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        if not made:
            return at, counts, np.zeros(0, np.int64)
        rows, lengths, ids = (np.concatenate(parts) for parts in zip(*made))
        counts[rows], at[rows] = lengths, np.cumsum(lengths) - lengths
        return at, counts, ids

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * len(self.table) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((right >= 0) & (self.pairs[at] == key), self.values[at], _NONE)

    def _merge_block(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray, width: int, made: list) -> None:
        """Each round merges one pair of every word that still has one, so all rows of the matrix shrink by one."""
        used = np.arange(width) < sizes[rows][:, None]
        letters = flat[np.minimum(starts[rows][:, None] + np.arange(width), len(flat) - 1)]
        ids = np.where(used, np.array(self.first, np.int64)[letters], -1)
        found = self._rank_of(ids[:, :-1], ids[:, 1:]) if len(self.pairs) else np.full((len(ids), width - 1), _NONE)
        while True:
            i = found.argmin(axis=1) if found.shape[1] else np.zeros(len(ids), np.int64)
            best = found[np.arange(len(ids)), i] if found.shape[1] else np.full(len(ids), _NONE)
            done = best == _NONE
            if done.any():
                ended = ids[done]
                held = ended >= 0
                made.append((rows[done], held.sum(axis=1), ended[held]))
                rows, ids, found, i, best = (x[~done] for x in (rows, ids, found, i, best))
            if not len(rows):
                return
            line, column = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids[line, i] = best & 0xFFFFFFFF
            ids = np.take_along_axis(ids, column + (column > i[:, None]), axis=1)
            column = column[:-1]
            found = np.take_along_axis(found, column + (column >= i[:, None]), axis=1)
            if at := len(column):
                # Only the pairs beside the new id change.
                before, after = np.flatnonzero(i > 0), np.flatnonzero(i < at)
                found[before, i[before] - 1] = self._rank_of(ids[before, i[before] - 1], ids[before, i[before]])
                found[after, i[after]] = self._rank_of(ids[after, i[after]], ids[after, i[after] + 1])

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank, leftmost first, until none is left."""
        ids, rank_of, none = [self.first[b] for b in word], self.ranks.get, _NONE
        if len(ids) > LONGEST:
            return self._merge_long(ids)
        found = [rank_of(pair, none) for pair in zip(ids, ids[1:])]
        while found and (best := min(found)) < none:
            i, new = found.index(best), best & 0xFFFFFFFF
            ids[i] = new
            del ids[i + 1], found[i]
            # Only the pairs beside the new id change.
            if i:
                found[i - 1] = rank_of((ids[i - 1], new), none)
            if i < len(found):
                found[i] = rank_of((new, ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for words without end: n log n steps."""
        ranks, n = self.ranks, len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], gone[j], after[i] = ranks[pair] & 0xFFFFFFFF, True, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := (ids[a], ids[b])) in ranks:
                    heapq.heappush(heap, (ranks[p], a, p))
        return [x for x, dead in zip(ids, gone) if not dead]


@lru_cache(2)
def read_vocabulary(raw: bytes) -> Vocabulary:
    """``Vocabulary`` of a file, read once per process."""
    return Vocabulary(raw)


def build_transducer(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """Minimal acyclic automaton over sorted distinct words, with their ids as output.

    States with the same continuations are one state. Each edge carries how many words sort before
    those that pass it, so the sum along a path is the word's number, which selects its ids. Layout:
    counts, then the arrays edge key (state * 256 + byte), edge target, edge skip, state is final,
    id offsets, ids.
    """
    root: dict = {}
    register: dict = {}
    states: list[tuple] = []  # (final, ((byte, target), ...)), children before parents
    path: list[dict] = [root]
    final: list[bool] = [False]
    last, outputs = b"", []

    def fold(depth: int) -> None:
        while len(path) > depth + 1:
            node, end = path.pop(), final.pop()
            shape = (end, tuple(node.items()))
            if shape not in register:
                register[shape] = len(states)
                states.append(shape)
            path[-1][last[len(path) - 1]] = register[shape]

    for word, ids in entries:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        fold(shared)
        for _ in word[shared:]:
            path.append({})
            final.append(False)
        final[-1], last = True, word
        outputs.append(ids)
    fold(0)
    states.append((final[0], tuple(root.items())))
    below, keys, targets, skips = [], [], [], []
    for i, (end, edges) in enumerate(states):
        total = int(end)
        for byte, target in edges:
            keys.append(i * 256 + byte)
            targets.append(target)
            skips.append(total)
            total += below[target]
        below.append(total)
    offsets = np.cumsum([0, *map(len, outputs)])
    arrays = [np.array(keys), np.array(targets), np.array(skips), np.array([s[0] for s in states]), offsets,
              np.array([x for ids in outputs for x in ids])]
    arrays = [a.astype(np.int64) for a in arrays]
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


class Transducer:
    """A built automaton, memory-mapped from a file of the worker."""

    def __init__(self, raw: bytes):
        import tempfile

        # The file has no name any more once it is open, so nothing stays when the worker ends.
        with tempfile.TemporaryFile() as out:
            out.write(raw)
            out.flush()
            whole = np.memmap(out, np.int64, "r")
        lengths, at, parts = whole[:6], 6, []
        for n in lengths:
            parts.append(whole[at : at + n])
            at += n
        # Plain views of the mapped file: slices of them cost less.
        self.keys, self.targets, self.skips, self.final, self.offsets, ids = map(np.asarray, parts)
        self.ids = ids
        self.root = len(self.final) - 1

    def find(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each word among the bytes ``flat``, -1 for a word that is not in the lexicon; all words step together."""
        state, number = np.full(len(sizes), self.root), np.zeros(len(sizes), np.int64)
        at = np.flatnonzero((sizes > 0) & (sizes <= LONGEST)) if len(self.keys) else np.zeros(0, np.int64)
        held, step = [], 0
        while len(at):
            key = state[at] * 256 + flat[starts[at] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[edge] == key
            at, edge, step = at[hit], edge[hit], step + 1
            number[at] += self.skips[edge]
            state[at] = self.targets[edge]
            ended = sizes[at] == step
            held.append(at[ended])
            at = at[~ended]
        out, held = np.full(len(sizes), -1), np.concatenate([*held, np.zeros(0, np.int64)])
        held = held[self.final[state[held]] == 1]
        out[held] = number[held]
        return out


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words, and start and size of each."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = words.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), ends[:-1], np.diff(ends)


def _gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Stretches of ``values``, one behind the other."""
    return values[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]


def byte_slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """``texts`` in parts of about ``size`` bytes; a text stays whole."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield texts.slice(at, upto - at)
        at = upto


def count_words(docs: DataFrame, vocabulary_file: bytes, text: str = "text", flush: int = 1 << 23) -> DataFrame:
    """``word`` and its ``n`` over all texts, for words of at most ``LONGEST`` bytes; ``flush`` bytes at a time are counted before the shuffle."""
    raw = docs.sparkSession.sparkContext.broadcast(vocabulary_file)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = read_vocabulary(raw.value)

        def out(keys: list[pa.Array]) -> pa.RecordBatch:
            met = pc.value_counts(pa.chunked_array(keys))
            plain, words, others = vocabulary.key_words(met.field(0))
            rest: Counter = Counter()
            for parts, n in zip(others, met.field(1).filter(pc.invert(plain)).to_pylist()):
                for w in parts:
                    if isinstance(w, str):
                        rest[w] += n
            words = pa.concat_arrays([words, pa.array(list(rest), words.type)])
            made = pa.RecordBatch.from_arrays([words, pa.concat_arrays([met.field(1).filter(plain), pa.array(list(rest.values()), pa.int64())])], names=["word", "n"])
            return made.filter(pc.less_equal(pc.binary_length(words), LONGEST))

        held, size = [], 0
        for batch in batches:
            for part in byte_slices(batch.column(0), 1 << 21):
                held.append(vocabulary.keys(part)[0])
                size += held[-1].nbytes
                if size > flush:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)

    return docs.select(text).mapInArrow(work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(docs: DataFrame, vocabulary_file: bytes, text: str = "text", words: int = 50_000) -> bytes:
    """Transducer of the most frequent words of all texts, at most ``words`` of them and 64 bytes each.

    All words are counted; those reach the driver whose count is at least the least bound that at most ``words``
    words meet. Bounds are powers of two cut in sixteen parts, so counts of counts are a few hundred rows. Repeated rows
    count each; other columns are not read.
    """
    vocabulary = Vocabulary(vocabulary_file)
    counts = stored(count_words(docs, vocabulary_file, text), "words")
    step = F.floor(F.log2("n") * 16).cast("int")
    held, bound = 0, None
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        held += r["n"]
        if held > words:
            break
        bound = r["step"]
    top = counts.where(step >= bound).select("word").collect() if bound is not None else []
    return build_transducer((w, vocabulary.merge(w)) for w in sorted(r["word"].encode() for r in top))


def encode(docs: DataFrame, vocabulary_file: bytes, lexicon: bytes, text: str = "text", size: int = 1 << 21) -> DataFrame:
    """``docs`` with ``ids`` (array of int), the tokens of the whole text; null and empty texts give an empty array.

    The lexicon only saves work: a word that it lacks is merged exactly. Added tokens in a text are
    one id, as the library reads them. A task reads about ``size`` bytes at a time and finds the ids of each distinct chunk among
    them once. Repeated rows get equal ids; a column ``ids`` of ``docs`` is replaced.
    """
    spark = docs.sparkSession
    raw, built = spark.sparkContext.broadcast(vocabulary_file), spark.sparkContext.broadcast(lexicon)

    def make():
        vocabulary, transducer = read_vocabulary(raw.value), Transducer(built.value)

        def ids_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Start and number of the ids of each word, and the ids: words of the lexicon by one walk for all, the others merged."""
            flat, starts, sizes = _bytes_of(words)
            number = transducer.find(flat, starts, sizes)
            rest = np.flatnonzero(number < 0)
            at, counts = transducer.offsets[number], transducer.offsets[np.minimum(number + 1, len(transducer.offsets) - 1)] - transducer.offsets[number]
            merged, n, ids = vocabulary.merge_all(flat, starts[rest], sizes[rest])
            at[rest], counts[rest] = len(transducer.ids) + merged, n
            return at, counts, np.concatenate([transducer.ids, ids])

        def part(texts: pa.Array) -> pa.Array:
            flat, sizes, order = vocabulary.keys(texts)
            keys = flat.dictionary_encode()
            plain, single, others = vocabulary.key_words(keys.dictionary)
            several = [w for words in others for w in words]
            names = pa.concat_arrays([single, pa.array(["" if isinstance(w, int) else w for w in several], single.type)]).dictionary_encode()
            start, count, ids = ids_of(names.dictionary)
            # Added tokens are numbered behind the words.
            word, added = names.indices.to_numpy().astype(np.int64), [(i, w) for i, w in enumerate(several, len(single)) if isinstance(w, int)]
            word[[i for i, _ in added]] = len(start) + np.arange(len(added))
            start, count = np.concatenate([start, len(ids) + np.arange(len(added))]), np.concatenate([count, np.ones(len(added), np.int64)])
            ids = np.concatenate([ids, np.array([w for _, w in added], np.int64)])
            # Words of each key, the plain keys first, then of each key as it occurs, then the ids of those.
            words = np.concatenate([np.ones(len(single), np.int64), np.array([len(w) for w in others], np.int64)])
            place = np.empty(len(words), np.int64)
            place[np.argsort(pc.invert(plain).to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(words))
            met = place[keys.indices.to_numpy()]
            use = _gather(word, (np.cumsum(words) - words)[met], words[met])
            made = pa.array(_gather(ids.astype(np.int32), start[use], count[use]))
            ends = np.concatenate([[0], np.cumsum(count[use])])[np.concatenate([[0], np.cumsum(words[met])])[np.concatenate([[0], np.cumsum(sizes)])]]
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)
            # Texts that were cut by the pattern stand last.
            return made if (order[1:] > order[:-1]).all() else made.take(pa.array(np.argsort(order)))

        def batch(texts):
            return [pa.concat_arrays([part(some) for some in byte_slices(texts, size)])]

        return batch

    return append_columns(docs, [text], "ids array<int>", make, rows=512, arrow=True)


def decode(docs: DataFrame, vocabulary_file: bytes, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of the ids; null and empty arrays give an empty text, broken UTF-8 the replacement character."""
    spelled = read_vocabulary(vocabulary_file).table
    # Ids without a token are null and refused below; tasks need nothing else of the vocabulary.
    tokens = docs.sparkSession.sparkContext.broadcast([spelled.get(i) for i in range(max(spelled) + 1)])

    def make():
        table_ = pa.array(tokens.value, pa.binary())

        def batch(rows):
            parts = table_.take(rows.flatten())
            if parts.null_count:
                raise KeyError("an id that the vocabulary does not have")
            bytes_ = np.concatenate([[0], np.cumsum(pc.binary_length(parts).to_numpy())])
            ends = bytes_[np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy())])]
            # The tokens of a row lie one behind the other, so its text is a stretch of their bytes.
            flat = pa.py_buffer(b"".join(parts.to_pylist())) if parts.offset else parts.buffers()[2] or pa.py_buffer(b"")
            made = pa.StringArray.from_buffers(len(rows), pa.py_buffer(ends.astype(np.int32).tobytes()), flat)
            try:
                made.validate(full=True)
            except pa.ArrowInvalid:
                raw_ = flat.to_pybytes()
                return [[raw_[a:b].decode("utf-8", "replace") for a, b in zip(ends.tolist(), ends[1:].tolist())]]
            return [made]

        return batch

    return append_columns(docs, [ids], "decoded string", make, rows=256, arrow=True)


def vocabulary_path() -> str:
    """The installed byte-level vocabulary; pass another file's content for another vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op9_bpe(spark, sf_dir):
    """Tokens of every text, and the text that they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = _read(vocabulary_path())
    tokens = encode(docs, vocabulary, compile_lexicon(docs, vocabulary)).select("doc_id", "ids")
    return decode(tokens, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def stage_tokens(spark, docs, sf_dir):
    """The documents that are left, as token ids beside the text."""
    vocabulary = _read(vocabulary_path())
    return encode(docs, vocabulary, compile_lexicon(docs, vocabulary))


QUERIES = {"op9_bpe": op9_bpe}
SQL: dict[str, str] = {}
