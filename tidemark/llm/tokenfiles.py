"""Token ids in binary files: one zstandard frame per document over a shared dictionary, with an index at the end.

A folder holds the dictionary, the token files and a catalogue of them (Parquet). A token file is

    8 bytes  MAGIC
    1 byte   width of an id, 2 or 4; 7 bytes of zeros
    32 bytes SHA-256 of the dictionary
    frames   one per document, ids as little-endian unsigned integers
    index    one zstandard frame: for each document its key, whether it is null, the end of its frame and its number of ids
    24 bytes start of the index, number of documents, crc32 of the index (8 bytes each)
    8 bytes  MAGIC

Documents lie in ascending order of their keys, within a file and from file to file.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.operators.ranges import range_bounds, range_number
from tidemark.session import file_count, scratch_dir

MAGIC = b"TIDETOK1"
_HEAD = len(MAGIC) + 8 + 32
_TAIL = 24 + len(MAGIC)
_INDEX = np.dtype([("key", "<i8"), ("null", "u1"), ("end", "<u8"), ("ids", "<u8")])

# How the installed word-level vocabulary prepares a text.
_NORMAL = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Letters for which lower-casing and composition are settled character by character: A-Z and those of Latin-1 and Latin Extended-A.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_SIMPLE = re.compile(f"[!-~{_LETTERS}]+")
_SPLIT_SIMPLE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is visible in Latin-1, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: 256 + i for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as the tokenizers library gives them, without truncation, padding and added ends.

    Where the vocabulary drops white space and lower-cases character by character, ASCII white space parts a text
    into chunks that do not touch each other: a chunk is encoded once and remembered, the first ``cached`` of them.
    Chunks of visible ASCII characters and Latin letters go to the library's model directly, all others through the
    whole library. Any other vocabulary encodes whole texts.
    """

    def __init__(self, vocabulary: str, cached: int = 400_000, longest: int = 64):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if self.tokenizer.get_vocab_size(True) <= 2**16 else 4
        self.kind, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        self.letters = byte_letters()
        parts = json.loads(vocabulary)
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.chunked = (
            parts.get("normalizer") == _NORMAL
            and len(split) == 2 and split[0].get("pattern") == {"Regex": _SPLIT} and split[0].get("behavior") == "Removed" and split[0].get("invert") is True
            and split[1].get("type") == "ByteLevel" and not split[1].get("add_prefix_space") and not split[1].get("use_regex")
            and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and t["content"].split() == [t["content"]] and t["content"].startswith("<|") for t in parts.get("added_tokens") or [])
        )
        self.cached, self.longest = cached, longest
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _simple(self, chunk: str) -> bytes:
        parts, words = [], self.words
        for word in _SPLIT_SIMPLE.findall(chunk.lower()):
            known = words.get(word)
            if known is None:
                plain = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                known = self._pack([t.id for t in self.tokenizer.model.tokenize(plain)])
                if len(words) < self.cached and len(word) <= self.longest:
                    words[word] = known
            parts.append(known)
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [self._pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Serialised ids of each text; null is empty."""
        if not self.chunked:
            return self._library([t or "" for t in texts])
        split = [(t or "").encode("utf-8", "replace").split() for t in texts]
        chunks, simple = self.chunks, _SIMPLE.fullmatch
        new, other = [c for c in set().union(*split) if c not in chunks], []
        for c in new:
            text = c.decode()
            if "<|" not in text and simple(text):
                chunks[c] = self._simple(text)
            else:
                other.append(c)
        chunks.update(zip(other, self._library([c.decode() for c in other])))
        out = [b"".join(map(chunks.__getitem__, found)) for found in split]
        full = len(chunks) > self.cached
        for c in new:
            if full or len(c) > self.longest:
                del chunks[c]
        return out


def _file_system(path: str):
    """A file system that Python workers reach too (local, HDFS, object stores), and the path in it."""
    from pyarrow import fs

    if "://" not in path:
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def _compressor(dictionary: bytes, level: int):
    import zstandard

    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=data, write_dict_id=False, write_content_size=True)


def train_dictionary(
    docs: DataFrame, vocabulary: str, text: str = "text", rows: int = 2_000, piece: int = 4_096, size: int = 65_536
) -> bytes:
    """A zstandard dictionary of ``size`` bytes trained on serialised ids of about ``rows`` texts, spread by hash over all.

    One piece of at most ``piece`` bytes of each, from anywhere in it, reaches the driver. The sample decides
    the rate of compression only. Too few texts to train on give an empty dictionary.
    """
    import zstandard

    raw = docs.sparkSession.sparkContext.broadcast(vocabulary)
    total = docs.count()
    chosen = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(F.monotonically_increasing_id()).alias("h"))
    chosen = chosen.where(F.pmod("h", F.lit(1_000_000)) < max(1, -(-1_000_000 * rows // max(1, total)))).where("length(text) > 0")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(raw.value)
        for batch in batches:
            made = []
            for ids, h in zip(encoder(batch.column(0).to_pylist()), batch.column(1).to_pylist()):
                at = h % max(1, len(ids) - piece + 1) // encoder.width * encoder.width
                made.append(ids[at : at + piece])
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["ids"])

    # Few tasks: each has to load the vocabulary.
    pieces = sorted(r["ids"] for r in chosen.repartition(4).mapInArrow(work, "ids binary").collect() if r["ids"])
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, pieces)) // 8), [bytes(p) for p in pieces]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_token_files(
    docs: DataFrame, vocabulary: str, end_id: int, text: str = "text", key: str = "doc_id", folder: str | None = None,
    files: int | None = None, level: int = 3,
) -> str:
    """Write the ids of every whole text, ``end_id`` after each, in ascending order of ``key``; returns the folder.

    Files cut the keys into ranges of equal depth; bounds come from a sampling pass over the key, so texts are encoded
    once and only compressed frames are shuffled. A task writes a file under a name of its own, and the
    catalogue names the files of the attempts that Spark committed, so lost executors leave none half read.

    ``key`` is an integer column. Null keys come first and equal keys lie side by side in no given order, spread over
    files where they are many. Null and empty texts have the end id alone, repeated rows are all written, an empty
    table gives a catalogue of no files. Rows must come from a table, so that a task that runs again reads them in the same order.
    """
    import hashlib

    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-files")
    files = files or file_count(spark)
    raw = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text")).withColumn("row", F.monotonically_increasing_id())
    bounds = range_bounds(rows.select("key", "row"), ["key", "row"], files)
    dictionary = train_dictionary(rows, vocabulary)
    system, place = _file_system(folder)
    system.create_dir(place, recursive=True)
    with system.open_output_stream(f"{place}/dictionary.zdict") as out:
        out.write(dictionary)
    shared, digest = spark.sparkContext.broadcast(dictionary), hashlib.sha256(dictionary).digest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pack = Encoder(raw.value), _compressor(shared.value, level).compress
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                # Caches of strings have no cycles; walking them again and again would cost a fifth of the time.
                gc.disable()
                try:
                    ids = [x + end for x in encoder(part.column(2).to_pylist())]
                finally:
                    gc.enable()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(3), pa.array([len(x) // encoder.width for x in ids], pa.int64()),
                     pa.array(map(pack, ids), pa.binary()), pa.array([encoder.width] * len(ids), pa.int32())],
                    names=["key", "row", "file", "n", "frame", "width"])

    frames = rows.select("key", "row", "text", range_number(rows, ["key", "row"], bounds).alias("file")).mapInArrow(
        encode, "key bigint, row bigint, file int, n bigint, frame binary, width int")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        place_, out, at, index, number = None, None, _HEAD, [], None
        system_, base = _file_system(folder)
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    number = batch.column(2)[0].as_py()
                    place_ = f"ids-{number:06d}-{uuid.uuid4().hex}.tok"
                    out = system_.open_output_stream(f"{base}/{place_}")
                    out.write(MAGIC + bytes([batch.column(5)[0].as_py()]) + bytes(7) + digest)
                sizes = np.zeros(batch.num_rows, _INDEX)
                keys = batch.column(0)
                sizes["key"], sizes["null"] = keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_null().to_numpy(zero_copy_only=False)
                made = [f.as_buffer() for f in batch.column(4)]
                sizes["end"] = at + np.cumsum([f.size for f in made])
                sizes["ids"] = batch.column(3).to_numpy()
                for f in made:
                    out.write(f)
                at = int(sizes["end"][-1])
                index.append(sizes)
            if out is not None:
                whole = np.concatenate(index)
                packed = zstandard.ZstdCompressor(level=level).compress(whole.tobytes())
                out.write(packed + struct.pack("<QQQ", at, len(whole), zlib.crc32(packed)) + MAGIC)
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([number], pa.int32()), "name": [place_], "docs": pa.array([len(whole)], pa.int64()),
                    "ids": pa.array([int(whole["ids"].sum())], pa.int64()), "bytes": pa.array([at + len(packed) + _TAIL], pa.int64())})
        finally:
            if out is not None:
                out.close()

    sorted_ = frames.repartitionById(files, F.col("file")).sortWithinPartitions("file", "key", "row")
    sorted_.mapInArrow(write, "file int, name string, docs bigint, ids bigint, bytes bigint").write.parquet(f"{folder}/catalog")
    return folder


class TokenFile:
    """One token file, opened for reads of single documents."""

    def __init__(self, folder: str, name: str):
        import hashlib

        import zstandard

        system, base = _file_system(folder)
        with system.open_input_stream(f"{base}/dictionary.zdict") as f:
            dictionary = f.read()
        self.file = system.open_input_file(f"{base}/{name}")
        head = self.file.read_at(_HEAD, 0)
        tail = self.file.read_at(_TAIL, self.file.size() - _TAIL)
        if head[: len(MAGIC)] != MAGIC or tail[24:] != MAGIC:
            raise ValueError(f"{name} is not a token file")
        if head[len(MAGIC) + 8 :] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name} was written with another dictionary")
        start, count, crc = struct.unpack("<QQQ", tail[:24])
        packed = self.file.read_at(self.file.size() - _TAIL - start, start)
        if zlib.crc32(packed) != crc:
            raise ValueError(f"the index of {name} is damaged")
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), _INDEX)
        assert len(self.index) == count
        self.kind = f"<u{head[len(MAGIC)]}"
        self.starts = np.concatenate([[_HEAD], self.index["end"][:-1]]).astype(np.int64)
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.unpack = zstandard.ZstdDecompressor(dict_data=data).decompress

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, by one read of its frame."""
        frame = self.file.read_at(int(self.index["end"][i]) - int(self.starts[i]), int(self.starts[i]))
        return np.frombuffer(self.unpack(frame), self.kind).astype("<u4")

    def find(self, key: int) -> list[int]:
        """Numbers of the documents with a key; nulls come first, so the rest is searched in order."""
        nulls = int(self.index["null"].sum())
        low, high = (nulls + int(np.searchsorted(self.index["key"][nulls:], key, side)) for side in ("left", "right"))
        return list(range(low, high))

    def documents(self, step: int = 1 << 22) -> Iterator[tuple[int, np.ndarray]]:
        """Every document in order, read in stretches of about ``step`` bytes."""
        i = 0
        while i < len(self.index):
            j = max(i + 1, int(np.searchsorted(self.index["end"], int(self.starts[i]) + step, "right")))
            at = int(self.starts[i])
            block = memoryview(self.file.read_at(int(self.index["end"][j - 1]) - at, at))
            for k in range(i, j):
                frame = block[int(self.starts[k]) - at : int(self.index["end"][k]) - at]
                yield k, np.frombuffer(self.unpack(frame), self.kind).astype("<u4")
            i = j


def _catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder with ``start``, the ids of all files before: one row per file."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema("file int, name string, docs bigint, ids bigint, bytes bigint").parquet(f"{folder}/catalog")
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32`` and ``ids``, read back file by file.

    ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit integers. Files are read in parallel, a stretch of
    each at a time.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with TokenFile(folder, name) as opened:
                    ends = start + np.cumsum(opened.index["ids"].astype(np.int64))
                    held: list = []
                    size = 0

                    def out():
                        at = [k for k, _, _ in held]
                        index = opened.index[at]
                        counts = index["ids"].astype(np.int64)
                        columns = [pa.array(index["key"], mask=index["null"] == 1), pa.array(ends[at] - counts), pa.array(counts), pa.array([c for _, c, _ in held], pa.int64())]
                        if with_ids:
                            columns.append(pa.array([x.astype(np.int64) for _, _, x in held], pa.list_(pa.int64())))
                        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

                    for k, ids in opened.documents():
                        held.append((k, zlib.crc32(ids.tobytes()), ids if with_ids else None))
                        size += len(ids) if with_ids else 1
                        if size >= 200_000:
                            yield out()
                            held, size = [], 0
                    if held:
                        yield out()

    files = _catalog(spark, folder).select("name", "start").repartition(file_count(spark))
    return files.mapInArrow(work, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else ""))


def vocabulary_text(path: str | None = None) -> str:
    """Content of a tokenizers file; by default the installed word-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def op12_token_files(spark, sf_dir):
    """Place, number and checksum of every document's ids, from the files that they were written to."""
    docs = table(spark, sf_dir, "documents")
    return read_token_files(spark, write_token_files(docs, vocabulary_text(), end_id=2), with_ids=False)


QUERIES = {"op12_token_files": op12_token_files}
SQL: dict[str, str] = {}
