"""Language identification by compression with one raw-content dictionary per language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append_columns, fresh, remainder, sample_keys, table

UNDETERMINED = "und"


class Languages:
    """Raw-content dictionaries, one per language, and the coder that compares them.

    A text is lower-cased, everything but letters becomes one blank, and the bytes are coded in
    blocks, each block by each dictionary. So the whole text counts, and a long text cannot replace
    the dictionary by its own beginning.
    """

    def __init__(self, dictionaries: dict[str, bytes], level: int = 6, block: int = 2048, min_margin: float = 0.004):
        self.dictionaries, self.level, self.block, self.min_margin = dictionaries, level, block, min_margin

    def coder(self):
        import re

        import regex
        import zstandard

        letter, other, block = regex.compile(r"\p{L}"), re.compile(r"[\W\d_]+"), self.block
        compressors = []
        for lang in sorted(self.dictionaries):
            raw = self.dictionaries[lang]
            entry = None
            if len(raw) >= 8:  # the library takes no shorter dictionary
                entry = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                entry.precompute_compress(level=self.level)
            compressors.append((lang, zstandard.ZstdCompressor(
                level=self.level, dict_data=entry, write_content_size=False, write_checksum=False, write_dict_id=False)))

        def predict(text: str | None) -> tuple[str, float, float]:
            if text is None or not compressors or not letter.search(text):
                return UNDETERMINED, 0.0, 0.0
            raw = other.sub(" ", text.lower()).encode("utf-8", "replace")
            blocks = [raw[i : i + block] for i in range(0, len(raw), block)]
            sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in compressors)
            best, lang = sizes[0]
            margin = 1.0 if len(sizes) == 1 else (sizes[1][0] - best) / sizes[1][0]
            # Bytes as code lengths, tempered: a lead of 4 bytes halves the odds of a rival.
            score = 1 / sum(2 ** (-min(200, (s - best) / 4)) for s, _ in sizes)
            return lang, score, margin

        return predict


def spread_over(raw: bytes, size: int, width: int = 96) -> bytes:
    """At most ``size`` bytes of ``raw`` in pieces of ``width``, evenly spread from its first to its last byte."""
    if len(raw) <= size:
        return raw
    count = (size + 1) // (width + 1)  # a blank between two pieces
    if count < 2:
        at = (len(raw) - size) // 2
        return raw[at : at + size]
    starts = [i * (len(raw) - width) // (count - 1) for i in range(count)]
    return b" ".join(raw[at : at + width] for at in starts)[:size]


def fit_languages(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    rows_per_language: int = 400, dictionary_bytes: int = 112 * 1024, **options,
) -> Languages:
    """Dictionaries from a bounded sample: the ``rows_per_language`` keys of each language with the smallest hash.

    Each gives an equal share of the ``dictionary_bytes``, in pieces spread over its whole text; of several texts under a key
    the smallest counts. Rows without language or key teach nothing, null and empty texts neither.
    """
    import re

    chosen = sample_keys(labelled, lang, key, rows_per_language)
    if not chosen:
        return Languages({}, **options)
    members: dict[str, int] = {}
    for name, _, _ in chosen:
        members[name] = members.get(name, 0) + 1
    shares = {name: max(64, dictionary_bytes // n - 1) for name, n in members.items()}

    def make():
        other = re.compile(r"[\W\d_]+")

        def batch(names, texts):
            return [[spread_over(other.sub(" ", t.lower()).encode("utf-8", "replace"), shares[n]) for n, t in zip(names, texts)]]

        return batch

    taken = {(name, k) for name, _, k in chosen}
    rows = (
        labelled.where(F.col(key).isin(sorted({k for _, k in taken})) & F.col(lang).isin(sorted(members)) & F.col(text).isNotNull())
        .groupBy(F.col(lang).alias("lang"), F.col(key).alias("key")).agg(F.min(text).alias("text"))
    )
    pieces = append_columns(rows, ["lang", "text"], "piece binary", make).drop("text").collect()
    found = {(r["lang"], r["key"]): bytes(r["piece"]) for r in pieces}
    dictionaries: dict[str, bytes] = {}
    for name, _, k in chosen:
        if found.get((name, k)):
            dictionaries[name] = (dictionaries[name] + b" " if name in dictionaries else b"") + found[(name, k)]
    return Languages({name: raw[:dictionary_bytes] for name, raw in dictionaries.items()}, **options)


def identify_language(docs: DataFrame, languages: Languages, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``margin`` and ``rejected``.

    ``lang_pred`` is the language whose dictionary codes the text smallest; equal sizes go to the
    first name. ``margin`` is the relative lead over the next; ``rejected`` means undetermined or
    a lead below ``min_margin``. Null texts, texts without a letter (empty ones too) and a model
    without languages give ``und`` with score 0, rejected. Rows are judged one by one, so repeated
    rows get equal results; columns of ``docs`` with these four names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(languages)  # 112 KiB per language

    def make():
        predict, narrow = model.value.coder(), model.value.min_margin

        def batch(texts):
            found = [predict(t) for t in texts]
            return [[f[0] for f in found], [f[1] for f in found], [f[2] for f in found],
                    [f[0] == UNDETERMINED or f[2] < narrow for f in found]]

        return batch

    return append_columns(docs, [text], "lang_pred string, score double, margin double, rejected boolean", make)


def op1_language(spark, sf_dir):
    """Languages of all documents, learnt from those whose remainder by 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit_languages(docs.where(~held))
    return identify_language(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


def stage_language(spark, docs, sf_dir):
    """Keep the documents whose language is determined with a sufficient lead."""
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit_languages(table(spark, sf_dir, "documents").where(~held))
    copy = fresh(docs, "text_in")
    judged = identify_language(docs.withColumn(copy, F.col("text")), model, copy)
    return judged.where(~F.col("rejected")).select(*docs.columns)


QUERIES = {"op1_language": op1_language}
SQL: dict[str, str] = {}
