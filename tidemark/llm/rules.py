"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append_columns, sample_keys, table

SYMBOLS = "#*$%&|<>"
_CUT = str.maketrans("\t\n\x0b\x0c\r", "     ")


class Measures:
    """What the rules look at; each figure of a text is computed when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        # Blank and the five ASCII controls cut words; other white space belongs to them.
        return [w for w in self.text.translate(_CUT).split(" ") if w]

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_upper(self) -> int:
        return sum(1 for c in self.text if "A" <= c <= "Z")

    @cached_property
    def n_lower(self) -> int:
        return sum(1 for c in self.text if "a" <= c <= "z")

    @cached_property
    def n_repeat_words(self) -> int:
        if self.n_words < 4:
            return 0
        numbers: dict[str, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in self.words], np.int64)
        pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
        _, window, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        often = times[window] > 1
        covered = np.zeros(len(ids), bool)
        for shift in range(3):
            covered[shift : shift + len(often)] |= often
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    """A text goes when ``rejects`` holds; ``sql`` says the same over the columns of the figures."""

    name: str
    rejects: Callable[[Measures], bool]
    sql: str


RULES = (
    Rule("few_words", lambda m: m.n_words < 50, "n_words < 50"),
    Rule("repetition", lambda m: 100 * m.n_repeat_words > 50 * m.n_words, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", lambda m: 10 * m.n_symbols > 3 * m.n_words, "10 * n_symbols > 3 * n_words"),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 15 * m.n_words, "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("dup_lines", lambda m: 10 * m.n_dup_lines > 3 * len(m.lines), "10 * n_dup_lines > 3 * n_lines"),
    Rule("upper_case", lambda m: m.n_upper > m.n_lower, "n_upper > n_lower"),
)


def order_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", key: str = "doc_id", rows: int = 200,
) -> list[Rule]:
    """Rules by falling rejections per second on the ``rows`` keys with the smallest hash.

    Their whole texts (the smallest of a key) are timed where they lie; two figures a rule and text reach the driver. Only the order,
    hence the time, depends on this sample, never a verdict. A table without keys leaves the order as given.
    """
    wanted = [k for _, _, k in sample_keys(docs.select(F.lit(0).alias("one"), F.col(key).alias("of")), "one", "of", rows)]
    if not wanted:
        return list(rules)

    def make():
        def batch(texts):
            out = []
            for t in texts:
                figures = []
                for rule in rules:
                    began = time.perf_counter()
                    rejected = rule.rejects(Measures(t))
                    figures += [float(rejected), time.perf_counter() - began]
                out.append(figures)
            return [out]

        return batch

    picked = docs.where(F.col(key).isin(wanted)).groupBy(F.col(key).alias("k")).agg(F.min(text).alias("t"))
    figures = [r["figures"] for r in append_columns(picked, ["t"], "figures array<double>", make).select("figures").collect()]
    worth = [-sum(f[2 * i] for f in figures) / (sum(f[2 * i + 1] for f in figures) + 1e-9) for i in range(len(rules))]
    return [rules[i] for i in sorted(range(len(rules)), key=worth.__getitem__)]


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def apply_rules(docs: DataFrame, rules: Sequence[Rule], text: str = "text", figures: Sequence[str] = ()) -> DataFrame:
    """``docs`` with ``kept``, ``failed_rule`` (first in the order that rejects, else null) and the figures asked for.

    A rejected text is not put to later rules. Null and empty texts have no words, so ``few_words``
    rejects them. Rows are judged one by one, so repeated rows get equal verdicts; the whole text
    counts however long. Columns of ``docs`` with these names are replaced.
    """

    def make():
        def batch(texts):
            out = [[], [], *([] for _ in figures)]
            for t in texts:
                m = Measures(t)
                failed = next((r.name for r in rules if r.rejects(m)), None)
                out[0].append(failed is None)
                out[1].append(failed)
                for column, name in zip(out[2:], figures):
                    column.append(getattr(m, name))
            return out

        return batch

    schema = ", ".join(["kept boolean", "failed_rule string", *(f"{name} bigint" for name in figures)])
    return append_columns(docs, [text], schema, make)


def op2_quality_rules(spark, sf_dir):
    """Figures and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = apply_rules(docs, order_rules(docs), figures=FIGURES)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *FIGURES, failed.alias("base_failed"), "kept")


_VERDICT = " OR ".join(f"({r.sql})" for r in RULES)
SQL = {
    "op2_quality_rules": rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM t),
win AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
often AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + s) AS n FROM often, (VALUES (0), (1), (2)) v(s) GROUP BY doc_id),
f AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum([length(x) for x in words]), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower
      FROM w LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, NOT ({_VERDICT}) AS kept FROM f
"""
}
QUERIES = {"op2_quality_rules": op2_quality_rules}
