"""Secret scans by a trigram index of the rules' mandatory trigrams, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, stored, table
from tidemark.operators.skew import split_join


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long ``group`` of a match must be at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, then well-known token formats. Runs that a length test would
# drop whole are left out by their count; ``assign`` is scanned first and tested after.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)

#: More strings than this that a pattern can begin or end with count as unknown.
_MANY = 64


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of lower-case trigrams that a match's text must all hold; None without a mandatory one.

    The pattern's tree is walked once: literals, small classes, alternatives, groups and counted
    repeats yield exact strings while these are few; a part that is not exact ends them.
    """
    from re import _parser

    def grams(strings):
        return [frozenset(s[i : i + 3].lower() for i in range(len(s) - 2)) for s in strings]

    def joined(x, y):
        out = {a | b for a in x for b in y}
        return list(out) if len(out) <= 4 * _MANY else x

    def walk(items):
        """(exact strings or None, alternatives of sets) of a sequence."""
        run, need = [""], [frozenset()]
        for op, arg in items:
            name, exact, inner = str(op), None, None
            if name == "LITERAL":
                exact = [chr(arg)]
            elif name == "IN":
                parts = [(str(o), a) for o, a in arg]
                if all(o in ("LITERAL", "RANGE") for o, _ in parts):
                    exact = [chr(c) for o, a in parts for c in ([a] if o == "LITERAL" else range(a[0], a[1] + 1))]
            elif name == "SUBPATTERN":
                exact, inner = walk(arg[3])
            elif name == "BRANCH":
                made = [walk(b) for b in arg[1]]
                if all(e is not None for e, _ in made):
                    exact = [s for e, _ in made for s in e]
                inner = [g for e, n in made for g in (grams(e) if e is not None else n)]
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                low, high, body = arg
                e, inner = walk(body)
                if e is not None and (low, int(high)) == (0, 1):
                    exact = ["", *e]
                elif e is not None and low == high and len(e) ** low <= _MANY:
                    exact = ["".join(p) for p in product(e, repeat=low)]
                if low == 0:
                    inner = None
            if exact is not None and len(run) * len(exact) <= _MANY:
                run = [a + b for a in run for b in exact]
                continue
            need, run = joined(need, grams(run)), [""]
            if exact is not None and len(exact) <= _MANY:
                run = exact
            elif inner:
                need = joined(need, inner)
        if need == [frozenset()] and run != [""]:
            return run, grams(run)
        return None, joined(need, grams(run))

    exact, need = walk(_parser.parse(pattern))
    found = list(set(grams(exact) if exact is not None else need))
    return sorted(found, key=sorted) if found and all(found) else None



def rule_spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end, kind) in code points of the rule's leftmost non-overlapping matches that are long enough.

    What lies between matches and the matches themselves alternate, so their lengths give the places.
    """
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), lambda s: F.char_length(s))
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda s: F.char_length(s) >= rule.least)
    steps = F.zip_with(F.zip_with(whole, tested, lambda w, t: F.struct(F.char_length(w).alias("n"), t.alias("ok"))), between,
                       lambda m, gap: F.struct(gap.alias("gap"), m["n"].alias("n"), m["ok"].alias("ok")))
    found = F.filter(steps, lambda s: s["n"].isNotNull())
    kind = F.lit(rule.kind)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,ok:boolean,kind:string>>)")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(acc, s):
        begin = acc["at"] + s["gap"]
        span = F.struct(begin.alias("start"), (begin + s["n"]).alias("end"), s["ok"].alias("ok"), kind.alias("kind"))
        return F.struct((begin + s["n"]).alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.filter(F.aggregate(found, start, step, lambda acc: acc["spans"]), lambda s: s["ok"])


def postings(docs: DataFrame, grams: Sequence[str], text: str, row: str) -> DataFrame:
    """``gram``, ``row``: the trigrams of ``grams`` that each text holds, case aside. Only rules' trigrams are indexed."""
    lower = F.lower(F.col(f"`{text}`"))
    held = F.array_compact(F.array(*[F.when(F.contains(lower, F.lit(g)), F.lit(g)) for g in grams]))
    return docs.select(F.explode(held).alias("gram"), F.col(row).alias("row")).distinct()


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``secrets``: array of (start, end, kind) in code points, by start, then kind as listed.

    Rules with mandatory trigrams run only on texts in the intersection of their postings, rules
    without run on all. Null and empty texts have no spans. Rows are joined to the index by a hash of key
    and text, so rows equal in both get equal spans, and null keys do no harm. Spans of
    different kinds may overlap. A column ``secrets`` of ``docs`` is replaced. Long texts are
    scanned whole.
    """
    docs = docs.drop("secrets")
    row, wanted = fresh(docs, "row_key"), fresh(docs, "wanted_rules")
    keyed = docs.withColumn(row, F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")))
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    grams = sorted({g for q in queries.values() if q for alternative in q for g in alternative})
    if grams:
        index = stored(postings(keyed, grams, text, row), "postings")
        flags = index.groupBy("row").agg(*[F.max(F.col("gram") == g).alias(f"g{i}") for i, g in enumerate(grams)])
        place = {g: f"g{i}" for i, g in enumerate(grams)}
        hits = []
        for kind, q in queries.items():
            if q:
                anyof = F.lit(False)
                for alternative in q:
                    allof = F.lit(True)
                    for g in sorted(alternative):
                        allof = allof & F.col(place[g])
                    anyof = anyof | allof
                hits.append(F.when(anyof, F.lit(kind)))
        listed = flags.select("row", F.array_compact(F.array(*hits)).alias("kinds")).where(F.size("kinds") > 0)
        keyed = split_join(keyed, stored(listed, "candidates").select(F.col("row").alias(row), F.col("kinds").alias(wanted)), [row], "left")
    else:
        keyed = keyed.withColumn(wanted, F.lit(None).cast("array<string>"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    none = F.expr("cast(array() as array<struct<start:int,end:int,ok:boolean,kind:string>>)")
    arrays = [F.when(F.array_contains(F.col(wanted), r.kind), rule_spans(body, r)).otherwise(none) if queries[r.kind] else rule_spans(body, r) for r in rules]
    order = {r.kind: i for i, r in enumerate(rules)}
    ranks = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    ranked = F.transform(F.concat(*arrays), lambda s: F.struct(s["start"].alias("start"), ranks[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.sort_array(ranked), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return keyed.select(*[F.col(f"`{c}`") for c in docs.columns], spans.alias("secrets"))


BASE = ("assign", "access", "hex")


def op7_secrets(spark, sf_dir):
    """Secrets of every document: counts of the base kinds and all spans."""
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # Held once: each figure below would scan anew otherwise.
    found = stored(found.select("doc_id", "secrets"), "secrets")
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("secrets")).alias("spans"))


QUERIES = {"op7_secrets": op7_secrets}
SQL: dict[str, str] = {}
