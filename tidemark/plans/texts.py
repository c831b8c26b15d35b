"""Text-corpus and vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import text as X
from tidemark.operators import vectors as V
from tidemark.plans.registry import query

# Lookup entries; order matters for the ordered mapping.
LOOKUP = [("the", "THE"), ("there", "THERE"), ("on", "ON"), ("onthe", "<ONTHE>"), ("THE and", "ARTICLE AND"), ("le ", "LE ")]
RULES = [("[0-9]+", "#"), (" +", " "), ("(th)([a-z])", "$1-$2"), ("\\n+", "\n")]


def nested_replace(column: str, pairs) -> str:
    out = column
    for old, new in pairs:
        out = f"replace({out}, '{old}', '{new}')"
    return out


@query("x01_dictionary_replace", f"SELECT doc_id, md5({nested_replace('text', sorted(LOOKUP, key=lambda p: -len(p[0])))}) AS digest FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(X.replace_longest_first("text", LOOKUP)).alias("digest"))


@query("x02_ordered_mapping", f"SELECT doc_id, md5({nested_replace('text', LOOKUP)}) AS digest FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(X.replace_in_order("text", LOOKUP)).alias("digest"))


@query("x03_regex_rules", """
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[0-9]+', '#', 'g'), ' +', ' ', 'g'), '(th)([a-z])', '\\1-\\2', 'g'), chr(10) || '+', chr(10), 'g')) AS digest
    FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.md5(X.rewrite("text", RULES)).alias("digest"))


@query("x04_replace_and_append", """
    SELECT doc_id, contains(text, 'and the') AS replaced, md5(concat(replace(text, 'and the', 'plus the'), chr(10), '-- end of file')) AS digest FROM documents""")
def _(t):
    edited = X.replace_block_and_append(t.documents.select("doc_id", "text"), "text", "and the", "plus the", "\n-- end of file\n")
    return edited.select("doc_id", "replaced", F.md5("text").alias("digest"))


SQL_TEXT = """concat('with a as (select * from ', source, '.', lang, '_rows r left join (select 1) x on true)', chr(10), 'select * from a join {{{{ source(''raw'', ''', lang, '_', source, ''') }}}} s',
    chr(10), 'inner  JOIN ', source, '_dim, cross join table(gen) where from_x = ', CAST(n_chars AS VARCHAR))""".replace("{{{{", "{{").replace("}}}}", "}}")


@query("x05_referenced_tables", f"""
    WITH s AS (SELECT doc_id, {SQL_TEXT} AS txt FROM documents),
    c AS (SELECT doc_id, unnest(regexp_extract_all(txt, '\\{{\\{{\\s*source\\([''"][^''"]+[''"], [''"]([^''"]+)[''"]\\)\\s*\\}}\\}}', 1)) AS table_name FROM s
          UNION ALL SELECT doc_id, replace(unnest(regexp_extract_all(txt, '(?i)(?:^|[^A-Za-z0-9_])(?:FROM|JOIN)\\s+([A-Za-z0-9_.]+)', 1)), '.', '') FROM s)
    SELECT DISTINCT doc_id, table_name FROM c WHERE table_name <> '' AND upper(table_name) NOT IN ('AS', 'TABLE')""")
def _(t):
    text = F.concat(
        F.lit("with a as (select * from "), "source", F.lit("."), "lang", F.lit("_rows r left join (select 1) x on true)\nselect * from a join {{ source('raw', '"),
        "lang", F.lit("_"), "source", F.lit("') }} s\ninner  JOIN "), "source", F.lit("_dim, cross join table(gen) where from_x = "), F.col("n_chars").cast("string"))
    return X.referenced_tables(t.documents.select("doc_id", text.alias("txt")), "doc_id", "txt")


@query("x06_prefixed_tokens", """
    SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '(?:^|[^A-Za-z0-9_])(thr[A-Za-z0-9_]*)', 1)) AS token FROM documents""")
def _(t):
    return X.tokens_with_prefix(t.documents, "doc_id", "text", "thr")


@query("x07_run_log", """
    SELECT event_id, concat('shop.', event_type, '_', CAST(user_id AS VARCHAR)) AS model, value AS seconds FROM events WHERE value > 100""")
def _(t):
    kind = F.element_at(F.array(F.lit("table"), F.lit("view"), F.lit("incremental")), (F.col("event_id") % 3 + 1).cast("int"))
    line = F.concat(F.lit("\x1b[0m08:55  1 of 9 OK created sql "), kind, F.lit(" model shop."), "event_type", F.lit("_"), F.col("user_id").cast("string"),
                    F.lit(" ........ [\x1b[32mSUCCESS 1\x1b[0m in "), F.col("value").cast("decimal(10,2)").cast("string"), F.lit("s]"))
    return X.mine_run_log(t.events.select("event_id", line.alias("line")), "line", 100).select("event_id", "model", "seconds")


@query("x08_stitch_records", """
    WITH l AS (SELECT user_id, event_id, event_type, event_type IN ('click', 'view') AS cont FROM events),
    g AS (SELECT *, COUNT(*) FILTER (NOT cont) OVER (PARTITION BY user_id ORDER BY event_id) AS grp FROM l)
    SELECT user_id, MAX(CASE WHEN NOT cont THEN event_id END) AS first_line,
           string_agg(CASE WHEN cont THEN concat(event_type, '/') ELSE concat('16,', event_type, '/') END, '' ORDER BY event_id) AS record FROM g GROUP BY user_id, grp""")
def _(t):
    mark = F.when(F.col("event_type").isin("click", "view"), F.lit("88,  ")).otherwise(F.lit("16,"))
    lines = t.events.select("user_id", "event_id", F.concat(mark, "event_type", F.lit("/")).alias("line"))
    return X.stitch_records(lines, "user_id", "event_id", "line")


@query("x09_section", """
    SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title>(.*?)</title>') THEN regexp_extract(html, '(?is)<title>(.*?)</title>', 1) END AS title,
           CASE WHEN regexp_matches(html, '(?is)<h1>(.*?)</h1>') THEN regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1) END AS heading FROM pages""")
def _(t):
    return t.pages.select("page_id", X.section_between("html", "<title>", "</title>").alias("title"),
                          X.section_between("html", "<H1>", "</H1>").alias("heading"))


SCORES_SQL = """scores AS (SELECT vec_id, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) AS s FROM embeddings)"""


def query_vector(t):
    """The question's vector: one row, the driver may hold it."""
    return t.embeddings.filter("vec_id = 0").select("embedding").first()["embedding"]


@query("v01_cosine_threshold", f"WITH {SCORES_SQL} SELECT vec_id, label, ROUND(s, 4) AS similarity FROM scores WHERE s >= 0.1")
def _(t):
    hits = V.similar_rows(t.embeddings, "embedding", query_vector(t), 0.1)
    return hits.select("vec_id", "label", F.round("similarity", 4).alias("similarity")).orderBy(F.col("similarity").desc(), "vec_id")


@query("v02_top_k", f"WITH {SCORES_SQL} SELECT vec_id, ROUND(s, 4) AS similarity FROM scores WHERE s > 0 ORDER BY s DESC, vec_id LIMIT 10")
def _(t):
    best = V.top_k(t.embeddings.select("vec_id", "embedding"), "embedding", query_vector(t), 10, "vec_id")
    return best.select("vec_id", F.round("similarity", 4).alias("similarity"))


@query("v03_context_assembly", f"""
    WITH {SCORES_SQL}, best AS (SELECT vec_id, s, replace(text, chr(39), chr(39) || chr(39)) AS txt FROM scores JOIN documents ON doc_id = vec_id WHERE s > 0 ORDER BY s DESC, vec_id LIMIT 5)
    SELECT string_agg(txt, chr(10) ORDER BY s DESC, vec_id) AS context, string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY s DESC, vec_id) AS ids FROM best""")
def _(t):
    # Only ids and vectors are ranked; the k texts are fetched afterwards.
    embedded = t.embeddings.select("vec_id", "embedding").join(t.documents.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi")
    best = V.top_k(embedded, "embedding", query_vector(t), 5, "vec_id").select("vec_id", "similarity")
    texts = t.documents.select(F.col("doc_id").alias("vec_id"), "text")
    return V.assemble_context(texts.join(best, "vec_id"), "text", "vec_id")


@query("v04_batch_retrieval", """
    WITH q AS (SELECT label AS query_id, arg_min(CAST(embedding AS DOUBLE[]), vec_id) AS v FROM embeddings GROUP BY label),
    s AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS s FROM embeddings, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM s)
    SELECT query_id, vec_id, ROUND(s, 4) AS similarity, rank FROM r WHERE rank <= 5""")
def _(t):
    questions = t.embeddings.groupBy(F.col("label").cast("bigint").alias("label")).agg(F.min_by("embedding", "vec_id").alias("vector"))
    best = V.batch_top_k(t.embeddings, "vec_id", "embedding", questions, "label", "vector", 5)
    return best.withColumn("similarity", F.round("similarity", 4))
