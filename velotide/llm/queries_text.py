"""Registered queries and oracle SQL: quality rules and line dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotide.llm.binary_codes import near_duplicates
from velotide.llm.common import table
from velotide.llm.line_dedup import line_dedup
from velotide.llm.paragraph_dedup import paragraph_dedup
from velotide.llm.parity_join import jaccard_components
from velotide.llm.quality_rules import RULES, STOP_WORDS, SYMBOLS, quality_rules
from velotide.llm.warc import round_trip

_W = r"[^\x20\x09-\x0D]+"


def op2_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


def _rule_sql(rule):
    _, top, bottom, low, high = rule
    parts = [f"{top} >= {float(low)}::DOUBLE * {bottom}"] if low is not None else []
    parts += [f"{top} <= {float(high)}::DOUBLE * {bottom}"] if high is not None else []
    return f"({bottom} = 0 OR ({' AND '.join(parts)}))"


_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP2_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, row_number() OVER () AS r FROM documents),
w AS (SELECT *, regexp_extract_all(x, '{_W}') AS ws,
             list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '{_W}')) AS ls FROM t),
g AS (SELECT r, i, list_aggregate(ws[i:i+4], 'string_agg', ' ') AS k
      FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM g) WHERE n > 1),
cover AS (SELECT r, count(DISTINCT i + j) AS n FROM again, (SELECT unnest([0,1,2,3,4]) AS j) GROUP BY r),
s AS (SELECT doc_id, len(ws) AS n_words, greatest(len(ws) - 50, 0) AS n_words_past_50, length(translate(x, {_SPACES}, '')) AS word_chars,
    length(x) - length(translate(x, '{SYMBOLS}', '')) AS n_symbols,
    length(x) - length(regexp_replace(x, '[A-Z]', '', 'g')) AS n_upper,
    length(x) - length(replace(x, '!', '')) AS n_exclamations,
    len(list_filter(ws, lambda v: lower(v) IN ({_STOP}))) AS n_stop_words,
    len(ls) AS n_text_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    len(list_filter(ls, lambda l: rtrim(l, ' ') LIKE '%...' OR rtrim(l, ' ') LIKE '%…')) AS n_ellipsis_lines,
    len(list_filter(ls, lambda l: ltrim(l, ' ') LIKE '- %' OR ltrim(l, ' ') LIKE '* %' OR ltrim(l, ' ') LIKE '•%')) AS n_bullet_lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cover c USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT *, concat_ws(',', {', '.join(f"CASE WHEN NOT {_rule_sql(r)} THEN '{r[0]}' END" for r in RULES)}) AS failed_rules,
  NOT base_failed AND {' AND '.join(map(_rule_sql, RULES))} AS kept FROM b
"""


def op5_line_dedup(spark, sf_dir):
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_ld_lines").alias("n_lines"), F.col("_ld_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_KEY = f"translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP5_SQL = f"""
WITH l AS (SELECT doc_id, pos, line, {_KEY} AS key FROM (
    SELECT doc_id, unnest(generate_series(1, len(a))) AS pos, unnest(a) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))),
o AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT doc_id, pos, line, coalesce(doc_id > first, false) AS gone FROM l LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

QUERIES = {"op2_quality_rules": op2_quality_rules, "op5_line_dedup": op5_line_dedup}
ORACLE = {"op2_quality_rules": OP2_SQL, "op5_line_dedup": OP5_SQL}


def op3_parity_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), 3, 90)


OP3_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(generate_series(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])
   WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(root) FROM r WHERE node = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""

QUERIES["op3_parity_join"] = op3_parity_join
ORACLE["op3_parity_join"] = OP3_SQL


def op4_warc(spark, sf_dir):
    return round_trip(spark, table(spark, sf_dir, "pages"))


OP4_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN o USING (payload_digest)
"""

QUERIES["op4_warc"] = op4_warc
ORACLE["op4_warc"] = OP4_SQL


def op10_substring_dedup(spark, sf_dir):
    """Per document its text without repeated passages, and what was taken out."""
    out = paragraph_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col("_pd_passages").alias("n_removed"), F.col("_pd_words").alias("removed_words"),
                      (F.col("_pd_passages") == 0).alias("unchanged"))


QUERIES["op10_substring_dedup"] = op10_substring_dedup


def op1_binary_codes(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(node, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
c AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT vec_id, (SELECT count(*) FROM l WHERE a = vec_id) AS n_links, c.root AS component_id, vec_id = c.root AS kept
FROM v JOIN c ON c.node = v.vec_id
"""

QUERIES["op1_binary_codes"] = op1_binary_codes
ORACLE["op1_binary_codes"] = OP1_SQL
