"""Registered queries: personal data, tokenizer alignment, conversation trie."""

from __future__ import annotations

import public_tokenizers

from velotide.llm.alignment import align_tokenizers
from velotide.llm.common import table
from velotide.llm.pii import personal_data
from velotide.llm.prefix_trie import prefix_trie

QUERIES, ORACLE = {}, {}


def op11_pii(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


QUERIES["op11_pii"] = op11_pii


def op12_alignment(spark, sf_dir):
    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op12_alignment"] = op12_alignment


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"))


# DuckDB has no crc32: a byte goes into the register, eight steps of the reflected polynomial follow
_CRC_STEP = ("list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, "
             "xor(v, ascii(substr(c::VARCHAR, i + 1, 1))::BIGINT))")
OP13_SQL = f"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT c, 0 AS i, 4294967295::BIGINT AS v FROM ids
  UNION ALL SELECT c, i + 1, {_CRC_STEP} FROM crc WHERE i < length(c::VARCHAR)),
h AS (SELECT c, xor(v, 4294967295) % 9 AS h FROM crc WHERE i = length(c::VARCHAR)),
t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS name FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, sha256(name) AS token, octet_length(encode(text)) AS bytes,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(name)) AS pos FROM t),
r AS (SELECT h.c, 0 AS part, pos, token, bytes FROM h JOIN o ON o.c = h.c - h.c % 5 WHERE pos <= h
  UNION ALL SELECT h.c, 1, pos, token, bytes FROM h JOIN o ON o.c = h.c WHERE pos > h),
s AS (SELECT ids.c, coalesce(list(token ORDER BY part, pos) FILTER (token IS NOT NULL), []) AS ts,
    coalesce(list(bytes ORDER BY part, pos) FILTER (token IS NOT NULL), []) AS bs FROM ids LEFT JOIN r ON r.c = ids.c GROUP BY ids.c),
p AS (SELECT c, unnest(generate_series(0, len(ts))) AS d, ts, bs FROM s),
k AS (SELECT c, d, array_to_string(ts[1:d], ',') AS k, array_to_string(ts[1:d-1], ',') AS up, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS bytes, len(ts) = d AS ends FROM p),
n AS (SELECT d, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM k GROUP BY d, k),
m AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.up = n.k) AS n_children FROM n),
a AS (SELECT k.d, k.k, sum((m.n_convs - 1) * m.bytes) AS saved, count(*) FILTER (m.n_children = 0) AS leaves
  FROM m JOIN k ON k.c = m.conv_id AND k.d <= m.d GROUP BY k.d, k.k)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, a.leaves AS n_leaves,
  a.saved::BIGINT AS saved_tokens, m.ends_sha256
FROM m JOIN a ON a.d = m.d AND a.k = m.k LEFT JOIN m u ON u.d = m.d - 1 AND u.k = m.up
"""

QUERIES["op13_prefix_trie"] = op13_prefix_trie
ORACLE["op13_prefix_trie"] = OP13_SQL
