"""Query op11: the prefix trie of conversations."""

from __future__ import annotations

from valuelens.llm.prefix_trie import trie
from valuelens.llm.tables import register, table

_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))))"""


@register("op11_prefix_trie", rf"""
WITH o AS (SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS u,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, list(u ORDER BY pos) AS turns FROM o GROUP BY conv_id),
h AS (SELECT *, {_CRC.format("conv_id")} % 4 AS h FROM t),
s AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS s FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, d, s[1:d] AS pre, d = len(s) AS ended FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM s)),
n AS (SELECT pre, d, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended) AS ids FROM m GROUP BY pre, d),
k AS (SELECT pre[1:d - 1] AS up, count(*) AS n_children FROM n WHERE d > 0 GROUP BY up),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(pre[d].t, '[^\x20\x09-\x0D]+')) END AS saved FROM n LEFT JOIN k ON k.up = n.pre),
a AS (SELECT pre[1:e] AS top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
      FROM (SELECT pre, saved, n_children, unnest(range(0, d + 1)) AS e FROM v) GROUP BY top)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves,
       CAST(a.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(v.ids, '')) AS ends_sha256
FROM v JOIN a ON a.top = v.pre LEFT JOIN n p ON v.d > 0 AND p.d = v.d - 1 AND p.pre = v.pre[1:v.d - 1]
""")
def op11_prefix_trie(spark, sf_dir):
    return trie(table(spark, sf_dir, "conversations"))
