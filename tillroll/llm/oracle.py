"""DuckDB SQL for the text operators that SQL can express."""

import corpus_pipeline

_FOLD = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         "'abcdefghijklmnopqrstuvwxyz')")

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents),
g AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS tokens,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, 3 * tokens AS cap, sum(tokens) OVER () AS t_all, sum(w) OVER () AS w_all,
         coalesce(sum(3 * tokens) OVER b, 0) AS cap_b, coalesce(sum(w) OVER b, 0) AS w_b
  FROM g
  WINDOW b AS (ORDER BY 3 * tokens / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (
  SELECT *, cap < w * (CAST(t_all - cap_b AS DOUBLE) / (w_all - w_b)) AS capped FROM o),
t AS (
  SELECT source, tokens, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
         w * (CAST(t_all - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS DOUBLE)
              / nullif(sum(CASE WHEN capped THEN 0 ELSE w END) OVER (), 0)) END AS target
  FROM c),
n AS (
  SELECT *, least(CAST(round(round(target, 4)) AS BIGINT), 3 * tokens) AS want,
         CASE WHEN tokens > 0 THEN least(CAST(round(round(target, 4)) AS BIGINT), 3 * tokens) // tokens
              ELSE 0 END AS base
  FROM t),
p AS (
  SELECT d.doc_id, d.size, n.tokens, n.target, n.base,
         greatest(0, least(d.size, n.want - n.base * n.tokens - coalesce(sum(d.size) OVER (
           PARTITION BY d.source ORDER BY d.place, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS part
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, tokens AS source_size, target,
       CAST(base * size + part AS BIGINT) AS taken,
       CAST(base + CASE WHEN size > 0 AND part = size THEN 1 ELSE 0 END AS BIGINT) AS copies,
       CAST(CASE WHEN part = size THEN 0 ELSE part END AS BIGINT) AS part
FROM p
"""

OP9 = f"""
WITH d AS (SELECT doc_id, sha256({_FOLD}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""


OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""

OP8 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(
           range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS sh
  FROM d),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS sh FROM s),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM s
  UNION
  SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other)
SELECT s.doc_id, CAST(len(any_value(s.sh)) AS BIGINT) AS n_shingles,
       min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id
"""


# crc32 by the usual table, on the bytes of runs of characters below U+0100
OP11 = rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda t, x:
           CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END) ORDER BY i) AS tab
  FROM range(256) AS r(i)),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_FOLD}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
coded AS (
  SELECT run, n, flatten(list_transform(
           string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c:
           CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), 128 + (unicode(c) & 63)] END)) AS b
  FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda acc, x:
           xor(acc >> 8, tab[(xor(acc, x) & 255) + 1]))) AS h
  FROM coded, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                       ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
skips AS (
  SELECT word, n, i, left(word, i) AS pre, substr(word, i + 2) AS suf
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM skips a JOIN skips b USING (i, pre, suf) WHERE a.word <> b.word
  UNION SELECT s.word, v.word, v.n FROM skips s JOIN words v ON v.word = s.pre || s.suf
  UNION SELECT v.word, s.word, s.n FROM skips s JOIN words v ON v.word = s.pre || s.suf),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(m := -other_n, w := other)) AS b
  FROM near GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -b.m >= 2 * n THEN b.w END AS form, CASE WHEN -b.m >= 2 * n THEN -b.m END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS here, 0 AS step FROM forms
  UNION ALL
  SELECT w.word, f.form, step + 1 FROM walk w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM forms JOIN (SELECT word, arg_max(here, step) AS root FROM walk GROUP BY word) USING (word)
"""

_OP12_ROUND = """a{r} AS (
  SELECT v.id, min(struct_pack(d := CAST(list_inner_product(v.f, v.f) - 2 * list_inner_product(v.f, c.f)
                                         + list_inner_product(c.f, c.f) AS BIGINT), c := c.c)) AS m
  FROM v, c{r} AS c GROUP BY v.id),
"""
_OP12_MEANS = """s{r} AS (
  SELECT c, i, (s - ((s % n) + n) % n) // n AS mean
  FROM (SELECT a.m.c AS c, i, CAST(sum(v.e[i]) AS BIGINT) AS s, count(*) AS n
        FROM a{r} a JOIN v USING (id), range(1, 65) AS r(i) GROUP BY ALL)),
c{next} AS (
  SELECT c.c, coalesce(t.e, c.e) AS e, list_transform(coalesce(t.e, c.e), lambda x: CAST(x AS DOUBLE)) AS f
  FROM c{r} c LEFT JOIN (SELECT c, list(mean ORDER BY i) AS e FROM s{r} GROUP BY c) t USING (c)),
"""

OP12 = """
WITH v AS (
  SELECT row_number() OVER () AS id, vec_id, e, list_transform(e, lambda x: CAST(x AS DOUBLE)) AS f
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) = 64
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, e) - 1 AS c, e, f FROM v
  QUALIFY c < 16),
""" + "".join(_OP12_ROUND.format(r=r) + _OP12_MEANS.format(r=r, next=r + 1) for r in range(3)) \
    + _OP12_ROUND.format(r=3) + """t AS (
  SELECT m.c AS c, CAST(sum(m.d) AS BIGINT) AS cluster_inertia, count(*) AS cluster_size FROM a3 GROUP BY ALL)
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, cluster_inertia,
       CAST((SELECT sum(m.d) FROM a3) AS BIGINT) AS inertia,
       sha256(array_to_string(c3.e, ',')) AS centroid_sha256, cluster_size
FROM a3 JOIN v USING (id) JOIN c3 ON c3.c = m.c JOIN t ON t.c = m.c
"""


def oracle_sql() -> dict[str, str]:
    sql = {"op1_mixing": OP1, "op6_topk": OP6, "op8_near_dedup": OP8,
           "op9_exact_dedup": OP9, "op11_spelling_variants": OP11, "op12_clustering": OP12}
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
