"""DuckDB statements of the queries that SQL can express, written independently of the operators."""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

AUDIT = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, {WORDS.format('t')} AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
f AS (SELECT part, doc_id,
  CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
n AS (SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, letter, n, good, toxic, fails,
  contains(fails, letter) AS here, length(translate(left(filter_order, step - 1), fails, '')) = step - 1 AS alive FROM n, s),
a AS (SELECT part, filter_order, step, letter,
  CAST(sum(CASE WHEN alive AND NOT here THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN alive AND here THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN here AND NOT alive THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN alive AND here AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN alive AND here AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
 CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM a"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _runs(table: str, key: str) -> str:
    """All runs of one to three words, one row each, with the number of the text."""
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""(SELECT n, id, ws, list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
  list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS runs
 FROM (SELECT row_number() OVER () AS n, {key} AS id, {words} AS ws FROM {table}))"""


# crc32 by a table of 256 entries, made from the polynomial, over the bytes of the text's hexadecimal form.
IMPORTANCE = f"""
WITH poly AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
   lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS tab),
d AS {_runs('documents', 'doc_id')}, b AS {_runs('benchmark', 'item_id')},
df AS (SELECT n, unnest(runs) AS f FROM d), bf AS (SELECT unnest(runs) AS f FROM b),
u AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
y AS (SELECT f, list_transform(range(len(h) // 2), lambda i: (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16
   + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1) AS bytes FROM u),
k AS (SELECT f, xor(list_reduce(bytes, lambda c, x: xor(c // 256, tab[xor(c % 256, x) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM y, poly),
s AS (SELECT bucket, count(*) AS s FROM df JOIN k USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN k USING (f) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)
   / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)))) AS gain FROM s FULL JOIN t USING (bucket)),
w AS (SELECT n, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM df JOIN k USING (f) JOIN g USING (bucket) GROUP BY n),
h AS (SELECT d.n, id AS doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  CAST('0x' || left(sha256('42:' || coalesce(CAST(id AS VARCHAR), '')), 8) AS BIGINT) AS h FROM d LEFT JOIN w ON d.n = w.n),
c AS (SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM h),
r AS (SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank FROM c WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * 5 // 100 FROM c WHERE n_words >= 20) THEN rank END AS rank
FROM c LEFT JOIN r ON c.n = r.n"""

# Products of whole numbers, exact in double precision below 2^53.
TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""

SIMILAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 3 THEN [ws] ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2]) END)
  AS gram FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT node, b FROM r JOIN e ON other = a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM w LEFT JOIN n USING (doc_id)
 JOIN (SELECT node AS doc_id, min(other) AS component_id FROM r GROUP BY node) USING (doc_id)"""

STATEMENTS: dict[str, str] = {"op6_mtree_top_k": TOP_K, "op10_ngram_jaccard_join": SIMILAR, "op11_filter_audit": AUDIT,
                              "op12_importance_resampling": IMPORTANCE}
