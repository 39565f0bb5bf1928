"""SQL for the queries that SQL can express."""

_BLANKS = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

REPEATS = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_BLANKS}'), []) AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS g
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d WHERE len(words) >= 13)),
f AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g),
r AS (SELECT DISTINCT doc_id, p FROM (
      SELECT doc_id, unnest(range(i, i + 13)) AS p FROM w JOIN f USING (g) WHERE doc_id > least)),
x AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d),
k AS (SELECT x.doc_id, count(r.p) AS n_removed,
             coalesce(array_to_string(list(word ORDER BY x.p) FILTER (r.p IS NULL), ' '), '') AS kept
      FROM x LEFT JOIN r ON x.doc_id = r.doc_id AND x.p = r.p GROUP BY x.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_ALNUM}'), []) AS words
           FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_ALNUM}'), []) AS words
      FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS g
       FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
n AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, n WHERE len(words) >= n)),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, array_to_string(list(item ORDER BY item), ',') AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


def _rounds(count: int) -> str:
    """Each round takes what fits into the remainder, up to the first document that does not."""
    return ",\n".join(f"""a{i} AS (SELECT *, NOT done AND size <= remain AND sum(CASE WHEN NOT done AND size <= remain THEN size ELSE 0 END)
        OVER (PARTITION BY source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) <= remain AS new FROM r{i - 1}),
r{i} AS (SELECT * EXCLUDE (new) REPLACE (remain - sum(CASE WHEN new THEN size ELSE 0 END) OVER (PARTITION BY source) AS remain,
        done OR new AS done) FROM a{i})""" for i in range(1, count + 1))


MIX = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(coalesce(regexp_extract_all(text, '{_BLANKS}'), []))::BIGINT AS size,
                            md5('7:' || coalesce(doc_id::VARCHAR, ''))[1:16] AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
      FROM d GROUP BY source),
r AS (SELECT *, 3 * size AS cap, sum(size) OVER () AS total,
             coalesce(sum(3 * size) OVER (ORDER BY 3.0 * size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(weight) OVER (ORDER BY 3.0 * size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight,
             row_number() OVER (ORDER BY 3.0 * size / weight, source NULLS LAST) AS k FROM s),
f AS (SELECT min(k) AS k FROM r WHERE cap::HUGEINT * left_weight > weight::HUGEINT * (total - held)),
e AS (SELECT (total - held)::DOUBLE AS rest, left_weight::DOUBLE AS weights FROM r WHERE k = (SELECT k FROM f)),
t AS (SELECT source, size AS source_size, CASE WHEN k < (SELECT k FROM f) THEN cap::DOUBLE
             ELSE weight * (SELECT rest FROM e) / (SELECT weights FROM e) END AS target FROM r),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS n_whole FROM t),
r0 AS (SELECT d.*, p.source_size, p.target, n_whole, target - n_whole * source_size AS remain, false AS done
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
{_rounds(4)}
SELECT doc_id, size, source_size, target, (size * (n_whole + done::BIGINT))::BIGINT AS taken FROM r4
"""

TOP_K = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS f FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND coalesce(list_bool_and([x IS NOT NULL AND isfinite(x::DOUBLE) FOR x IN embedding]), true)),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.f, c.f)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def _record(text: str) -> str:
    parts = [f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


#: crc32 is 32 steps of a shift register over each byte; the leaf of the changed text is folded level by level.
MERKLE = f"""
WITH RECURSIVE c AS (SELECT *, doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT,
         [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]), lambda a, b: list_reduce(
         [xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, e: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 2 = 0 AS hit
       FROM documents),
l AS (SELECT doc_id, source IS NULL AS none, source, {_record('text')} AS leaf,
             CASE WHEN hit THEN {_record("replace(text, chr(10), '')")} ELSE {_record('text')} END AS changed FROM c),
p AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS width,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
n AS (SELECT tree, 0 AS level, pos, width, leaf AS digest FROM p
      UNION ALL
      SELECT tree, level + 1, pos // 3, (width + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM n
      WHERE width > 1 GROUP BY tree, level, pos // 3, width),
s AS (SELECT tree, digest AS subroot FROM n WHERE width = 1),
t AS (SELECT 0 AS level, tree AS pos, count(*) OVER () AS width, subroot AS digest FROM s
      UNION ALL
      SELECT level + 1, pos // 3, (width + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM t
      WHERE width > 1 GROUP BY level, pos // 3, width),
runs AS (SELECT tree, level, pos // 3 AS parent, width, list(digest ORDER BY pos) AS kids FROM n WHERE width > 1 GROUP BY ALL
         UNION ALL
         SELECT -1, level, pos // 3, width, list(digest ORDER BY pos) FROM t WHERE width > 1 GROUP BY ALL),
f AS (SELECT tree AS own, tree, 0 AS level, pos AS start, pos, width, changed AS now, '' AS siblings, false AS last FROM p
      UNION ALL
      SELECT f.own, CASE WHEN f.width = 1 THEN -1 ELSE f.tree END, CASE WHEN f.width = 1 THEN 0 ELSE f.level + 1 END, f.start,
             CASE WHEN f.width = 1 THEN f.own ELSE f.pos // 3 END,
             CASE WHEN f.width = 1 THEN (SELECT count(*) FROM s) ELSE (f.width + 2) // 3 END,
             CASE WHEN f.width = 1 THEN f.now ELSE sha256(array_to_string(
               [CASE WHEN i - 1 = f.pos % 3 THEN f.now ELSE kids[i] END FOR i IN range(1, len(kids) + 1)], '')) END,
             CASE WHEN f.width = 1 THEN f.siblings ELSE f.siblings || array_to_string(
               [kids[i] FOR i IN range(1, len(kids) + 1) IF i - 1 <> f.pos % 3], '') END,
             f.width = 1 AND f.tree = -1
      FROM f LEFT JOIN runs r ON r.tree = f.tree AND r.level = f.level AND r.parent = f.pos // 3 AND f.width > 1
      WHERE NOT f.last)
SELECT doc_id, leaf, subroot, (SELECT digest FROM t WHERE width = 1) AS root, sha256(f.siblings) AS proof_sha256,
       f.now AS folded_root, f.now = (SELECT digest FROM t WHERE width = 1) AS verified
FROM p JOIN s USING (tree) JOIN f ON f.own = p.tree AND f.start = p.pos AND f.last
"""
