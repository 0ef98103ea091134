"""DuckDB SQL for the rows of those corpus queries that SQL can express and finish on whole tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# All pairs that chains of `link` (a, b) connect, for `node` (id).
_REACHED = """reached(id, other) AS (
  SELECT id, id FROM node UNION SELECT reached.id, link.b FROM reached JOIN link ON link.a = reached.other)"""

# One row with the checksum's table: entry i is what eight steps make of i.
_CRC_STEPS = """crc_steps(i, step, v) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) AS t(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM crc_steps WHERE step < 8),
crc_table AS (SELECT list(v ORDER BY i) AS entry FROM crc_steps WHERE step = 8)"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8, in a query that reads crc_table."""
    size, digits = f"octet_length(encode({text}))", f"hex(encode({text}))"
    read = f"list_transform(range({size}), lambda k: ('0x' || substr({digits}, 2 * k + 1, 2))::UBIGINT)"
    step = "xor(s >> 8, entry[(xor(s, x) & 255)::INT + 1])"
    return f"xor(list_reduce({read}, lambda s, x: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


OP1 = rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id != y.doc_id GROUP BY x.doc_id, y.doc_id),
link AS (
  SELECT a, b FROM shared o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * o.n >= 85 * (x.n + y.n - o.n)),
node AS (SELECT doc_id AS id FROM documents), {_REACHED},
least_ids AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least_ids ON id = d.doc_id"""

OP3 = f"""WITH RECURSIVE vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors
  WHERE label IS NOT NULL AND len(v) > 0 AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN v IF x != 0]) > 0),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id != y.vec_id
  WHERE list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.98),
node AS (SELECT vec_id AS id FROM embeddings), {_REACHED},
least_ids AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id),
degrees AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least_ids ON id = vec_id LEFT JOIN degrees ON a = vec_id"""

OP12 = f"""WITH RECURSIVE {_CRC_STEPS},
runs AS (
  SELECT concat(doc_id) AS doc, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
per_doc AS (SELECT doc, run, doc || ':' || run AS mark, count(*) AS k FROM runs GROUP BY doc, run),
hashed AS (SELECT run, k, {_crc32("mark")} AS h FROM per_doc, crc_table),
spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k
  FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
places AS (SELECT word, unnest(range(length(word))) AS i FROM words),
cuts AS (SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM places),
near AS (
  SELECT x.word AS word, y.word AS other FROM cuts x JOIN cuts y ON x.i = y.i AND x.rest = y.rest AND x.word != y.word
  UNION SELECT cuts.word, words.word FROM cuts JOIN words ON cuts.rest = words.word
  UNION SELECT words.word, cuts.word FROM cuts JOIN words ON cuts.rest = words.word),
ranked AS (
  SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place
  FROM near JOIN words ON words.word = other),
forms AS (
  SELECT w.word, CASE WHEN r.n >= 2 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
chains(word, last) AS (
  SELECT word, word FROM forms UNION ALL SELECT chains.word, form FROM chains JOIN forms ON forms.word = last WHERE form IS NOT NULL)
SELECT forms.word, forms.form, tips.last AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN (SELECT chains.word, last FROM chains JOIN forms ON forms.word = last WHERE form IS NULL) tips ON tips.word = forms.word"""

OP13 = f"""WITH RECURSIVE {_CRC_STEPS},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS mark FROM turns),
convs AS (SELECT conv_id, conv_id - (conv_id % 5 + 5) % 5 AS head, ({_crc32("mark")} % 9)::BIGINT AS h FROM ids, crc_table),
rebuilt AS (
  SELECT c.conv_id, place, role, text FROM convs c JOIN turns t ON t.conv_id = head AND place <= h
  UNION ALL SELECT c.conv_id, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h),
numbered AS (
  SELECT conv_id, row_number() OVER along AS depth, octet_length(encode(text)) AS size,
         list({{'role': role, 'text': text}}) OVER along AS prefix
  FROM rebuilt WINDOW along AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)),
prefixes AS (
  SELECT conv_id, depth, size, prefix FROM numbered
  UNION ALL SELECT conv_id, 0, 0, [] FROM convs),
members AS (
  SELECT conv_id, depth, size, min(conv_id) OVER (PARTITION BY depth, prefix) AS node, depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM prefixes),
nodes AS (
  SELECT depth, node, any_value(size) AS size, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY depth, node),
parents AS (
  SELECT n.depth, n.node, m.node AS parent FROM nodes n JOIN members m ON m.conv_id = n.node AND m.depth = n.depth - 1),
children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM parents GROUP BY depth, parent),
tree AS (
  SELECT nodes.depth, nodes.node, size, n_convs, ends_sha256, parent, coalesce(n, 0) AS n_children
  FROM nodes LEFT JOIN parents USING (depth, node) LEFT JOIN children USING (depth, node)),
totals AS (
  SELECT m.depth, m.node, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * t.size)::BIGINT AS saved_tokens
  FROM tree t JOIN members m ON m.conv_id = t.node AND m.depth <= t.depth GROUP BY m.depth, m.node)
SELECT node AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM tree JOIN totals USING (depth, node)"""

SQL = {
    "op1_ngram_jaccard_join": OP1,
    "op3_embedding_near_duplicates": OP3,
    "op12_spelling_variants": OP12,
    "op13_prefix_trie": OP13,
}
