"""DuckDB SQL for the queries that SQL can express."""

OP6 = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), places AS (
  SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w
), grams AS (
  SELECT r, i, words[i:i + 4] AS g FROM places
), twice AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) AS s(k) GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM w
), line_counts AS (
  SELECT r, count(*) AS n, count(DISTINCT line) AS d FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum([length(x) FOR x IN words]), 0)::BIGINT AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(replace(text, '!', '')) AS n_excl,
         coalesce(l.n, 0) AS n_lines, coalesce(l.n - l.d, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         len([x FOR x IN words IF list_contains(string_split('STOP', ' '), x)]) AS n_stop
  FROM w LEFT JOIN line_counts l USING (r) LEFT JOIN covered c USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND word_chars BETWEEN 2 * n_words AND 15 * n_words
         AND 100 * n_symbols <= 10 * n_words AND 100 * n_excl <= 30 * n_words
         AND 100 * n_dup_lines <= 40 * n_lines
         AND (n_words < 40 OR 100 * n_stop >= 2 * n_words) AS kept
FROM m
"""

_CRC = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], [ord(c)::BIGINT FOR c IN string_split({0}, '')]), lambda x, b:"
    " list_reduce(list_concat([xor(x, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z:"
    " xor(y >> 1, (y & 1) * 3988292384))), 4294967295)"
)
_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_FIELDS = " || ".join(_FIELD.format(name) for name in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP13 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, sha256({_FIELDS} || {_FIELD.format("text")}) AS leaf,
         CASE WHEN {_CRC.format("doc_id::VARCHAR")} % 3 = 0
              THEN sha256({_FIELDS} || {_FIELD.format(_LOWER)}) ELSE sha256({_FIELDS} || {_FIELD.format("text")}) END AS tampered
  FROM documents
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves
), nodes(tree, level, pos, hash) AS (
  SELECT tree, 0, pos, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1
  GROUP BY tree, level, pos // 8
), heights AS (
  SELECT tree, max(level) AS height FROM nodes GROUP BY tree
), subroots AS (
  SELECT tree, height, hash FROM nodes JOIN heights USING (tree) WHERE level = height
), upper_nodes(level, pos, hash) AS (
  SELECT 0, tree, hash FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM upper_nodes) WHERE n > 1
  GROUP BY level, pos // 8
), top AS (
  SELECT level AS height, hash AS root FROM upper_nodes ORDER BY level DESC LIMIT 1
), climb(doc_id, leaf, tree, level, pos, hash, proof) AS (
  SELECT doc_id, leaf, tree, 0, pos, tampered, '' FROM placed
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, c.level + 1, c.pos // 8,
         sha256(string_agg(CASE WHEN n.pos = c.pos THEN c.hash ELSE n.hash END, '' ORDER BY n.pos)),
         c.proof || coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (n.pos <> c.pos), '')
  FROM climb c JOIN heights h USING (tree) JOIN nodes n ON n.tree = c.tree AND n.level = c.level AND n.pos // 8 = c.pos // 8
  WHERE c.level < h.height
  GROUP BY c.doc_id, c.leaf, c.tree, c.level, c.pos, c.hash, c.proof
), done AS (
  SELECT c.doc_id, c.leaf, c.tree, c.hash, c.proof, s.hash AS subroot
  FROM climb c JOIN subroots s ON s.tree = c.tree AND s.height = c.level
), rise(doc_id, leaf, tree, subroot, level, pos, hash, proof) AS (
  SELECT doc_id, leaf, tree, subroot, 0, tree, hash, proof FROM done
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, c.subroot, c.level + 1, c.pos // 8,
         sha256(string_agg(CASE WHEN n.pos = c.pos THEN c.hash ELSE n.hash END, '' ORDER BY n.pos)),
         c.proof || coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (n.pos <> c.pos), '')
  FROM rise c JOIN upper_nodes n ON n.level = c.level AND n.pos // 8 = c.pos // 8
  WHERE c.level < (SELECT height FROM top)
  GROUP BY c.doc_id, c.leaf, c.tree, c.subroot, c.level, c.pos, c.hash, c.proof
)
SELECT r.doc_id, r.leaf, r.subroot, t.root, sha256(r.proof) AS proof_sha256,
       r.hash AS folded_root, r.hash = t.root AS verified
FROM rise r JOIN top t ON r.level = t.height
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP11 = f"""
WITH bags AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents
), lengths AS (
  SELECT r, doc_id, len(terms)::BIGINT AS n FROM bags WHERE len(terms) > 0
), corpus AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths
), counted AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM bags) GROUP BY r, term
), spread AS (
  SELECT term, count(*) AS df FROM counted GROUP BY term
), asked AS (
  SELECT DISTINCT i, item_id, unnest(terms) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark)
), scored AS (
  SELECT a.i, a.item_id, c.r, l.doc_id,
         sum(floor(1000 * ln((2 * k.docs + 2) / (2 * s.df + 1)))::BIGINT
             * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 90 + (90 * l.n * k.docs) // k.length))))::BIGINT AS score
  FROM asked a JOIN counted c USING (term) JOIN spread s USING (term) JOIN lengths l USING (r), corpus k
  GROUP BY a.i, a.item_id, c.r, l.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
