"""DuckDB statements of the queries that SQL can express."""

# The characters of [\x20\x09-\x0D] and A-Z, stated as text for trim() and translate().
_BLANK = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM parts
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, {_BLANK}), {_UPPER}, {_LOWER}) AS key FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# A turn is 12 + role + 1 + text + 10 + 1 code points; each escape adds one.
CHAT_TREE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length(regexp_extract_all(role, '[\\\n|]'))
                + length(text) + length(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def crc32(codes: str) -> str:
    """Unsigned CRC-32 of a list of byte values, bit by bit from the polynomial."""
    bits = (f"flatten(list_transform({codes}, lambda b: list_transform(range(8), lambda k: (b >> k::INT) & 1)))")
    return (f"xor(list_reduce({bits}, lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384) "
            f"ELSE c >> 1 END, 4294967295::BIGINT), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))

# Levels by recursion: three consecutive nodes become one. The fold walks every
# leaf up its tree, then its subroot up the tree of subroots.
MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, sha256({_HEAD} || {_field('text')}) AS leaf,
         CASE WHEN {crc32("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)")} % 2 = 0
              THEN sha256({_HEAD} || {_field("replace(text, chr(10), '')")}) END AS changed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n FROM leaves
), lv AS (
  SELECT source, 0 AS level, idx, leaf AS digest, n FROM placed
  UNION ALL
  SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 2) // 3)
  FROM lv WHERE n > 1 GROUP BY source, level, idx // 3
), subs AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM lv WHERE n = 1
), top AS (
  SELECT 0 AS level, idx, digest, n FROM subs
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 2) // 3)
  FROM top WHERE n > 1 GROUP BY level, idx // 3
), up AS (
  SELECT row_number() OVER () AS id, doc_id, source, leaf, 0 AS level, idx, n, coalesce(changed, leaf) AS cur, '' AS proof FROM placed
  UNION ALL
  SELECT u.id, any_value(u.doc_id), any_value(u.source), any_value(u.leaf), any_value(u.level) + 1, any_value(u.idx) // 3,
         any_value((u.n + 2) // 3), sha256(string_agg(CASE WHEN l.idx = u.idx THEN u.cur ELSE l.digest END, '' ORDER BY l.idx)),
         any_value(u.proof) || coalesce(string_agg(l.digest, '' ORDER BY l.idx) FILTER (WHERE l.idx <> u.idx), '')
  FROM up u JOIN lv l ON l.source IS NOT DISTINCT FROM u.source AND l.level = u.level AND l.idx // 3 = u.idx // 3
  WHERE u.n > 1 GROUP BY u.id
), over AS (
  SELECT u.id, u.doc_id, u.leaf, s.digest AS subroot, 0 AS level, s.idx, s.n, u.cur, u.proof
  FROM up u JOIN subs s ON s.source IS NOT DISTINCT FROM u.source WHERE u.n = 1
  UNION ALL
  SELECT u.id, any_value(u.doc_id), any_value(u.leaf), any_value(u.subroot), any_value(u.level) + 1, any_value(u.idx) // 3,
         any_value((u.n + 2) // 3), sha256(string_agg(CASE WHEN l.idx = u.idx THEN u.cur ELSE l.digest END, '' ORDER BY l.idx)),
         any_value(u.proof) || coalesce(string_agg(l.digest, '' ORDER BY l.idx) FILTER (WHERE l.idx <> u.idx), '')
  FROM over u JOIN top l ON l.level = u.level AND l.idx // 3 = u.idx // 3
  WHERE u.n > 1 GROUP BY u.id
)
SELECT o.doc_id, o.leaf, o.subroot, t.digest AS root, sha256(o.proof) AS proof_sha256, o.cur AS folded_root,
       o.cur = t.digest AS verified
FROM over o, (SELECT digest FROM top WHERE n = 1) t WHERE o.n = 1
"""

_UTF8 = ("list_transform(range(octet_length(encode({x}))), "
         "lambda i: ('0x' || substr(hex(encode({x})), (2 * i + 1)::INT, 2))::BIGINT)")

# Two words are near if leaving out the same place makes them equal, or leaving
# out one of the longer word's letters makes it the shorter.
SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, {_UPPER}, {_LOWER}), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, {crc32(_UTF8.format(x="coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h FROM runs
), vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, n
    FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cut c JOIN vocabulary v ON v.word = c.rest
  UNION SELECT v.word, c.word FROM cut c JOIN vocabulary v ON v.word = c.rest
), best AS (
  SELECT p.word, p.near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, p.near) AS place
  FROM pairs p JOIN vocabulary v ON v.word = p.near
), forms AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 5 * v.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 5 * v.n THEN b.near_n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON b.word = v.word AND b.place = 1
), walk AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT w.word, f.word, f.form FROM walk w JOIN forms f ON f.word = w.next
)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM forms f JOIN walk w ON w.word = f.word AND w.next IS NULL
"""
