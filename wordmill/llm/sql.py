"""DuckDB SQL of the operators that SQL can express."""

# The Poisson distribution of each source as a table of cumulative probabilities.
MIXING_SQL = """
WITH counts AS (SELECT source, count(*) AS n, count(*)::DOUBLE ** 0.7 AS w FROM documents GROUP BY source),
rates AS (
  SELECT source, w / (SELECT sum(w) FROM counts) * (SELECT sum(n) FROM counts) / n AS rate FROM counts
),
steps AS (
  SELECT source, sum(exp(j * ln(rate) - rate - lgamma(j + 1))) OVER (PARTITION BY source ORDER BY j) AS cdf
  FROM rates, generate_series(0, 150) AS s(j)
),
drawn AS (
  SELECT *, ('0x' || substr(md5('42:draw:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents
),
counted AS (
  SELECT d.*, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.cdf <= d.u) AS k
  FROM drawn d
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
  ('0x' || substr(md5('42:order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR), 1, 13))::BIGINT
    AS shuffle_key
FROM (SELECT *, unnest(generate_series(0, k - 1)) AS copy FROM counted WHERE k > 0)
"""

TOP_K_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""


def _least(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"


def _way(origin: str, cost: str, edit: str, line: str | None = None, when: str = "true") -> str:
    """The way ``origin`` with one more edit, and one more repaired row."""
    text = f"{origin}.t" if line is None else f"coalesce({origin}.t || chr(10), '') || {line}"
    return f"CASE WHEN {origin} IS NOT NULL AND {when} THEN {{'c': {origin}.c + {cost}, 'a': {origin}.a || '{edit}', 't': {text}}} END"


# A way is its cost, its edits and the repaired rows; w0 to w3 are the least ones before anything is kept, after the
# system turn, after a user turn and after an assistant turn. Inserted turns follow in a second step.
_GROUND = "{'c': 0::BIGINT, 'a': '', 't': NULL::VARCHAR}"
_INSERT_USER = ", ".join(_way(f"w{k}", "3", "I", "'user:'") for k in (0, 1, 3))
_INSERT_ASSISTANT = _way("u", "3", "I", "'assistant:'")
_KEPT = "d.role || ':' || d.text"
_TO_USER = ", ".join(
    _way(f"p.w{k}", "d.extra", "K", _KEPT, "d.fault AND d.initial = 'u'") + ", " + _way(f"p.w{k}", "3 + d.extra", "R", "'user:' || d.text", "d.fault")
    for k in (0, 1, 3)
)
_TO_ASSISTANT = (
    _way("p.w2", "d.extra", "K", _KEPT, "d.fault AND d.initial = 'a'") + ", " + _way("p.w2", "3 + d.extra", "R", "'assistant:' || d.text", "d.fault")
)

REPAIR_SQL = f"""
WITH RECURSIVE filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
),
hashed AS (
  SELECT *, xor(list_reduce(
    list_transform(generate_series(1, length(key)), lambda i: ascii(key[i])::BIGINT),
    lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
    4294967295::BIGINT), 4294967295::BIGINT) % 20 AS damage
  FROM filled
),
copied AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE damage WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE damage <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+$', '') AS trimmed
  FROM copied
),
judged AS (
  SELECT *, trimmed = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, left(role, 1) AS initial,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
),
d AS (
  SELECT *, NOT blank AND NOT again AS fault, CASE WHEN right(trimmed, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS extra FROM judged
),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, {_GROUND} AS w0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS w1,
    {{'c': 3::BIGINT, 'a': 'I', 't': 'user:'}} AS w2, {{'c': 6::BIGINT, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}} AS w3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, w0, w1, u, {_least("w3", _INSERT_ASSISTANT)} AS w3 FROM (
    SELECT *, {_least("w2", _INSERT_USER)} AS u FROM (
      SELECT p.conv_id, d.i, {_way("p.w0", "4", "D")} AS w0,
        {_least(_way("p.w1", "4", "D"), _way("p.w0", "d.extra", "K", _KEPT, "d.fault AND d.initial = 's'"))} AS w1,
        {_least(_way("p.w2", "4", "D"), _TO_USER)} AS w2, {_least(_way("p.w3", "4", "D"), _TO_ASSISTANT)} AS w3
      FROM ways p JOIN d ON d.conv_id IS NOT DISTINCT FROM p.conv_id AND d.i = p.i + 1
    )
  )
),
chosen AS (
  SELECT conv_id, {_least("w0", "w3")} AS w FROM ways
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (fault AND extra > 0) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM d GROUP BY conv_id
)
SELECT w.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, w.w.c AS cost, w.w.a AS audit,
  sha256(coalesce(w.w.t, '')) AS repaired_sha256
FROM chosen w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
"""

TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
hashed AS (
  SELECT *, sha256(length(role)::VARCHAR || ':' || role || text)[:32] AS digest, octet_length(encode(text)) AS size FROM turns
),
convs AS (
  SELECT conv_id, list({'d': digest, 'n': size} ORDER BY turn NULLS FIRST, role, digest) AS t, conv_id::VARCHAR AS key
  FROM hashed GROUP BY conv_id
),
dealt AS (
  SELECT conv_id, t, xor(list_reduce(
    list_transform(generate_series(1, length(key)), lambda i: ascii(key[i])::BIGINT),
    lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
    4294967295::BIGINT), 4294967295::BIGINT) % 9 AS h
  FROM convs
),
rebuilt AS (
  SELECT c.conv_id, CASE WHEN b.t IS NULL THEN c.t[h + 1:] ELSE list_concat(b.t[:h], c.t[h + 1:]) END AS p
  FROM dealt c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5
),
placed AS (
  SELECT conv_id, len(p) AS n, d, list_transform(p[:d], lambda x: x.d) AS key, CASE WHEN d = 0 THEN 0 ELSE p[d].n END AS size
  FROM rebuilt, unnest(generate_series(0, len(p))) AS u(d)
),
nodes AS (
  SELECT key, d AS depth, key[:d - 1] AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM placed GROUP BY key, d
),
children AS (SELECT parent AS key, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent, depth),
own AS (SELECT o.*, coalesce(c.n, 0) AS n_children FROM nodes o LEFT JOIN children c USING (key, depth)),
below AS (
  SELECT key[:d] AS key, d AS depth, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM own, unnest(generate_series(0, depth)) AS u(d) GROUP BY key[:d], d
)
SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, b.n_leaves::BIGINT AS n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN below b USING (key, depth) LEFT JOIN nodes p ON p.key = o.parent AND p.depth = o.depth - 1
"""
