"""DuckDB SQL of the queries that SQL can express, over the driver's tables."""

CHAT = """
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    regexp_replace(coalesce(text, ''), '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS content,
    regexp_replace(replace(replace(coalesce(role, ''), '\\', '\\\\'), chr(10), '\\n'), '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS head
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(length('<|turn|>') + length(head) + 1 + length(content) + length('<|end|>') + 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_SHARE = """
{name}_order AS (
  SELECT *, above - coalesce(sum(capacity) OVER before, 0) AS rest,
    sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER before, 0) AS heavy
  FROM {name}_nodes WINDOW before AS (PARTITION BY {parent} ORDER BY capacity // weight,
    (capacity % weight) / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), {name}_full AS (SELECT *, capacity * heavy <= rest * weight AS fits FROM {name}_order),
{name}_budget AS (
  SELECT {columns}, CASE WHEN fits THEN capacity ELSE weight * (above - coalesce(sum(CASE WHEN fits THEN capacity END)
    OVER (PARTITION BY {parent}), 0)) // sum(CASE WHEN fits THEN 0 ELSE weight END) OVER (PARTITION BY {parent}) END AS above
  FROM {name}_full
)"""


def _share(name: str, level: str, parent: str, columns: str) -> str:
    return _SHARE.format(name=name, level=level, parent=parent, columns=columns)


MIXING = f"""
WITH d AS (
  SELECT doc_id, text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS n_tokens,
    ['web', 'forum', 'books'][coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER), 0) % 3 + 1] AS domain
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens, CAST(sum(n_tokens) * 4 AS HUGEINT) AS capacity,
    CASE domain WHEN 'web' THEN 5 WHEN 'forum' THEN 3 WHEN 'books' THEN 2 ELSE 2 END AS domain_weight,
    CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 1 ELSE 2 END AS lang_weight,
    CASE source WHEN 'src0' THEN 1 ELSE 2 END AS source_weight
  FROM d WHERE n_tokens > 0 GROUP BY domain, lang, source
), top AS (SELECT least(sum(tokens) * 6 // 5, sum(capacity)) AS above FROM leaves),
domain_nodes AS (
  SELECT 0 AS root, domain, max(domain_weight) AS weight, sum(capacity) AS capacity, (SELECT above FROM top) AS above
  FROM leaves GROUP BY domain
), {_share("domain", "domain", "root", "domain")},
lang_nodes AS (
  SELECT domain, lang, max(lang_weight) AS weight, sum(capacity) AS capacity, any_value(above) AS above
  FROM leaves JOIN domain_budget USING (domain) GROUP BY domain, lang
), {_share("lang", "lang", "domain", "domain, lang")},
source_nodes AS (
  SELECT domain, lang, source, max(source_weight) AS weight, sum(capacity) AS capacity, any_value(above) AS above
  FROM leaves JOIN lang_budget USING (domain, lang) GROUP BY domain, lang, source
), {_share("source", "source", "domain, lang", "domain, lang, source")},
plan AS (
  SELECT domain, lang, source, above // tokens AS whole, above % tokens AS part
  FROM leaves JOIN source_budget USING (domain, lang, source)
), ranked AS (
  SELECT doc_id, domain, lang, source, n_tokens, whole, part,
    coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
      ORDER BY md5(concat_ws('|', '7', whole, coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(md5(text), ''))), doc_id NULLS FIRST, md5(text), n_tokens
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN plan USING (domain, lang, source) WHERE n_tokens > 0
), epochs AS (
  SELECT *, unnest(range(0, CAST(whole + CASE WHEN before < part THEN 1 ELSE 0 END AS BIGINT))) AS epoch FROM ranked
)
SELECT doc_id, domain, lang, source, CAST(epoch AS INTEGER) AS epoch, n_tokens,
  CAST(CASE WHEN epoch = whole THEN least(n_tokens, part - before) ELSE n_tokens END AS BIGINT) AS tokens_taken
FROM epochs
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first,
    list_reduce(list_transform(range(0, 40), lambda i: lpad(bin(instr('0123456789abcdef', hex[i + 1]) - 1), 4, '0')),
      lambda a, c: a || c) AS bits
  FROM p
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  list_reduce(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    1 + 16 * CAST(bits[5 * i + 1] AS BIGINT) + 8 * CAST(bits[5 * i + 2] AS BIGINT) + 4 * CAST(bits[5 * i + 3] AS BIGINT)
      + 2 * CAST(bits[5 * i + 4] AS BIGINT) + CAST(bits[5 * i + 5] AS BIGINT)]), lambda a, c: a || c) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

LINES = """
WITH l AS (
  SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT doc_id, text, lines, unnest(range(0, len(lines) - 2)) AS pos FROM l WHERE len(lines) >= 3
), f AS (
  SELECT doc_id, pos, lines[pos + 1 : pos + 3] AS win,
    row_number() OVER (PARTITION BY lines[pos + 1 : pos + 3] ORDER BY doc_id, pos) AS nth
  FROM w WHERE len(list_filter(lines[pos + 1 : pos + 3], lambda x: regexp_matches(x, '[^ \\t-\\r]'))) > 0
), gone AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM f WHERE nth > 1
), g AS (SELECT doc_id, list(pos) AS pos FROM gone GROUP BY doc_id)
SELECT d.doc_id,
  CASE WHEN g.pos IS NULL THEN d.text ELSE coalesce(array_to_string(list_filter(string_split(d.text, chr(10)),
    lambda x, i: NOT list_contains(g.pos, i - 1)), chr(10)), '') END AS text,
  CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS INTEGER) AS n_lines,
  CAST(coalesce(len(g.pos), 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN g USING (doc_id)
"""

SUBSTRINGS = """
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^ \\t-\\r]+'), []) AS words FROM documents),
w AS (
  SELECT doc_id, unnest(range(0, len(words) - 19)) AS pos,
    unnest(list_transform(range(0, len(words) - 19), lambda i: sha256(array_to_string(words[i + 1 : i + 20], ' ')))) AS win
  FROM d WHERE len(words) >= 20
), f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM w),
g AS (
  SELECT doc_id, list(DISTINCT word) AS gone
  FROM (SELECT doc_id, unnest(range(pos, pos + 20)) AS word FROM f WHERE nth > 1) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN words
    ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i - 1)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


def _crc32(number: str) -> str:
    """Unsigned CRC-32 of a whole number's decimal digits."""
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    byte = (
        "list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    )
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, b: {byte}), 4294967295)"


def _framed(*values: str) -> str:
    each = (f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values)
    return f"sha256({' || '.join(each)})"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('+' || lang, '-') AS tree, {_framed("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
    CASE WHEN {_crc32("doc_id")} % 3 = 0 THEN {_framed("doc_id", "source", "lang", "n_chars", _LOWER)}
      ELSE {_framed("doc_id", "source", "lang", "n_chars", "text")} END AS claimed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS idx
  FROM documents
), lower AS (
  SELECT tree, 0 AS level, idx, leaf AS digest FROM l
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM lower) WHERE n > 1 GROUP BY tree, level, idx // 8
), subroots AS (
  SELECT tree, arg_max(digest, level) AS subroot, max(level) AS top, row_number() OVER (ORDER BY tree <> '-', tree) - 1 AS idx
  FROM lower GROUP BY tree
), upper AS (
  SELECT 0 AS level, idx, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM upper) WHERE n > 1 GROUP BY level, idx // 8
), tops AS (SELECT max(level) AS top, arg_max(digest, level) AS root FROM upper),
nodes AS (
  SELECT tree, level AS step, lower.idx, digest FROM lower JOIN subroots s USING (tree) WHERE level < s.top
  UNION ALL SELECT '', level, idx, digest FROM upper, tops WHERE level < tops.top
), steps AS (
  SELECT tree, top, idx AS place, unnest(range(0, top + (SELECT top FROM tops))) AS step FROM subroots
), lift AS (
  SELECT l.doc_id, l.idx AS leaf_idx, l.tree, s.step, CASE WHEN s.step < s.top THEN l.tree ELSE '' END AS at_tree,
    CASE WHEN s.step < s.top THEN s.step ELSE s.step - s.top END AS at_step,
    CASE WHEN s.step < s.top THEN l.idx // CAST(8 ** s.step AS BIGINT) ELSE s.place // CAST(8 ** (s.step - s.top) AS BIGINT) END AS at
  FROM l JOIN steps s USING (tree)
), proofs AS (
  SELECT p.tree, p.leaf_idx, sha256(coalesce(string_agg(n.digest, '' ORDER BY p.step, n.idx), '')) AS proof
  FROM lift p LEFT JOIN nodes n ON n.tree = p.at_tree AND n.step = p.at_step AND n.idx // 8 = p.at // 8 AND n.idx <> p.at
  GROUP BY p.tree, p.leaf_idx
), fold AS (
  SELECT tree, idx AS leaf_idx, 0 AS step, claimed AS digest FROM l
  UNION ALL
  SELECT f.tree, f.leaf_idx, f.step + 1,
    sha256(string_agg(CASE WHEN n.idx = p.at THEN f.digest ELSE n.digest END, '' ORDER BY n.idx))
  FROM fold f JOIN lift p ON p.tree = f.tree AND p.leaf_idx = f.leaf_idx AND p.step = f.step
    JOIN nodes n ON n.tree = p.at_tree AND n.step = p.at_step AND n.idx // 8 = p.at // 8
  GROUP BY f.tree, f.leaf_idx, f.step
), folded AS (SELECT tree, leaf_idx, arg_max(digest, step) AS digest FROM fold GROUP BY tree, leaf_idx)
SELECT l.doc_id, l.leaf, s.subroot, tops.root, p.proof AS proof_sha256, f.digest AS folded_root,
  f.digest = tops.root AS verified
FROM l JOIN subroots s USING (tree) JOIN proofs p ON p.tree = l.tree AND p.leaf_idx = l.idx
  JOIN folded f ON f.tree = l.tree AND f.leaf_idx = l.idx, tops
"""

TRIE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS lender, {_crc32("conv_id")} % 4 AS take FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.lender WHERE t.place < c.take
  UNION ALL SELECT c.conv_id, 1, t.place, t.role, t.text FROM c JOIN t USING (conv_id) WHERE t.place >= c.take
), s AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY own, place) AS turns FROM r GROUP BY conv_id
  UNION ALL SELECT conv_id, [] FROM c WHERE conv_id NOT IN (SELECT conv_id FROM r)
), p AS (
  SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth,
    unnest(list_transform(range(0, len(turns) + 1), lambda d: turns[1 : d])) AS prefix
  FROM s
), nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(any_value(prefix[depth].text), '[^ \\t-\\r]+')) END AS words
  FROM p GROUP BY depth, prefix
), children AS (SELECT depth - 1 AS depth, prefix[1 : depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix
), under AS (
  SELECT unnest(range(0, depth + 1)) AS depth, unnest(list_transform(range(0, depth + 1), lambda d: prefix[1 : d])) AS prefix,
    CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * words AS saved
  FROM full_nodes
), sums AS (SELECT depth, prefix, sum(leaf) AS n_leaves, sum(saved) AS saved FROM under GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON s.depth = n.depth AND s.prefix = n.prefix
  LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.prefix = n.prefix[1 : n.depth - 1]
"""
