"""DuckDB SQL for the queries that SQL can express on whole tables; the others are tested against
brute force."""

from tillbook.llm.licenses import CUE, LICENSE_FILE, TEMPLATES, THRESHOLD

TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

TOOL_CALLS = """
WITH users AS (
    SELECT DISTINCT conv_id, turn, text FROM conversations WHERE role = 'user'
), answers AS (
    SELECT conv_id, turn - 1 AS asked, turn, min(text) AS text FROM conversations WHERE role = 'assistant' GROUP BY ALL
), calls AS (
    SELECT *, EXISTS (FROM users b WHERE b.conv_id = u.conv_id AND b.turn = u.turn - 2) AS follows FROM users u
)
SELECT u.conv_id, u.turn::VARCHAR AS call_id, u.turn, 'respond' AS name,
       CASE WHEN a.turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status, a.turn AS result_turn, u.turn AS after_turn, 0 AS step,
       CASE WHEN u.text IS NULL THEN 'missing prompt' ELSE '' END AS errors,
       concat('{"arguments":{', CASE WHEN follows THEN '"after":"$' || (u.turn - 2) || '"' END,
              CASE WHEN follows AND u.text IS NOT NULL THEN ',' END, '"prompt":' || to_json(u.text)::VARCHAR, '},"id":"', u.turn,
              '","name":"respond"', ',"result":' || to_json(a.text)::VARCHAR, '}') AS json
FROM calls u LEFT JOIN answers a ON a.conv_id = u.conv_id AND a.asked = u.turn
UNION ALL
SELECT a.conv_id, a.asked::VARCHAR, a.turn, NULL, 'orphan', a.turn, NULL, NULL, '',
       concat('{"id":"', a.asked, '"', ',"result":' || to_json(a.text)::VARCHAR, '}')
FROM answers a WHERE NOT EXISTS (FROM users u WHERE u.conv_id = a.conv_id AND u.turn = a.asked)
"""

_TOKENS = "list_filter(list_transform(regexp_split_to_array(lower({}), '[^a-z0-9.]+'), lambda w: trim(w, '.')), lambda w: w <> '')"

LICENSES = f"""
WITH known(license, text) AS (VALUES {", ".join(f"('{license}', '{text}')" for license, text in TEMPLATES)}),
files AS (
    SELECT doc_id, text, concat(source, '/', doc_id // 1000,
        CASE WHEN doc_id % 100 < 5 THEN '/LICENSE.' || doc_id WHEN doc_id % 100 < 10 THEN '/' || (doc_id // 100 % 10) || '/LICENSE.' || doc_id
             ELSE '/' || (doc_id // 100 % 10) || '/' || doc_id || '.txt' END) AS path
    FROM documents
), named AS (
    SELECT doc_id, path, text, array_to_string(string_split(path, '/')[:-2], '/') AS directory,
           regexp_matches(string_split(path, '/')[-1], '{LICENSE_FILE}') AS is_license
    FROM files
), lines AS (
    SELECT doc_id, path, directory, is_license,
           unnest(list_distinct(list_concat(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(lower(x), '{CUE}')),
                                            CASE WHEN is_license THEN [text] ELSE [] END))) AS passage
    FROM named WHERE text IS NOT NULL
), distinct_passages AS (SELECT passage, count(*) AS n FROM lines GROUP BY passage),
texts AS (SELECT passage, n FROM distinct_passages UNION ALL SELECT text, 1 FROM known),
total AS (SELECT sum(n) AS total FROM texts),
frequency AS (
    SELECT token, ln((any_value(total) + 1) / (sum(n) + 1)) + 1 AS idf
    FROM (SELECT n, unnest(list_distinct({_TOKENS.format("passage")})) AS token FROM texts), total GROUP BY token
), vectors AS (
    SELECT passage, token, count(*) * any_value(idf) AS w
    FROM (SELECT passage, unnest({_TOKENS.format("passage")}) AS token FROM distinct_passages) JOIN frequency USING (token) GROUP BY passage, token
), sides AS (
    SELECT license, text, token, count(*) * any_value(idf) AS w
    FROM (SELECT license, text, unnest({_TOKENS.format("text")}) AS token FROM known) JOIN frequency USING (token) GROUP BY license, text, token
), scored AS (
    SELECT passage, license, round(sum(v.w * s.w) / (any_value(l.length) * any_value(t.length)), 6) AS score
    FROM vectors v JOIN sides s USING (token)
    JOIN (SELECT passage, sqrt(sum(w * w)) AS length FROM vectors GROUP BY passage) l USING (passage)
    JOIN (SELECT license, text, sqrt(sum(w * w)) AS length FROM sides GROUP BY license, text) t USING (license, text)
    GROUP BY passage, license, text
), own AS (
    SELECT doc_id, path, directory, is_license, license, score FROM lines JOIN scored USING (passage) WHERE score >= {THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY score DESC, license) = 1
), directories AS (
    SELECT directory, license FROM own WHERE is_license
    QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, path) = 1
), near AS (
    SELECT f.directory AS folder, d.directory, d.license
    FROM (SELECT DISTINCT directory FROM named) f JOIN directories d ON f.directory = d.directory OR starts_with(f.directory, d.directory || '/')
    QUALIFY row_number() OVER (PARTITION BY f.directory ORDER BY length(d.directory) DESC) = 1
)
SELECT n.doc_id, n.path, o.license AS own_license, o.score AS own_score, coalesce(o.license, near.license) AS license,
       CASE WHEN o.license IS NULL THEN near.directory END AS inherited_from
FROM named n LEFT JOIN own o USING (doc_id, path) LEFT JOIN near ON near.folder = n.directory
"""

def _crc32(column: str) -> str:
    """Unsigned crc32 of a number in decimals."""
    bits = "list_reduce(list_prepend(xor(crc, code), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({column}::VARCHAR, ''), lambda c: unicode(c)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), lambda crc, code: {bits}))"


PREFIX_TRIE = f"""
WITH RECURSIVE own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), chats AS (
    SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {_crc32("conv_id")} % 9 AS taken FROM own
), rebuilt AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth
    FROM (SELECT c.conv_id, 0 AS part, o.pos, o.role, o.text FROM chats c JOIN own o ON o.conv_id = c.base AND o.pos < c.taken
          UNION ALL SELECT c.conv_id, 1, o.pos, o.role, o.text FROM chats c JOIN own o ON o.conv_id = c.conv_id AND o.pos >= c.taken)
), prefixes(conv_id, depth, key, parent, bytes) AS (
    SELECT conv_id, 0::BIGINT, '', NULL::VARCHAR, 0::BIGINT FROM chats
    UNION ALL
    SELECT r.conv_id, r.depth, sha256(concat(p.key, '/', strlen(r.role), ':', r.role, r.text)), p.key, strlen(r.text)
    FROM prefixes p JOIN rebuilt r ON r.conv_id = p.conv_id AND r.depth = p.depth + 1
), nodes AS (
    SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(bytes) AS bytes FROM prefixes GROUP BY depth, key
), children AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
known AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children, (c.n IS NULL)::BIGINT AS leaf, (n_convs - 1) * bytes AS saved
    FROM nodes n LEFT JOIN children c USING (depth, key)
), totals AS (
    SELECT p.depth, p.key, sum(k.leaf)::BIGINT AS n_leaves, sum(k.saved)::BIGINT AS saved_tokens
    FROM known k JOIN prefixes p ON p.conv_id = k.conv_id AND p.depth <= k.depth GROUP BY ALL
), ends AS (
    SELECT depth, key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM (SELECT conv_id, depth, key FROM prefixes QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY ALL
)
SELECT k.conv_id, k.depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, t.n_leaves, t.saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM known k JOIN totals t USING (depth, key) LEFT JOIN ends e USING (depth, key) LEFT JOIN nodes u ON u.depth = k.depth - 1 AND u.key = k.parent
"""


def _leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(concat(" + ", ".join(f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields) + "))"


def _tree(name: str, base: str) -> str:
    """All levels of the trees over ``base`` (g, pos, node)."""
    return f"""{name}(g, level, pos, node, alone) AS (
    SELECT g, 0, pos, node, max(pos) OVER (PARTITION BY g) = 0 FROM {base}
    UNION ALL
    SELECT g, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), max(pos // 2) OVER (PARTITION BY g) = 0
    FROM {name} WHERE NOT alone GROUP BY g, level, pos // 2
)"""


def _siblings(rows: str, tree: str, up: int) -> str:
    """For each of ``rows`` and each level it is hashed at: L or R and the sibling's digest, N if it has none."""
    return f"""SELECT r.row, {up} + t.level AS step, CASE WHEN s.node IS NULL THEN 'N' WHEN s.pos < t.pos THEN 'L' || s.node ELSE 'R' || s.node END AS entry
    FROM {rows} r JOIN {tree} t ON t.g = r.g AND NOT t.alone AND t.pos = r.pos >> t.level
    LEFT JOIN {tree} s ON s.g = t.g AND s.level = t.level AND s.pos = xor(t.pos, 1)"""


MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, CASE WHEN {_crc32("doc_id")} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS other FROM documents
), ranked AS (
    SELECT *, row_number() OVER () AS row, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS node
    FROM leaves
), {_tree("tree", "ranked")}, subroots AS (SELECT 0 AS g, g AS pos, node FROM tree WHERE alone),
{_tree("top", "subroots")}, above AS (SELECT row, 0 AS g, g AS pos FROM ranked), entries AS (
    {_siblings("ranked", "tree", 0)} UNION ALL {_siblings("above", "top", 1000)}
), paths AS (SELECT row, list(entry ORDER BY step) AS path FROM entries GROUP BY row),
folded AS (
    SELECT doc_id, leaf, s.node AS subroot, t.node AS root, coalesce(path, []) AS path,
           list_reduce(list_prepend(coalesce(other, leaf), coalesce(path, [])), lambda node, e:
               sha256(CASE e[1] WHEN 'L' THEN e[2:] || node WHEN 'R' THEN node || e[2:] ELSE node END)) AS folded_root
    FROM ranked r JOIN subroots s ON s.pos = r.g JOIN top t ON t.alone LEFT JOIN paths USING (row)
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda e: e[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
marked AS (SELECT *, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS target FROM payloads)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(digest, (k // 4 * 5 + 1)::BIGINT, 5))::INTEGER >> (15 - 5 * (k % 4))::INTEGER) & 31), 1)), '') AS payload_digest,
       CASE WHEN target IS NULL OR page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN target END AS refers_to
FROM marked
"""

SQL: dict[str, str] = {
    "op1_exact_top_k": TOP_K,
    "op7_tool_call_linking": TOOL_CALLS,
    "op10_license_scan": LICENSES,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_merkle_manifest": MERKLE,
    "op13_warc_round_trip": WARC,
}
