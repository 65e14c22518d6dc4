"""SQL counterparts of the operator queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_SPLIT = r"([<\[])(/?s>|\|turn\|>|\|end\|>|/?INST\]|</?SYS>>)"


def _escaped(column: str) -> str:
    return rf"regexp_replace(replace({column}, '\', '\\'), '{_SPLIT}', '\1\\\2', 'g')"


ORACLE: dict[str, str] = {
    "op1_chat_format": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        )
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || txt || chr(10), '' ORDER BY turn NULLS FIRST, role, txt)) AS turns_sha256,
               CAST(coalesce(sum(length(txt)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(txt, '' ORDER BY turn NULLS FIRST, txt) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(7 + sum(8 + length(replace({_escaped("role")}, chr(10), '\\' || chr(10))) + 1
                   + length({_escaped("txt")}) + 7) AS BIGINT) AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "op6_cross_polytope": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
        ),
        reach AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(vec_id, least.b), vec_id) AS component_id,
               coalesce(least(vec_id, least.b), vec_id) = vec_id AS kept
        FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
    """,
    "op7_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ),
        sets AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id
            GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)
        ),
        reach AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(documents.doc_id, least.b), documents.doc_id) AS component_id,
               coalesce(least(documents.doc_id, least.b), documents.doc_id) = documents.doc_id AS kept
        FROM documents LEFT JOIN sizes ON sizes.doc_id = documents.doc_id LEFT JOIN least ON least.a = documents.doc_id
    """,
    "op9_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scores QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
    """,
    "op13_conversation_trie": f"""
        WITH crc AS (
            -- Bit by bit: a byte goes in at the first of its eight steps.
            SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
                string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(unicode(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
                lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384))) AS h
            FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
        ),
        own AS (
            SELECT conv_id, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, r, t) AS turns
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations)
            WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        rebuilt AS (
            SELECT o.conv_id, list_concat(coalesce(b.turns[1 : h % 4], []), coalesce(o.turns[h % 4 + 1 :], [])) AS turns
            FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
        ),
        prefixes AS (
            SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
        ),
        members AS (SELECT conv_id, n, depth, turns[1 : depth] AS prefix FROM prefixes),
        nodes AS (
            SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends,
                   CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(prefix[depth].t, '{_WORD}')) END AS words
            FROM members GROUP BY prefix, depth
        ),
        children AS (SELECT prefix[1 : depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
        full_ AS (
            SELECT nodes.*, coalesce(c.n, 0) AS n_children FROM nodes LEFT JOIN children c USING (prefix)
        ),
        up AS (
            SELECT prefix, n_convs, words, n_children, unnest(range(0, depth + 1)) AS above FROM full_
        ),
        below AS (
            SELECT prefix[1 : above] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
                   CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens FROM up GROUP BY 1
        )
        SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves,
               b.saved_tokens, sha256(f.ends) AS ends_sha256
        FROM full_ f JOIN below b ON b.prefix = f.prefix
        LEFT JOIN full_ p ON f.depth > 0 AND p.prefix = f.prefix[1 : f.depth - 1]
    """,
}
