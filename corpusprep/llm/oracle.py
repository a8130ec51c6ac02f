"""DuckDB SQL for the queries that SQL can express."""


def _classes(links: str, nodes: str, key: str) -> str:
    """Smallest node reachable by ``links`` (x, y), both directions given, for each of ``nodes``."""
    return f"""reached AS (
          SELECT {key} AS x, {key} AS y FROM {nodes}
          UNION SELECT r.x, l.y FROM reached r JOIN {links} l ON l.x = r.y),
        classes AS (SELECT x AS {key}, min(y) AS component_id FROM reached GROUP BY x)"""


ORACLE = {
    "op3_embeddings": f"""
        WITH RECURSIVE v AS (
          SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
          WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        {_classes('links', 'embeddings', 'vec_id')}
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM classes LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x) USING (vec_id)
    """,
    "op7_minhash_forest": rf"""
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[ 	-
]+'), lambda w: w <> '') AS w FROM documents),
        sets AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
          FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        pairs AS (
          SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
        links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
        {_classes('links', 'documents', 'doc_id')}
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM classes LEFT JOIN sizes USING (doc_id)
    """,
    "op10_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        WINDOW g AS (PARTITION BY norm)
    """,
    # The checksum is made bit by bit; the dynamic program keeps the cheapest and then least edits by last role.
    "op11_turn_repair": r"""
        WITH RECURSIVE read AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
        sums AS (
          SELECT k, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: unicode(c)::BIGINT)),
                          lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]),
                            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS fault
          FROM (SELECT DISTINCT k FROM read)),
        damaged AS (
          SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
                 CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
          FROM read JOIN sums USING (k)),
        numbered AS (
          SELECT conv_id, turn, role, text, left(role, 1) AS initial,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM damaged),
        faulty AS (
          SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
                 lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM numbered),
        counted AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(i) AS n, count(*) FILTER (fault = 'blank') AS blank,
                 count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (illegal) AS illegal
          FROM faulty GROUP BY conv_id),
        reach(state, target, inserted) AS (VALUES
          ('-', NULL, NULL), ('s', NULL, NULL), ('u', NULL, NULL), ('a', NULL, NULL), ('-', 's', NULL), ('-', 'u', NULL), ('s', 'u', NULL),
          ('a', 'u', NULL), ('u', 'u', 'assistant:'), ('u', 'a', NULL), ('-', 'a', 'user:'), ('s', 'a', 'user:'), ('a', 'a', 'user:')),
        walk AS (
          SELECT DISTINCT conv_id, 0::BIGINT AS i, '-' AS state, {'cost': 0, 'edits': '', 'lines': []::VARCHAR[]} AS best FROM conversations
          UNION ALL
          SELECT w.conv_id, w.i + 1, coalesce(r.target, r.state),
                 min(CASE WHEN r.target IS NULL THEN {'cost': w.best.cost + 2, 'edits': w.best.edits || 'D', 'lines': w.best.lines}
                          ELSE {'cost': w.best.cost + (r.target <> f.initial)::INT + 5 * (r.inserted IS NOT NULL)::INT + 5 * (f.fault = 'truncated')::INT,
                                'edits': w.best.edits || CASE WHEN r.inserted IS NULL THEN '' ELSE 'I' END || CASE WHEN r.target = f.initial THEN 'K' ELSE 'R' END,
                                'lines': w.best.lines || CASE WHEN r.inserted IS NULL THEN []::VARCHAR[] ELSE [r.inserted] END
                                  || [CASE WHEN r.target = f.initial THEN f.role WHEN r.target = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text]} END)
          FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN reach r ON r.state = w.state
          WHERE r.target IS NULL OR (f.fault NOT IN ('blank', 'duplicate') AND (r.target = f.initial OR r.target <> 's'))
          GROUP BY ALL),
        ended AS (
          SELECT w.conv_id, min(CASE state WHEN 'u' THEN {'cost': best.cost + 5, 'edits': best.edits || 'I', 'lines': best.lines || ['assistant:']}
                                         WHEN 's' THEN {'cost': best.cost + 10, 'edits': best.edits || 'II', 'lines': best.lines || ['user:', 'assistant:']}
                                         ELSE best END) AS best
          FROM walk w LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.i = coalesce(c.n, 0) GROUP BY w.conv_id)
        SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, best.edits AS audit,
               sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
        FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
    "op13_fill_in_middle": r"""
        WITH units AS (
          SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                 sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        drawn AS (
          SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
                 ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d FROM units),
        cut AS (
          SELECT doc_id, text, n, array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
                 array_to_string(u[greatest(a, b) + 1:], '') AS suffix,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 100 THEN 'plain'
                      WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM cut
    """,
}
