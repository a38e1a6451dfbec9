"""SQL that must give the same rows as the registered queries, where SQL can say them (DuckDB's dialect)."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


OP1 = f"""
    WITH docs AS (SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
    windows AS (
        SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS seq
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM docs WHERE len(words) >= 20)
    ),
    later AS (
        SELECT doc_id, s FROM (
            SELECT doc_id, s, row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) AS nth FROM windows
        ) WHERE nth > 1
    ),
    covered AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later),
    placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
    kept AS (
        SELECT p.doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
        FROM placed p LEFT JOIN covered c USING (doc_id, i) WHERE c.doc_id IS NULL GROUP BY p.doc_id
    )
    SELECT d.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM docs d LEFT JOIN kept k USING (doc_id)
"""

OP5 = f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS words FROM documents
    ),
    grams AS (
        SELECT DISTINCT doc_id, array_to_string(words[s : s + 4], ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS s FROM docs WHERE len(words) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM grams a JOIN grams b USING (gram) JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
    ),
    reach(id, to_id) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT id, b FROM reach JOIN links ON to_id = a
    ),
    labels AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id),
    partners AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
    FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN partners p ON p.a = d.doc_id JOIN labels l ON l.id = d.doc_id
"""

OP6 = rf"""
    WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text, {_words("coalesce(text, '')")} AS words FROM documents),
    windows AS (
        SELECT doc_id, s, array_to_string(words[s : s + 2], ' ') AS seq
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS s FROM docs WHERE len(words) >= 3)
    ),
    twice AS (SELECT doc_id, s FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, seq) > 1),
    repeats AS (
        SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(s, s + 3)) FROM twice) GROUP BY doc_id
    ),
    lines AS (
        SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    ),
    copies AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
    base AS (
        SELECT d.doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(c.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
               len(words) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(words) AS base_failed
        FROM docs d LEFT JOIN copies c USING (doc_id) LEFT JOIN repeats r USING (doc_id)
    ),
    hosts AS (
        SELECT source AS host, count(*) AS host_rows, count(*) FILTER (base_failed) AS host_failed FROM base GROUP BY source
    ),
    sums AS (
        SELECT count(*) - 1 AS within, sum(host_rows)::DOUBLE AS n, sum(host_failed)::DOUBLE / sum(host_rows) AS mean,
               sum(host_rows::DOUBLE * host_rows) AS squares, sum(host_failed::DOUBLE * host_failed / host_rows) AS rates
        FROM hosts
    ),
    prior AS (
        SELECT mean, (rates - n * mean * mean) / (mean * (1 - mean)) - within AS between_, n - squares / n - within AS weight
        FROM sums WHERE mean > 0 AND mean < 1
    ),
    strength AS (
        SELECT (SELECT mean FROM sums) AS mean,
               (SELECT greatest(weight / between_ - 1, 1) FROM prior WHERE between_ > 0 AND weight > 0) AS rows_
    )
    SELECT b.*, host_rows, host_failed,
           NOT base_failed AND CASE WHEN rows_ IS NULL THEN mean ELSE (host_failed + rows_ * mean) / (host_rows + rows_) END <= 0.5 AS kept
    FROM base b JOIN hosts h ON b.source IS NOT DISTINCT FROM h.host, strength
"""

# The checksum CRC-32 of a number's digits, bit by bit; 3988292384 is its polynomial (fixed values).
_CRC32 = """
    xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda sum, c: list_reduce(
            list_concat([xor(sum, c)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
        )
    ), 4294967295)
"""

OP13 = f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
        ) - 1 AS p
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    ids AS (
        SELECT conv_id, count(*) AS n, {_CRC32.format("conv_id")} % 6 AS h, conv_id - conv_id % 100 AS base
        FROM turns GROUP BY conv_id
    ),
    built AS (
        SELECT i.conv_id, p + 1 AS d, role, text FROM ids i JOIN turns t ON t.conv_id = base WHERE p < h
        UNION ALL
        SELECT i.conv_id, p - i.h + least(coalesce(b.n, 0), i.h) + 1, role, text
        FROM ids i JOIN turns t ON t.conv_id = i.conv_id LEFT JOIN ids b ON b.conv_id = i.base WHERE p >= i.h
    ),
    paths AS (
        SELECT conv_id, d, length(text) AS chars,
               sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (
                   PARTITION BY conv_id ORDER BY d
               )) AS node
        FROM built
        UNION ALL SELECT conv_id, 0, 0, 'root' FROM ids
    ),
    nodes AS (
        SELECT node, d, count(*) AS n_convs, min(conv_id) AS conv_id, any_value(chars) AS chars FROM paths GROUP BY node, d
    ),
    parents AS (
        SELECT n.node, p.node AS parent FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.d = n.d - 1
    ),
    families AS (SELECT parent AS node, count(*) AS n_children FROM parents GROUP BY parent),
    below AS (
        SELECT p.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved
        FROM nodes u JOIN paths p ON p.conv_id = u.conv_id AND p.d <= u.d LEFT JOIN families f ON f.node = u.node
        GROUP BY p.node
    ),
    ends AS (
        SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
        FROM (SELECT conv_id, arg_max(node, d) AS node FROM paths GROUP BY conv_id) GROUP BY node
    )
    SELECT n.conv_id, n.d::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
           n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes n JOIN below USING (node) LEFT JOIN parents p USING (node) LEFT JOIN nodes q ON q.node = p.parent
    LEFT JOIN families f ON f.node = n.node LEFT JOIN ends e ON e.node = n.node
"""

ORACLES = {"op1_substring_dedup": OP1, "op5_ngram_jaccard": OP5, "op6_quality_rules": OP6, "op13_conversation_trie": OP13}
