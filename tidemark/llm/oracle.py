"""SQL for another engine whose results some queries must equal."""

# Components by handing on the smallest id until nothing changes.
OP1_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e,
        label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
    FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE a.usable AND b.usable AND len(a.e) = len(b.e)
        AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT vec_id AS node, vec_id AS other FROM v
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), component AS (
    SELECT node, min(other) AS component_id FROM reach GROUP BY node
), counts AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id,
    v.vec_id = c.component_id AS kept, 1.0::DOUBLE AS recall
FROM v JOIN component c ON c.node = v.vec_id LEFT JOIN counts n ON n.a = v.vec_id
"""

OP3_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(
        CASE WHEN len(w) = 0 THEN []
            WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END
        ) AS s
    FROM words
), tokens AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
    SELECT doc_id AS node, doc_id AS other FROM sets
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), component AS (
    SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id
FROM sets s JOIN component c ON c.node = s.doc_id
"""

# CRC-32 by a table of 256 remainders, the text taken byte by byte; jump hashing by
# one recursion step for each jump.
OP5_SQL = """
WITH RECURSIVE remainders AS (
    SELECT i AS byte, 0 AS step, i::BIGINT AS value FROM range(256) t(i)
    UNION ALL
    SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END
    FROM remainders WHERE step < 8
), crc_table AS (
    SELECT list(value ORDER BY byte) AS t FROM remainders WHERE step = 8
), texts AS (
    SELECT DISTINCT x FROM (
        SELECT coalesce(text, '') AS x FROM documents
        UNION ALL SELECT coalesce(doc_id, 0)::VARCHAR FROM documents)
), checksums AS (
    SELECT x, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(
            regexp_extract_all(hex(encode(x)), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda crc, byte: xor(crc >> 8, t[xor(crc & 255, byte) + 1]))) AS crc
    FROM texts, crc_table
), sizes AS (
    SELECT 16 AS shards UNION ALL SELECT 17
), jumps AS (
    SELECT DISTINCT coalesce(doc_id, 0) AS k, shards, 0::BIGINT AS shard, 0::BIGINT AS ahead,
        ((coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616)::UBIGINT AS state
    FROM documents, sizes
    UNION ALL
    SELECT k, shards, ahead, floor((ahead + 1)::DOUBLE * (2147483648::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT, next
    FROM (
        SELECT *, ((((state % 4294967296)::HUGEINT * 2862933555777941757 + 1)
            + ((state >> 32)::HUGEINT * 2862933555777941757 % 4294967296) * 4294967296)
            % 18446744073709551616)::UBIGINT AS next
        FROM jumps WHERE ahead < shards)
), placed AS (
    SELECT k, max(shard) FILTER (shards = 16) AS shard, max(shard) FILTER (shards = 17) AS grown
    FROM jumps GROUP BY k
), rows_ AS (
    SELECT d.doc_id, strlen(coalesce(d.text, '')) + 1 AS size, c.crc, p.shard, p.grown,
        i.crc % 1024 AS slice
    FROM documents d JOIN placed p ON p.k = coalesce(d.doc_id, 0)
    JOIN checksums c ON c.x = coalesce(d.text, '')
    JOIN checksums i ON i.x = coalesce(d.doc_id, 0)::VARCHAR
)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id, crc, size) - 1 AS slot,
    grown::INTEGER AS grown_shard
FROM rows_
"""

# Every anchor against every row.
OP12_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), negatives AS (
    SELECT p.*, s.other_id AS negative_id, s.score AS negative_score, row_number() OVER (
        PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 5
"""

# Every phrase of one to five words written out and counted.
OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, k AS size, unnest(list_transform(
        range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, range(1, 6) t(k)
    WHERE len(w) >= k
), f AS (
    SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND f >= 100
), inner_phrases AS (
    SELECT lang, a, unnest(list_transform(
        range(1, size - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM candidates, range(2, 5) t(k)
    WHERE k < size
), covered AS (
    SELECT lang, phrase, max(a) AS held_by FROM inner_phrases GROUP BY lang, phrase
), kept AS (
    SELECT c.* FROM candidates c LEFT JOIN covered h ON h.lang = c.lang AND h.phrase = c.phrase
    WHERE h.held_by IS NULL OR 100 * h.held_by < 100 * c.a
), cuts AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
        ((1000::HUGEINT * c.a::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT))::BIGINT AS score
    FROM kept c, range(1, 5) t(k)
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.size], ' ')
    JOIN totals m ON m.lang = c.lang
    WHERE k < c.size
), lowest AS (
    SELECT * FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
    phrase, a, l, r, n, score
FROM lowest
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000
"""

ORACLE_SQL = {
    "op1_robust_graph_links": OP1_SQL,
    "op3_ngram_join": OP3_SQL,
    "op5_jump_sharding": OP5_SQL,
    "op12_bit_plane_negatives": OP12_SQL,
    "op13_top_order_phrases": OP13_SQL,
}
