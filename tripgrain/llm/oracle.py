"""SQL counterparts for DuckDB of the queries that SQL can express whole."""

from __future__ import annotations

# CRC-32 of a list of bytes, with a table made by the checksum's rule.
CRC_TABLE = """crc_table AS (
            SELECT list(c ORDER BY k) AS crc FROM (
                SELECT k, list_reduce(list_prepend(k::BIGINT, range(8)::BIGINT[]), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) AS c
                FROM range(256) numbers(k)))"""


def crc32_of(text: str) -> str:
    """Needs `crc_table` among the tables of the query."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, x: xor(c >> 8, crc[xor(c & 255, x) + 1])), 4294967295)"


OP11 = r"""
        WITH texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents
        ), words AS (
            SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM texts
        ), failed AS (
            SELECT doc_id, part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
                + 4 * (100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 5 * length(body))::INT
                + 8 * regexp_matches(body, '[#$%&*|]')::INT
                + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), FALSE)::INT AS mask
            FROM words
        ), known AS (
            SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
        ), masks AS (
            SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
            FROM failed LEFT JOIN known USING (doc_id) GROUP BY part, mask
        ), filters(letter, bit) AS (
            VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
        ), orders AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
            FROM filters a, filters b, filters c, filters d, filters e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
        ), removal AS (
            SELECT mask, filter_order, coalesce(min(instr(filter_order, letter)) FILTER ((mask & bit) > 0), 6) AS removed_at
            FROM range(32) all_masks(mask), orders, filters GROUP BY mask, filter_order
        ), steps AS (
            SELECT filter_order, letter, bit, instr(filter_order, letter) AS step FROM orders, filters
        ), counts AS (
            SELECT part, filter_order, step, letter, sum(CASE WHEN removed_at > step THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN removed_at = step THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN (mask & bit) > 0 AND removed_at < step THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN removed_at = step THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN removed_at = step THEN toxic ELSE 0 END) AS toxic_lost
            FROM masks JOIN removal USING (mask) JOIN steps USING (filter_order) GROUP BY part, filter_order, step, letter
        )
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
            unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
            (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
        FROM counts"""

OP12 = f"""
        WITH {CRC_TABLE}, draws AS (
            SELECT doc_id, shard, -1.0 / ln((('0x' || left(md5(coalesce(doc_id::VARCHAR, '') || ':' || shard), 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS draw
            FROM documents, range(17) shards(shard)
        ), dealt AS (
            SELECT doc_id, arg_max(shard, draw) FILTER (shard < 16) AS shard, arg_max(shard, draw) AS grown_shard FROM draws GROUP BY doc_id
        )
        SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {crc32_of("coalesce(text, '')")}::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
            row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard::INT AS grown_shard
        FROM documents JOIN dealt USING (doc_id), crc_table"""

OP13 = rf"""
        WITH {CRC_TABLE}, bodies AS (
            SELECT 'd' AS kind, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark
        ), words AS (
            SELECT kind, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM bodies
        ), features AS (
            SELECT kind, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words
        ), buckets AS (
            SELECT feature, {crc32_of("feature")} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM features), crc_table
        ), used AS (
            SELECT kind, doc_id, bucket, count(*) AS n FROM features JOIN buckets USING (feature) GROUP BY ALL
        ), counts AS (
            SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 't'), 0) AS t FROM used GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts
        ), sums AS (
            SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS gain FROM used JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id
        ), weighed AS (
            SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
                CASE WHEN n_features > 0 THEN (gain - ((gain % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight,
                ('0x' || left(sha256('7:' || doc_id), 8))::BIGINT AS h
            FROM words LEFT JOIN sums USING (doc_id) WHERE kind = 'd'
        ), scored AS (
            SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20
        )
        SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
            CASE WHEN rank <= (SELECT 25 * count(*) // 100 FROM ranked) THEN rank END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)"""

ORACLE = {"op11_filter_audit": OP11, "op12_sharding": OP12, "op13_resampling": OP13}
