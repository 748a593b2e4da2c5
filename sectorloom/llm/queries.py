"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import new_folder
from . import (
    bpe,
    decontaminate,
    fingerprints,
    html_extract,
    lang_id,
    lexical,
    near_dup,
    quality,
    resampling,
    sharding,
    token_output,
    url_filter,
    va_file,
)
from .common import table


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op1_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.listing(table(spark, sf_dir, "documents"), new_folder(spark, "tokens"))


def op2_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op4_block_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op6_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.top_k(table(spark, sf_dir, "embeddings"))


def op9_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op10_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_simple8b": op1_simple8b,
    "op2_redirect_equivalence": op2_redirect_equivalence,
    "op3_recursive_bpe": op3_recursive_bpe,
    "op4_block_tree": op4_block_tree,
    "op5_language_bitmask": op5_language_bitmask,
    "op6_vector_approximation": op6_vector_approximation,
    "op7_ordinal_quality": op7_ordinal_quality,
    "op8_stratified_interleaving": op8_stratified_interleaving,
    "op9_weighted_sampling": op9_weighted_sampling,
    "op10_simhash_windows": op10_simhash_windows,
    "op11_one_permutation": op11_one_permutation,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_presence_masks": op13_presence_masks,
}

# The checksum polynomial of CRC-32, reflected.
_CRC32 = """
    crc_table AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
            FROM range(256) r(i)
        )
    )"""
_CRC32_OF_TEXT = """
    xor(4294967295::UBIGINT, list_reduce(
        [4294967295::UBIGINT] || [('0x' || hex[2 * i - 1 : 2 * i])::UBIGINT FOR i IN range(1, len(hex) // 2 + 1)],
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])
    ))::BIGINT"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_PAGE_RULES = """(VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
    rules(action, rule_host, rule_path)"""

ORACLE = {
    "op2_redirect_equivalence": f"""
    WITH RECURSIVE split AS (
        SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0
            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ),
    urls AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^#]*') AS node,
            coalesce(regexp_extract(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical[^>]*>'), '') AS tag
        FROM split
    ),
    links AS (
        SELECT node AS a, regexp_extract(tag, '(?is)\\bhref\\s*=\\s*["'']?[a-z]+://([^"''#\\s>]+)', 1) AS b
        FROM urls WHERE tag <> ''
    ),
    edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT node AS a, node AS b FROM urls UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
    ruled AS (
        SELECT page_id, host, path, node, arg_min(rule_host || rule_path, (-length(rule_host || rule_path), action))
            AS rule, arg_min(action, (-length(rule_host || rule_path), action)) AS action
        FROM urls LEFT JOIN {_PAGE_RULES} ON (host = rule_host OR suffix(host, '.' || rule_host))
            AND starts_with(path, rule_path)
        GROUP BY ALL
    ),
    aliases AS (
        SELECT reach.a AS node, min(ruled.action) AS action FROM reach JOIN ruled ON ruled.node = reach.b GROUP BY ALL
    )
    SELECT page_id, host, path, rule, coalesce(ruled.action, aliases.action, 'allow') AS verdict
    FROM ruled LEFT JOIN aliases USING (node)""",
    "op6_vector_approximation": """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
    ),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
        FROM (SELECT DISTINCT * FROM vectors WHERE vec_id % 50 = 0) q JOIN vectors c ON c.vec_id <> q.vec_id
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5""",
    "op8_stratified_interleaving": f"""
    WITH {_CRC32},
    rows AS (
        SELECT *, md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32 || ':' || size) AS digest
        FROM (
            SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, {_CRC32_OF_TEXT} AS text_crc32
            FROM (SELECT *, hex(encode(coalesce(text, ''))) AS hex FROM documents), crc_table
        )
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY digest, doc_id, text_crc32, size) AS r,
            count(*) OVER (PARTITION BY source) AS n
        FROM rows
    ),
    placed AS (
        SELECT *, row_number() OVER (
            ORDER BY (2 * r - 1) / (2 * n), source, digest, doc_id, text_crc32, size
        ) - 1 AS place, count(*) OVER () AS total
        FROM ranked
    )
    SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place * 8 // total)::INT AS shard,
        (place - (place * 8 // total * total + 7) // 8)::BIGINT AS slot, NULL::INT AS grown_shard
    FROM placed""",
    "op12_importance_resampling": f"""
    WITH {_CRC32},
    texts AS (
        SELECT 0 AS target, doc_id, text, row_number() OVER () AS r FROM documents
        UNION ALL SELECT 1, item_id, text, row_number() OVER () FROM benchmark
    ),
    words AS (
        SELECT target, doc_id, r, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM texts
    ),
    features AS (
        SELECT target, r, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))],
            [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) AS f
        FROM words
    ),
    counted AS (SELECT target, r, f, count(*) AS n FROM features GROUP BY ALL),
    distinct_features AS (SELECT f, hex(encode(f)) AS hex FROM (SELECT DISTINCT f FROM counted)),
    buckets AS (SELECT f, {_CRC32_OF_TEXT} % 10000 AS bucket FROM distinct_features, crc_table),
    per_bucket AS (
        SELECT bucket, coalesce(sum(n) FILTER (target = 0), 0)::BIGINT AS s,
            coalesce(sum(n) FILTER (target = 1), 0)::BIGINT AS t
        FROM counted JOIN buckets USING (f) GROUP BY bucket
    ),
    totals AS (SELECT sum(s)::BIGINT AS all_s, sum(t)::BIGINT AS all_t FROM per_bucket),
    gains AS (
        SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE
            / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
        FROM per_bucket, totals
    ),
    weights AS (
        SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
        FROM counted JOIN buckets USING (f) JOIN gains USING (bucket) WHERE target = 0 GROUP BY r
    ),
    scored AS (
        SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
            (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[:8])
            ::UBIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score, coalesce(len(w), 0) >= 20 AS eligible
        FROM words LEFT JOIN weights USING (r) WHERE target = 0
    ),
    ordered AS (
        SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id) AS place,
            count(*) FILTER (eligible) OVER () * 5 // 100 AS drawn
        FROM scored
    )
    SELECT doc_id, n_features, weight, score,
        CASE WHEN eligible AND place <= drawn THEN place END::BIGINT AS rank
    FROM ordered""",
    "op13_presence_masks": f"""
    WITH counted AS (
        SELECT doc_id, r, term, count(*) AS tf FROM (
            SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all({_LOWER}, '{_WORD}')) AS term
            FROM documents
        ) GROUP BY ALL
    ),
    lengths AS (SELECT r, sum(tf)::BIGINT AS n FROM counted GROUP BY r),
    totals AS (SELECT count(*) AS all_n, sum(n)::BIGINT AS all_l FROM lengths),
    weights AS (
        SELECT term, floor(1000 * ln((2 * all_n + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM counted, totals GROUP BY term, all_n
    ),
    wanted AS (
        SELECT DISTINCT item_id, item, term FROM (
            SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all({_LOWER}, '{_WORD}')) AS term
            FROM benchmark
        )
    ),
    scored AS (
        SELECT item_id, item, doc_id, r,
            sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * all_n) // all_l))))::BIGINT AS score
        FROM wanted JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (r), totals
        GROUP BY ALL HAVING score > 0
    )
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scored QUALIFY rank <= 50""",
}
