"""The registered query of each operator over the given tables, and DuckDB SQL where SQL can say the same."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopgrain.llm import (
    ann,
    bpe,
    filter_audit,
    language_id,
    merkle,
    mixing,
    near_dedup,
    order_minhash,
    quality,
    secret_scan,
    sharding,
    token_counts,
    url_rules,
)
from shopgrain.sources.scratch import scratch_root

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
TOKEN_CACHE = "shopgrain-token-counts"  # in the shared folder, for this and later runs
SHARDS = 16
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree(SHARDS)
    return sharding.shard_documents(table(spark, sf_dir, "documents"), tree, sharding.grown(tree))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def url_rules_table(spark: SparkSession) -> DataFrame:
    rules = [
        F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path"))
        for v, h, p in URL_RULES
    ]
    return spark.range(1).select(F.inline(F.array(*rules)))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules_table(spark))


OP6_SQL = """
WITH rules(verdict, host, path) AS (VALUES
    ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
split AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM hosts),
addresses AS (SELECT DISTINCT host, path FROM split),
fits AS (
    SELECT a.host, a.path, arg_max(r, length(r.host) + length(r.path) + length(r.host) / 1000000.0) AS r
    FROM addresses a JOIN rules r
      ON (a.host = r.host OR a.host LIKE '%.' || r.host) AND starts_with(a.path, r.path)
    GROUP BY ALL)
SELECT page_id, s.host, s.path, r.host || r.path AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON s.host = f.host AND s.path = f.path
"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(VOCABULARY),
        f"{scratch_root(spark)}/{TOKEN_CACHE}",
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


OP11_SQL = r"""
WITH read AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents),
flags AS (
    SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        [len(words) < 100, 100 * list_unique(words) < 80 * len(words),
         100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS f
    FROM read LEFT JOIN flags USING (doc_id)),
counts AS (
    SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
axes AS (SELECT unnest(range(1, 6)) AS x),
orders AS (
    SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM axes a, axes b, axes c, axes d, axes e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, x AS step, o[x] AS own, o[1:x - 1] AS before FROM orders, axes),
met AS (
    SELECT part, o, step, own, n, good, toxic, f[own] AS fails,
        list_bool_or(list_transform(before, lambda b: f[b])) IS TRUE AS gone,
        len(list_filter(f, lambda b: b)) = 1 AS alone
    FROM steps, counts),
sums AS (
    SELECT part, o, step, own,
        sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails AND alone THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
    FROM met GROUP BY ALL)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, CAST(step AS INT) AS step,
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, own) AS shapley
FROM sums
"""


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE
said AS (
    SELECT doc_id, source, text,
        concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END,
               CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
               CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
               CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END) AS head,
        list_reduce(
            list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
            lambda crc, byte: xor(crc >> 8, list_reduce(list_prepend(xor(crc, byte) & 255, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))) AS crc
    FROM documents),
leaves AS (
    SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256(head || CASE WHEN text IS NULL THEN '-' ELSE
            strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END) END AS tampered
    FROM said),
placed AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, tampered NULLS FIRST) - 1 AS idx,
        count(*) OVER (PARTITION BY source) AS n
    FROM leaves),
low AS (
    SELECT tree, 0 AS level, CAST(idx AS BIGINT) AS idx, CAST(n AS BIGINT) AS n, leaf AS digest FROM placed
    UNION ALL
    SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM low WHERE n > 1 GROUP BY tree, level, idx // 16, n),
subroots AS (SELECT tree, digest, level FROM low WHERE n = 1),
high AS (
    SELECT 0 AS level, CAST(tree - 1 AS BIGINT) AS idx, CAST(count(*) OVER () AS BIGINT) AS n, digest FROM subroots
    UNION ALL
    SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM high WHERE n > 1 GROUP BY level, idx // 16, n),
nodes AS (
    SELECT tree, level, idx, n, digest FROM low WHERE n > 1
    UNION ALL
    SELECT s.tree, s.level + h.level, h.idx, h.n, h.digest FROM high h, subroots s WHERE h.n > 1),
steps AS (
    SELECT p.tree, p.idx, v.level,
        CASE WHEN v.level < s.level THEN p.idx // CAST(pow(16, v.level) AS BIGINT)
             ELSE (p.tree - 1) // CAST(pow(16, v.level - s.level) AS BIGINT) END AS place
    FROM placed p JOIN subroots s USING (tree) JOIN (SELECT DISTINCT tree, level FROM nodes) v USING (tree)),
siblings AS (
    SELECT t.tree, t.idx, t.level,
        coalesce(string_agg(x.digest, '' ORDER BY x.idx) FILTER (x.idx < t.place), '') AS l,
        coalesce(string_agg(x.digest, '' ORDER BY x.idx) FILTER (x.idx > t.place), '') AS r
    FROM steps t JOIN nodes x ON x.tree = t.tree AND x.level = t.level AND x.idx // 16 = t.place // 16
    GROUP BY ALL),
paths AS (
    SELECT tree, idx, list({'l': l, 'r': r} ORDER BY level) AS path, string_agg(l || r, '' ORDER BY level) AS said
    FROM siblings GROUP BY ALL),
folds AS (
    SELECT p.tree, p.idx, 1 AS pos, coalesce(p.tampered, p.leaf) AS digest FROM placed p
    UNION ALL
    SELECT f.tree, f.idx, pos + 1, sha256(path[pos].l || digest || path[pos].r)
    FROM folds f JOIN paths p ON f.tree = p.tree AND f.idx = p.idx WHERE pos <= len(path)),
ends AS (SELECT tree, idx, arg_max(digest, pos) AS folded_root FROM folds GROUP BY ALL)
SELECT p.doc_id, p.leaf, s.digest AS subroot, h.digest AS root, sha256(coalesce(w.said, '')) AS proof_sha256,
    e.folded_root, e.folded_root = h.digest AS verified
FROM placed p JOIN subroots s USING (tree) JOIN ends e ON p.tree = e.tree AND p.idx = e.idx
    LEFT JOIN paths w ON p.tree = w.tree AND p.idx = w.idx, high h
WHERE h.n = 1
"""


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH rules(kind, place, base, pattern, grp, least) AS (VALUES
    ('assign', 1, true, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    ('access', 2, true, 'AKIA[A-Z0-9]+', 0, 20),
    ('hex', 3, true, '[0-9a-f]+', 0, 24),
    ('private_key', 4, false, '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0),
    ('hosting_token', 5, false, 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 0),
    ('chat_token', 6, false, 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 0),
    ('map_key', 7, false, 'AIza[A-Za-z0-9_-]{35}', 0, 0),
    ('web_token', 8, false, 'eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}', 0, 0)),
texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
cut AS (
    SELECT text, kind, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern, 0) AS whole,
        regexp_extract_all(text, pattern, grp) AS held
    FROM texts, rules),
found AS (
    SELECT text, kind, unnest(range(1, len(whole) + 1)) AS pos, gaps, whole, held FROM cut),
lengths AS (
    SELECT text, kind, pos, length(gaps[pos]) AS gap, length(whole[pos]) AS size, length(held[pos]) AS held FROM found),
placed AS (
    SELECT *, sum(gap + size) OVER (PARTITION BY text, kind ORDER BY pos) AS stop FROM lengths),
kept AS (
    SELECT text, kind, place, base, CAST(stop - size AS BIGINT) AS begin, kind || ':' || CAST(stop - size AS BIGINT) || ':' || CAST(stop AS BIGINT) AS said
    FROM placed JOIN rules USING (kind) WHERE held >= least),
per_text AS (
    SELECT text, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, string_agg(said, ',' ORDER BY begin, place) FILTER (base) AS base,
        string_agg(said, ',' ORDER BY begin, place) AS spans
    FROM kept GROUP BY text)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per_text p ON coalesce(d.text, '') = p.text
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_ann,
        op3_bpe,
        op4_sharding,
        op5_quality,
        op6_url_rules,
        op7_token_counts,
        op8_language_id,
        op9_near_duplicates,
        op10_order_minhash,
        op11_filter_audit,
        op12_merkle,
        op13_secrets,
    )
}
ORACLE = {
    "op6_url_rules": OP6_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_merkle": OP12_SQL,
    "op13_secrets": OP13_SQL,
}
