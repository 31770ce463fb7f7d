"""The operators over the standard tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, written
from . import audit, bpe, exact, linededup, mixing, neardup, pii, quality, sharding, topk, trie, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEY = b"a key for tests: a real one comes from a key store"
SHARDS, GROWN = 16, 17
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_pseudonyms")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, KEY).withColumn("n_values", F.size("pii"))


@query(
    "op2_max_score",
    """
    WITH vectors AS (
        SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
    ), ranked AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@query("op3_speculative_bpe")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts."""
    coded = bpe.encode(docs.select("doc_id", "text"), vocabulary(), decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


MIX_SQL = r"""
    WITH sized AS (
        SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
        FROM documents
    ), sums AS (
        SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM sized GROUP BY source
    ), weighted AS (
        SELECT source, source_size,
               CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END
                    AS DOUBLE) AS weight,
               sum(source_size) OVER () AS total
        FROM sums
    ), ordered AS (
        SELECT 2 * source_size / weight AS full_at, row_number() OVER by_fill AS place,
               (1.5 * total - coalesce(sum(2 * source_size) OVER before, 0))
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS l
        FROM weighted
        WINDOW by_fill AS (ORDER BY 2 * source_size / weight, source),
               before AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), level AS (
        SELECT arg_min(l, place) FILTER (full_at >= l) AS l FROM ordered
    ), targets AS (
        SELECT source, source_size, least(2 * source_size, weight * l) AS target,
               CASE WHEN source_size > 0 THEN least(2 * source_size, weight * l) / source_size ELSE 0 END AS rate
        FROM weighted, level
    ), drawn AS (
        SELECT d.doc_id, d.size, t.source_size, t.target, t.rate,
               CAST('0x' || substr(md5('mix-' || coalesce(CAST(d.doc_id AS VARCHAR), '') || '-' || coalesce(d.text, '')), 1, 13)
                    AS BIGINT) / CAST(4503599627370496 AS DOUBLE) AS u
        FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
           CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM drawn
"""


@query("op4_mix", MIX_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    planned = mixing.plan_mix(docs, weights=(3, 1, 2), share=1.5, most=2.0)
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op5_virtual_slots")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    sizes = written(sharding.slot_bytes(docs), "slots")
    maps = scratch_path(spark, "slot-map")
    first = sharding.first_map(sizes, SHARDS)
    sharding.save_map(spark, maps, 1, first)
    sharding.save_map(spark, maps, 2, sharding.edit_map(first, sizes, GROWN))
    placed = sharding.assign(docs, sharding.load_map(spark, maps, 1), edited=sharding.load_map(spark, maps))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "version",
        "edited_version", "edited_shard", "edited_slot",
    )


@query("op6_minhash_links")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), words=2, percent=80)


@query("op7_pairwise_quality")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.measured(table(spark, folder, "documents"))
    ranker = quality.fit(rows, table(spark, folder, "labels"))
    scored = quality.classify_measured(rows, ranker)
    return scored.select("doc_id", quality.is_held_out().alias("held_out"), "score", "predicted")


@query(
    "op8_block_naming",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return exact.dedup(table(spark, folder, "documents"))


@query(
    "op9_archive",
    """
    WITH bodies AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
               max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
        FROM pages
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
    FROM bodies
    """,
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.parsed(warc.read_archive(spark, path))


@query("op9_records")
def op9_records(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.rebuilt(warc.read_archive(spark, path))


def _rule_sql() -> str:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
    WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rows}),
    rests AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parts AS (
        SELECT page_id,
               translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT page_id, coalesce(rest, '') AS rest FROM rests)
    )
    SELECT page_id, host, path, best.rule, coalesce(best.rule_verdict, 'allow') AS verdict
    FROM parts LEFT JOIN LATERAL (
        SELECT rule_host || rule_path AS rule, rule_verdict FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC LIMIT 1
    ) best ON true
    """


@query("op10_url_rules", _rule_sql())
def op10(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = urls.judge(pages, urls.rule_table(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")



CRC_STEP = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
TRIE_SQL = rf"""
    WITH turns AS (
        SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST,
                             sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS own
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ), headed AS (
        SELECT c.conv_id, c.own, b.own AS base,
               xor(list_reduce(list_concat([4294967295],
                       list_transform(range(1, len(CAST(c.conv_id AS VARCHAR)) + 1), lambda i: ord(CAST(c.conv_id AS VARCHAR)[i]))),
                   lambda c, b: {CRC_STEP}), 4294967295) % 4 AS h
        FROM turns c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20
    ), paths AS (
        SELECT conv_id, list_concat(coalesce(base[1:h], []), own[h + 1:]) AS path FROM headed
    ), prefixes AS (
        SELECT conv_id, len(path) AS size, path, unnest(range(len(path) + 1)) AS depth FROM paths
    ), nodes AS (
        SELECT depth, path[1:depth] AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
               coalesce(len(regexp_extract_all(path[1:depth][depth].text, '[^\x20\x09-\x0D]+')), 0) AS words,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
        FROM prefixes GROUP BY depth, path[1:depth]
    ), children AS (
        SELECT p[1:depth - 1] AS up, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up
    ), families AS (
        SELECT n.*, u.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children
        FROM nodes n LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1] LEFT JOIN children c ON c.up = n.p
    ), above AS (
        SELECT (n_children = 0)::INT AS leaf, (n_convs - 1) * words AS saved, p, unnest(range(depth + 1)) AS d FROM families
    ), sums AS (
        SELECT p[1:d] AS p, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY p[1:d]
    )
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
    FROM families JOIN sums USING (p)
    """


@query("op11_conversation_trie", TRIE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    paths = trie.rebuilt_paths(trie.turn_lists(table(spark, folder, "conversations")), block=20, shared=4)
    return trie.nodes(paths)


@query(
    "op12_line_dedup",
    r"""
    WITH lines AS (
        SELECT doc_id, place, line,
               translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
    ), keyed AS (
        SELECT doc_id, place, line, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM lines
    )
    SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM keyed GROUP BY doc_id
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    index = linededup.LineIndex(spark, scratch_path(spark, "lines"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    for part in (0, 1):  # all documents, in two steps: the second asks the filters that the first has made
        index.insert(docs.where(half == part))
    clean = index.dedup(docs)
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _audit_sql() -> str:
    steps = ", ".join(f"('{s['filter_order']}', {s['step']}, {s['before']}, {s['bit']})" for s in audit.orders("ABCDE"))
    return rf"""
    WITH steps(filter_order, step, before, bit) AS (VALUES {steps}),
    texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS repeats
        FROM documents
    ), labelled AS (
        SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
    ), masks AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
               + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
               + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(repeats, false)::INT AS mask
        FROM texts LEFT JOIN labelled USING (doc_id)
    ), counts AS (
        SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask
    ), found AS (
        SELECT part, filter_order, step, bit,
               sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM counts, steps GROUP BY part, filter_order, step, bit
    )
    SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM found
    """


@query("op13_filter_audit", _audit_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"), audit.standard_filters())
