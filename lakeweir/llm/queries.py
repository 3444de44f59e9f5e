"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeweir.llm import (
    conversation_trie,
    decontamination,
    exact_dedup,
    fingerprints,
    language_model,
    mixing,
    near_dedup,
    quality,
    secret_scan,
    sharding,
    spelling,
    token_files,
    toxicity,
)
from lakeweir.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_secret_scan, op2_toxicity, op3_decontamination, op4_exact_dedup, op5_lm_scoring, op6_near_dedup,
              op7_source_mixing, op8_token_files, op9_quality, op10_sharding, op11_spelling_variants,
              op12_conversation_trie, op13_fingerprints)
}

# crc32 by the byte: the table of its 256 remainders, and the checksum of ``{text}``, whose code points are below U+0800.
CRC_TABLE = """
        crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS remainders
        )"""
CRC = """xor(4294967295, list_reduce(
                flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT]
                    ELSE [192 + (ord(c) >> 6)::BIGINT, 128 + (ord(c) & 63)::BIGINT] END)),
                lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"""

SQL: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM (
            SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id,
                   count(*) OVER (PARTITION BY body) AS group_size
            FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
        )
    """,
    "op7_source_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS turn,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents
        ),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place
            FROM sized GROUP BY source
        ),
        weighed AS (
            SELECT source, source_size, CASE place WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
                   CASE place WHEN 0 THEN 0.6::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE -0.6::DOUBLE END AS slope,
                   2 * source_size AS cap,
                   row_number() OVER (ORDER BY source NULLS LAST) AS number,
                   CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS total
            FROM sources
        ),
        levels AS (
            SELECT *, cap / weight AS stop,
                   (total - coalesce(CAST(sum(cap) OVER (ORDER BY cap / weight, number
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
                   / CAST(sum(weight) OVER (ORDER BY cap / weight, number
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
            FROM weighed
        ),
        targets AS (
            SELECT source, source_size, slope, total,
                   CASE WHEN stop <= level THEN CAST(cap AS DOUBLE)
                        ELSE weight * max(level) FILTER (WHERE stop > level) OVER () END AS target
            FROM levels
        ),
        tilted AS (SELECT *, sum(target * slope) OVER () AS tilt FROM targets),
        placed AS (
            SELECT s.doc_id, s.size, t.*,
                   coalesce(CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.turn, s.size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS earlier,
                   CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS passes
            FROM sized s JOIN tilted t ON s.source IS NOT DISTINCT FROM t.source
        ),
        taken AS (
            SELECT *, greatest(0, least(size, CAST(round(target - passes * source_size) AS BIGINT) - earlier)) AS extra,
                   CASE WHEN target > 0 THEN least(1.0::DOUBLE, (earlier + size / 2) / target) ELSE 0 END AS y
            FROM placed
        ),
        timed AS (
            SELECT *, CASE WHEN slope = 0 THEN y
                           ELSE (slope - 1 + sqrt((1 - slope) * (1 - slope) + 4 * slope * y)) / (2 * slope) END AS t,
                   CAST(CASE WHEN size > 0 THEN passes ELSE 0 END
                        + CASE WHEN extra > 0 AND 2 * extra >= size THEN 1 ELSE 0 END AS INTEGER) AS copies
            FROM taken
        )
        SELECT doc_id, size, source_size, target, passes * size + extra AS taken, copies,
               CASE WHEN copies > 0 THEN round(total * t + tilt * (t * t - t), 3) END AS position
        FROM timed
    """,
    "op11_spelling_variants": f"""
        WITH RECURSIVE {CRC_TABLE},
        found AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                   unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{6,}}')) AS run
            FROM documents
        ),
        runs AS (
            SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
            FROM found GROUP BY ALL
        ),
        hashed AS (SELECT run, times, {CRC.format(text="id || ':' || run")} AS h FROM runs, crc),
        spelled AS (
            SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                   times
            FROM hashed
        ),
        words AS (
            SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelled
            WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
        ),
        places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
        shorter AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
        pairs AS (
            SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT s.word, w.word FROM shorter s JOIN words w ON w.word = s.rest
            UNION SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest
        ),
        best AS (
            SELECT p.word, count(*) AS n_near, max(w.n) AS most, arg_min(p.near, (-w.n, p.near)) AS near
            FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word
        ),
        forms AS (
            SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN near END AS form,
                   CASE WHEN most >= 5 * n THEN most END AS form_n
            FROM words LEFT JOIN best ON best.word = words.word
        ),
        steps AS (
            SELECT word, word AS root, form AS ahead FROM forms
            UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.ahead
        )
        SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
        FROM forms f JOIN steps s ON s.word = f.word AND s.ahead IS NULL
    """,
    "op12_conversation_trie": f"""
        WITH {CRC_TABLE},
        said AS (
            SELECT conv_id, turn, strlen(coalesce(text, '')) AS octets,
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        own AS (
            SELECT conv_id, list(struct_pack(digest := digest, octets := octets) ORDER BY turn NULLS FIRST, digest) AS turns
            FROM said GROUP BY conv_id
        ),
        hashed AS (
            SELECT own.*, {CRC.format(text="CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own, crc
        ),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
            FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
        ),
        paths AS (
            SELECT conv_id, len(turns) AS size, turns,
                   list_transform(range(len(turns) + 1), lambda d: sha256(array_to_string(list_transform(turns[1:d], lambda t: t.digest), ''))) AS path
            FROM rebuilt
        ),
        steps AS (SELECT *, unnest(range(size + 1)) AS depth FROM paths),
        nodes AS (
            SELECT path[depth + 1] AS id, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   any_value(CASE WHEN depth > 0 THEN path[depth] END) AS parent, any_value(path[1:depth + 1]) AS above,
                   any_value(CASE WHEN depth > 0 THEN turns[depth].octets ELSE 0 END) AS octets,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends
            FROM steps GROUP BY path[depth + 1], depth
        ),
        counted AS (
            SELECT n.*, coalesce(children, 0) AS n_children
            FROM nodes n LEFT JOIN (SELECT parent, count(*) AS children FROM nodes GROUP BY parent) c ON c.parent = n.id
        ),
        sums AS (
            SELECT id, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * octets) AS BIGINT) AS saved
            FROM (SELECT unnest(above) AS id, n_children, n_convs, octets FROM counted) GROUP BY id
        )
        SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves,
               s.saved AS saved_tokens, c.ends AS ends_sha256
        FROM counted c JOIN sums s ON s.id = c.id LEFT JOIN nodes p ON p.id = c.parent
    """,
}
