"""The registered queries of this folder and their SQL, with production parameters.

Each is a thin layer over its operator: it reads whole tables and derives the columns that the contracts ask for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import audio, byte_bpe, fm_index, kneser_ney, quotes, rollup, simhash, storage, token_shards, toxicity, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_shards.encode_shards(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return token_shards.read_documents(storage.written(rows, "token-shards"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op4_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return rollup.replayed(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.held_out_scores(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.digests(fm_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))).drop("spans")


def op9_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = storage.written(audio.as_media(table(spark, sf_dir, "documents")), "media")
    found = storage.written(audio.features(media), "audio-features")
    storage.drop(media)
    return audio.described(found)


#: The contract's rules: verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_shards": op1_token_shards,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quote_links": op3_quote_links,
    "op4_token_rollup": op4_token_rollup,
    "op5_toxicity": op5_toxicity,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_simhash": op7_simhash,
    "op8_fm_index": op8_fm_index,
    "op9_audio": op9_audio,
    "op10_url_filter": op10_url_filter,
}

ORACLE_SQL: dict[str, str] = {
    "op3_quote_links": r"""
        WITH messages AS (
            SELECT conv_id, turn, min(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))) AS m FROM conversations GROUP BY conv_id, turn
        ), raw AS (
            SELECT conv_id, turn, m.role AS role, m.text AS text, regexp_matches(m.text, '(?m)^[ \t]*>') AS quoting FROM messages
        ), lines AS (
            SELECT conv_id, turn, generate_subscripts(regexp_split_to_array(text, '\r\n|\n|\r'), 1) AS k, unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM raw WHERE quoting
        ), leveled AS (
            SELECT conv_id, turn, k, length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)*)', 1), '[^>]', '', 'g')) AS own_level, regexp_replace(line, '^(?:[ \t]*>)+ ?', '') AS line FROM lines
        ), carried AS (
            SELECT *, last_value(CASE WHEN k = 1 OR own_level > 0 OR trim(line) <> '' THEN own_level END IGNORE NULLS) OVER (PARTITION BY conv_id, turn ORDER BY k) AS level FROM leveled
        ), marked AS (
            SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY conv_id, turn ORDER BY k) THEN 1 ELSE 0 END AS new FROM carried
        ), numbered AS (
            SELECT *, sum(new) OVER (PARTITION BY conv_id, turn ORDER BY k) AS passage FROM marked
        ), own AS (
            SELECT r.conv_id, r.turn, r.role, r.quoting, regexp_replace(CASE WHEN NOT quoting THEN text ELSE coalesce((
                SELECT string_agg(n.line, chr(10) ORDER BY k) FROM numbered n
                WHERE n.level = 0 AND n.conv_id IS NOT DISTINCT FROM r.conv_id AND n.turn IS NOT DISTINCT FROM r.turn
                  AND NOT regexp_matches(trim(n.line), '(?i)^(on .{0,200}wrote|.{0,200} (wrote|schrieb|écrit|escribió)) ?:$')), '') END, '^\s+|\s+$', '', 'g') AS text
            FROM raw r
        ), pieces AS (
            SELECT conv_id, turn, unnest(list_concat([text], regexp_split_to_array(text, '\n[ \t]*\n'), string_split(text, chr(10)))) AS said FROM own
        ), offers AS (
            SELECT DISTINCT conv_id, turn, trim(regexp_replace(lower(said), '\s+', ' ', 'g')) AS said FROM pieces
        ), passages AS (
            SELECT conv_id, turn, passage, any_value(level) AS level, string_agg(line, chr(10) ORDER BY k) AS text, list(line ORDER BY k) AS ls FROM numbered WHERE level > 0 GROUP BY conv_id, turn, passage
        ), quoted AS (
            SELECT DISTINCT conv_id, turn, passage, level, trim(regexp_replace(lower(said), '\s+', ' ', 'g')) AS said FROM (SELECT *, unnest(list_concat([text], ls)) AS said FROM passages)
        ), found AS (
            SELECT q.*, (SELECT min(o.turn) FROM offers o WHERE o.said = q.said AND o.conv_id IS NOT DISTINCT FROM q.conv_id) AS near_turn,
                   (SELECT min(struct_pack(c := o.conv_id, t := o.turn)) FROM offers o WHERE o.said = q.said) AS first
            FROM quoted q WHERE q.said <> ''
        ), aimed AS (
            SELECT *, CASE WHEN near_turn < turn THEN struct_pack(c := conv_id, t := near_turn)
                           WHEN first.c < conv_id OR (first.c = conv_id AND first.t < turn) THEN first END AS target
            FROM found
        ), linked AS (
            SELECT conv_id, turn, passage, level, max(struct_pack(size := length(said), target := target)) FILTER (target IS NOT NULL) AS best FROM aimed GROUP BY ALL
        ), told AS (
            SELECT conv_id, turn, count(*) AS n_quotes, count(best) AS n_linked, max(level) AS depth, max(struct_pack(here := best.target.c = conv_id, target := best.target)) FILTER (level = 1 AND best IS NOT NULL) AS reply
            FROM linked GROUP BY conv_id, turn
        ), placed AS (
            SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS previous FROM own
        )
        SELECT p.conv_id, p.turn, p.role, p.text, CAST(coalesce(depth, 0) AS INT) AS depth, CAST(coalesce(n_quotes, 0) AS BIGINT) AS n_quotes, CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked,
               CASE WHEN reply IS NOT NULL THEN reply.target.c WHEN previous IS NOT NULL THEN p.conv_id END AS reply_conv, coalesce(reply.target.t, previous) AS reply_turn
        FROM placed p LEFT JOIN told t ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND p.turn IS NOT DISTINCT FROM t.turn
    """,
    "op8_fm_index": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, w[k : k + 9] AS win FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM items WHERE len(w) > 0)
        ), lengths AS (
            SELECT DISTINCT len(win) AS n FROM windows
        ), places AS (
            SELECT doc_id, k, n, w[k : k + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM words, lengths WHERE len(w) >= n)
        ), hits AS (
            SELECT doc_id, k, n, item_id FROM places JOIN windows USING (win)
        ), covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY doc_id
        ), found AS (
            SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op10_url_filter": r"""
        WITH cut AS (
            SELECT page_id, strpos(coalesce(url, ''), '://') AS pos, url FROM pages
        ), rest AS (
            SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS r FROM cut
        ), parts AS (
            SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ), rules(verdict, h, p) AS (
            VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
        ), fits AS (
            SELECT page_id, host, path, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC NULLS LAST) AS k
            FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
    """,
}
