"""One registered query for each operator, over whole tables, and its SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import ann, bpe, divergence, exact, html, language, lm, packing, repair, secrets, sharding, simhash, toxicity
from strataflow.registry.tables import table


def op1_lm(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"))


def op10_ann(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"))


#: The same vocabulary as ``byte_bpe_50k.json``, as ranks.
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.deduplicate(table(spark, sf, "documents"))


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return packing.pack(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    pieces = language.read_pieces(public_tokenizers.path(PIECES))
    return language.predict(table(spark, sf, "documents"), pieces)


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.round_trips(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op6_html(spark: SparkSession, sf: str) -> DataFrame:
    return html.main_texts(table(spark, sf, "pages"))


def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents"))


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op9_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"))


def op11_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair(table(spark, sf, "conversations"))


def op12_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.divergence(table(spark, sf, "documents"))


QUERIES = {
    "op1_lm": op1_lm,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_packing": op3_packing,
    "op4_language": op4_language,
    "op5_bpe": op5_bpe,
    "op6_html": op6_html,
    "op7_secrets": op7_secrets,
    "op8_simhash": op8_simhash,
    "op9_sharding": op9_sharding,
    "op10_ann": op10_ann,
    "op11_repair": op11_repair,
    "op12_toxicity": op12_toxicity,
    "op13_divergence": op13_divergence,
}
SQL = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_repair": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
            FROM conversations
        ), kinds AS (
            SELECT *, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda ch: ascii(ch)::BIGINT)),
                lambda sum, byte: list_reduce(
                    list_prepend(xor(sum, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                    lambda bits, nothing: xor(bits >> 1, 3988292384 * (bits & 1)))
                ), 4294967295) % 20 AS kind
            FROM keyed
        ), damaged AS (
            SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM kinds
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS nth,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
            FROM damaged
        ), faults AS (
            SELECT conv_id, turn, role, text, nth, left(role, 1) AS initial,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY nth) AS before,
                   CASE WHEN solid = '' THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nth) > 1 THEN 'duplicate'
                        WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM ordered
        ), totals AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows
            FROM faults GROUP BY conv_id
        ), ends AS (
            -- What the rest costs, its audit and its lines, where the grammar stands at: start, s, u, a.
            SELECT [{'c': 0, 'a': '', 'r': []::VARCHAR[]}, {'c': 4, 'a': 'II', 'r': ['user:', 'assistant:']},
                    {'c': 2, 'a': 'I', 'r': ['assistant:']}, {'c': 0, 'a': '', 'r': []::VARCHAR[]}] AS best
        ), walk AS (
            SELECT conv_id, rows AS nth, best FROM totals, ends
            UNION ALL
            SELECT conv_id, nth - 1, list_transform([1, 2, 3, 4], lambda s: list_min([
                       here[s],
                       {'c': here[next_[s]].c + 2, 'a': 'I' || here[next_[s]].a, 'r': list_prepend(made[s] || ':', here[next_[s]].r)},
                       {'c': here[next_[next_[s]]].c + 4, 'a': 'II' || here[next_[next_[s]]].a,
                        'r': list_concat([made[s] || ':', made[next_[s]] || ':'], here[next_[next_[s]]].r)}])) AS best
            FROM (
                SELECT conv_id, nth, next_, made, list_transform([1, 2, 3, 4], lambda s: list_min(list_filter([
                           {'c': best[s].c + 3, 'a': 'D' || best[s].a, 'r': best[s].r},
                           {'c': best[next_[s]].c + 2 + cut, 'a': 'R' || best[next_[s]].a,
                            'r': list_prepend(made[s] || ':' || text, best[next_[s]].r)},
                           {'c': best[stays[s]].c + cut, 'a': 'K' || best[stays[s]].a,
                            'r': list_prepend(role || ':' || text, best[stays[s]].r)}],
                           lambda way: way.c IS NOT NULL AND (left(way.a, 1) = 'D' OR fault NOT IN ('blank', 'duplicate'))))) AS here
                FROM (
                    SELECT walk.conv_id, walk.nth, best, role, text, fault, (fault = 'truncated')::INT AS cut,
                           [3, 3, 4, 3] AS next_, ['user', 'user', 'assistant', 'user'] AS made,
                           CASE initial WHEN 's' THEN [2, NULL, NULL, NULL] WHEN 'u' THEN [3, 3, NULL, 3]
                                WHEN 'a' THEN [NULL, NULL, 4, NULL] ELSE [NULL::INT, NULL, NULL, NULL] END AS stays
                    FROM walk JOIN faults ON faults.conv_id IS NOT DISTINCT FROM walk.conv_id AND faults.nth = walk.nth
                )
            )
        )
        SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best[1].c, 0)::BIGINT AS cost,
               coalesce(best[1].a, '') AS audit, sha256(coalesce(array_to_string(best[1].r, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS every
        LEFT JOIN totals ON totals.conv_id IS NOT DISTINCT FROM every.conv_id
        LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM every.conv_id AND walk.nth = 0
    """,
    "op13_divergence": r"""
        WITH named AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   row_number() OVER () AS doc, coalesce(text, '') AS text FROM documents
        ), words AS (
            SELECT lang, source, doc, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM named
        ), kept AS (
            SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
        ), langs AS (
            SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
        ), counts AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), cells AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS lang_n,
                   sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS own
            FROM (SELECT DISTINCT lang, source FROM named) AS g JOIN kept USING (lang) LEFT JOIN counts AS c USING (lang, source, term)
        ), shares AS (
            SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (own + 2 * v) AS p,
                   1 + (1000000000 * (lang_n + 2)) // (total + 2 * v) AS q
            FROM cells JOIN langs USING (lang)
        ), valued AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                   coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM shares x JOIN shares y USING (lang, term)
                             WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
            FROM (SELECT DISTINCT lang, source FROM named) AS a JOIN (SELECT DISTINCT lang, source FROM named) AS b
              ON a.lang = b.lang AND a.source <> b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM valued
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
}
