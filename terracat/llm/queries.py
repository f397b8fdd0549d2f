"""Queries over the driver tables that apply the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fingerprint, licenses, lm, mixing, ngram_join, page_text, pii, prefix_trie, secrets, spelling, substring, toxicity

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}

#: CRC-32 (the usual polynomial, reflected) of a list of bytes: its table by the
#: rule, and the expression over ``bytes`` and the table ``t``.
_CRC_TABLE = """(SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(i)))"""
_CRC = "xor(list_reduce(list_prepend(4294967295, {bytes}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"

#: UTF-8 bytes of a string of ASCII and Latin-1 letters.
_BYTES = """flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128
    THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END))"""

SPELLING_SQL = f"""
WITH RECURSIVE crc AS {_CRC_TABLE},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
per AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {_CRC.format(bytes=_BYTES.format(text="id || ':' || run"))} AS h FROM per, crc),
edited AS (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS MATERIALIZED (SELECT word, n, i, word[1:i] || word[i + 2:] AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM pairs GROUP BY word),
found AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
              CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM words w LEFT JOIN near USING (word)),
way AS (SELECT word, form AS root FROM found WHERE form IS NOT NULL
        UNION ALL SELECT way.word, f.form FROM way JOIN found f ON f.word = way.root WHERE f.form IS NOT NULL),
ends AS (SELECT way.word, way.root FROM way JOIN found f ON f.word = way.root WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n FROM found f LEFT JOIN ends e USING (word)"""

#: Turns of equal number: by role and text (the driver's tables have none).
PREFIX_TRIE_SQL = f"""
WITH crc AS {_CRC_TABLE},
turns AS (SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
                 sha256(coalesce(role, '') || chr(0) || coalesce(text, '')) AS h,
                 len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
          FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv FROM turns),
convs AS (SELECT conv, conv - conv % 20 AS base, {_CRC.format(bytes=_BYTES.format(text="CAST(conv AS VARCHAR)"))} % 4 AS head FROM ids, crc),
parts AS (SELECT c.conv, 0 AS part, t.pos, h, words FROM convs c JOIN turns t ON t.conv = c.base AND t.pos <= c.head
          UNION ALL SELECT c.conv, 1, t.pos, h, words FROM convs c JOIN turns t ON t.conv = c.conv AND t.pos > c.head),
built AS (SELECT conv, row_number() OVER w AS depth, sha256(string_agg(h, '') OVER w) AS key, words FROM parts WINDOW w AS (PARTITION BY conv ORDER BY part, pos)),
steps AS (SELECT conv, depth, key, words FROM built UNION ALL SELECT conv, 0, '', 0 FROM ids),
sized AS (SELECT *, max(depth) OVER (PARTITION BY conv) AS last FROM steps),
nodes AS (SELECT depth, key, min(conv) AS owner, count(*) AS n_convs, max(words) AS words,
                 sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (WHERE depth = last), '')) AS ends_sha256
          FROM sized GROUP BY depth, key),
paths AS (SELECT s.conv, s.depth, n.owner FROM steps s JOIN nodes n USING (depth, key)),
edges AS (SELECT n.*, p.owner AS parent FROM nodes n LEFT JOIN paths p ON p.conv = n.owner AND p.depth = n.depth - 1),
children AS (SELECT parent AS owner, depth - 1 AS depth, count(*) AS n_children FROM edges WHERE depth > 0 GROUP BY ALL),
forest AS (SELECT e.*, coalesce(n_children, 0) AS n_children FROM edges e LEFT JOIN children USING (owner, depth)),
sums AS (SELECT p.owner, p.depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
         FROM forest f JOIN paths p ON p.conv = f.owner AND p.depth <= f.depth GROUP BY ALL)
SELECT owner AS conv_id, depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM forest JOIN sums USING (owner, depth)"""


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, oracle)
        return fn
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.digest(toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels"))))


@register("op2_ngram_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


@register("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


@register("op4_mix_sources")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


@register("op5_lm_score")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), stored=True)


@register("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(_table(spark, sf_dir, "documents")))


@register("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@register("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated(_table(spark, sf_dir, "documents"))


@register("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.identify(_table(spark, sf_dir, "documents")))


@register("op10_fingerprint")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(_table(spark, sf_dir, "documents"))


@register("op11_spelling", SPELLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(spelling.words_of(_table(spark, sf_dir, "documents")))


@register("op13_prefix_trie", PREFIX_TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


@register("op12_page_text")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(_table(spark, sf_dir, "pages"))
