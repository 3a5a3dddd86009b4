"""The registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataloom.llm import ann, bpe, chat, divergence, fingerprints, packing, pii, prefix_trie, simhash, substring_dedup, suffix_dedup, toxicity, weak_quality
from strataloom.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    whole = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.chats(whole).drop("n_tokens", "loss_tokens")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents")).drop("n_spans")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.judged(table(spark, sf_dir, "documents"))[0].drop("quality", "votes")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))[0]


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))[0]


OPERATORS = (op1_suffix_dedup, op2_fingerprints, op3_bpe, op4_chat, op5_toxicity, op6_neighbours, op7_substring_dedup, op8_simhash, op9_personal_data, op10_packing, op11_quality, op12_prefix_trie, op13_divergence)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}


def _quality_sql() -> str:
    """Texts are measured by SQL's own means; the model is a recursion over the counts of votes."""
    rules = list(weak_quality.RULES.values())
    said = ", ".join(f"CASE WHEN {against} THEN -1 WHEN {for_} THEN 1 ELSE 0 END" for against, for_ in rules)
    n, low, (good, poor) = len(rules), weak_quality.WITHIN, weak_quality.BEGIN
    inside = lambda a, b: f"CASE WHEN {b} > 0 THEN greatest({low}, least({1 - low}, {a} / {b})) ELSE 0.5 END"
    sums = lambda what: f"list_sum(list_transform(seen, lambda s, k: {what}))"
    odds = f"ln(m.good / (1 - m.good)) + list_sum(list_transform(range(1, {n + 1}), lambda r: CASE s.said[r] WHEN 1 THEN ln(m.rates[r].good / (1 - m.rates[r].poor)) WHEN -1 THEN ln((1 - m.rates[r].good) / m.rates[r].poor) ELSE 0 END))"
    of_rule = f"{{'good': {inside(sums('CASE WHEN s.said[r] = 1 THEN s.n * q[k] ELSE 0 END'), sums('CASE WHEN s.said[r] <> 0 THEN s.n * q[k] ELSE 0 END'))}, 'poor': {inside(sums('CASE WHEN s.said[r] = -1 THEN s.n * (1 - q[k]) ELSE 0 END'), sums('CASE WHEN s.said[r] <> 0 THEN s.n * (1 - q[k]) ELSE 0 END'))}}}"
    posterior = f"list_transform(seen, lambda s: 1 / (1 + exp(-({odds}))))"
    return rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
 w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
 p AS (SELECT id, i, words[i:i + 4] AS five FROM w, unnest(range(1, len(words) - 3)) AS t(i)), t AS (SELECT id, i FROM p QUALIFY count(*) OVER (PARTITION BY id, five) > 1),
 c AS (SELECT id, count(DISTINCT i + k) AS n_repeat_words FROM t, unnest(range(0, 5)) AS o(k) GROUP BY id),
 m AS (SELECT w.id, doc_id, len(words) AS n_words, cast(length(array_to_string(words, '')) AS BIGINT) AS word_chars, cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, cast(length(regexp_replace(text, '\P{{L}}+', '', 'g')) AS BIGINT) AS n_letters, cast(length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS BIGINT) AS n_capitals FROM w LEFT JOIN c ON w.id = c.id),
 v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, [{said}] AS said FROM m),
 g AS (SELECT list({{'said': said, 'n': n}} ORDER BY said) AS seen FROM (SELECT said, count(*) FILTER (WHERE NOT base_failed) AS n FROM v GROUP BY said)),
 e AS (SELECT 0 AS round, {{'good': {weak_quality.PRIOR}::DOUBLE, 'rates': list_transform(range(0, {n}), lambda r: {{'good': {good}::DOUBLE, 'poor': {poor}::DOUBLE}})}} AS m
  UNION ALL SELECT round + 1, {{'good': {inside(sums('s.n * q[k]'), sums('s.n'))}, 'rates': list_transform(range(1, {n + 1}), lambda r: {of_rule})}} FROM (SELECT round, seen, {posterior} AS q FROM e, g WHERE round < {weak_quality.ROUNDS})),
 f AS (SELECT unnest(list_zip(list_transform(seen, lambda s: s.said), {posterior})) AS x FROM e, g WHERE round = {weak_quality.ROUNDS})
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND x[2] >= 0.5 AS kept FROM v JOIN f ON v.said = x[1]"""


_TRIE_SQL = """WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
 c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM t GROUP BY 1),
 h AS (SELECT a.conv_id, a.turns, coalesce(b.turns, []) AS base, crc32_of.h AS h FROM c a LEFT JOIN c b ON b.conv_id = a.conv_id - a.conv_id % 5 JOIN crc32_of ON crc32_of.conv_id = a.conv_id),
 r AS (SELECT conv_id, list_concat(base[1:h], turns[h + 1:]) AS seq FROM h),
 m AS (SELECT conv_id, len(seq) AS length, d, seq[1:d] AS k, CASE WHEN d = 0 THEN 0 ELSE strlen(seq[d].text) END AS size FROM r, unnest(range(0, len(seq) + 1)) AS u(d)),
 n AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE length = d), '')) AS ends_sha256 FROM m GROUP BY 1, 2),
 p AS (SELECT n.*, coalesce(x.n_children, 0) AS n_children FROM n LEFT JOIN (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2) x ON n.d = x.d AND n.k = x.k),
 s AS (SELECT j AS d, k[1:j] AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, cast(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens FROM p, unnest(range(0, d + 1)) AS u(j) GROUP BY 1, 2)
 SELECT p.conv_id, p.d AS depth, q.conv_id AS parent_conv_id, p.n_convs, p.n_children, s.n_leaves, s.saved_tokens, p.ends_sha256 FROM p JOIN s ON p.d = s.d AND p.k = s.k LEFT JOIN n q ON p.d > 0 AND q.d = p.d - 1 AND q.k = p.k[1:p.d - 1]"""
#: CRC-32 of each decimal conv_id by its bytes and bits, as DuckDB has no such function.
_CRC_SQL = """crc32_of AS (SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(cast(conv_id AS VARCHAR)) + 1), lambda i: ascii(cast(conv_id AS VARCHAR)[i])::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [x::BIGINT for x in range(0, 8)]), lambda y, z: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),"""

_DIVERGENCE_SQL = r"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
 w AS (SELECT id, lang, source, unnest(terms) AS term FROM d), g AS (SELECT DISTINCT lang, source FROM d),
 k AS (SELECT lang, term, count(*) AS c FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= 3), l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY 1),
 o AS (SELECT w.lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY 1, 2, 3), s AS (SELECT lang, source, sum(c) AS n FROM o GROUP BY 1, 2),
 f AS (SELECT g.lang, g.source, k.term, coalesce(o.c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(o.c, 0) + 1) // (coalesce(s.n, 0) + l.v) AS p, 1 + 1000000000::HUGEINT * (k.c + 1) // (l.n + l.v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
 x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
 y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, cast(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, cast((p - q) * (p - q) // q AS BIGINT) FROM f WHERE c > 0 AND p > q)
 SELECT *, cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM y QUALIFY part = 'pair' OR rank <= 200"""

#: The other operators hash, train, tokenise or cut in ways that SQL can't express: tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_chat": r"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
 e AS (SELECT *, length(regexp_replace(role, '\\|<turn>|<says>|</turn>', '\\\0', 'g')) + length(regexp_replace(text, '\\|<turn>|<says>|</turn>', '\\\0', 'g')) + 19 AS n FROM c)
 SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 cast(sum(n) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id""",
    "op11_quality": _quality_sql(),
    "op12_prefix_trie": _TRIE_SQL.replace("WITH t AS", f"WITH {_CRC_SQL} t AS", 1),
    "op13_divergence": _DIVERGENCE_SQL,
}
