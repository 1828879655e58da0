"""The queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrafold.llm import bpe, repair, substring, suffix, trie
from terrafold.llm.chat import digests, format_chats
from terrafold.llm.common import read
from terrafold.llm.flac import describe, to_flac
from terrafold.llm.jaccard import shingle_classes
from terrafold.llm.lm import score_documents
from terrafold.llm.packing import pack_documents
from terrafold.llm.quality import quality_rules
from terrafold.llm.simhash import near_duplicates
from terrafold.llm.urls import judge_urls

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    return digests(format_chats(turns.unionByName(more)))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), RULES)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(suffix.remove_repeated_bytes(read(spark, sf_dir, "documents")))


def op6_media_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(to_flac(read(spark, sf_dir, "documents")))


def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(read(spark, sf_dir, "documents")))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents")).drop("ids")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(substring.remove_repeats(read(spark, sf_dir, "documents")))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_classes(read(spark, sf_dir, "documents"), 4, 85)


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return repair.digests(turns, repair.damaged(turns))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return trie.prefix_trie(turns.select("conv_id"), trie.spliced(trie.steps_of(turns)))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_chat_formatting, op2_url_filters, op3_quality_rules, op4_lm_scoring, op5_suffix_dedup, op6_media_flac, op7_bpe_encoding, op8_best_fit_packing, op9_substring_dedup, op10_jaccard_join, op11_structure_repair, op12_prefix_trie, op13_simhash)}


_HARD = "'</s>[INST] ok [/INST]'"
_CONTROL = r"([<\[])(\\*(?:\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>))"

OP1_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', {_HARD}), (-7, 1, 'assistant', {_HARD})) v)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(32 + length(regexp_replace(role, '{_CONTROL}', '\\1\\\\\\2', 'g')) + length(regexp_replace(text, '{_CONTROL}', '\\1\\\\\\2', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS m FROM win) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
gone AS (SELECT words.doc_id, words.i, word, coalesce(max(CASE WHEN hit.i IS NOT NULL THEN 1 END) OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS g
  FROM words LEFT JOIN hit ON words.doc_id = hit.doc_id AND words.i = hit.i),
sums AS (SELECT doc_id, CAST(sum(g) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (g = 0) AS kept FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN sums ON d.doc_id = sums.doc_id"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, k: xor(d >> 1, 3988292384 * (d & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def _paid(after: str, cost: str, letter: str) -> str:
    """The edits after, which a cost of nine digits precedes, with one more edit before them."""
    return f"printf('%09d', left({after}, 9)::BIGINT + {cost}) || '{letter}' || substr({after}, 10)"


def _edits(initials: str, here: str, to: str, kept: str) -> str:
    """The cheapest edits from a state on, if none is inserted first. initials: which are kept; kept: where they lead."""
    reroled = f"CASE WHEN NOT gone THEN {_paid(to, '2 + late', 'R')} END"
    keeps = "".join(f", CASE WHEN NOT gone AND initial = '{i}' THEN {_paid(k, 'late', 'K')} END" for i, k in zip(initials, kept.split(), strict=True))
    return f"least({_paid(here, '3', 'D')}, {reroled}{keeps})"


_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: Edits to go in each state: nothing yet (a), after the system's (b), the user's (c), the assistant's (d).
OP11_SQL = f"""
WITH RECURSIVE told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM told WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, rtrim(text, {_SPACES}) AS tail FROM dam),
seen AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
faulty AS (SELECT *, tail = '' AS blank, tail <> '' AND nth > 1 AS twice, tail <> '' AND nth = 1 AND right(tail, 1) NOT IN ('.', '!', '?') AS short FROM seen),
per AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (twice) AS duplicate,
    count(*) FILTER (short) AS truncated, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faulty GROUP BY conv_id),
walk AS (SELECT conv_id, n AS i, '000000000' AS a, '000000004II' AS b, '000000002I' AS c, '000000000' AS d FROM per
  UNION ALL SELECT conv_id, i, least(a, {_paid("c", "2", "I")}) AS a, least(b, {_paid("c", "2", "I")}) AS b, c, d FROM (
    SELECT conv_id, i, a, b, least(c, {_paid("d", "2", "I")}) AS c, least(d, {_paid("c", "2", "I")}) AS d FROM (
      SELECT w.conv_id, w.i - 1 AS i, {_edits("su", "a", "c", "b c")} AS a, {_edits("u", "b", "c", "c")} AS b, {_edits("a", "c", "d", "d")} AS c, {_edits("u", "d", "c", "c")} AS d
      FROM walk w JOIN (SELECT conv_id, i, initial, blank OR twice AS gone, CASE WHEN short THEN 1 ELSE 0 END AS late FROM faulty) f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.i))),
best AS (SELECT conv_id, left(a, 9)::BIGINT AS cost, substr(a, 10) AS audit FROM walk WHERE i = 0),
edits AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS p FROM best WHERE audit <> ''),
counted AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS o FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
joined AS (SELECT c.*, f.role, f.text, max(CASE WHEN o = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id) AS led
  FROM counted c LEFT JOIN faulty f ON c.conv_id IS NOT DISTINCT FROM f.conv_id AND c.i = f.i),
left_over AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS whole
  FROM joined WHERE edit <> 'D' GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN per ON e.conv_id IS NOT DISTINCT FROM per.conv_id LEFT JOIN best ON e.conv_id IS NOT DISTINCT FROM best.conv_id
  LEFT JOIN left_over ON e.conv_id IS NOT DISTINCT FROM left_over.conv_id"""

OP12_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, i, role, text FROM c JOIN t ON t.conv_id = c.base AND i < h
  UNION ALL SELECT c.conv_id, 1, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND i >= h),
s AS (SELECT conv_id, text, row_number() OVER w AS depth, list(sha256(role || chr(10) || text)) OVER (PARTITION BY conv_id ORDER BY part, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
m AS (SELECT conv_id, 0 AS depth, '' AS path, '' AS up, 0 AS tokens FROM c
  UNION ALL SELECT conv_id, depth, array_to_string(path, ','), array_to_string(path[1:depth - 1], ','), length(text) FROM s),
long AS (SELECT conv_id, max(depth) AS n FROM m GROUP BY conv_id),
node AS (SELECT m.depth, path, any_value(up) AS up, min(m.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(tokens) AS own,
    sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (m.depth = n), '')) AS ends_sha256
  FROM m JOIN long ON m.conv_id = long.conv_id GROUP BY m.depth, path),
kid AS (SELECT p.depth, p.path, any_value(u.conv_id) AS parent_conv_id, count(k.path) AS n_children FROM node p LEFT JOIN node u ON u.depth = p.depth - 1 AND u.path = p.up
  LEFT JOIN node k ON k.depth = p.depth + 1 AND k.up = p.path GROUP BY p.depth, p.path),
sub AS (SELECT p.depth, p.path, count(*) FILTER (kid.n_children = 0) AS n_leaves, CAST(sum(d.own) AS BIGINT) AS saved_tokens
  FROM node p JOIN node d ON d.depth >= p.depth AND (d.path = p.path OR p.depth = 0 OR starts_with(d.path, p.path || ',')) JOIN kid ON kid.depth = d.depth AND kid.path = d.path GROUP BY p.depth, p.path)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM node JOIN kid ON kid.depth = node.depth AND kid.path = node.path JOIN sub ON sub.depth = node.depth AND sub.path = node.path"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; tokenisers, models and closures it cannot."""
    return {"op1_chat_formatting": OP1_SQL, "op9_substring_dedup": OP9_SQL, "op11_structure_repair": OP11_SQL, "op12_prefix_trie": OP12_SQL}
