"""The queries of this subpackage, over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    conversation_trie,
    decontaminate,
    exact_dedup,
    fill_in_middle,
    html_extract,
    jaccard_join,
    license_scan,
    lm_score,
    packing,
    pii,
    quality,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_score(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.withColumnRenamed("id", "doc_id")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(
        decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(license_scan.scan(_table(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.withColumnRenamed("id", "doc_id")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    log = chat_format.events_of_turns(given.unionByName(control))
    return chat_format.digests(chat_format.format_chats(log))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(_table(spark, sf_dir, "documents"))
    return fill_in_middle.digests(made).withColumnRenamed("id", "doc_id")


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return conversation_trie.report(conversation_trie.prefixes(conversations, conversation_trie.FAMILY))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(_table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_html_extraction": op2_html_extraction,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_license_scans": op6_license_scans,
    "op7_toxicity": op7_toxicity,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_pii": op13_pii,
}

# The templates' words as SQL rows; the query compares every sentence with every template.
_TEMPLATES = ",\n".join(
    f"('{name}', {license_scan.plain_words(text)!r})" for name, texts in license_scan.LICENSES.items() for text in texts)

SQL: dict[str, str] = {
    "op6_license_scans": rf"""
WITH t AS (SELECT name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
           FROM (VALUES {_TEMPLATES}) AS v(name, w)),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
marked AS (     -- a sign that texts do not hold stands for each border
  SELECT doc_id, regexp_replace(text, '[\n\r]+', chr(1), 'g') AS a, regexp_replace(text, '[\n\r]+', ' ', 'g') AS b FROM d),
s AS (
  SELECT DISTINCT doc_id, unnest(string_split(regexp_replace(x, '([.!?:;])[\x20\x09-\x0D\x01]+', '\1' || chr(1), 'g'), chr(1))) AS s
  FROM (SELECT doc_id, a AS x FROM marked UNION ALL SELECT doc_id, b FROM marked)),
w AS (
  SELECT doc_id, s, list_filter(regexp_split_to_array(
           translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
           lambda x: x <> '') AS w
  FROM s),
g AS (SELECT doc_id, s, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w WHERE len(w) > 1),
c AS (SELECT doc_id, s, name, len(t.g) AS n, 2 * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS dice FROM g, t),
best AS (
  SELECT doc_id, dice, name FROM c WHERE dice >= 0.8
  QUALIFY row_number() OVER (PARTITION BY doc_id, s ORDER BY dice DESC, n DESC, name DESC) = 1),
r AS (
  SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, count(DISTINCT name) AS n, max(dice) AS top,
         min(name) FILTER (dice = m) AS first
  FROM (SELECT *, max(dice) OVER (PARTITION BY doc_id) AS m FROM best) GROUP BY doc_id)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n, 0) AS n_licenses, first AS best_license, top AS best_dice
FROM d LEFT JOIN r USING (doc_id)""",
    "op5_benchmark_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s : s + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, l, array_to_string(w[s : s + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s
        FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)),
hit AS (SELECT doc_id, s, l, item_id FROM dw JOIN iw USING (l, g)),
places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM hit) GROUP BY 1),
names AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(t, ',' ORDER BY t)) AS h
  FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS t FROM hit) GROUP BY 1)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(places.n, 0) AS bigint) AS n_hit,
       cast(coalesce(names.n, 0) AS bigint) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(places.n, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)""",
    "op8_chat_formatting": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<\[\]]', '', 'g')) AS t,
         length(role) + length(regexp_replace(role, '[^\\<\[\]]', '', 'g')) AS r
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(3 + sum(CASE role WHEN 'user' THEN t + 15 WHEN 'assistant' THEN t + 4 ELSE r + t + 16 END) AS bigint) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op9_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS kept, sha256(t) AS text_sha256
FROM n""",
    "op10_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach (doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT b, other FROM reach JOIN links ON a = doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op11_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(cast(doc_id AS varchar), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
r AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::UBIGINT % (len(u) + 1) AS p, ('0x' || h[9:16])::UBIGINT % (len(u) + 1) AS q,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || h[17:24])::UBIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::UBIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
s AS (
  SELECT *, array_to_string(u[1 : least(p, q)], '') AS a, array_to_string(u[least(p, q) + 1 : greatest(p, q)], '') AS b,
         array_to_string(u[greatest(p, q) + 1 : n], '') AS c
  FROM r)
SELECT doc_id, cast(n AS bigint) AS n, form,
       CASE WHEN form <> 'plain' THEN cast(length(a) AS bigint) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN cast(length(b) AS bigint) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
                        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s""",
    # DuckDB has no crc32: it is folded bit by bit over the digits.
    "op12_conversation_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(cast(conv_id AS varchar), ''), lambda x: ascii(x)::BIGINT)),
           lambda crc, x: list_reduce(
             [xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.p, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL SELECT c.conv_id, t.p, t.role, t.text FROM c JOIN t USING (conv_id) WHERE t.p > c.h),
s AS (
  SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY p) FILTER (p IS NOT NULL), []) AS s
  FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id),
m AS (SELECT conv_id, d, s[1 : d] AS k, d = len(s) AS ends FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM s)),
n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n,
         coalesce(string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (ends), '') AS ends,
         (count(*) - 1) * coalesce(len(list_filter(regexp_split_to_array(k[d].text, '[ 	-]+'), lambda x: x <> '')), 0) AS saved
  FROM m GROUP BY k, d),
up AS (SELECT k[1 : d - 1] AS k, d - 1 AS d, count(*) AS n FROM n WHERE d > 0 GROUP BY 1, 2),
full_ AS (SELECT n.*, coalesce(up.n, 0) AS n_children FROM n LEFT JOIN up USING (k, d)),
below AS (
  SELECT k[1 : a] AS k, a AS d, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT k, saved, n_children, unnest(range(0, d + 1)) AS a FROM full_) GROUP BY 1, 2)
SELECT f.conv_id, cast(f.d AS bigint) AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, b.n_leaves,
       cast(b.saved AS bigint) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ f JOIN below b USING (k, d) LEFT JOIN n p ON f.d > 0 AND p.k = f.k[1 : f.d - 1] AND p.d = f.d - 1""",
}
