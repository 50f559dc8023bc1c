"""The queries of this subpackage and their independent SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import (
    exact_dedup,
    html_text,
    language_id,
    line_dedup,
    merkle_manifest,
    mixing,
    ngram_join,
    personal_data,
    quality_rules,
    segmentation,
    spelling_variants,
    substring_dedup,
    token_counts,
)
from shopfloor.llm.shared import lower_ascii, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"), keep="largest")


ORACLE_SQL["op1_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM d WINDOW same AS (PARTITION BY text)
"""


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    verdict = quality_rules.quality(table(spark, folder, "documents"))
    return verdict.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"
    )


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mix(table(spark, folder, "documents"), mixing.word_count())
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, folder, "documents"), n=3, percent=90)


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, folder, "documents"), length=50)


@query
def op9_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    samples = segmentation.segmentations(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"), with_ids=False)
    return samples.drop("ids")


@query
def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_texts(table(spark, folder, "pages"))


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    net = language_id.fit(docs.where(~language_id.held_out()))
    kept_out = docs.select("doc_id", language_id.held_out().alias("held_out"), "text")
    predicted = language_id.predict(kept_out.select(F.struct("doc_id", "held_out").alias("doc_id"), "text"), net)
    return predicted.select("doc_id.doc_id", "doc_id.held_out", "lang_pred", "score")


@query
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    field = personal_data.train(personal_data.labelled_table())
    return personal_data.find_personal_data(table(spark, folder, "documents"), field)


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    lowered = merkle_manifest.row_digest(*(lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in fields))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered)
    rows = merkle_manifest.manifest(docs, fields, carry={"tampered": tampered})
    folded = merkle_manifest.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    proven = rows.select("doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(table(spark, folder, "documents"), min_chars=40, min_docs=5)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL["op11_line_dedup"] = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM l
),
common AS (
  SELECT line_key, max(doc_id) AS keep_id FROM k WHERE length(line_key) >= 40
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
  SELECT k.doc_id, k.line, k.place, c.line_key IS NOT NULL AND k.doc_id <> c.keep_id AS dropped
  FROM k LEFT JOIN common c USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

#: CRC-32 of each byte value, from its defining polynomial (a fixed value).
_CRC_TABLE = """
crc AS (
  SELECT list(v ORDER BY i) AS bytes FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
)"""


def _crc32(text: str) -> str:
    codes = f"list_transform(range(strlen({text})), lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: xor(c >> 8, crc.bytes[(xor(c, b) & 255) + 1])), 4294967295)"


def _row_digest_sql(text: str) -> str:
    values = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes of all levels over ``leaves`` (tree, r, n, h): the level, the place on it, the nodes there, the digest."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, r, n, h FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, r // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY r))
  FROM {name} WHERE n > 1 GROUP BY tree, level, r // 8, n
)"""


def _walk_sql(name: str, start: str, nodes: str) -> str:
    """From the rows of ``start`` up the tree: the siblings met so far, and the digest folded so far."""
    return f"""
{name} AS (
  SELECT id, tree, 0 AS level, r, n, proof, h FROM {start}
  UNION ALL
  SELECT w.id, w.tree, w.level + 1, w.r // 8, (w.n + 7) // 8,
         w.proof || coalesce(string_agg(s.h, '' ORDER BY s.r) FILTER (WHERE s.r <> w.r), ''),
         sha256(string_agg(CASE WHEN s.r = w.r THEN w.h ELSE s.h END, '' ORDER BY s.r))
  FROM {name} w JOIN {nodes} s ON s.tree = w.tree AND s.level = w.level AND s.r // 8 = w.r // 8
  WHERE w.n > 1 GROUP BY w.id, w.tree, w.level, w.r, w.n, w.proof, w.h
)"""


ORACLE_SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_row_digest_sql("text")} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0
              THEN {_row_digest_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents, crc
),
ranked AS (
  SELECT *, leaf AS h, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS id
  FROM d
),
{_tree_sql("nodes", "ranked")},
tops AS (
  SELECT '' AS tree, tree AS lang_tree, h, row_number() OVER (ORDER BY tree) - 1 AS r, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
{_tree_sql("top_nodes", "tops")},
climb_start AS (SELECT id, tree, r, n, '' AS proof, coalesce(tampered, leaf) AS h FROM ranked),
{_walk_sql("climb", "climb_start", "nodes")},
top_start AS (
  SELECT c.id, '' AS tree, t.r, t.n, c.proof, c.h FROM climb c JOIN tops t ON t.lang_tree = c.tree WHERE c.n = 1
),
{_walk_sql("top_climb", "top_start", "top_nodes")}
SELECT k.doc_id, k.leaf, t.h AS subroot, root.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = root.h AS verified
FROM ranked k JOIN tops t ON t.lang_tree = k.tree JOIN top_climb c ON c.id = k.id AND c.n = 1
CROSS JOIN (SELECT h FROM top_nodes WHERE n = 1) root
"""


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    runs = spelling_variants.word_runs(table(spark, folder, "documents"), min_chars=7)
    runs = runs.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    words = runs.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelling_variants.spelling_forms(spelling_variants.count_words(words, min_chars=7, min_count=2), ratio=10)


ORACLE_SQL["op13_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_TABLE},
lowered AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]{{7,}}')) AS run FROM lowered),
hashed AS (
  SELECT run, copies, {_crc32("keyed")} AS h
  FROM (SELECT run, count(*) AS copies, coalesce(doc_id::VARCHAR, '') || ':' || run AS keyed FROM runs GROUP BY doc_id, run), crc
),
cut AS (
  SELECT copies, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed
),
v AS (SELECT word, sum(copies)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(copies) >= 2),
holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, a.n, v.word, v.n FROM holes a JOIN v ON a.rest = v.word
  UNION
  SELECT v.word, v.n, a.word, a.n FROM holes a JOIN v ON a.rest = v.word
),
best AS (
  SELECT word, count(*) AS n_near, min({{'less': -near_n, 'form': near}}) FILTER (WHERE near_n >= 10 * n) AS b FROM pairs GROUP BY word
),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, b.form AS form, -b.less AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at_word, form AS next FROM forms
  UNION ALL
  SELECT w.word, w.next, f.form FROM walk w JOIN forms f ON f.word = w.next
)
SELECT f.word, f.form, w.at_word AS root, f.n, f.n_near, f.form_n FROM forms f JOIN walk w ON w.word = f.word AND w.next IS NULL
"""
