"""Queries of the training-text operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import capping, leaks, main_body, mixing, mojibake, repeated_lines, residue, shared_spans, visual_forms
from tidewire.operators.ranking import one_row_each
from tidewire.runtime import table


def _articles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row for each article, the copy extracted last."""
    return one_row_each(table(spark, sf_dir, "articles").select("id", "extracted_at", *columns), "id", "extracted_at").select("id", *columns)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines.found_lines(table(spark, sf_dir, "articles"))


def p1_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = _articles(spark, sf_dir, "source_id", "content")
    return repeated_lines.without_repeated_lines(arts).select("id", "content", "removed_lines")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual_forms.lookalike_pairs(table(spark, sf_dir, "articles"), ["title", "content"])


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual_forms.lookalike_classes(table(spark, sf_dir, "articles"), ["title", "content"])


def p2_one_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = _articles(spark, sf_dir, "title", "content")
    return visual_forms.in_one_form(arts, ["title", "content"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_body.furniture_lines(table(spark, sf_dir, "articles"), table(spark, sf_dir, "raw_pages"))


def p3_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_body.main_bodies(_articles(spark, sf_dir, "content", "raw_path"), table(spark, sf_dir, "raw_pages"))


def p3_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_body.page_bodies(table(spark, sf_dir, "raw_pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capping.capped(table(spark, sf_dir, "articles")).filter(~F.col("kept")).select("id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.garbled_fields(table(spark, sf_dir, "articles"), ["title", "content"]).select("id", "field")


def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = _articles(spark, sf_dir, "title", "content")
    return mojibake.restored(arts, ["title", "content"])


def p6_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many fields have an original that the table verified, and how many are known by their bytes alone."""
    found = mojibake.garbled_fields(table(spark, sf_dir, "articles"), ["title", "content"])
    return found.groupBy("field", "tier").agg(F.count(F.lit(1)).alias("n"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue_ids(table(spark, sf_dir, "articles"))


def p7_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = _articles(spark, sf_dir, "content", "content_length")
    return residue.without_residue(arts)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares_reached(p9_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p10_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans.shared_parts(table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans.shared_pairs(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(v)}


#: White space of any kind, as a class RE2 knows.
_WS = r"[\s\x{0085}\x{000B}\x{001C}-\x{001F}\p{Z}]+"
_P1_LINES = rf"""
WITH arts AS (SELECT DISTINCT id, source_id, content FROM articles WHERE source_id IS NOT NULL AND trim(source_id) <> ''),
rows_ AS (SELECT id, source_id, string_split(content, chr(10)) AS ls FROM arts),
lines AS (SELECT id, source_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM rows_),
keyed AS (SELECT id, source_id, line_no, line,
  lower(upper(regexp_replace(trim(regexp_replace(line, '{_WS}', ' ', 'g')), '[0-9]+', '0', 'g'))) AS k FROM lines),
totals AS (SELECT source_id, count(DISTINCT id) AS n FROM arts GROUP BY source_id),
often AS (SELECT source_id, k FROM keyed JOIN totals USING (source_id) WHERE k <> '' GROUP BY source_id, k, n
  HAVING count(DISTINCT id) >= 5 AND count(DISTINCT id) * 100 >= 3 * n)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _P1_LINES + "SELECT DISTINCT id, CAST(line_no AS INTEGER) AS line_no FROM keyed JOIN often USING (source_id, k)",
        "p1_cleaned": _P1_LINES + """, drops AS (SELECT id, list(DISTINCT line_no) AS gone FROM keyed JOIN often USING (source_id, k) GROUP BY id),
every AS (SELECT DISTINCT id, content FROM articles)
SELECT e.id, CASE WHEN gone IS NULL THEN content ELSE array_to_string(list_filter(string_split(content, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS content,
  CAST(coalesce(len(gone), 0) AS INTEGER) AS removed_lines FROM every e LEFT JOIN drops d ON e.id = d.id""",
        "p8_found": r"""
WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{Nd}]+') AS w FROM documents WHERE doc_id IS NOT NULL),
i AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{Nd}]+') AS w FROM eval_items),
dg AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d)),
ig AS (SELECT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
        "p10_found": """
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) >= 500),
w AS (SELECT doc_id, substr(text, k, 500) AS s FROM (SELECT doc_id, text, unnest(range(1, length(text) - 498)) AS k FROM d)),
h AS (SELECT DISTINCT doc_id, hash(s) AS h, md5_number_lower(s) AS m FROM w),
many AS (SELECT h, m FROM h GROUP BY h, m HAVING count(*) > 1), kept AS (SELECT doc_id, h, m FROM h SEMI JOIN many USING (h, m))
SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM kept a JOIN kept b USING (h, m) WHERE a.doc_id < b.doc_id""",
        "p10_shared": """
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) >= 500),
h AS (SELECT doc_id, k, hash(substr(text, k, 500)) AS h, md5_number_lower(substr(text, k, 500)) AS m FROM (SELECT doc_id, text, unnest(range(1, length(text) - 498)) AS k FROM d)),
many AS (SELECT h, m FROM h GROUP BY h, m HAVING count(DISTINCT doc_id) > 1), kept AS (SELECT doc_id, k FROM h SEMI JOIN many USING (h, m)),
c AS (SELECT doc_id, least(500, coalesce(lead(k) OVER (PARTITION BY doc_id ORDER BY k) - k, 500)) AS n FROM kept), s AS (SELECT doc_id, sum(n)::BIGINT AS shared_chars FROM c GROUP BY doc_id)
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, shared_chars, round(shared_chars / length(text), 6) AS share FROM s JOIN d USING (doc_id)""",
        "p4_found": """
WITH a AS (SELECT DISTINCT id, source_id, quality_score FROM articles),
r AS (SELECT id, row_number() OVER (PARTITION BY source_id ORDER BY quality_score DESC NULLS LAST, id) AS rn
      FROM a WHERE source_id IS NOT NULL AND trim(source_id) <> '')
SELECT id FROM r WHERE rn > (SELECT count(DISTINCT id) * 2 // 100 FROM articles)""",
    }
