"""Every operator on empty tables, nulls in all columns, repeated rows, long texts and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from tidewire.llm import capping, leaks, main_body, mixing, mojibake, repeated_lines, residue, shared_spans, visual_forms

ARTS = "id string, source_id string, title string, content string, raw_path string, quality_score double"
DOCS = "doc_id long, text string, source string"
CLASH = ["n", "h", "hashes", "_id", "_drop", "line_no", "record", "contributor", "score", "place", "field", "look", "exact", "word", "kind", "original", "labels", "keys", "chars", "tokens", "pattern", "pos", "digest", "lo", "hi", "_rank", "_piece", "_w", "kept", "m"]


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH if c not in df.columns})


@pytest.fixture(scope="module")
def arts(spark):
    long = "dòng rất dài " * 30_000
    rows = [("1", "s", "t", "a\nb", "p", 1.0), ("1", "s", "t", "a\nb", "p", 1.0), (None, None, None, None, None, None), ("2", "", "", "", "", None), ("3", "s", None, long, None, None), ("4", None, "​", " \n \n", "p", 2.0), ("5", "s", "t", "\n", None, float("nan"))]
    return clashing(spark.createDataFrame(rows, ARTS))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "a b c " * 400, "s"), (1, "a b c " * 400, "s"), (None, None, None), (2, "", "s"), (3, None, "s"), (4, "x" * 300_000, None), (5, "one two three " * 60, "r")]
    return clashing(spark.createDataFrame(rows, DOCS))


ON_ARTS = {
    "found_lines": repeated_lines.found_lines,
    "without_repeated_lines": repeated_lines.without_repeated_lines,
    "lookalike_pairs": lambda d: visual_forms.lookalike_pairs(d, ["title", "content"]),
    "in_one_form": lambda d: visual_forms.in_one_form(d, ["title", "content"]),
    "furniture_lines": lambda d: main_body.furniture_lines(d, d.select("raw_path", F.col("content").alias("html"))),
    "main_bodies": lambda d: main_body.main_bodies(d),
    "page_bodies": lambda d: main_body.page_bodies(d.select("raw_path", F.col("content").alias("html"))),
    "capped": lambda d: capping.capped(d, share=0.3),
    "garbled_fields": lambda d: mojibake.garbled_fields(d, ["title", "content"]),
    "restored": lambda d: mojibake.restored(d, ["title", "content"]),
    "residue_ids": residue.residue_ids,
    "without_residue": residue.without_residue,
}


@pytest.mark.parametrize("name", ON_ARTS)
def test_articles(arts, name):
    full, none = ON_ARTS[name](arts), ON_ARTS[name](arts.limit(0))
    full.collect()
    assert none.count() == 0
    assert none.columns == full.columns


ON_DOCS = {
    "leaked_items": lambda d, spark: leaks.leaked_items(d, spark.createDataFrame([(1, "one two three " * 10), (2, None), (3, ""), (None, "a b c " * 9)], "item_id long, text string")),
    "no_items": lambda d, spark: leaks.leaked_items(d, spark.createDataFrame([], "item_id long, text string")),
    "shared_pairs": lambda d, spark: shared_spans.shared_pairs(d),
    "shared_parts": lambda d, spark: shared_spans.shared_parts(d),
    "mixed": lambda d, spark: mixing.mixed(d, spark.createDataFrame([("s", 0.5, 2), ("r", 0.5, 3), ("none", 0.1, 1), (None, None, None)], "source string, target_share double, max_repeats int")),
    "no_targets": lambda d, spark: mixing.mixed(d, spark.createDataFrame([], "source string, target_share double, max_repeats int")),
}


@pytest.mark.parametrize("name", ON_DOCS)
def test_documents(spark, docs, name):
    full, none = ON_DOCS[name](docs, spark), ON_DOCS[name](docs.limit(0), spark)
    full.collect()
    assert none.count() == 0
    assert none.columns == full.columns


def test_every_column_null(spark):
    rows = spark.createDataFrame([(None,) * 6] * 3, ARTS)
    for name, run in ON_ARTS.items():
        assert run(rows).filter("false").count() == 0, name
    docs = spark.createDataFrame([(None,) * 3] * 3, DOCS)
    for run in ON_DOCS.values():
        assert run(docs, spark).count() == 0
