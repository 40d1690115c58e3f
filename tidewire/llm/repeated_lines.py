"""Problem 1: lines that one source prints in many of its documents.

Method: hash the normalised lines of each document once, count distinct documents per source and hash, keep hashes
above a share of the source's documents, join back, and rebuild documents without those lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.runtime import broadcast_if_small, packed, staged

MIN_DOCS = 5
MIN_SHARE = 0.03
#: Bytes one (source, hash) pair takes in a hash relation, for the size check of the broadcast.
PAIR_BYTES = 96


def normal_lines(text: Column) -> Column:
    """The lines of a text: trimmed, white space of any kind as one space, case folded, runs of digits 0-9 as one sign.

    The whole text is normalised once, then cut at its line feeds.
    """
    spaced = F.regexp_replace(text, r"(?U)[\s\p{Z}&&[^\n]]+", " ")
    folded = F.lower(F.upper(F.regexp_replace(spaced, "[0-9]+", "0")))
    return F.transform(F.split(folded, "\n"), lambda line: F.trim(line))


def line_hashes(text: Column, source: Column) -> Column:
    """The hash of each line between line feeds in order, null for blank lines; null text gives null."""
    return F.transform(normal_lines(text), lambda line: F.when(line != "", F.xxhash64(source, line)))


def frequent_lines(
    docs: DataFrame, id_col: str = "id", source_col: str = "source_id", text_col: str = "content", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE
) -> tuple[DataFrame, DataFrame]:
    """(documents with their line hashes, frequent (source, hash) pairs with their document counts).

    The text is read once; what is staged and shuffled is one array of longs per document. A document contributes
    each hash once, so the count needs no distinct over documents, and a source that holds a third of all rows is
    counted by partial aggregation on every task before anything moves.
    Rows that repeat an id count once. Documents without source or text take no part; empty input gives empty frames.
    """
    lines = (
        docs.filter((F.col(source_col).isNotNull()) & (F.trim(F.col(source_col)) != ""))
        .select(F.col(id_col).alias("id"), F.col(source_col).alias("source_id"), line_hashes(F.col(text_col), F.col(source_col)).alias("hashes"))
        .groupBy("id")
        .agg(F.first("source_id").alias("source_id"), F.first("hashes").alias("hashes"))
    )
    lines = staged(lines, "line_hashes")
    totals = lines.groupBy("source_id").agg(F.count(F.lit(1)).alias("docs_of_source"))
    counts = (
        lines.select("source_id", F.explode(F.array_distinct("hashes")).alias("h"))
        .filter(F.col("h").isNotNull())
        .groupBy("source_id", "h")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
    )
    # in whole numbers, so that a share of exactly the threshold counts
    scale = 1_000_000
    frequent = counts.join(totals, "source_id").filter(F.col("n_docs") * scale >= F.col("docs_of_source") * round(min_share * scale))
    return lines, staged(frequent, "frequent_lines")


def found_lines(docs: DataFrame, **settings: object) -> DataFrame:
    """(id, line_no) of every line repeated excessively in its source; line numbers start at 0."""
    lines, frequent = frequent_lines(docs, **settings)
    rows = lines.select("id", "source_id", F.posexplode("hashes").alias("line_no", "h")).filter(F.col("h").isNotNull())
    pairs = broadcast_if_small(frequent.select("source_id", "h"), PAIR_BYTES)
    return rows.join(pairs, ["source_id", "h"], "left_semi").select("id", F.col("line_no").cast("int").alias("line_no"))


def without_repeated_lines(docs: DataFrame, id_col: str = "id", source_col: str = "source_id", text_col: str = "content", **settings: object) -> DataFrame:
    """Every row of ``docs`` with its text rebuilt without the repeated lines, and ``removed_lines``.

    The lines to drop arrive as one array of line numbers per document. Rows whose text is null or holds no such line
    keep their text unchanged; rows that repeat an id all lose the same lines. Other columns pass through.
    """
    found = found_lines(docs, id_col=id_col, source_col=source_col, text_col=text_col, **settings)
    drops = found.groupBy("id").agg(F.collect_set("line_no").alias("dropped"))
    rows = docs.select(packed(docs), F.col(id_col).alias("id"), F.col(text_col).alias("old"))
    joined = rows.join(drops, "id", "left")
    kept = F.filter(F.split("old", "\n"), lambda _, i: ~F.array_contains("dropped", i))
    return joined.select(
        *[F.col(f"row.`{c}`") for c in docs.columns if c not in (text_col, "removed_lines")],
        F.when(F.col("dropped").isNull(), F.col("old")).otherwise(F.array_join(kept, "\n")).alias(text_col),
        F.coalesce(F.size("dropped"), F.lit(0)).alias("removed_lines"),
    )
