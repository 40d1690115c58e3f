"""Validation rules as frames of violations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition that a row must meet; one that is null counts as met unless ``strict``."""

    name: str
    holds: Column
    strict: bool = False


def violations(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """(key, rule) for each row and rule it breaks, in one pass over the rows."""
    broken = [F.when(~F.coalesce(r.holds, F.lit(not r.strict)), F.lit(r.name)) for r in rules]
    names = F.filter(F.array(*broken).cast("array<string>"), lambda x: x.isNotNull())
    return df.select(F.col(key), F.explode(names).alias("rule"))


def repeated_values(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """(key, rule) of the rows whose value another key has too; null values are no repeats."""
    rows = df.select(F.col(key), value.alias("v")).filter(F.col("v").isNotNull()).distinct()
    many = rows.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v")
    return rows.join(many, "v", "left_semi").select(key, F.lit(name).alias("rule"))


def unknown_values(df: DataFrame, key: str, value: Column, known: DataFrame, name: str) -> DataFrame:
    """(key, rule) of the rows whose value is not in the one column of ``known``; null values are not asked for."""
    rows = df.select(F.col(key), value.alias("v")).filter(F.col("v").isNotNull()).distinct()
    return rows.join(known.toDF("v").distinct(), "v", "left_anti").select(key, F.lit(name).alias("rule"))


def window_gate(counts: DataFrame, columns: Sequence[str], least: int) -> DataFrame:
    """One row: ``passed`` where any of the counts reaches ``least``, and the largest of them."""
    top = F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in columns])
    return counts.select((top >= least).alias("passed"), top.alias("most"))


def thin_groups(df: DataFrame, group: str, wanted: DataFrame, least: int) -> DataFrame:
    """(group, n) for every wanted group with fewer than ``least`` rows, those without any too."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return wanted.select(group).distinct().join(counts, group, "left").select(group, F.coalesce("n", F.lit(0)).alias("n")).filter(F.col("n") < least)
