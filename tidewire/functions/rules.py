"""Rule tables as column expressions: signals, first-match labels, flags, and weighted scores.

A rule table is data: named patterns or conditions, given by the caller. The same strings can build a SQL text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hint_text(*parts: Column) -> Column:
    """Upper-case text of all parts with single blanks between; a null part counts as empty, so no word moves."""
    padded: list[Column] = []
    for p in parts:
        padded += [F.coalesce(p, F.lit("")), F.lit(" ")]
    return F.upper(F.concat(*padded[:-1]))


def signals(text: Column, patterns: Mapping[str, str]) -> dict[str, Column]:
    """One boolean column for each pattern; null text matches none."""
    return {name: F.coalesce(text.rlike(p), F.lit(False)).alias(name) for name, p in patterns.items()}


def first_label(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The label of the first rule that is true; a null condition is not true."""
    out: Column | None = None
    for condition, label in rules:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def flags(rules: Sequence[tuple[Column, str]]) -> Column:
    """The labels of all true rules, in the rules' order; an empty array if none is true."""
    return F.filter(F.array(*[F.when(c, F.lit(label)) for c, label in rules]).cast("array<string>"), lambda x: x.isNotNull())


def weighted(rules: Sequence[tuple[Column, int]]) -> Column:
    """The sum of the weights of the true rules."""
    total = F.lit(0)
    for condition, weight in rules:
        total = total + F.when(condition, weight).otherwise(0)
    return total


def bins(value: Column, edges: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first edge that ``value`` is at or below; null gives null."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in edges:
        out = out.when(value <= edge, label)
    return out.otherwise(otherwise)


def substring_score(text: Column, weights: Mapping[str, int], repeats: bool = False) -> Column:
    """Sum of the weights of the substrings that the lower-case text holds, once each; every occurrence with ``repeats``."""
    low, total = F.lower(F.coalesce(text, F.lit(""))), F.lit(0)
    for needle, weight in weights.items():
        times = F.regexp_count(low, F.lit(_quoted(needle))) if repeats else low.contains(needle).cast("int")
        total = total + times * weight
    return total


def _quoted(s: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in s)
