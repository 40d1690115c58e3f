"""Bounded, ordered arrays out of groups."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def bound(value: Column, use) -> Column:  # noqa: ANN001
    """``use(value)`` with ``value`` worked out once, however often it stands in there, also inside of lambdas."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def ordered_array(value: Column, order: list[tuple[Column, bool]], limit: int) -> Column:
    """Aggregate: up to ``limit`` non-null values, ordered by (column, descending) pairs and then by value.

    Use it on groups that are bounded before, as by ``top_n_per_group``; an aggregate array holds its whole group.
    """
    fields = [c.alias(f"k{i}") for i, (c, _) in enumerate(order)]
    item = F.when(value.isNotNull(), F.struct(*fields, value.alias("v")))

    def compare(a: Column, b: Column) -> Column:
        out: Column | None = None
        for i, (_, down) in enumerate(order):
            x, y = a[f"k{i}"], b[f"k{i}"]
            lo, hi = (F.lit(1), F.lit(-1)) if down else (F.lit(-1), F.lit(1))
            # nulls come last either way
            for test, res in ((x.isNull() & y.isNotNull(), F.lit(1)), (x.isNotNull() & y.isNull(), F.lit(-1)), (x < y, lo), (x > y, hi)):
                out = F.when(test, res) if out is None else out.when(test, res)
        rest = F.when(a["v"] < b["v"], -1).when(a["v"] > b["v"], 1).otherwise(0)
        return rest if out is None else out.otherwise(rest)

    return F.transform(F.slice(F.array_sort(F.collect_list(item), compare), 1, limit), lambda x: x["v"])


def distinct_array(value: Column, limit: int) -> Column:
    """Aggregate: up to ``limit`` different non-null values in ascending order."""
    return F.slice(F.array_sort(F.collect_set(value)), 1, limit)


def ordered_distinct(items: Column, limit: int | None = None, key=lambda x: x) -> Column:  # noqa: ANN001
    """The items of an array without those whose key stood before, in order; null items are dropped."""
    kept = F.filter(items, lambda x: x.isNotNull())
    keys = F.transform(kept, key)
    out = F.filter(kept, lambda x, i: F.array_position(keys, key(x)) == i + 1)
    return F.slice(out, 1, limit) if limit else out


def clean_entities(text: Column, limit: int, width: int = 120) -> Column:
    """';'-separated names as an array: ',offset' suffixes dropped, blanks squeezed, case-insensitively distinct, cut."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r",?\d+", "")
    names = F.transform(F.split(plain, ";"), lambda x: F.substring(F.trim(F.regexp_replace(x, r"\s+", " ")), 1, width))
    return ordered_distinct(F.filter(names, lambda x: x != ""), limit, key=F.lower)


def forward_fill(value: Column, order: list[Column], keys: list[Column] | None = None) -> Column:
    """The last non-null value at or before each row."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(w)
