"""JSON records of several sources as rows of one schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def uniform_rows(raw: DataFrame, body: str, schema: str, fields: Mapping[str, str], common: Mapping[str, str]) -> DataFrame:
    """One row of the ``common`` schema (name: type) for each JSON record of a lane.

    ``fields`` gives the SQL expression over the lane's parsed ``r`` for each common column; the others are null, and text
    is trimmed with blanks as null. Broken JSON gives no row. Lanes made this way union by name.
    """
    parsed = raw.select(F.from_json(F.col(body), schema, {"mode": "PERMISSIVE"}).alias("r")).filter(F.col("r").isNotNull())
    names = [p.strip().split()[0].strip("`") for p in _top_level(schema)]
    parsed = parsed.filter(F.coalesce(*[F.col(f"r.`{n}`").cast("string") for n in names]).isNotNull())
    cells = []
    for name, kind in common.items():
        c = F.expr(fields[name]).try_cast(kind) if name in fields else F.lit(None).cast(kind)
        cells.append((F.nullif(F.trim(c), F.lit("")) if kind == "string" else c).alias(name))
    return parsed.select(*cells)


def _top_level(schema: str) -> list[str]:
    """The columns of a DDL schema, split at commas outside of angle brackets."""
    out, depth, part = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += c
    return [*out, part]


def fenced_json(text: str = "text", schema: str = "map<string,string>"):  # noqa: ANN201
    """The first JSON object of a text that may hold it in a fence, parsed; null where there is none."""
    inner = F.coalesce(F.nullif(F.regexp_extract(F.col(text), r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit("")), F.nullif(F.regexp_extract(F.col(text), r"(?s)(\{.*\})", 1), F.lit("")))
    return F.from_json(inner, schema)


def json_strings(column: str):  # noqa: ANN201
    """A JSON list in text as an array of strings; null, broken and other JSON give an empty array."""
    return F.coalesce(F.from_json(F.col(column), "array<string>"), F.array().cast("array<string>"))
