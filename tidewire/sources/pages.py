"""Saved pages, feeds and sitemaps as rows."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import markup, urls
from tidewire.operators.ranking import top_n_per_group

_SPACE = re.compile(r"\s+")


def squeezed(text: str) -> str:
    return _SPACE.sub(" ", text).strip()


def paragraphs(pages: DataFrame, key: str, page: str, least: int = 40) -> DataFrame:
    """(key, title, paragraphs) for each page; null and empty pages give an empty title and no paragraphs."""
    return pages.select(F.col(key), markup.title(F.col(page)).alias("title"), markup.paragraphs(F.col(page), least).alias("paragraphs"))


def snippets(pages: DataFrame, key: str, page: str, first: int = 3, most: int = 600) -> DataFrame:
    """(key, title, snippet): the first paragraphs of each page in at most ``most`` characters."""
    held = paragraphs(pages, key, page)
    return held.select(key, "title", markup.snippet(F.col("paragraphs"), first, most).alias("snippet"))


def internal_links(pages: DataFrame, key: str, base: str, page: str, cap: int = 200) -> DataFrame:
    """(key, pos, link): links of a page to its own host, absolute, without fragment, each once at its first place, ``cap`` at most."""
    hrefs = F.regexp_extract_all(F.col(page), F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"'#\s]+)"""), F.lit(1))
    site = F.concat(F.regexp_extract(F.col(base), r"^([A-Za-z]+://)", 1), urls.host(F.col(base)))
    absolute = F.when(F.col("h").startswith("//"), F.concat(F.regexp_extract(F.col(base), r"^([A-Za-z]+:)", 1), "h")).when(F.col("h").startswith("/"), F.concat(site, "h")).otherwise(F.col("h"))
    rows = pages.select(F.col(key).alias("_key"), F.col(base), F.posexplode(hrefs).alias("pos", "h"))
    rows = rows.select("_key", F.col("pos"), absolute.alias("link"), urls.host(F.col(base)).alias("_host")).filter(F.col("link").rlike("^https?://") & (urls.host(F.col("link")) == F.col("_host")))
    first = rows.groupBy("_key", "link").agg(F.min("pos").alias("pos"))
    return top_n_per_group(first, ["_key"], [F.col("pos").asc()], cap).select(F.col("_key").alias(key), "pos", "link")


def _local(tag: object) -> str:
    return str(tag).rpartition("}")[2].lower()


def _text(node: ElementTree.Element | None) -> str | None:
    return squeezed("".join(node.itertext())) or None if node is not None else None


def _parsed(body: bytes | str | None) -> ElementTree.Element | None:
    """The document's root; gzip is unpacked by its first bytes. Broken XML, null and entity tricks give none."""
    if not body:
        return None
    raw = body.encode() if isinstance(body, str) else bytes(body)
    if raw[:2] == b"\x1f\x8b":
        try:
            raw = gzip.decompress(raw)
        except OSError:
            return None
    if b"<!ENTITY" in raw:
        return None
    try:
        return ElementTree.fromstring(raw)
    except ElementTree.ParseError:
        return None


def feed_entries(body: bytes | str | None, limit: int = 100) -> list[tuple[str, str | None, str | None, str | None]]:
    """(link, title, published else updated, summary) of RSS items or Atom entries that have a link."""
    root, out = _parsed(body), []
    for node in root.iter() if root is not None else ():
        if _local(node.tag) not in ("item", "entry"):
            continue
        got: dict[str, ElementTree.Element] = {}
        for child in node:
            got.setdefault(_local(child.tag), child)
        link = got.get("link")
        href = (_text(link) or link.get("href", "").strip()) if link is not None else ""
        when = next((_text(got[k]) for k in ("pubdate", "published", "date", "updated") if k in got), None)
        summary = next((_text(got[k]) for k in ("encoded", "content", "summary", "description") if k in got), None)
        if href:
            out.append((href, _text(got.get("title")), when, squeezed(re.sub(r"<[^>]+>", " ", summary)) if summary else None))
        if len(out) >= limit:
            break
    return out


def sitemap_entries(body: bytes | str | None) -> list[tuple[str, str | None, bool]]:
    """(loc, lastmod, is a sitemap itself) of a url set or a sitemap index, plain or gzip."""
    root, out = _parsed(body), []
    for node in root.iter() if root is not None else ():
        kind = _local(node.tag)
        if kind not in ("url", "sitemap"):
            continue
        got = {_local(c.tag): _text(c) for c in node}
        if got.get("loc"):
            out.append((got["loc"], got.get("lastmod"), kind == "sitemap"))
    return out


def feed_rows(bodies: DataFrame, key: str, body: str, limit: int = 100) -> DataFrame:
    """(key, link, title, published, summary) for each entry of each stored feed."""
    return _exploded(bodies, key, body, lambda b: feed_entries(b, limit), "link string, title string, published string, summary string")


def sitemap_rows(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """(key, loc, lastmod, nested) for each entry of each stored sitemap."""
    return _exploded(bodies, key, body, sitemap_entries, "loc string, lastmod string, nested boolean")


def _exploded(bodies: DataFrame, key: str, body: str, parse, fields: str) -> DataFrame:  # noqa: ANN001
    names = [f.split()[0] for f in fields.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *r) for k, b in zip(batch["_key"], batch["_body"], strict=True) for r in parse(b)]
            yield pd.DataFrame(rows, columns=["_key", *names])

    rows = bodies.select(F.col(key).alias("_key"), F.col(body).alias("_body"))
    return rows.mapInPandas(read, f"_key {dict(rows.dtypes)['_key']}, {fields}").withColumnRenamed("_key", key)
