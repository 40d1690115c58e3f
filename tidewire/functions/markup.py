"""Text out of page mark-up as column expressions, so that pages are read without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.arrays import bound

#: Parts of a page that nobody reads.
UNSEEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<svg\b.*?</svg\s*>|<!--.*?-->"
OPENS = r"(?i)<(?:p|h[1-3]|li)(?:\s[^>]*)?>"
CLOSES = r"(?i)</(?:p|h[1-3]|li)\s*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title"
META = r"(?is)<meta\s[^>]*>"
DESCRIBES = r"""(?is)\s(?:name|property)\s*=\s*["']?(?:og:)?description["'\s/>]"""
CONTENT = r"""(?is)\scontent\s*=\s*"([^"]*)"|\scontent\s*=\s*'([^']*)'"""
#: Named entities that texts use; others stay as they are written.
ENTITIES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "hellip": "…", "bull": "•", "middot": "·", "copy": "©", "reg": "®", "trade": "™", "euro": "€", "laquo": "«", "raquo": "»", "deg": "°",
}
_OPEN, _CLOSE = "\u0001", "\u0002"


def squeezed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\s\x{00A0}]+", " "))


def _numbered(text: Column, pattern: str, base: int) -> Column:
    """Numeric entities of one base as their characters; numbers beyond the first plane stay."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    def put(acc: Column, entity: Column) -> Column:
        code = F.conv(F.regexp_extract(entity, r"&#x?([0-9a-f]+);", 1) if base == 10 else F.regexp_extract(entity, r"(?i)&#x([0-9a-f]+);", 1), base, 16)
        char = F.decode(F.unhex(F.lpad(code, 4, "0")), "UTF-16BE")
        return F.when((F.length(code) <= 4) & ~code.rlike("^0*D[89A-F]"), F.replace(acc, entity, char)).otherwise(acc)

    return F.aggregate(found, text, put)


def unescaped(text: Column) -> Column:
    """Entities as their characters; texts without any are passed on untouched."""

    def resolved(t: Column) -> Column:
        out = bound(bound(t, lambda x: _numbered(x, r"&#[0-9]{1,7};", 10)), lambda x: _numbered(x, r"(?i)&#x[0-9a-f]{1,6};", 16))
        for name, sign in ENTITIES.items():
            out = F.replace(out, F.lit(f"&{name};"), F.lit(sign))
        return F.when(t.contains("&"), F.replace(out, F.lit("&amp;"), F.lit("&"))).otherwise(t)

    return bound(text, resolved)


def plain(markup: Column) -> Column:
    """The text between the tags, entities resolved, blanks squeezed."""
    return squeezed(unescaped(F.regexp_replace(markup, "(?s)<[^>]*>", " ")))


def title(page: Column) -> Column:
    """The page's title; '' where it has none or is null."""
    return plain(F.regexp_extract(F.coalesce(page, F.lit("")), TITLE, 1))


def description(page: Column) -> Column:
    """The first meta description; '' where there is none."""
    tags = F.filter(F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(META), F.lit(0)), lambda x: x.rlike(DESCRIBES))
    quoted = lambda tag: F.concat(F.regexp_extract(tag, CONTENT, 1), F.regexp_extract(tag, CONTENT, 2))
    return squeezed(unescaped(bound(F.coalesce(F.get(tags, F.lit(0)), F.lit("")), quoted)))


def block_texts(page: Column) -> Column:
    """The texts of the paragraphs, headings and list items of a page, in order; an inner block ends the outer one's text."""
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(page, F.lit("")), UNSEEN, " "), OPENS, _OPEN), CLOSES, _CLOSE)
    inner = bound(F.split(marked, _OPEN), lambda pieces: F.slice(pieces, F.lit(2), F.size(pieces)))
    return F.transform(inner, lambda x: plain(F.substring_index(x, _CLOSE, 1)))


def paragraphs(page: Column, least: int = 40) -> Column:
    """Blocks of at least ``least`` characters, each once whatever its case; where there are none, the description."""
    once = lambda long: bound(F.transform(long, lambda x: F.lower(x)), lambda low: F.filter(long, lambda x, i: F.array_position(low, F.lower(x)) == i + 1))
    kept = bound(F.filter(block_texts(page), lambda x: F.length(x) >= least), once)
    about = lambda d: F.when(d != "", F.array(d)).otherwise(F.array().cast("array<string>"))
    return bound(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(bound(description(page), about)))


def snippet(parts: Column, first: int, most: int) -> Column:
    """The first paragraphs in one line, cut to ``most`` characters."""
    return F.rtrim(F.substring(F.array_join(F.slice(parts, 1, first), " "), 1, most))
