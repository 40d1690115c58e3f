"""Text predicates and small text functions of the cleaning steps."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions import markup, urls

# Titles of listing pages, parts of their URLs, and dates as lists print them.
LISTING_TITLES = ["forex news", "east asia", "spotlight", "markets", "business", "economy", "technology", "công nghệ"]
LISTING_PATHS = ["/tag/", "/tags/", "/topic/", "/category/", "/categories/", "trang-1", "trang-2", "-trang-1", "/page/"]
DATE_IN_TEXT = r"\b\d{1,2}/\d{1,2}/\d{4}\b|\b\d{1,2}-\d{1,2}-\d{4}\b"

#: Shapes of listing addresses: (part of the URL, what it looks like, what an article's address of that look has).
LISTING_SHAPES = (
    ("path", r"^(index\.html?)?$", None),
    ("path", r"^([^/]+/+)?[^/]{0,27}\.html?$", r"\d{6}[^/]*$|(-[^/]*){4}\.html?$|\d{4}[-/]\d{2}"),
    ("query", r"(^|&)(page|p|trang|paged|pagenum)=0*([2-9]|[1-9]\d+)(&|$)|paged=|pagenum=", None),
    ("page", r"^[^/?]{1,39}(\?|$)", r"^([^?]*-){4}|^[^?]*\d{6}|/\d{4}/\d{2}/\d{2}|\d{4}-\d{2}-\d{2}"),
)


def listing_page(url: Column, title: Column, phrases: tuple[str, ...] = ()) -> Column:
    """Whether URL and title look like a list of articles: by known titles, LISTING_PATHS or one of LISTING_SHAPES.

    Null URL or title counts as empty.
    """
    low = F.lower(F.coalesce(url, F.lit("")))
    path, query = F.regexp_replace(urls.path(low), "^/+|/+$", ""), urls.query(low)
    parts = {"path": path, "query": query, "page": F.concat(path, F.lit("?"), query)}
    shaped = [parts[p].rlike(look) & (~parts[p].rlike(unless) if unless else F.lit(True)) for p, look, unless in LISTING_SHAPES]
    heading = F.lower(F.trim(F.coalesce(title, F.lit(""))))
    named = [heading.isin(LISTING_TITLES), *[heading.contains(x) for x in phrases], *[low.contains(x) for x in LISTING_PATHS]]
    return reduce(or_, named + shaped)


def listing_content(text: Column, min_dates: int = 8) -> Column:
    """Whether a text looks like a list: many dates, or 25 lines with at least 4 dates. Null is none."""
    body = F.coalesce(text, F.lit(""))
    dates = F.regexp_count(body, F.lit(DATE_IN_TEXT))
    lines = F.size(F.filter(F.split(body, r"\r\n|\r|\n"), lambda x: F.trim(x) != ""))
    return (dates >= min_dates) | ((lines >= 25) & (dates >= 4))


def text_key(text: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of the text in lower case with runs of blanks squeezed."""
    low = F.regexp_replace(F.lower(F.trim(F.coalesce(text, F.lit("")))), r"\s+", " ")
    return F.substring(F.sha2(low, 256), 1, 16)


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(text, F.lit(""))) / 4))


def cut_at_word(text: Column, limit: int) -> Column:
    """At most ``limit`` characters, not within a word unless the first word is longer."""
    s = F.trim(text)
    return F.when(F.length(s) <= limit, s).otherwise(
        F.coalesce(F.nullif(F.regexp_extract(s, rf"^(?s)(.{{1,{limit}}})(?=\s)", 1), F.lit("")), F.substring(s, 1, limit))
    )


def without_markup(text: Column) -> Column:
    """Text without tags, scripts and styles, entities resolved and blanks squeezed; '' for null."""
    return markup.plain(F.regexp_replace(F.coalesce(text, F.lit("")), markup.UNSEEN, " "))
