"""URL parts and the canonical forms the pipeline keys by; each form keeps and drops different parts, so they stay apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*)://"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"


def _part(url: Column, pattern: str) -> Column:
    return F.regexp_extract(F.coalesce(F.trim(url), F.lit("")), pattern, 1)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, SCHEME))


def host(url: Column) -> Column:
    """The host in lower case without a leading www.; '' for null or text that is no absolute URL."""
    return F.regexp_replace(F.lower(_part(url, HOST)), r"^www\.", "")


def path(url: Column) -> Column:
    return _part(url, PATH)


def query(url: Column) -> Column:
    return _part(url, QUERY)


def _bare_path(url: Column) -> Column:
    p = F.when(path(url) == "", "/").otherwise(path(url))
    return F.when(p == "/", p).otherwise(F.regexp_replace(p, "/$", ""))


def page_key(url: Column) -> Column:
    """scheme://host/path without www., closing slash, query and fragment; https where there is no scheme."""
    return F.concat(F.when(scheme(url) == "", "https").otherwise(scheme(url)), F.lit("://"), host(url), _bare_path(url))


def page_query_key(url: Column) -> Column:
    """As page_key, but the query stays."""
    q = query(url)
    return F.concat(page_key(url), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def squeezed_key(url: Column) -> Column:
    """scheme://host/path?query with runs of slashes in the path as one; '' without a scheme."""
    p = F.regexp_replace(_bare_path(url), "/{2,}", "/")
    q = query(url)
    whole = F.concat(scheme(url), F.lit("://"), host(url), p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.when(scheme(url) == "", "").otherwise(whole)


def loose_key(url: Column) -> Column:
    """The whole URL in lower case without fragment and closing slash, http read as https."""
    s = F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), "#.*$", "")
    return F.regexp_replace(F.regexp_replace(s, "/+$", ""), "^http://", "https://")


def strict_key(url: Column) -> Column:
    """page_query_key for http and https only, else ''."""
    return F.when(scheme(url).isin("http", "https"), page_query_key(url)).otherwise("")


def junk_free(url: Column) -> Column:
    """The URL without attribute text that was scraped along with it, and without closing blanks, % and )."""
    return F.regexp_replace(F.regexp_replace(url, r"(?i)(\s|%20|\")+(target|rel|class|title)=.*$", ""), r"[ %)]+$", "")


def host_path_key(url: Column) -> Column:
    """host|path, by which mentions of one page are the same."""
    return F.concat(host(url), F.lit("|"), F.lower(_bare_path(url)))


def source_id(domain: Column) -> Column:
    """A domain as an identifier: dots and other signs become underscores."""
    return F.regexp_replace(F.lower(F.regexp_replace(domain, r"^www\.", "")), "[^a-z0-9]+", "_")


def domain_suffixes(domain: Column) -> Column:
    """The domain and all its parent domains, longest first, so that a suffix match is an equality."""
    parts = F.split(F.lower(domain), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def names_recent_day(url: Column, days: list[str]) -> Column:
    """Whether the URL holds one of the days (yyyy-mm-dd) with dashes or slashes, or a /yyyy/mm/ of one of their months."""
    low = F.lower(F.coalesce(url, F.lit("")))
    hit = F.lit(False)
    for d in days:
        hit = hit | low.contains(d) | low.contains(d.replace("-", "/"))
    y, m = (F.regexp_extract(low, r"/(\d{4})/(\d{1,2})(?:/|$)", k) for k in (1, 2))
    months = sorted({d[:7] for d in days})
    return hit | F.concat(y, F.lit("-"), F.lpad(m, 2, "0")).isin(months)
