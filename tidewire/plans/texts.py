"""Queries of text measures, projections and labels over articles, pages and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import scores, urls
from tidewire.operators.ranking import distributed_rank
from tidewire.runtime import table

COMMON = ["the", "of", "and", "to", "in", "that", "for", "is", "was", "with", "said", "on"]
WALLS = ["subscribe", "sign in", "đăng ký", "abonne"]


def _articles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "articles").select("id", *columns).distinct()


def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _articles(spark, sf_dir, "title", "content", "published_at", "language")
    n = F.length(F.coalesce("content", F.lit("")))
    points = [(n >= 200, 2), (n >= 800, 2), (n >= 2000, 1.5), (F.length("title") >= 20, 2), (F.col("published_at") != "", 1.5), (F.col("language").isNotNull(), 1), (scores.holds_any(F.col("content"), WALLS), -3)]
    return a.select("id", scores.graded(points).alias("score"))


def text_fullness(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _articles(spark, sf_dir, "content")
    return a.groupBy(scores.fullness(F.col("content"), 600, ["...", "…", "[+]"], WALLS).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def text_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", scores.vietnamese(F.col("text")).alias("vi"), scores.english(F.col("text"), COMMON).alias("en"), scores.word_count(F.col("text")).cast("long").alias("words"))


def text_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in titles that the first 400 characters of the text do not hold."""
    a = _articles(spark, sf_dir, "title", "content")
    return a.select("id", F.array_join(scores.unsupported_names(F.col("title"), F.substring("content", 1, 400), r"[A-Z][a-z]+(?: [A-Z][a-z]+)+"), "|").alias("names"))


def text_scripted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved pages that seem to need scripts, by three votes of five."""
    p = table(spark, sf_dir, "raw_pages")
    h = F.coalesce("html", F.lit(""))
    signs = [F.regexp_count(h, F.lit("<script")) >= 1, F.regexp_count(h, F.lit("<p")) < 3, F.length(h) < 3000, scores.holds_any(h, ['id="app"', 'id="root"']), scores.holds_any(h, ["noscript"])]
    return p.select("raw_path", scores.vote(signs, 3).alias("scripted"))


def text_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by value: their place from 0 over the whole order, and an impact out of place and tone."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value").withColumn("all", F.lit(0))
    ranked = distributed_rank(e, ["all"], [F.col("value").desc(), F.col("event_id").asc()], "rank").withColumn("place", F.col("rank") - 1)
    tone = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value") / 3)
    return ranked.select("event_id", "place", scores.impact(F.col("place"), tone, 200, 100.0).alias("impact"))


def text_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "source_profiles").select("source_id", urls.host(F.col("homepage_url")).alias("host"), "status", "has_rss", "html_status_code", "robots_ok")
    first = F.when(F.col("status") == "active", "live").when(F.col("html_status_code") >= 400, "broken")
    rules = [(F.col("status") == "active", "live"), (F.col("html_status_code") >= 400, "broken"), (F.col("has_rss"), "fed"), (F.col("robots_ok"), "open")]
    return p.select(
        "source_id", scores.source_label(F.col("host"), {"zinova.example": "Zinova News"}).alias("label"), scores.source_family(F.col("host"), {"co.example": "co family", "vn.example": "vn family"}).alias("family"),
        scores.source_tier(F.col("host"), [["co.example"], ["vn.example", "test"]]).alias("tier"), scores.second_label(rules, first).alias("second"),
        F.array_join(scores.listed([(F.col("has_rss"), ["rss", "feed"]), (F.col("robots_ok"), ["robots"])]), ",").alias("traits"),
    )


def text_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as cards: title or 'Untitled', source or host, a short summary, a time to show."""
    a = _articles(spark, sf_dir, "title", "source_id", "url", "content", "published_at", "extracted_at").groupBy("id").agg(*[F.max(c).alias(c) for c in ("title", "source_id", "url", "content", "published_at", "extracted_at")])
    return a.select(
        "id", F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("Untitled")).alias("title"), F.coalesce(F.nullif(F.trim("source_id"), F.lit("")), urls.host(F.col("url"))).alias("source"),
        scores.shortened(F.col("content"), 150).alias("summary"), scores.has_clock(F.col("published_at")).alias("clock"), scores.display_time(F.col("published_at"), F.col("extracted_at")).alias("shown"),
    )


def text_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty articles whose written times sort last as strings."""
    a = table(spark, sf_dir, "articles").groupBy("id").agg(F.max("published_at").alias("published_at"))
    return a.orderBy(F.col("published_at").desc_nulls_last(), "id").limit(50)


def text_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each host of discovered pages: the first address, and how many others lead to it."""
    d = table(spark, sf_dir, "discovered_urls").filter("url IS NOT NULL").select(urls.source_id(urls.host(F.col("url"))).alias("source"), urls.page_key(F.col("url")).alias("k")).distinct()
    return d.groupBy("source").agg(F.min("k").alias("first"), (F.count(F.lit(1)) - 1).alias("others"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("text_")}


def _any(column: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({column}, '')), '{n}')" for n in needles) + ")"


_HOST = "regexp_replace(lower(regexp_extract(trim({}), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
_KEY = "(CASE WHEN lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) = '' THEN 'https' ELSE lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) END || '://' || " + _HOST.format("url") + " || CASE WHEN regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) IN ('', '/') THEN '/' ELSE regexp_replace(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/$', '') END)"
_S = "trim(coalesce(content, ''), ' ')"
_CLOCK = "regexp_extract(coalesce(published_at, ''), '[T ](\\d{1,2}:\\d{2}(?::\\d{2})?)', 1)"
ORACLE = {
    "text_quality": f"""WITH a AS (SELECT DISTINCT id, title, content, published_at, language FROM articles), s AS (SELECT *, length(coalesce(content, '')) AS n FROM a)
SELECT id, greatest(0.0, least(10.0, CASE WHEN n >= 200 THEN 2.0 ELSE 0 END + CASE WHEN n >= 800 THEN 2 ELSE 0 END + CASE WHEN n >= 2000 THEN 1.5 ELSE 0 END + CASE WHEN length(title) >= 20 THEN 2 ELSE 0 END
 + CASE WHEN published_at <> '' THEN 1.5 ELSE 0 END + CASE WHEN language IS NOT NULL THEN 1 ELSE 0 END - CASE WHEN {_any("content", WALLS)} THEN 3 ELSE 0 END))::DOUBLE AS score FROM s""",
    "text_fullness": f"""WITH a AS (SELECT DISTINCT id, content FROM articles) SELECT CASE WHEN {_S} = '' THEN 'empty' WHEN length({_S}) < 600 AND {_any("content", WALLS)} THEN 'walled'
 WHEN ends_with({_S}, '...') OR ends_with({_S}, '…') OR ends_with({_S}, '[+]') THEN 'truncated' WHEN length({_S}) < 600 THEN 'short' ELSE 'full' END AS kind, count(*) AS n FROM a GROUP BY 1""",
    "text_languages": f"""WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(t, '\\p{{L}}')) AS l, len(regexp_extract_all(t, '[{scores.VIETNAMESE}]')) AS v,
 len(regexp_extract_all(t, '\\p{{L}}+')) AS w, len(regexp_extract_all(t, '\\b(?:{"|".join(COMMON)})\\b')) AS e FROM d) SELECT doc_id, l > 0 AND v >= 0.08 * l AS vi, w > 0 AND e >= 0.12 * w AS en, w AS words FROM c""",
    "text_names": """WITH a AS (SELECT DISTINCT id, title, content FROM articles), n AS (SELECT id, lower(coalesce(substr(content, 1, 400), '')) AS b, regexp_extract_all(coalesce(title, ''), '[A-Z][a-z]+(?: [A-Z][a-z]+)+') AS x FROM a)
SELECT id, array_to_string(list_filter(x, lambda y, i: list_position(x, y) = i AND NOT contains(b, lower(y))), '|') AS names FROM n""",
    "text_scripted": f"""WITH p AS (SELECT raw_path, coalesce(html, '') AS h FROM raw_pages) SELECT raw_path, (CASE WHEN contains(h, '<script') THEN 1 ELSE 0 END + CASE WHEN len(regexp_extract_all(h, '<p')) < 3 THEN 1 ELSE 0 END
 + CASE WHEN length(h) < 3000 THEN 1 ELSE 0 END + CASE WHEN {_any("h", ['id="app"', 'id="root"'])} THEN 1 ELSE 0 END + CASE WHEN contains(lower(h), 'noscript') THEN 1 ELSE 0 END) >= 3 AS scripted FROM p""",
    "text_impact": """WITH r AS (SELECT event_id, event_type, value, row_number() OVER (ORDER BY value DESC, event_id) - 1 AS place FROM events)
SELECT event_id, place, CAST(round_even(50 * (1 - least(place, 200) / 200.0) + 50 * least(abs(CASE WHEN event_type = 'error' THEN -value ELSE value / 3 END) / 100.0, 1.0), 0) AS INTEGER) AS impact FROM r""",
    "text_labels": f"""WITH p AS (SELECT *, {_HOST.format("homepage_url")} AS host FROM source_profiles), q AS (SELECT *, CASE WHEN status = 'active' THEN 'live' WHEN html_status_code >= 400 THEN 'broken' END AS f FROM p)
SELECT source_id, CASE WHEN host = 'zinova.example' THEN 'Zinova News' ELSE upper(left(string_split(host, '.')[1], 1)) || substr(string_split(host, '.')[1], 2) END AS label,
 CASE WHEN host = 'co.example' OR host LIKE '%.co.example' THEN 'co family' WHEN host = 'vn.example' OR host LIKE '%.vn.example' THEN 'vn family' ELSE array_to_string(string_split(host, '.')[-2:], '.') END AS family,
 CASE WHEN host = 'co.example' OR host LIKE '%.co.example' THEN 0 WHEN host = 'vn.example' OR host LIKE '%.vn.example' OR host = 'test' OR host LIKE '%.test' THEN 1 ELSE 2 END AS tier,
 CASE WHEN status = 'active' AND f IS DISTINCT FROM 'live' THEN 'live' WHEN html_status_code >= 400 AND f IS DISTINCT FROM 'broken' THEN 'broken' WHEN has_rss THEN 'fed' WHEN robots_ok THEN 'open' END AS second,
 array_to_string(list_concat(CASE WHEN has_rss THEN ['rss', 'feed'] ELSE [] END, CASE WHEN robots_ok THEN ['robots'] ELSE [] END), ',') AS traits FROM q""",
    "text_cards": f"""WITH a AS (SELECT id, max(title) AS title, max(source_id) AS source_id, max(url) AS url, max(content) AS content, max(published_at) AS published_at, max(extracted_at) AS x FROM articles GROUP BY id),
c AS (SELECT *, {_CLOCK} AS t, regexp_extract(coalesce(published_at, ''), '^(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1) AS day FROM a), k AS (SELECT *, t <> '' AND t NOT IN ('00:00', '00:00:00', '0:00') AS clock FROM c)
SELECT id, coalesce(nullif(trim(title, ' '), ''), 'Untitled') AS title, coalesce(nullif(trim(source_id, ' '), ''), {_HOST.format("url")}) AS source,
 CASE WHEN length({_S}) > 150 THEN rtrim(substr({_S}, 1, 150), ' ') || '…' ELSE {_S} END AS summary, clock,
 CASE WHEN day <> '' AND clock THEN replace(substr(published_at, 1, 19), 'T', ' ') WHEN day <> '' THEN day || ' ' || strftime(x, '%H:%M:%S') ELSE strftime(x, '%Y-%m-%d %H:%M:%S') END AS shown FROM k""",
    "text_newest": "SELECT id, max(published_at) AS published_at FROM articles GROUP BY id ORDER BY published_at DESC NULLS LAST, id LIMIT 50",
    "text_aliases": f"""WITH d AS (SELECT DISTINCT regexp_replace({_HOST.format("url")}, '[^a-z0-9]+', '_', 'g') AS source, {_KEY} AS k FROM discovered_urls WHERE url IS NOT NULL) SELECT source, min(k) AS first, count(*) - 1 AS others FROM d GROUP BY 1""",
}
