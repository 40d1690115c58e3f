"""Queries over saved pages and fuzzy matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions import markup
from tidewire.functions.arrays import bound
from tidewire.operators import matching
from tidewire.operators.ranking import distributed_rank
from tidewire.runtime import table
from tidewire.sources import files, pages

#: Items in one built feed.
FEED_ITEMS = 50


def web_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pages.paragraphs(table(spark, sf_dir, "raw_pages"), "raw_path", "html")
    both = bound(F.col("paragraphs"), lambda x: F.struct(F.size(x).alias("n"), F.array_join(x, "|").alias("text")))
    return p.select("raw_path", "title", both.alias("r")).select("raw_path", "title", "r.n", "r.text")


def web_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.snippets(table(spark, sf_dir, "raw_pages"), "raw_path", "html", 2, 300)


def web_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "raw_pages").join(table(spark, sf_dir, "source_profiles").select("source_id", "homepage_url"), "source_id")
    return pages.internal_links(raw, "raw_path", "homepage_url", "html")


def web_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of up to 50 items built from the discovered rows of each source, then read as a collector would."""
    d = table(spark, sf_dir, "discovered_urls").filter("discovery_method = 'rss' AND title IS NOT NULL AND source_id IS NOT NULL").select("source_id", "url", "title").distinct()
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    clean = F.regexp_replace(F.col("title"), r"[\x00-\x1f]", " ")
    item = F.concat(F.lit("<item><title>"), esc(clean), F.lit("</title><link>"), esc(F.col("url")), F.lit("</link></item>"))
    ranked = distributed_rank(d, ["source_id"], [F.col("title").asc(), F.col("url").asc_nulls_last()])
    feeds = ranked.groupBy("source_id", F.floor((F.col("rank") - 1) / FEED_ITEMS).alias("feed"))
    bodies = feeds.agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.array_sort(F.collect_list(item)), ""), F.lit("</channel></rss>")).alias("body"))
    return pages.feed_rows(bodies, "source_id", "body").select("source_id", "link").distinct()


def web_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source profiles as a catalog file: every second URL has a numbered name line before it."""
    p = table(spark, sf_dir, "source_profiles").select("source_id", "homepage_url")
    n = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source_id"))
    p = p.withColumn("n", n)
    notes = p.filter("n % 2 = 0").select((F.col("n") * 2).alias("line_no"), F.concat(F.lit("# "), F.col("n").cast("string"), F.lit(". "), "source_id").alias("line"))
    lines = notes.unionByName(p.select((F.col("n") * 2 + 1).alias("line_no"), F.col("homepage_url").alias("line")))
    return files.catalog(lines)


def match_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged article URLs, resolved against the discovered ones by path and title."""
    a = table(spark, sf_dir, "articles").select("url", F.col("title").alias("headline"))
    wanted = a.select(F.concat(F.regexp_replace("url", r"-?\d+\.html?$", ""), F.lit(".html")).alias("raw_url"), "headline")
    found = matching.resolved_urls(wanted, table(spark, sf_dir, "discovered_urls").select("url", "title"))
    return found.select("raw_url", "url", F.round("score", 6).alias("score"))


def match_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article that fits the title of each profiled homepage best, at any score above none."""
    heads = table(spark, sf_dir, "source_profiles").select(F.col("html_title").alias("headline"))
    arts = table(spark, sf_dir, "articles").select("id", "title", F.col("content").alias("text")).dropDuplicates(["id"])
    return matching.headline_matches(heads, arts, 0.1)


def match_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles for each test item by its words; those about copper are not wanted, and where an item asks for figures ones that name a group are."""
    items = table(spark, sf_dir, "eval_items")
    stories = items.select(
        F.col("item_id").alias("story"), F.substring("text", 1, 120).alias("text"), F.when(F.col("item_id") % 3 == 0, F.array(F.lit("group"), F.lit("capital"))).alias("needed"), F.array(F.lit("copper")).alias("forbidden")
    )
    return matching.story_sources(stories, table(spark, sf_dir, "articles").select("id", "title"))


def match_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sources each article names, by title or domain as plain substrings, as its SQL says."""
    n = table(spark, sf_dir, "source_profiles").filter("html_title IS NOT NULL").select(F.col("source_id").alias("entity"), F.array(F.col("html_title"), F.col("domain")).alias("aliases"))
    return matching.entity_hits(table(spark, sf_dir, "articles").select("id", "content").distinct(), "id", "content", n, compact=False)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_PLAIN = "regexp_replace({}, '(?s)<[^>]*>', ' ', 'g')"


def _unescaped(x: str) -> str:
    for name, sign in {"#39": "'", "#8217": "’", "#8211": "–", "#160": "\u00a0", "#8230": "…", "#8220": "“", "#8221": "”"}.items() | markup.ENTITIES.items():
        x = f"replace({x}, '&{name};', {_quoted(sign)})"
    return f"replace({x}, '&amp;', '&')"


def _text(x: str) -> str:
    return f"trim(regexp_replace({_unescaped(_PLAIN.format(x))}, '[\\s\\x{{00A0}}]+', ' ', 'g'))"


_READ = f"""WITH raw AS (SELECT raw_path, coalesce(html, '') AS page FROM raw_pages),
marked AS (SELECT raw_path, page, string_split(regexp_replace(regexp_replace(regexp_replace(page, {_quoted(markup.UNSEEN)}, ' ', 'g'), {_quoted(markup.OPENS)}, chr(1), 'g'), {_quoted(markup.CLOSES)}, chr(2), 'g'), chr(1))[2:] AS pieces FROM raw),
long AS (SELECT raw_path, page, list_filter(list_transform(pieces, lambda x: {_text("string_split(x, chr(2))[1]")}), lambda x: length(x) >= 40) AS b FROM marked),
once AS (SELECT raw_path, {_text(f"regexp_extract(page, {_quoted(markup.TITLE)}, 1)")} AS title, list_filter(b, lambda x, i: list_position(list_transform(b, lambda y: lower(y)), lower(x)) = i) AS b,
  list_filter(regexp_extract_all(page, {_quoted(markup.META)}), lambda x: regexp_matches(x, {_quoted(markup.DESCRIBES)}))[1] AS tag FROM long),
about AS (SELECT raw_path, title, b, {_text(f"regexp_extract(coalesce(tag, ''), {_quoted(markup.CONTENT)}, 1) || regexp_extract(coalesce(tag, ''), {_quoted(markup.CONTENT)}, 2)")} AS d FROM once),
read AS (SELECT raw_path, title, CASE WHEN len(b) > 0 THEN b WHEN d <> '' THEN [d] ELSE [] END AS paragraphs FROM about)"""

QUERIES = {k: v for k, v in list(globals().items()) if k.startswith(("web_", "match_"))}
ORACLE = {
    "web_paragraphs": f"{_READ} SELECT raw_path, title, CAST(len(paragraphs) AS INTEGER) AS n, array_to_string(paragraphs, '|') AS text FROM read",
    "web_snippets": f"{_READ} SELECT raw_path, title, rtrim(substr(array_to_string(paragraphs[:2], ' '), 1, 300)) AS snippet FROM read",
    "web_feeds": "SELECT DISTINCT source_id, trim(regexp_replace(url, '\\s+', ' ', 'g')) AS link FROM discovered_urls WHERE discovery_method = 'rss' AND title IS NOT NULL AND source_id IS NOT NULL AND url IS NOT NULL",
    "web_catalog": """WITH p AS (SELECT source_id, homepage_url, row_number() OVER (ORDER BY source_id) AS n FROM source_profiles)
SELECT CAST(n * 2 + 1 AS INTEGER) AS line_no, CASE WHEN n % 2 = 0 THEN source_id ELSE regexp_replace(lower(regexp_extract(homepage_url, '^[A-Za-z]+://([^/?#]*)', 1)), '^www\\.', '') END AS name, homepage_url AS url FROM p""",
    "web_links": r"""WITH r AS (SELECT raw_path, homepage_url, unnest(regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"''#\s]+)', 1)) AS h, unnest(range(len(regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"''#\s]+)', 1)))) AS pos
  FROM raw_pages JOIN source_profiles USING (source_id)),
l AS (SELECT raw_path, pos, CASE WHEN h LIKE '//%' THEN regexp_extract(homepage_url, '^([A-Za-z]+:)', 1) || h WHEN h LIKE '/%' THEN regexp_extract(homepage_url, '^([A-Za-z]+://)', 1) || regexp_replace(lower(regexp_extract(homepage_url, '^[A-Za-z]+://([^/?#]*)', 1)), '^www\.', '') || h ELSE h END AS link,
  regexp_replace(lower(regexp_extract(homepage_url, '^[A-Za-z]+://([^/?#]*)', 1)), '^www\.', '') AS host FROM r)
SELECT raw_path, CAST(min(pos) AS INTEGER) AS pos, link FROM l WHERE regexp_matches(link, '^https?://') AND regexp_replace(lower(regexp_extract(link, '^[A-Za-z]+://([^/?#]*)', 1)), '^www\.', '') = host GROUP BY raw_path, link
QUALIFY row_number() OVER (PARTITION BY raw_path ORDER BY min(pos)) <= 200""",
    "match_stories": r"""WITH s0 AS (SELECT item_id AS story, regexp_extract_all(strip_accents(lower(substr(text, 1, 120))), '[\p{L}\p{N}_]{3,}') AS w, CASE WHEN item_id % 3 = 0 THEN ['group', 'capital'] ELSE [] END AS need FROM eval_items WHERE text IS NOT NULL),
s AS (SELECT story, list_distinct(w) AS w, need FROM s0), a AS (SELECT DISTINCT id, list_distinct(regexp_extract_all(strip_accents(lower(title)), '[\p{L}\p{N}_]{3,}')) AS v FROM articles WHERE title IS NOT NULL),
p AS (SELECT story, id, count(*) AS n FROM (SELECT id, unnest(v) AS x FROM a) JOIN (SELECT story, unnest(w) AS x FROM s) USING (x) GROUP BY ALL),
r AS (SELECT story, id, round(n / len(w), 6) AS score FROM p JOIN s USING (story) JOIN a USING (id) WHERE NOT list_contains(v, 'copper') AND (len(need) = 0 OR list_has_any(need, v)) AND round(n / len(w), 6) >= 0.2),
q AS (SELECT story, id, CASE WHEN score >= 0.36 THEN 1 ELSE 2 END AS pass, score FROM r)
SELECT story, id, pass, row_number() OVER (PARTITION BY story ORDER BY pass, score DESC, id) AS place FROM q QUALIFY place <= 3""",
    "match_entities": """WITH w AS (SELECT source_id AS entity, html_title AS a1, domain AS a2 FROM source_profiles WHERE html_title IS NOT NULL), a AS (SELECT DISTINCT id, lower(content) AS c FROM articles WHERE content IS NOT NULL)
SELECT id, entity, CASE WHEN contains(c, lower(a1)) THEN lower(a1) ELSE lower(a2) END AS alias FROM a JOIN w ON contains(c, lower(a1)) OR contains(c, lower(a2))""",
}
