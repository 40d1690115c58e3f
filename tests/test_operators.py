"""Operators against plain Python on small frames, with nulls, ties, repeated rows and empty tables."""

import gzip
import random
from collections import Counter
from datetime import datetime


import pytest
from pyspark.sql import functions as F

from tidewire.functions import arrays, pages, rules, urls
from tidewire.operators import matching, selection, state, store
from tidewire.operators.ranking import distributed_rank, distributed_running_sum, top_n_per_group
from tidewire.plans import web
from tidewire.sources import files
from tidewire.sources import pages as saved
from tidewire.streaming import flows


def test_distributed_rank_and_sum(spark):
    random.seed(1)
    rows = [(random.choice(["a", "a", "a", "b", None]), i, random.choice([1, 2, None]), random.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, id long, w long, _piece double").repartition(5)
    got = distributed_rank(df, ["g"], [F.col("w").desc_nulls_last(), F.col("id").asc()], "rank").collect()
    sums = {r.id: r.upto for r in distributed_running_sum(df.drop("_piece"), ["g"], [F.col("id").asc()], F.col("w"), "upto").collect()}
    for g in ("a", "b", None):
        own = [r for r in rows if r[0] == g]
        order = sorted(own, key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        assert [r[1] for r in order] == [r.id for r in sorted((r for r in got if r.g == g), key=lambda r: r["rank"])]
        total = 0
        for r in sorted(own, key=lambda r: r[1]):
            total += r[2] or 0
            assert sums[r[1]] == total
    assert distributed_rank(df.limit(0), ["g"], [F.col("id").asc()]).count() == 0


def test_top_n(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None)], "g string, v int")
    assert {tuple(r) for r in top_n_per_group(df, ["g"], [F.col("v").desc_nulls_last()], 1).collect()} == {("a", 2), (None, 4), ("b", None)}


@pytest.mark.parametrize("block", [7, 1000])
def test_chunks(spark, block):
    random.seed(2)
    sizes = [random.choice([None, 1, 5, 9, 40]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(sizes)), "i int, size int")
    got = {r.i: r.chunk for r in selection.chunks_by_size(df, [F.col("i").asc()], "size", 20, block).collect()}
    number, held = -1, 0
    for i, n in enumerate(s or 0 for s in sizes):
        if i % block == 0 or held + n > 20:
            number, held = number + 1, 0
        held += n
        assert got[i] == number
    assert selection.chunks_by_size(df.limit(0), [F.col("i").asc()], "size", 20).count() == 0


@pytest.mark.parametrize("sizes", [[None, 1, 5, 9, 40, 0], [3], [0, 0, 30], [1, 2, 3, 4, 5, 6, 7]])
def test_chunks_do_not_restart(spark, sizes):
    """More rows than a block used to hold, over several partitions: the plain greedy rule throughout."""
    rnd = random.Random(5)
    rows = [(i, rnd.choice(sizes)) for i in range(12_000)]
    df = spark.createDataFrame(rows, "i int, size int").repartition(5)
    got = {r.i: (r.size, r.chunk) for r in selection.chunks_by_size(df, [F.col("i").asc()], "size", 20).collect()}
    number, held = 0, 0
    for i, n in rows:
        if i and held + (n or 0) > 20:
            number, held = number + 1, 0
        held += n or 0
        assert got[i] == (n, number)


def test_greedy_pick(spark):
    rows = [(i, f"c{i % 3}", f"h{i % 2}") for i in range(20)]
    df = spark.createDataFrame(rows, "i int, category string, host string")
    got = [(r.i, r.pick) for r in selection.greedy_pick(df, [F.col("i").asc()], 5, "category", {"host": 2}, ["c2"]).orderBy("pick").collect()]
    assert got == [(2, 1), (0, 2), (1, 3), (3, 4)]  # two of each host, the priority category first


def test_greedy_pick_sees_all_rows(spark):
    """One host holds the 600 best rows, the priority category comes last; two caps against the plain rule."""
    rows = [(i, "c0", "h0", f"k{i % 7}") for i in range(600)] + [(600 + i, "c1" if i < 90 else "c2", f"h{i % 50}" if i % 11 else None, f"k{i % 3}") for i in range(100)]
    df = spark.createDataFrame(rows, "i int, category string, host string, kind string").repartition(6)
    for caps in ({"host": 2}, {"host": 2, "kind": 4}, {"host": 3, "kind": 30}):
        used, want = Counter(), []
        for options in ([r for r in rows if r[1] == "c2"], [r for r in rows if r[1] == "c1"], *[[r] for r in rows]):
            for r in options:
                keys = [(c, r[{"host": 2, "kind": 3}[c]]) for c in caps]
                if len(want) < 30 and r[0] not in want and all(used[k] < caps[k[0]] for k in keys):
                    used.update(keys)
                    want.append(r[0])
                    break
        got = selection.greedy_pick(df, [F.col("i").asc()], 30, "category", caps, ["c2", "c1"]).orderBy("pick").collect()
        assert [r.i for r in got] == want and [r.pick for r in got] == list(range(1, len(want) + 1))


def test_round_robin_null_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "s string, i int")
    assert [r.i for r in selection.round_robin(df, "s", [F.col("i").asc()], 3).collect()] == [1, 4, 3]


def test_rules(spark):
    df = spark.createDataFrame([("a oil b", 3), (None, None)], "t string, v int")
    hit = rules.signals(F.upper("t"), {"oil": r"\bOIL\b"})["oil"]
    got = df.select(rules.first_label([(hit, "x")], "y").alias("l"), rules.flags([(hit, "x")]).alias("f"), rules.weighted([(hit, 2)]).alias("w"), rules.bins(F.col("v"), [(2, "low")], "high").alias("b")).collect()
    assert [tuple(r) for r in got] == [("x", ["x"], 2, "high"), ("y", [], 0, None)]
    two = spark.createDataFrame([("GDP and gdp, loss",)], "t string")
    assert two.select(rules.substring_score(F.col("t"), {"gdp": 1, "loss": -2}, repeats=True).alias("s")).first().s == 0
    assert df.select(rules.hint_text(F.col("t"), F.lit(None).cast("string")).alias("h")).first().h == "A OIL B "


def test_arrays(spark):
    df = spark.createDataFrame([("g", 1, "b"), ("g", 1, "a"), ("g", 2, "c"), ("g", None, "d"), ("g", 3, None)], "g string, t int, v string")
    row = df.groupBy("g").agg(arrays.ordered_array(F.col("v"), [(F.col("t"), True)], 3).alias("o"), arrays.distinct_array(F.col("v"), 2).alias("d")).first()
    assert (row.o, row.d) == (["c", "a", "b"], ["a", "b"])
    one = spark.createDataFrame([("ONE,12; one ;;TWO  X,3",), (None,)], "t string").select(arrays.clean_entities(F.col("t"), 5).alias("e")).collect()
    assert [r.e for r in one] == [["ONE", "TWO X"], []]


def test_urls(spark):
    rows = [("HTTP://www.Ex.com/a//b/?q=1#f", "ex.com", "http://ex.com/a//b", "http://ex.com/a//b?q=1", "http://ex.com/a/b?q=1"), (None, "", "https:///", "https:///", ""), ("x", "", "https:///", "https:///", "")]
    df = spark.createDataFrame([(r[0],) for r in rows], "u string")
    u = F.col("u")
    got = df.select(urls.host(u), urls.page_key(u), urls.page_query_key(u), urls.squeezed_key(u)).collect()
    assert [tuple(r) for r in got] == [r[1:] for r in rows]
    assert df.limit(1).select(urls.domain_suffixes(F.lit("a.b.c")).alias("s")).first().s == ["a.b.c", "b.c", "c"]
    assert df.limit(1).select(urls.junk_free(F.lit('http://a.b/c%20target="x"')).alias("s")).first().s == "http://a.b/c"


def test_listing(spark):
    cases = [
        ("https://a.b/", "t", True), ("https://a.b/x/2025/09/20/a-long-article-name-12345678.html", "t", False), ("https://a.b/tag/x/y", "t", True),
        ("https://a.b/n/a-b-c-d-e-f-1234567.html?page=2", "t", True), ("https://a.b/cong-nghe/", "t", True), ("https://a.b/x/y/z-1234567", "Markets ", True), (None, None, True),
    ]
    df = spark.createDataFrame(cases, "u string, t string, want boolean")
    assert all(r.want == r.got for r in df.select("want", pages.listing_page(F.col("u"), F.col("t")).alias("got")).collect())
    many = spark.createDataFrame([("1/2/2025 " * 8,), ("1/2/2025 " * 7,), (None,)], "t string")
    assert [r.x for r in many.select(pages.listing_content(F.col("t")).alias("x")).collect()] == [True, False, False]


def test_text(spark):
    df = spark.createDataFrame([("<p>a &amp; b</p><script>x</script>",)], "t string")
    assert df.select(pages.without_markup(F.col("t")).alias("x")).first().x == "a & b"
    assert df.select(pages.cut_at_word(F.lit("alpha beta gamma"), 12).alias("x")).first().x == "alpha beta"
    assert df.select((pages.text_key(F.lit(" A  b")) == pages.text_key(F.lit("a b"))).alias("x")).first().x


def test_upsert_adds_columns(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, seq int")
    got = {(r.k, r.v) for r in state.upserted(old, new, "k", ["seq"]).collect()}
    assert got == {(1, "a"), (2, "d"), (3, "e"), (None, "n")}
    assert state.upserted(old.limit(0), new.limit(0), "k").count() == 0


def test_keep_list(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keep = spark.createDataFrame([("a",)], "k string")
    assert [r.k for r in state.kept_by_ids(df, "k", keep).collect()] == ["a"]
    assert state.kept_by_ids(df, "k", keep.limit(0)).count() == 3


def test_frontier_before_first_upsert(spark):
    rows = [("u", "x", "s", "failed", "E", None, None, 1), ("u", "x", "s", "upsert", None, "h", None, 2), ("u", "x", "s", "failed", "E1", None, None, 3), ("u", "x", "s", "crawled", None, None, None, 4)]
    df = spark.createDataFrame([(*r[:7], datetime(2025, 1, 1, r[7]), r[7]) for r in rows], "url_hash string, url string, source_id string, action string, error_type string, content_hash string, next_crawl_at timestamp, ts timestamp, seq int")
    r = state.replayed_frontier(df).first()
    assert (r.status, r.retry_count, r.last_error_type, r.content_hash) == ("crawled", 1, None, "h")
    assert state.replayed_frontier(df.limit(0)).count() == 0


def test_overlap_and_labels(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", 1), ("b", 2), (None, 2)], "g string, i int")
    assert {tuple(r) for r in store.overlap_counts(df, "g", "i").collect()} == {("a", "b", 1), ("a", "c", 1), ("b", "c", 1)}
    assert [tuple(r) for r in store.top_labels(df.withColumn("l", F.col("i").cast("string")), "g", "l", 1).filter("g = 'b'").collect()] == [("b", "1:1")]


def test_suffix_join(spark):
    left = spark.createDataFrame([("x.a.com",), ("a.com",), ("ba.com",), (None,)], "d string")
    allowed = spark.createDataFrame([("a.com",), ("x.a.com",)], "allowed string")
    assert {tuple(r) for r in store.suffix_join(left, "d", allowed).collect()} == {("x.a.com", "x.a.com"), ("a.com", "a.com")}


def test_pages(spark):
    page = "<title>T</title><p>" + "word " * 12 + "</p><p>" + "WORD " * 12 + "</p><script><p>" + "x" * 50 + "</p></script><li>short</li>"
    df = spark.createDataFrame([("k", page), ("e", ""), ("n", None)], "k string, h string")
    got = {r.k: (r.title, r.paragraphs) for r in saved.paragraphs(df, "k", "h").collect()}
    assert got == {"k": ("T", [("word " * 12).strip()]), "e": ("", []), "n": ("", [])}


def test_feeds_and_sitemaps():
    rss = "<rss><channel><item><title>A</title><link>http://x/1</link><pubDate>d</pubDate><description>&lt;b&gt;s&lt;/b&gt;</description></item><item><title>no link</title></item></channel></rss>"
    assert saved.feed_entries(rss) == [("http://x/1", "A", "d", "s")]
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>B</title><link href="http://x/2"/><updated>u</updated></entry></feed>'
    assert saved.feed_entries(atom) == [("http://x/2", "B", "u", None)]
    index = b"<sitemapindex><sitemap><loc> http://x/s </loc></sitemap></sitemapindex>"
    assert saved.sitemap_entries(gzip.compress(index)) == [("http://x/s", None, True)]
    assert saved.sitemap_entries("<broken") == saved.sitemap_entries(None) == saved.feed_entries("") == []


def test_feeds_hold_all_items(spark, tmp_path):
    rows = [("rss", f"t{i} & <x>", "hot" if i % 3 else "cold", f"https://x/{i}?a=1&b=2") for i in range(700)] + [("rss", None, "hot", "https://x/none"), ("sitemap", "t", "hot", "https://x/map")]
    spark.createDataFrame(rows, "discovery_method string, title string, source_id string, url string").write.parquet(str(tmp_path / "discovered_urls.parquet"))
    got = [(r.source_id, r.link) for r in web.web_feeds(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted((r[2], r[3]) for r in rows[:700])


def test_links(spark):
    df = spark.createDataFrame([("k", "https://www.a.b/", '<a href="/x"> <a href="https://a.b/x"><a href="https://c.d/y"><a href="/x">')], "k string, base string, h string")
    assert [tuple(r) for r in saved.internal_links(df, "k", "base", "h").collect()] == [("k", 0, "https://a.b/x")]


def test_catalog(spark):
    lines = ["# 1. First", "https://www.a.b/x", "https://c.d/", "", "# note", "https://e.f/", "# 2. Last"]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no int, line string")
    assert [(r.line_no, r.name) for r in files.catalog(df).orderBy("line_no").collect()] == [(1, "First"), (2, "c.d"), (5, "e.f")]


def test_files(spark, tmp_path):
    assert files.table_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert files.write_unless_empty(df, str(tmp_path / "t")) and not files.write_unless_empty(df.limit(0), str(tmp_path / "t"))
    assert files.table_or_empty(spark, str(tmp_path / "t"), "a int, b string").count() == 1
    files.publish_json({"a": 1}, str(tmp_path / "d/x.json"), [str(tmp_path / "m/x.json")])
    assert (tmp_path / "m/x.json").read_text() == (tmp_path / "d/x.json").read_text()
    (tmp_path / "l.txt").write_text("# c\n\nhttps://www.a.b/x\nc.d/\n")
    assert {r.domain for r in files.domain_list(spark, str(tmp_path / "l.txt")).collect()} == {"a.b", "c.d"}


def test_matching(spark):
    w = spark.createDataFrame([("https://a.b/news/the-long-story-of-it",), ("https://a.b/zzzzzzzzzzzzzzzz",), (None,)], "raw_url string")
    k = spark.createDataFrame([("https://www.a.b/news/the-long-story-of-it-123",), ("https://c.d/news/the-long-story-of-it",)], "url string")
    got = matching.resolved_urls(w, k).collect()
    assert [(r.url, r.score >= 0.82) for r in got] == [("https://a.b/news/the-long-story-of-it-123", True)]
    h = spark.createDataFrame([("central bank raises rates again",)], "headline string")
    a = spark.createDataFrame([("1", "Central bank raises rates"), ("2", "Football results"), ("3", None)], "id string, title string")
    assert [r.id for r in matching.headline_matches(h, a).collect()] == ["1"]
    b = spark.createDataFrame([("g", 1, "rates rise again"), ("g", 2, "rates rise again!"), ("g", 3, "oil falls"), ("g", 4, None)], "g string, i int, t string")
    assert {r.i for r in matching.distinct_bullets(b, "g", "t", "i").collect()} == {1, 3, 4}


def test_urls_by_title(spark):
    w = [
        ("https://a.b/news/the-long-story-of-it", "Rates rise in Ulkast"), ("https://a.b/short", "Harvest late in the northern valley"), ("https://e.f/gone-long-ago", "Oil falls as exports grow"),
        ("https://a.b/nothing-like-it-at-all", "zq"), ("https://a.b/no-headline-here", None),
    ]
    k = [
        ("https://a.b/news/the-long-story-of-it-1", "Football results of the week"), ("https://a.b/news/the-long-story-of-it-123", "Rates rise in Ulkast"), ("https://a.b/x/1", "Harvest is late in northern valley"),
        ("https://c.d/y/2", "Oil falls as exports grow again"), ("https://c.d/y/3", None),
    ]
    got = {r.raw_url: r.url for r in matching.resolved_urls(spark.createDataFrame(w, "raw_url string, headline string"), spark.createDataFrame(k, "url string, title string")).collect()}
    assert got == {w[0][0]: k[1][0], w[1][0]: k[2][0], w[2][0]: k[3][0]}


def test_common_words_and_late_bullets(spark):
    rows = [("g", i, "rates rise again" + "!" * (i % 3)) for i in range(300)] + [("g", 300, "oil falls"), ("h", 1, "oil falls")]
    b = spark.createDataFrame(rows, "g string, i int, t string").repartition(4)
    assert {(r.g, r.i) for r in matching.distinct_bullets(b, "g", "t", "i").collect()} == {("g", 0), ("g", 300), ("h", 1)}
    # the best title shares only the word that many titles have; the rare one stands in a poorer title
    a = spark.createDataFrame([(f"n{i:02}", f"markets {'x' * 40}{i}") for i in range(30)] + [("best", "Markets up in May"), ("rare", "Zebra")], "id string, title string")
    h = spark.createDataFrame([("markets up in may zebra",)], "headline string")
    assert [r.id for r in matching.headline_matches(h, a).collect()] == ["best"]


def test_compacted_alias(spark):
    texts = spark.createDataFrame([(1, "Open AI said"), (2, "the open-ai lab"), (3, "OpenAI"), (4, "open sea"), (5, None)], "i int, t string")
    names = spark.createDataFrame([("o", ["--", "OpenAI"])], "entity string, aliases array<string>")
    assert sorted(tuple(r) for r in matching.entity_hits(texts, "i", "t", names).collect()) == [(1, "o", "openai"), (2, "o", "openai"), (3, "o", "openai")]


def test_split_late(spark):
    df = spark.createDataFrame([(1, datetime(2025, 1, 3)), (2, datetime(2025, 1, 1)), (3, None)], "i int, at timestamp")
    good, late = flows.split_late(df, "at", "2025-01-03 12:00:00", "24 HOURS")
    assert ([r.i for r in good.collect()], sorted(r.i for r in late.collect())) == ([1], [2, 3])


def test_one_row_each(spark):
    from tidewire.operators.ranking import one_row_each

    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, None), (None, 1, "n"), (None, 1, "n"), ("c", 1, None)]
    df = spark.createDataFrame(rows, "id string, at int, _n string")
    got = sorted(map(tuple, one_row_each(df, "id", "at").collect()), key=str)
    assert got == sorted([("a", 2, "y"), ("b", None, None), (None, 1, "n"), (None, 1, "n"), ("c", 1, None)], key=str)
    assert one_row_each(df.limit(0), "id").count() == 0


def test_staged_tables_go(spark, tmp_path):
    from tidewire.runtime import drop_staged, exists, is_folder, listed, shared_dir, staged

    df = staged(spark.range(5).toDF("n"), "probe")
    assert df.count() == 5 and any(x.startswith("probe-") for x in listed(spark, shared_dir(spark)))
    assert drop_staged(spark) >= 1 and not any(x.startswith("probe-") for x in listed(spark, shared_dir(spark)))
    assert is_folder(spark, str(tmp_path)) and not exists(spark, f"{tmp_path}/none") and listed(spark, f"{tmp_path}/none") == []


def test_prose_covered(spark):
    prose = "Rates rise again in the spring, the bank said, and nobody was asked about that before."
    rows = [("rates rise again", True), (prose[:70] + " or else", True), (prose.replace("spring", "autumn"), True), ("oil falls", False), ("", False), (None, False)]
    df = spark.createDataFrame([(t, prose, w) for t, w in rows], "t string, p string, want boolean")
    assert all(r.want == r.got for r in df.select("want", matching.prose_covered(F.col("t"), F.col("p")).alias("got")).collect())
