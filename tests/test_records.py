from pyspark.sql import functions as F

from tidewire.operators import clusters, quality
from tidewire.sources.records import fenced_json, json_strings, uniform_rows

COMMON = {"url": "string", "title": "string", "stars": "int", "lane": "string"}


def test_uniform_rows(spark):
    a = spark.createDataFrame([('{"html_url": " https://x/1 ", "stars": 3}',), ("broken",), (None,), ("{}",)], "body string")
    b = spark.createDataFrame([('{"id": "m", "card": {"t": "M"}}',)], "body string")
    rows = uniform_rows(a, "body", "html_url string, stars int", {"url": "r.html_url", "stars": "r.stars", "lane": "'repo'"}, COMMON)
    rows = rows.unionByName(uniform_rows(b, "body", "id string, card struct<t: string, u: string>", {"url": "concat('https://h/', r.id)", "title": "r.card.t"}, COMMON))
    assert [tuple(r) for r in rows.orderBy("url").collect()] == [("https://h/m", "M", None, None), ("https://x/1", None, 3, "repo")]


def test_json_text(spark):
    df = spark.createDataFrame([('x ```json\n{"a": "1"}\n``` y', '["u"]'), ("none", "no json"), (None, None)], "text string, l string")
    got = df.select(fenced_json().alias("m"), json_strings("l").alias("l")).collect()
    assert [(r.m, r.l) for r in got] == [({"a": "1"}, ["u"]), (None, []), (None, [])]


def test_violations(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "id int, v string")
    rules = [quality.Rule("lenient", F.col("v") == "a"), quality.Rule("strict", F.col("v") == "a", strict=True)]
    assert [tuple(r) for r in quality.violations(df, "id", rules).collect()] == [(2, "strict")]
    assert {r.id for r in quality.repeated_values(df, "id", F.col("v"), "x").collect()} == {1, 3}
    known = spark.createDataFrame([("b",)], "k string")
    assert {r.id for r in quality.unknown_values(df, "id", F.col("v"), known, "x").collect()} == {1, 3}
    assert quality.violations(df.limit(0), "id", rules).count() == 0


def test_clusters(spark):
    df = spark.createDataFrame([(1, "c", 5, ["u", "v"]), (2, "c", 9, ["v", "w"]), (3, None, 1, None), (4, None, 1, ["z"])], "id int, c string, n int, urls array<string>")
    got = {tuple(map(str, r)) for r in clusters.merged(df, "c", "id", [F.col("n").desc(), F.col("id").asc()], ["n"], "urls", cap=2).collect()}
    assert got == {("2", "2", "9", "['v', 'w']"), ("3", "1", "1", "[]"), ("4", "1", "1", "['z']")}
    assert {r.id for r in clusters.best_of_cluster(df, F.col("c"), "id", [F.col("n").desc()]).collect()} == {2, 3, 4}
    one = spark.sql("SELECT TIMESTAMP '2025-01-02 00:00:00' a, TIMESTAMP '2025-01-01 00:00:00' b")
    row = one.select(clusters.better_time(F.col("a"), F.col("b"), F.lit(False), F.lit(True)).alias("t"), clusters.age_hours(F.col("b"), F.col("a")).alias("h"), clusters.age_hours(F.col("a"), F.col("b")).alias("z")).first()
    assert (row.t.day, row.h, row.z) == (1, 24, 0)


def test_hot_cluster_keeps_later_urls(spark):
    rows = [(i, "c", -i, ["u"] if i < 900 else [f"v{i}", "u"]) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, c string, n int, urls array<string>").repartition(5)
    got = clusters.merged(df, "c", "id", [F.col("n").desc(), F.col("id").asc()], ["n"], "urls", cap=4).first()
    assert (got.id, got.members, got.urls) == (0, 1000, ["u", "v900", "v901", "v902"])
