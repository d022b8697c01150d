import re

import duckdb
from pyspark.sql import functions as F

from skyquarry.llm import queries, urlfilter

RULES = queries.URL_RULES


def brute(url):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[2]) if m else ""
    path = m[3] if m else ""
    fit = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, "allow")


URLS = [None, "", "x", "://", "http://", "http://com", "http://com/", "HTTP://COM/en/", "http://a.b.com?x=/", "http://example.com/en/1", "http://Sub.EXAMPLE.com/en", "http://www.example.com/en/x#y", "http://xexample.com/en/", "http://a.www.example.com/en/", "http://shop.net/es/1", "http://net/fr/", "http://shop.net/FR/", "http://a..com/", "http://com./", "http://u@x.com:80/", "http://u@x.com/", "http://é.net/fr/ü", "a://b://com/en/", "http://com/\n/en/", "http://" + "a." * 3000 + "com/" + "y" * 9000, "http://com/", "http://com/"]


def test_query_and_sql_match_brute_force(spark, small):
    found = queries.op8_url_filter(spark, small).collect()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert len(found) == len(urls)
    assert all((r["host"], r["path"], r["rule"], r["verdict"]) == brute(urls[r["page_id"]]) for r in found)
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{small}/pages.parquet'")
    assert sorted(map(tuple, (r for r in found)), key=str) == sorted(db.execute(queries.OP8_SQL).fetchall(), key=str)


def test_awkward_urls(spark):
    df = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(URLS)], "page_id long, url string, key string, host int")
    found = urlfilter.judged(df, RULES).collect()
    assert len(found) == len(URLS)
    for r in found:
        assert (r["url_host"], r["url_path"], r["url_rule"], r["url_verdict"]) == brute(URLS[r["page_id"]])
    assert urlfilter.judged(df.limit(0), RULES).count() == 0
    assert {r["url_verdict"] for r in urlfilter.judged(df, []).collect()} == {"allow"}


def test_a_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = universe.where(F.crc32("key") % 7 == 0)
    levels = urlfilter.cascade(universe, listed)
    assert len(levels) > 2
    wrong = universe.withColumn("in", urlfilter.member(F.col("key"), levels)).where(F.col("in") != (F.crc32("key") % 7 == 0))
    assert wrong.count() == 0


def test_the_main_path_has_no_python(spark, small):
    plan = queries.op8_url_filter(spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Join", plan)


def test_later_levels_do_not_grow_with_the_universe(spark):
    listed = spark.createDataFrame([(f"host{i}/",) for i in range(5)], "key string")
    universe = spark.range(300_000).selectExpr("concat('u', id, '.example/') as key").union(listed)
    levels = urlfilter.cascade(universe, listed)
    assert sum(map(len, levels[1:])) <= 2
    told = universe.select("key", urlfilter.member(F.col("key"), levels).alias("in")).where("in")
    assert sorted(r[0] for r in told.collect()) == [f"host{i}/" for i in range(5)]


def test_a_universe_of_tens_of_millions_of_keys_needs_no_larger_later_levels(spark):
    listed = spark.range(40).selectExpr("concat('host', id, '/') as key")
    universe = spark.range(20_000_000).selectExpr("concat('u', id, '.example/') as key").union(listed)
    levels = urlfilter.cascade(universe, listed)
    assert sum(map(len, levels)) < 200 and sum(map(len, levels[1:])) <= 8
    told = universe.select(urlfilter.member(F.col("key"), levels).alias("in")).where("in")
    assert told.count() == 40


def test_many_rules_are_not_refused(spark):
    universe = spark.range(900_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = universe.where("substring(key, 2) % 2 = 0")
    levels = urlfilter.cascade(universe, listed)
    assert universe.where(urlfilter.member(F.col("key"), levels) != (F.substring("key", 2, 20).cast("long") % 2 == 0)).count() == 0
