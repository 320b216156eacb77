import random

import pytest
from pyspark.sql import functions as F

from shopgrain.llm import queries, url_rules
from shopgrain.operators import lookup as lookups

RULES = queries.URL_RULES


def by_hand(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for v, h, p in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, "allow"
    best = max(fits)
    return host, path, best[2], "block" if ("block" in {f[3] for f in fits if f[:3] == best[:3]}) else "allow"


def judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    found = url_rules.judge_urls(pages, table).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}


URLS = [
    "http://a.net/x", "http://net/", "http://net", "http://NET/?q", "http://x.example.net/en/1", "http://example.net/en",
    "http://example.net/en/#t", "http://notexample.com/de/", "https://www.example.com/de/1?x=/fr/", "org", "http://org/fr/a",
    "http://a.b.c.org/fr/", "http://a.org/en/fr/", "http://example.com?/de/", "://net/", "http://", "http:///net/", None, "",
    "http://u@A.Net:80/x", "ftp://a.net/b?c#d", "http://net./x", "http://.net/x", "x://y://net/z", "http://a..net/é/", "http://net/\nx",
]


def test_the_query_s_rules(spark):
    assert judged(spark, URLS, RULES) == {i: by_hand(u, RULES) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("seed", range(3))
def test_nested_rules(spark, seed):
    rng = random.Random(seed)
    labels, steps = ["a", "b", "aa", "net"], ["", "/", "/x", "/x/", "/x/y", "/xy", "/x/y/z"]
    hosts = [".".join(rng.choices(labels, k=rng.randrange(1, 5))) for _ in range(40)]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(steps)) for _ in range(60)]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(steps)}{rng.choice(['', '?q', '#f', 'w'])}" for _ in range(400)]
    assert judged(spark, urls, rules) == {i: by_hand(u, rules) for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    assert set(judged(spark, URLS, RULES[:1]).values()) >= {("", "", None, "allow")}
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert [tuple(r) for r in url_rules.judge_urls(pages, none).collect()] == [(1, "a.net", "/", None, "allow")]
    assert url_rules.judge_urls(pages.where("false"), none).collect() == []


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://a.net/"), (2, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    clash = pages.select("*", *[F.lit("x").alias(c) for c in ("id", "host", "path", "rule", "verdict", "key", "part")])
    table = queries.url_rules_table(spark)
    expected = sorted([(1, "net/"), (1, "net/"), (None, "net/"), (2, None)], key=repr)
    for p in (pages, clash):
        found = url_rules.judge_urls(p, table).collect()
        assert sorted([(r.page_id, r.rule) for r in found], key=repr) == expected


def test_a_host_of_very_many_labels(spark):
    url = "http://" + "a." * 20_000 + "net/x"
    assert judged(spark, [url], RULES)[0][2:] == ("net/", "block")


def test_no_python_runs_on_the_main_path(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    judged = url_rules.judge_urls(pages, queries.url_rules_table(spark))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_the_sql_gives_the_same(spark):
    from tests.oracle_check import compare, connect

    sf_dir = "/root/testdata/sf0.01"
    sql = queries.ORACLE["op6_url_rules"]
    problem, n = compare(spark, connect(sf_dir), sf_dir, "op6", queries.QUERIES["op6_url_rules"], sql)
    assert problem is None and n == 250


def test_a_hot_address_is_spread(spark, monkeypatch):
    """Without broadcasts the pages join their verdicts with a salt, and the verdicts are the same."""
    urls = URLS + ["http://a.net/x"] * 300 + [None] * 300
    whole = judged(spark, urls, RULES)
    monkeypatch.setattr(lookups, "small", lambda *_, **__: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
        table = spark.createDataFrame(RULES, "verdict string, host string, path string")
        found = url_rules.judge_urls(pages, table)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [host" in plan and "_salt" in plan.split("SortMergeJoin [host")[1].split("\n")[0]
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()} == whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_rule_paths_have_few_prefixes(spark):
    long = "/" + "x" * 20_000
    rules = [("block", "a.net", long), ("allow", "a.net", long + "/y"), ("allow", "net", "/x")]
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    assert {len(r.stack) for r in url_rules.rules_with_stacks(table).collect()} == {1, 2}
    urls = [f"http://a.net{long}", f"http://b.a.net{long}/y/z", "http://a.net/x", "http://c.net/xy"]
    assert judged(spark, urls, rules) == {i: by_hand(u, rules) for i, u in enumerate(urls)}
