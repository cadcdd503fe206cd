from __future__ import annotations

import random

from framelake.llm.bloom import bloom_blocks, possible_hits
from framelake.llm.url_filter import judge_urls, rule_table

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.b.example.org", "", "allow")]


def expected(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, verdict string")


def test_against_every_rule(spark):
    draw = random.Random(1)
    hosts = ["example.org", "EXAMPLE.org", "www.example.org", "myexample.org", "a.b.example.org", "org", "x.com", "com", "net", "", "é.com", "xorg", ".org", "example.org:80"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12.html", "/en/2", "/fr/x", "/de/", "/DE/", "/de/?q#f", "?x=/es/", "#/es/", "//", "/es/://y", "/fr/\nz"]
    rows = [(i, draw.choice(["http://", "https://", "://", "", "x://http://"]) + draw.choice(hosts) + draw.choice(paths)) for i in range(600)]
    rows += [(None, None), (1, None), (2, ""), (3, "http://example.org/" + "es/" * 100_000), (4, "http://" + "a." * 5000 + "org/"), rows[0], rows[0]]
    got = judge_urls(pages(spark, rows), rule_table(spark, RULES)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted([(i, *expected(u, RULES)) for i, u in rows], key=repr)


def test_rules_with_nulls_repeats_and_none(spark):
    rules = spark.createDataFrame([("org", "/", "allow"), ("org", "/", "block"), (None, "/", "block"), ("com", None, "block"), ("net", "/", None)], "host string, path string, verdict string")
    got = judge_urls(pages(spark, [(1, "http://a.org/"), (2, "http://a.net/x")]), rules).collect()
    assert sorted(map(tuple, got)) == [(1, "a.org", "/", "org/", "allow"), (2, "a.net", "/x", None, "allow")]
    none = judge_urls(pages(spark, [(1, "http://a.org/")]), rules.limit(0), default="block").collect()
    assert [tuple(r) for r in none] == [(1, "a.org", "/", None, "block")]
    assert judge_urls(pages(spark, []), rules).collect() == []


def test_filter_loses_no_key_and_passes_few_others(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    blocks = bloom_blocks(keys)
    assert possible_hits(keys, blocks).count() == 3000
    others = spark.range(20_000).selectExpr("concat('other', id) AS key")
    assert possible_hits(others, blocks).count() < 20
