import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from strata.llm import url_filter
from strata.llm.queries import op4_url_filters
from strata.llm.url_filter import RULES, judge_urls


def host_and_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def given(host, path):
    fits = [(len(r), r, v) for r, v in RULES for own, rest in [r.split("/", 1)]
            if (host == own or host.endswith("." + own)) and path.startswith("/" + rest)]
    return max(fits)[1:] if fits else (None, None)


def brute(urls, tokens):
    """Rules from all token subsets of the labelled URLs, then the best for each other URL."""
    labelled = [(frozenset(tokens[u]), given(*host_and_path(u))[1]) for u in urls if given(*host_and_path(u))[0]]
    sets, with_verdict = Counter(), Counter()
    for t, v in labelled:
        for n in range(1, len(t) + 1):
            for s in combinations(sorted(t), n):
                sets[s] += 1
                with_verdict[s, v] += 1
    rules = {(s, v): (n / sets[s], n / len(labelled)) for (s, v), n in with_verdict.items()
             if n / len(labelled) >= url_filter.MIN_SUPPORT and n >= url_filter.MIN_URLS and n / sets[s] >= url_filter.MIN_CONFIDENCE}
    short = {(s, v): c for (s, v), c in rules.items() if not any(
        rules.get((tuple(x for x in s if x != t), v), (0,))[0] >= c[0] for t in s)}
    out = []
    for u in urls:
        host, path = host_and_path(u)
        rule, verdict = given(host, path)
        fits = [(c, n, -len(s), v) for (s, v), (c, n) in short.items() if set(s) <= set(tokens[u])]
        out.append((host, path, rule, verdict or (max(fits)[3] if fits else "allow")))
    return out


URLS = [None, "", "no scheme", "http://", "http://ORG/", "http://a.org", "http://a.ORG/x?y=1", "https://x.example.org/en/12#t", "https://example.org/es/",
        "ftp://notexample.org/es/", "http://b.com/de/é", "http://com/fr/", "HTTP://b.com?q=://x.org/", "a://b://c.org/x", "http://b.com/dex", "http://É.com/de/x"]


def test_query_against_brute_force(spark, tmp_path):
    pages = list(enumerate(URLS + [f"http://{h}/{p}/{i}{e}" for i in range(12) for h in ("a.org", "b-c.com", "x.example.net", "spam.example.org")
                                   for p in ("de", "fr", "es", "en") if (h, p) != ("a.org", "es") for e in ("", ".html", "?k=1&l=2")] + URLS[4:6]))
    spark.createDataFrame(pages, "page_id long, url string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    host, path = url_filter.host_and_path(F.col("url"))
    tokens = {r.url: r.t for r in spark.createDataFrame(pages, "page_id long, url string").select("url", url_filter.url_tokens(F.col("url"), host, path).alias("t")).collect()}
    want = {i: w for (i, _), w in zip(pages, brute([u for _, u in pages], tokens))}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in op4_url_filters(spark, str(tmp_path)).collect()}
    assert got == want and {w[3] for w in want.values() if w[2] is None} == {"allow", "block"}


def test_given_table(spark):
    d = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    rows = op4_url_filters(spark, d).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = host_and_path(urls[r.page_id])
        rule, verdict = given(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and r.verdict == (verdict or r.verdict)


def test_words_after_a_number_decide(spark):
    urls = [f"http://a{i}.com/de/2024-free-pills" for i in range(20)] + [f"http://a{i}.com/fr/{i}" for i in range(20)]
    open_urls = {"http://q.net/x/2025-free-pills": "block", "http://q.net/x/7": "allow", "http://q.net/x/3d-print": "allow"}
    got = judge_urls(spark.createDataFrame([(u,) for u in [*urls, *open_urls]], "url string")).collect()
    mined = {r.url: (r.verdict, r.mined) for r in got if r.url in open_urls}
    assert mined == {"http://q.net/x/2025-free-pills": ("block", ["path1:0-free-pills"]), "http://q.net/x/7": ("allow", ["path1:0"]),
                     "http://q.net/x/3d-print": ("allow", None)}


@pytest.mark.parametrize("rows", [[], [(None, None, "x")], [(1, "http://q.net/", "x"), (1, "http://q.net/", "x")]])
def test_edge_tables(spark, rows):
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"))
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict", "mined"]
    assert [r.verdict for r in got.collect()] == ["allow"] * len(rows)


def test_one_labelled_url_makes_no_rule(spark):
    urls = ["http://a.com/de/spam/now", "http://b.com/fr/x", "http://c.net/q/spam", "http://d.net/de"]
    got = {r.url: (r.verdict, r.mined) for r in judge_urls(spark.createDataFrame([(u,) for u in urls], "url string")).collect()}
    assert got[urls[2]] == got[urls[3]] == ("allow", None)
    twice = judge_urls(spark.createDataFrame([(u,) for u in urls[:1] * 3 + urls[1:]], "url string")).collect()
    assert {r.url: r.mined for r in twice}["http://d.net/de"] == ["path0:de"]


def test_a_long_url_repeated_often(spark):
    long = "http://a.com/de/" + "/".join(f"part{i}" for i in range(58))
    urls = [long] * 1000 + [f"http://b{i}.com/fr/{i}" for i in range(100)] + ["http://q.net/x/part1", "http://q.net/x/y/part3", "http://q.net/0/7"]
    got = {r.url: (r.verdict, r.mined) for r in judge_urls(spark.createDataFrame([(u,) for u in urls], "url string")).collect()}
    assert got["http://q.net/x/part1"] == ("allow", None)  # another place in the path
    assert got["http://q.net/0/7"][0] == "allow"
    probe = "http://q.net/x/part0"
    again = judge_urls(spark.createDataFrame([(u,) for u in [*urls, probe]], "url string")).where(F.col("url") == probe).first()
    assert (again.verdict, again.mined) == ("block", ["path1:part0"])


def test_ties_of_mined_rules_go_to_block(spark):
    """Two rules of equal confidence, support and length."""
    urls = [f"http://a{i}.com/de/left" for i in range(5)] + [f"http://b{i}.com/fr/x/right" for i in range(5)] + ["http://q.net/x/left/right"]
    got = judge_urls(spark.createDataFrame([(u,) for u in urls], "url string")).where("rule IS NULL").first()
    assert (got.verdict, got.mined) == ("block", ["path1:left"])
