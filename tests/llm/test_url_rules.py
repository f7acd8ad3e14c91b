"""Operator 12: stated rules, and mined rules against all combinations."""

import random

import pytest
from pyspark.sql import functions as F

from parcelflow.llm.url_rules import (ALLOW, BLOCK, RULES, filter_urls, host_of, labelled_by_rules,
                                      mined_rules, path_of, tokens)

STATED = [  # url, host, path, rule, verdict of the rule
    ("http://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", ALLOW),
    ("http://EXAMPLE.Net/EN/1", "example.net", "/EN/1", "net/", BLOCK),
    ("https://example.net/en", "example.net", "/en", "net/", BLOCK),
    ("x://net/", "net", "/", "net/", BLOCK),
    ("x://net", "net", "", None, None),
    ("http://notnet/", "notnet", "/", None, None),
    ("http://b.example.com/de/?x=/fr/", "b.example.com", "/de/", "example.com/de/", BLOCK),
    ("http://badexample.com/de/", "badexample.com", "/de/", None, None),
    ("http://x.org/fr/a#b?c", "x.org", "/fr/a", "org/fr/", ALLOW),
    ("http://x.org?/fr/", "x.org", "", None, None),
    ("http://x.org#://y.net/", "x.org", "", None, None),
    ("a://b://c.net/d", "b:", "//c.net/d", None, None),
    ("http://É.NET/x\ny", "É.net", "/x\ny", "net/", BLOCK),
    ("example.net/en/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", "x") for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, tokens string")


def test_stated_rules_hosts_and_paths(spark):
    given = pages(spark, [u for u, *_ in STATED])
    found = {r.page_id: r for r in filter_urls(given, labelled_by_rules(given)).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(STATED):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].by_rule == (rule is not None)
        assert found[i].verdict in (BLOCK, ALLOW) and (rule is None or found[i].verdict == verdict)


def generated(spark, n=400):
    rng = random.Random(3)
    urls = [f"{rng.choice(['http', 'https'])}://{rng.choice(['www', 'm', 'blog'])}."
            f"{rng.choice('abc')}.{rng.choice(['com', 'org', 'net'])}/{rng.choice(['en', 'de'])}/"
            f"{rng.randint(1, 999)}{rng.choice(['', '.html', '?ref=x', '?ref=y&q=1', '#top'])}"
            for _ in range(n)]
    label = [BLOCK if ".net/de" in u or ("ref=" in u and "blog" in u) or rng.random() < .03
             else ALLOW for u in urls]
    return pages(spark, urls), spark.createDataFrame(
        list(zip(range(n), urls, label, strict=True)), "key long, url string, label string")


def brute(rows, support, confidence):
    """All combinations of items, the implied ones taken out."""
    where = {}
    for i, (t, _) in enumerate(rows):
        for x in t:
            where.setdefault(x, set()).add(i)
    first = {}
    for x in sorted(where):
        first.setdefault(frozenset(where[x]), x)
    items = {x: set(s) for s, x in first.items() if len(s) >= support * len(rows)}
    rules, grown = {}, {(): set(range(len(rows)))}
    while grown:
        grown = {(*c, x): both & items[x] for c, both in grown.items() for x in sorted(items)
                 if (not c or x > c[-1]) and len(both & items[x]) >= support * len(rows)}
        for c, both in grown.items():
            for label in (BLOCK, ALLOW):
                hits = sum(rows[i][1] == label for i in both)
                if hits >= support * len(rows) and hits / len(both) >= confidence:
                    rules[c, label] = (hits / len(both), len(both))
    return {(c, label, *v) for (c, label), v in rules.items() if not any(
        rules.get((c[:i] + c[i + 1:], label), (-1,))[0] >= v[0] for i in range(len(c)))}


@pytest.mark.parametrize("support,confidence", [(0.02, 0.9), (0.05, 0.75)])
def test_mined_rules_and_verdicts_against_all_combinations(spark, support, confidence):
    given, labelled = generated(spark)
    read = labelled.select(tokens(F.col("url")).alias("t"), "label").collect()
    expected = brute([(r.t, r.label) for r in read], support, confidence)
    found = mined_rules(labelled, support, confidence)
    assert {(tuple(r["items"]), r.label, r.confidence, r.n) for r in found.collect()} == expected
    assert expected
    verdicts = {r.page_id: r.verdict for r in filter_urls(
        given, labelled, (), support, confidence).collect()}
    for i, r in enumerate(labelled.orderBy("key").select(tokens(F.col("url")).alias("t")).collect()):
        fit = [(-c, -n, -len(x), label, x) for x, label, c, n in expected if set(x) <= set(r.t)]
        assert verdicts[i] == (min(fit)[3] if fit else ALLOW)


def test_tokens(spark):
    url = "https://WWW.a.com/en/12/x3.html?b=2&a=1&a=1#top"
    row = pages(spark, [url, "nothing", None]).select(tokens(F.col("url")).alias("t")).collect()
    assert row[0].t == sorted(["scheme:https", "host:www", "host:a", "host:com", "path:en", "path:0",
                               "path:x0", "type:html", "key:a", "key:b", "set:a=1", "set:b=2",
                               "part:top"])
    assert row[1].t == row[2].t == []


def test_templates_do_not_multiply_combinations(spark):
    # thirty settings that always stand together would make 2^30 combinations
    long = "http://a.com/?" + "&".join(f"k{i}={i}" for i in range(30))
    rows = [(i, long if i % 2 else f"http://b.org/{'x' * (i % 5 + 1)}", BLOCK if i % 2 else ALLOW)
            for i in range(60)]
    labelled = spark.createDataFrame(rows, "key long, url string, label string")
    assert 1 <= mined_rules(labelled, 0.1, 0.9).count() < 20


def test_bounded_sample_empty_tables_and_no_labels(spark):
    given, labelled = generated(spark)
    assert mined_rules(labelled, sample=100).count() >= 0
    none = labelled.filter("false")
    assert {r.verdict for r in filter_urls(given, none, ()).collect()} == {ALLOW}
    assert filter_urls(given.filter("false"), labelled, RULES).count() == 0
    empty = given.filter("false")
    assert filter_urls(empty, labelled_by_rules(empty)).count() == 0
    twice = given.unionAll(given)
    assert filter_urls(twice, labelled).count() == 800
    long = pages(spark, ["http://a.net/" + "x/" * 50_000, "http://a.com/?" + "y=1&" * 50_000])
    assert [r.rule for r in filter_urls(long, labelled_by_rules(long)).orderBy("page_id").collect()] == [
        "net/", None]


def test_host_and_path_of_columns(spark):
    row = pages(spark, ["ftp://H/p?q"]).select(host_of(F.col("url")).alias("h"),
                                              path_of(F.col("url")).alias("p")).first()
    assert (row.h, row.p) == ("h", "/p")
