import re

import pytest

from shelfwatch.llm.url_filter import MOST_RULES, RULES, judge, labelled_urls, matching_rule, split_by_host, train

PAGES = "page_id bigint, url string, html string, host string, rule string"


@pytest.fixture(scope="module")
def model(spark):
    return train(labelled_urls(spark))


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def rule(host, path):
    fits = []
    for text, action in RULES:
        name, start = text.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(text), text, action))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "://", "http://", "https://WWW.Example.ORG/es/1", "http://example.org/en/12?x#y", "http://example.org/en/2",
    "http://xexample.org/es/", "http://shop.com/fr/", "http://shop.com/de/9", "http://com/de/", "http://a.com?x=/de/", "ftp://É.example.org#/es/",
    "http://a.com/de", "x://y://z.org/es/", "https://news.site.net/de/4", "http://org/", "http://org", "a\n://example.org/es/\n", "http://" + "a" * 5000 + ".net/" + "b" * 50000,
]


def test_hosts_paths_and_rules(rows, model):
    got = judge(rows(PAGES, *[(i, u, None, "x", "y") for i, u in enumerate(URLS)], (None, URLS[5], None, None, None)), model).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        url = URLS[5] if r.page_id is None else URLS[r.page_id]
        assert (r.host, r.path) == split(url)
        text, action = rule(*split(url))
        assert r.rule == text
        assert r.verdict == (action or ("block" if r.score > 0.5 else "allow"))


def test_unwanted_hosts_of_the_pages_are_found(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    marks = "casino-win|ads-track|free-bets|spam-farm|cheap-pills|adult-x"  # none of them is a name in the labelled table
    assert labelled_urls(spark).where(f"url rlike '{marks}'").count() == 0
    found = judge(pages, model).selectExpr(f"host rlike '{marks}' AS bad", "score > 0.5 AS blocked").groupBy("bad", "blocked").count()
    counts = {(r.bad, r.blocked): r["count"] for r in found.collect()}
    assert counts[True, True] >= 0.95 * (counts[True, True] + counts.get((True, False), 0))
    assert counts.get((False, True), 0) <= 0.02 * counts[False, False]


def test_hosts_held_out_are_judged_right(spark):
    taught, held = split_by_host(labelled_urls(spark))
    rows = held.selectExpr("CAST(label AS BIGINT) AS page_id", "url")
    total, right = rows.count(), judge(rows, train(taught)).where("(score > 0.5) = (page_id = 1)").count()
    print(f"held out: {right} of {total}")
    assert total > 150 and right >= 0.95 * total
    assert taught.count() + total == labelled_urls(spark).count()


def test_longest_rule_wins_and_rules_are_bounded(rows, spark):
    table = rows("h string, p string", ("a.b.c", "/x/y"))
    choice = matching_rule(table.h, table.p, [("c/", "block"), ("b.c/x/", "allow"), ("c/x/y/", "block"), ("a.b.c", "block"), ("b.c/x?", "block")])
    assert table.select(choice.rule).first()[0] == "b.c/x/"
    with pytest.raises(ValueError):
        matching_rule(table.h, table.p, [("c/", "block")] * (MOST_RULES + 1))


def test_tables_without_rows(spark, model):
    assert judge(spark.createDataFrame([], PAGES), model).count() == 0
