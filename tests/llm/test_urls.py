import re

import pytest

from marquee.llm.urls import BLOCKED, RULES, judge_urls, labelled_urls, train_url_model


@pytest.fixture(scope="module")
def model(spark):
    return train_url_model(labelled_urls(spark))


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [(len(h + p), h + p, say) for say, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=(0, None, None))[1:]


ODD = [None, "", "no scheme.net/", "http://", "HTTP://A.NET/x", "http://Ä.Example.NET/en/1?q", "http://x.example.net", "http://xexample.net/en/", "ftp://u@org/fr/x#y", "http://a.org/fr", "a://b://net/", "http://example.com/de/\nx?y", "http://" + "h" * 5000 + ".net/" + "p" * 5000]


def test_parts_rules_and_verdicts(spark, sample, model):
    pages = sample("pages", "sf0.01")
    odd = spark.createDataFrame([(i // 2, u, 0.5) for i, u in enumerate(ODD)] + [(None, "http://net/", 1.0)], "page_id long, url string, found double")
    for df in (pages, odd):
        urls = [(r.page_id, *parts(r.url), *rule(*parts(r.url))) for r in df.collect()]
        got = judge_urls(df, model).collect()
        key = lambda x: repr(x[:3])
        for g, w in zip(sorted(map(tuple, got), key=key), sorted(urls, key=key), strict=True):
            assert g[:4] == w[:4]
            assert g[4] == (w[4] or ("block" if g[5] >= 0.5 else "allow"))


def test_blocks_what_it_was_shown_the_kind_of(sample, model, spark):
    got = judge_urls(sample("pages", "sf0.1"), model).where("rule is null").collect()
    spam = re.compile("spam|pills|casino|bets|ads")
    assert all((r.verdict == "block") == bool(spam.search(r.host)) for r in got)
    shown = spark.createDataFrame(list(enumerate(BLOCKED)), "page_id long, url string")
    assert {r.verdict for r in judge_urls(shown, model, rules=[]).collect()} == {"block"}


def test_no_python_in_the_plan(sample, model):
    plan = judge_urls(sample("pages"), model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_and_one_sided_tables(spark):
    none = spark.createDataFrame([], "url string, label double")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(pages, train_url_model(none)).collect()] == ["allow"]
    one = spark.createDataFrame([("http://b.com/", 1.0), ("http://c.com", None)], "url string, label double")
    assert [r.verdict for r in judge_urls(pages, train_url_model(one)).collect()] == ["block"]
    assert judge_urls(pages.limit(0), train_url_model(one)).collect() == []
