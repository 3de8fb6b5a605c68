import re

import pytest

from boardroll.llm import queries, url_filter

RULES = queries.URL_RULES
URLS = [
    None, "", "no scheme example.org/es/", "http://Example.ORG/es/1?x=/en/1", "https://www.example.org/en/12#a",
    "http://example.org", "http://example.org?q", "http://a.b.com/fr/", "http://com/de/x", "http://xcom/de/x",
    "HTTP://X.COM/DE/", "http://example.org/es", "x://y://z/../fr/", "http:///path", "http://é.com/fr/ü",
    "http://" + "a" * 3000 + ".com/de/" + "b" * 3000, "http://h.net/\n/x?y", "ftp://user@example.com:80/fr/#",
]


def slow(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in RULES:
        own, _, start = rule.partition("/")
        if ("." + host).endswith("." + own) and path.startswith("/" + start):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


def test_rules_against_brute_force(spark):
    rows = [(k, u, "<html>") for k, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = url_filter.judge(pages, RULES, url_filter.rule_labels(pages, RULES)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.host, r.path, r.rule) == slow(rows[r.page_id][1])
        assert r.verdict == (RULES[r.rule] if r.rule else ("block" if r.block_score >= 0.5 else "allow"))
    assert len({r.block_score for r in out if r.host == r.path == ""}) == 1
    empty = url_filter.judge(pages.where("false"), RULES, url_filter.rule_labels(pages.where("false"), RULES))
    assert empty.count() == 0


def test_model_generalises():
    names = ["red", "blue", "green", "pink"]
    rows = [(f"{n}.casino{k}.net", f"/win/{k}", "block") for k in range(30) for n in names]
    rows += [(f"{n}.library{k}.net", f"/read/{k}", "allow") for k in range(30) for n in names]
    model = url_filter.fit(rows)
    assert model.score("black.casino99.net", "/win/now") > 0.8
    assert model.score("black.library99.net", "/read/now") < 0.2
    assert model.score("", "") == pytest.approx(1 / (1 + 2.718281828459045 ** -model.bias))
    assert url_filter.fit([]).score("a", "/b") == 0.5
