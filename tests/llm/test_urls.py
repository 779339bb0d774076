import pytest
from pyspark.sql import functions as F

from authlytics.llm import urls
from authlytics.llm.queries import URL_RULES
from authlytics.plans.storage import WorkingTables

PAGES = "page_id long, url string, host int, verdict string, bad string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, 1, "v", "b") for i, u in rows], PAGES)


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "page_id long, bad boolean")


@pytest.mark.parametrize(
    "url,host,path",
    [
        ("http://A.Example.ORG/Es/1?x#y", "a.example.org", "/Es/1"),
        ("HTTP://x.com", "x.com", ""),
        ("http://x.com?q=/a", "x.com", ""),
        ("x://y.com/a://b/c", "y.com", "/a://b/c"),
        ("no scheme/here", "", ""),
        (None, "", ""),
        ("", "", ""),
        ("://É.com/é", "É.com", "/é"),
        ("http:///p", "", "/p"),
        ("http://u@h.net:80/", "u@h.net:80", "/"),
    ],
)
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "u string")
    found = row.select(urls.host_of(F.col("u")), urls.path_of(F.col("u"))).first()
    assert tuple(found) == (host, path)


@pytest.mark.parametrize(
    "host,domain,suffix",
    [
        ("a.b.example.com", "example.com", "com"),
        ("www.shop.co.uk", "shop.co.uk", "co.uk"),
        ("u@a.example.org:8080", "example.org", "org"),
        ("10.0.0.1", "10.0.0.1", ""),
        ("localhost", "localhost", "localhost"),
        ("", "", ""),
    ],
)
def test_domain_and_suffix(spark, host, domain, suffix):
    row = spark.createDataFrame([(host,)], "h string")
    found = row.select(urls.domain_of(F.col("h")), urls.suffix_of(F.col("h"))).first()
    assert tuple(found) == (domain, suffix)


def test_rules(spark):
    cases = {
        "http://example.org/": ("org/", "allow"),
        "http://example.org": (None, "allow"),
        "http://a.example.org/es/1": ("example.org/es/", "block"),
        "http://badexample.org/es/1": ("org/", "allow"),
        "http://example.org/en/12": ("example.org/en/1", "block"),
        "http://example.org/en/2": ("org/", "allow"),
        "http://x.com/fr/": ("com/fr/", "allow"),
        "http://x.com/de/a": ("com/de/", "block"),
        "http://x.net/de/a": (None, "allow"),
    }
    table = pages(spark, list(enumerate(cases)))
    found = urls.judge(table, outcomes(spark, []), URL_RULES, WorkingTables(spark)).collect()
    expected = list(cases.values())
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in found} == dict(enumerate(expected))


def test_shrinkage(spark):
    """A host is blocked on much evidence, and on little only where its domain is bad as well."""
    rows, labels = [], []

    def add(host, n, bad):
        for i in range(n):
            rows.append((len(rows), f"http://{host}/{i}"))
            labels.append((len(rows) - 1, i < bad))

    add("good.fine.com", 60, 2)
    add("bad.fine.com", 40, 40)
    add("once.fine.com", 1, 1)
    for i in range(12):
        add(f"h{i}.spam.net", 10, 10)
        add(f"h{i}.clean.net", 10, 0)
    add("new.spam.net", 1, 1)
    rows.append((len(rows), "http://unseen.spam.net/"))
    rows.append((len(rows), "http://unseen.clean.net/"))
    found = urls.host_reputation(pages(spark, rows), outcomes(spark, labels), WorkingTables(spark))
    by_host = {r["host"]: r for r in found.collect()}
    verdicts = {host: r["verdict"] for host, r in by_host.items()}
    assert verdicts["bad.fine.com"] == "block" and verdicts["good.fine.com"] == "allow"
    assert verdicts["once.fine.com"] == "allow" and verdicts["h3.spam.net"] == "block"
    assert verdicts["unseen.clean.net"] == "allow"
    assert by_host["unseen.spam.net"]["rate"] > 0.5 > by_host["unseen.clean.net"]["rate"]
    assert by_host["new.spam.net"]["rate"] > by_host["once.fine.com"]["rate"]
    for r in by_host.values():
        assert 0 <= r["rate"] <= 1 and r["bound"] <= r["rate"]


def test_odd_rows(spark):
    rows = [(None, "http://a.com/"), (1, None), (1, None), (2, ""), (3, "http://a.com/")]
    labels = [(1, None), (None, True), (2, True), (2, True), (9, False)]
    found = urls.judge(pages(spark, rows), outcomes(spark, labels), [], WorkingTables(spark)).collect()
    assert sorted(((r["page_id"], r["host"], r["rule"]) for r in found), key=repr) == sorted(
        [(None, "a.com", None), (1, "", None), (1, "", None), (2, "", None), (3, "a.com", None)],
        key=repr,
    )
    assert all(r["verdict"] in ("allow", "block") for r in found)
    none = urls.judge(pages(spark, rows).limit(0), outcomes(spark, labels), [], WorkingTables(spark))
    assert none.count() == 0
