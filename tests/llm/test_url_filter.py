import numpy as np
import pytest
from helpers import CLASHING
from pyspark.sql import functions as F

from feria.llm import url_filter
from feria.llm.url_filter import filter_urls

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow")]


def pages(spark, urls):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, html string")
    return df.withColumns({c: F.lit(1) for c in CLASHING + ["host", "path", "rule", "verdict"]})


def test_rules_and_list(spark):
    urls = {
        "http://a.example.net/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://EXAMPLE.net/de/x": ("example.net", "/de/x", "net/", "block"),
        "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
        "https://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
        "https://x.org/fr": ("x.org", "/fr", None, "allow"),
        "https://m.spam.org/de": ("m.spam.org", "/de", None, "block"),
        "https://m.spam.org/fr/1": ("m.spam.org", "/fr/1", "org/fr/", "allow"),
        "https://notspam.org/de": ("notspam.org", "/de", None, "allow"),
        "http://x.net": ("x.net", "", None, "allow"),
        "http://x.net?u=http://y.org/fr/": ("x.net", "", None, "allow"),
        "x.net/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "://": ("", "", None, "allow"), "http:///p": ("", "/p", None, "allow"), "a\nb://É.net/é": ("É.net", "/é", "net/", "block"),
        "http://" + "a." * 5000 + "net/" + "p" * 50_000: ("a." * 5000 + "net", "/" + "p" * 50_000, "net/", "block"),
    }
    got = filter_urls(spark, pages(spark, [*urls, "http://x.net/"] * 2), RULES, ["spam.org/"])
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [*urls.values(), ("x.net", "/", "net/", "block")] * 2
    assert [tuple(r)[1:] for r in got.orderBy("page_id").collect()] == want


def test_empty(spark):
    assert filter_urls(spark, pages(spark, []), RULES).count() == 0
    got = filter_urls(spark, pages(spark, ["http://x.net/"]), []).first()
    assert (got.rule, got.verdict) == (None, "allow")


def test_collisions_are_confirmed_by_string(spark, tmp_path, monkeypatch):
    """With every digest the same, stored strings alone decide."""
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda _: 7)
    arrays = url_filter.digest_arrays(RULES, ["spam.org/"])
    paths = {}
    for k, a in arrays.items():
        paths[k] = str(tmp_path / f"{k}.npy")
        np.save(paths[k], a)
    listed = url_filter.UrlList(paths)
    assert listed.match(["a.net", "x.org", "m.spam.org", "x.com"], ["/", "/fr/", "/", "/"]) == [
        ("net/", "block"), ("org/fr/", "allow"), (None, "block"), (None, None)]


@pytest.mark.parametrize("rules", [[("net", "block")], [("net/", "stop")], [("net/", "block"), ("net/", "allow")]])
def test_bad_rules(rules):
    with pytest.raises(ValueError):
        url_filter.digest_arrays(rules, [])
