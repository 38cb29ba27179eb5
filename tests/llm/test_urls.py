import random
import pytest

from callsift.llm import urls
from callsift.llm.queries import URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    path = rest[cut:]
    end = min([path.index(c) for c in "?#" if c in path] + [len(path)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    return host, path[:end]


def expected_rule(host, path):
    best = None
    for r in URL_RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.name) > len(best.name):
                best = r
    return best


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/",
    "http://example.com/en", "http://a.example.com/fr/", "http://com/", "http://com", "http://xcom/",
    "https://x.net/es/1?y=://z/", "https://x.net/fr/#a", "https://net/de/", "ftp://u:p@h.net:80/es/",
    "a\nb://H.org/p\nq?r", "x://ÀB.net/es/", "://example.com/en/x",
]


def test_hosts_paths_and_rules(spark):
    rows = [(k, u, "mine") for k, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = urls.judge(pages, URL_RULES).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = parts(r["url"])
        best = expected_rule(host, path)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (best and best.name)
        assert r["verdict"] == best.verdict if best else r["verdict"] in ("allow", "block")


def test_model_tells_apart_and_sums_to_one():
    good = [f"https://site{k}.org/en/item/{k * 7}" for k in range(300)]
    bad = [f"http://x{k}.biz/casino?win={k * 3}" for k in range(300)]
    model = urls.fit_model(good, bad)
    assert model.difference("https://site999.org/en/item/5") > model.threshold
    assert model.difference("http://x999.biz/casino?win=5") < model.threshold
    characters = [chr(c) for c in range(1024)]
    for context in ("http", "\x02\x02ht", "zzzz"):
        total = sum(2.718281828459045 ** model.accepted.log_probability(context + c) for c in characters)
        assert total == pytest.approx(1, abs=1e-9)


def test_without_a_class_and_empty(spark):
    pages = spark.createDataFrame([(1, "https://a.com/"), (2, "https://b.org/")], "page_id long, url string")
    got = urls.judge(pages, URL_RULES).orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["allow", "allow"]
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0


def known_urls(n):
    rows = [(f"https://www.site{k % 9}.com/de/item/{k * 7}?é={k % 5}", "allow") for k in range(n)]
    return rows + [(f"http://x{k % 7}.net/es/casino/win{k * 3}", "block") for k in range(n)] + [(None, "allow")]


def test_counts_in_spark_equal_plain_counts(spark, monkeypatch):
    rows = known_urls(150)
    known = spark.createDataFrame(rows, "_u string, _v string").repartition(3)
    monkeypatch.setattr(urls, "SHARD_GRAMS", 500)  # some shards
    model = urls.fit_spread(known, 4)
    assert model.grams.bits > 2
    plain = urls.UrlModel(
        *[urls.MarkovModel([u or "" for u, v in rows if v == c], 4) for c in ("allow", "block")], 0.0
    )
    asked = [None, "", "https://www.site3.com/de/item/1", "http://x1.net/es/casino/win9", "ftp://other.org/日本", "x" * 3000]
    assert model.differences(asked) == pytest.approx([plain.difference(u) for u in asked], rel=1e-9)


def test_counts_grow_with_the_urls(spark):
    few, many = (urls.fit_spread(spark.createDataFrame(known_urls(n), "_u string, _v string"), 4) for n in (100, 30_000))
    assert sum(many.grams.sizes.values()) > 3 * sum(few.grams.sizes.values())


def test_threshold_makes_the_fewest_errors():
    scored = [(0.5, True), (0.3, True), (0.1, False), (-0.2, True), (-0.4, False), (-0.6, False)]
    best = urls.best_threshold(scored)
    wrong = lambda t: sum(ok != (d >= t) for d, ok in scored)
    assert wrong(best) == min(wrong(t) for t in (-1, -0.5, -0.3, 0, 0.2, 0.4, 1))


def test_unruled_urls_are_judged_by_the_models(spark):
    rows = [(k, u, v) for k, (u, v) in enumerate(known_urls(200))]
    rows += [(1000 + k, f"https://www.site{k % 9}.org/de/item/{k * 11}", "allow") for k in range(40)]
    rows += [(2000 + k, f"http://x{k % 7}.biz/es/casino/win{k * 5}", "block") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, want string").repartition(3)
    got = urls.judge(pages, URL_RULES).where("rule is null and url is not null").collect()
    assert len(got) == 80 and all(r["verdict"] == r["want"] for r in got)


def test_of_equal_rules_the_first_counts(spark):
    rules = [urls.rule("block", "a.org/x"), urls.rule("allow", "a.org/x"), urls.rule("allow", "a.org/")]
    pages = spark.createDataFrame([("https://a.org/x1",), ("https://a.org/y",)], "url string")
    assert [r["verdict"] for r in urls.judge(pages, rules).orderBy("url").collect()] == ["block", "allow"]


def test_the_threshold_counts_every_url_left_out(spark):
    rng = random.Random(8)
    for n in (1, 2, 40, 30_000):  # more than 20,000 of a verdict
        scored = [(round(rng.gauss(0.3 * ok, 1), 3 if n == 40 else 9), ok) for k in range(n) for ok in (True, False)]
        got = urls.spread_threshold(spark.createDataFrame(scored, "_d double, _ok boolean").repartition(7))

        def errors(t):
            return sum(d < t if ok else d >= t for d, ok in scored)

        values = sorted({d for d, _ in scored})
        edges = [values[0] - 1, *[(a + b) / 2 for a, b in zip(values, values[1:])], values[-1] + 1]
        if n < 100:
            assert got == min(edges, key=lambda t: (errors(t), abs(t), t))
        else:
            assert abs(got - urls.best_threshold(scored)) < 1e-12
            assert got != urls.best_threshold([*scored[0:40_000:2][:20_000], *scored[1:40_000:2][:20_000]])
