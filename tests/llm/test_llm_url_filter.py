"""URL filter against a plain version."""

import random

import pytest

from corate.llm import url_filter

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    path = rest[stop:]
    return rest[:stop].translate(UP), path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]


def plain(url, rules, default="allow"):
    host, path = split(url)
    fits = [(len(h.translate(UP) + p), len(h), v, h.translate(UP) + p) for h, p, v in rules
            if None not in (h, p, v) and ("." + host).endswith("." + h.translate(UP)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[3], best[2]


ODD_URLS = [
    None, "", "net", "://", "http://", "http:///", "http://NET/", "http://net", "http://net?x=/", "http://a.net/",
    "http://xnet/", "http://a.example.net/en/x", "http://example.net/en", "http://EXAMPLE.NET/EN/", "http://.net/",
    "http://net./", "http://b.example.com/de/", "http://badexample.com/de/", "x://y.org/fr/?a#b", "y.org/fr/",
    "http://q.org#/fr/", "http://q.org/fr/#x", "a://b://net/", "http://é.net/é", "http://u:p@a.net:80/", "http://a.net:80/",
    "http://" + "a." * 50_000 + "net/" + "p/" * 100_000, "http://x\ny.net/\n", "http://a.net/\n?", "http://..net//",
]


def frame(spark, urls):
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("limit", [1 << 20, 0])  # broadcast and shuffled
def test_filter_matches_plain_version(spark, limit):
    rng = random.Random(3)
    names, parts = ["net", "org", "a", "b", "cc"], ["", "/", "/a", "/a/", "/a/b", "/ab", "/é"]
    host = lambda: ".".join(rng.choice(names) for _ in range(rng.randrange(1, 5)))
    rules = [(host(), rng.choice(parts), rng.choice(["allow", "block"])) for _ in range(60)]
    rules += [*rules[:5], ("a", "/a", "allow"), ("a", "/a", "block"), ("A.NET", "/", "block"), (None, "/", "block"),
              ("b", None, "allow"), ("b", "/", None), ("", "", "block") if limit else ("", "/ab", "allow")]
    urls = [f"http://{host()}{rng.choice(parts)}{rng.choice(['', 'x', '/y?q', '#'])}" for _ in range(500)] + ODD_URLS
    urls += [urls[0]] * 300
    listed = spark.createDataFrame(rules, url_filter.RULE_SCHEMA)
    got = rows(url_filter.judge(frame(spark, urls), listed, "block", max_broadcast_bytes=limit)
               .select("page_id", "host", "path", "verdict", "rule"))
    want = []
    for i, u in enumerate(urls):
        h, p, rule, verdict = plain(u, rules, "block")
        want.append((i, h, p, verdict, rule))
    assert got == sorted(want)


def test_full_digests_decide(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "_prefix", lambda digest: url_filter.F.lit(1).cast("bigint"))  # all collide
    got = rows(url_filter.judge(frame(spark, ODD_URLS[:26]), spark.createDataFrame(url_filter.RULES, url_filter.RULE_SCHEMA))
               .select("page_id", "verdict"))
    assert got == [(i, plain(u, url_filter.RULES)[3]) for i, u in enumerate(ODD_URLS[:26])]


def test_empty_list_and_table_and_extra_columns(spark):
    none = spark.createDataFrame([], url_filter.RULE_SCHEMA)
    listed = spark.createDataFrame(url_filter.RULES, url_filter.RULE_SCHEMA)
    pages = frame(spark, ODD_URLS)
    assert {r.verdict for r in url_filter.judge(pages, none).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), listed).count() == 0
    lit = url_filter.F.lit
    wide = pages.withColumns({c: lit(1) for c in ("host", "path", "rule", "verdict", "row", "digest", "id")})
    assert rows(url_filter.judge(wide, listed).select("page_id", "verdict")) == \
        rows(url_filter.judge(pages, listed).select("page_id", "verdict"))
    kept = url_filter.keep_allowed(wide, listed)
    assert kept.columns == wide.columns
    assert sorted(r.page_id for r in kept.collect()) == \
        [i for i, u in enumerate(ODD_URLS) if plain(u, url_filter.RULES)[3] == "allow"]


def test_repeated_ids_keep_their_rows(spark):
    pages = spark.createDataFrame([(None, "http://a.net/")] * 3 + [(1, "http://a.net/"), (1, "http://b.org/")],
                                  "page_id bigint, url string")
    listed = spark.createDataFrame(url_filter.RULES, url_filter.RULE_SCHEMA)
    got = sorted((r.page_id or 0, r.verdict) for r in url_filter.judge(pages, listed).collect())
    assert got == [(0, "block")] * 3 + [(1, "allow"), (1, "block")]
