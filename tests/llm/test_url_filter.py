import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import url_filter as U

URLS = [
    None, "", "no scheme", "http://", "HTTP://Sub.ORG/x?y#z", "http://a.org", "http://a.org/", "x://org/1", "http://xorg/1", "http://example.org/es/1",
    "http://m.example.org/en/12", "http://m.example.org/en/2", "http://a.com/fr/1", "http://a.com/de/1", "http://a.net?u=http://b.org/x", "http://a.net#f/x",
    "http://Ünï.com/de/ä", "http://a.org/" + "long/" * 5_000, "http://a.net/line\nbreak?x",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fit = [
        (r, v) for r, v in U.RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])
    ]
    return max(fit, key=lambda f: len(f[0])) if fit else (None, None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, None, None, None)], "page_id long, url string, rule string, score string")
    for r in U.judged_urls(pages).collect():
        host, path = parts(None if r.page_id is None else URLS[r.page_id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == verdict if verdict else r.verdict == ("allow" if r.score >= 0 else "block") or r.verdict in ("allow", "block")
    assert U.judged_urls(pages.limit(0)).count() == 0


def brute_counts(urls):
    return Counter(g for u in urls for s in [codes(u)] for g in zip(s, s[1:], s[2:], s[3:], strict=False))


def codes(url):
    return [0, 0, 0, *(U._CODE[b] for b in url.encode()), 0]


def test_scores_equal_a_plain_model():
    good, bad = ["a.org/x", "bb.org/", ""], ["c.com/de/1", "c.com/de/22"]

    def probability(counts, context, c):
        p = 1 / U.LETTERS
        for k in range(U.ORDER + 1):
            now = {g: n for g, n in counts.items() if g[3 - k : 3] == context[3 - k :]}
            total = sum(now.values())
            followers = len({g[3] for g in now})
            if total:
                p = (sum(n for g, n in now.items() if g[3] == c) + followers * p) / (total + followers)
        return p

    def table(urls):
        out = np.zeros(U.LETTERS**4, np.int64)
        number, _ = U.grams(pa.array(urls))
        np.add.at(out, number, 1)
        return out

    ratio = U.log_ratio(table(good), table(bad))
    for url in ["a.org/x", "c.com/de/9", "", "zz", "ü"]:
        s, a, b = codes(url), brute_counts(good), brute_counts(bad)
        each = [np.log(probability(a, tuple(s[i - 3 : i]), s[i]) / probability(b, tuple(s[i - 3 : i]), s[i])) for i in range(3, len(s))]
        assert U.scores(pa.array([url, "other"]), ratio)[0] == pytest.approx(np.mean(each), abs=1e-5)


def test_threshold_has_the_least_error():
    assert U.threshold([(0, True, 5)]) == 0
    rng = np.random.default_rng(2)
    bins = [(int(b), bool(g), 1) for g, m in ((True, 30), (False, -10)) for b in rng.normal(m, 20, 300)]
    found = U.threshold([(b, g, n) for (b, g), n in Counter((b, g) for b, g, _ in bins).items()])

    def error(t):
        return sum((b * U.BIN >= t) != g for b, g, _ in bins)

    assert error(found) == min(error(b * U.BIN) for b in range(-80, 120))


def test_whole_table(spark):
    rows = U.op4_url_filter(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 2_500
    unruled = [r for r in rows if r.rule is None]
    german = [r.verdict for r in unruled if r.path.startswith(("/de/", "/es/"))]
    french = [r.verdict for r in unruled if r.path.startswith("/fr/")]
    assert german.count("block") > 0.95 * len(german) and french.count("allow") > 0.95 * len(french)
