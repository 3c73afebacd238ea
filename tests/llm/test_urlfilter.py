"""The automaton against regular expressions; the judge against plain Python rules."""

import random
import re

from quarry.llm import urlfilter as U


def _regex(glob):
    parts = re.findall(r"\\.|\*\*|\*|[^*\\]", glob, re.S)
    return re.compile("".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p[-1]) for p in parts), re.S)


def test_automaton_equals_regex():
    rng = random.Random(1)
    globs = ["*.com/**", "a*b*c", "**x", "", "*", "**", r"a\*b", "abc", "*" * 1 + "a" * 70 + "**", "x**/y*z/**"]
    globs += ["".join(rng.choice(["a", "b", "/", "*", "**", "."]) for _ in range(rng.randrange(8))) for _ in range(40)]
    urls = ["".join(rng.choice("abcxyz./*") for _ in range(rng.randrange(14))) for _ in range(1500)]
    urls += ["a" * 70, "a" * 71 + "é", "x/y" * 4000, "", "\n"]
    hits = U.ShiftAnd([U.glob_pattern(g) for g in globs]).matches([u.encode() for u in urls])
    for j, g in enumerate(globs):
        want = [bool(_regex(g).fullmatch(u)) for u in urls]
        assert hits[:, j].tolist() == want, g


def _judge(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for v, h, p in U.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda f: len(f[0]))
        return host, path, rule, verdict
    return host, path, None, "block" if "spam" in host else "allow"


def test_judges_like_the_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en/", "http://com/",
            "http://com", "http://com?x", "http://badexample.com/en/a", "http://example.com/en", "http://x.net/es/1",
            "http://net/fr/", "http://a.net.org/es/", "http://x.org/.com/", "http://x.org/a://b.com/", "ftp://spam.org/x",
            "http://org/spam/", "http://éxample.com/en/é", "http://a.com:80/", "http://sub.www.example.com/en/q",
            "http://e.com/line\nbreak?x", "http://x.net/" + "es/" * 30_000, "://net/es/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "http://a.com/"), (3, "http://"), (3, "http://")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' AS host", "1 AS verdict")
    got = U.judge_urls(pages)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(((i, *_judge(u)) for i, u in rows), key=key)
    assert U.judge_urls(pages.limit(0)).count() == 0


def test_own_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x"), (2, "http://b"), (3, "http://c/y"), (4, "http://cb")],
                                  "page_id long, url string")
    got = U.judge_urls(pages, rules=(("block", "b", ""), ("allow", "a.b", "/x")), globs=(), default="hold")
    assert [(r.page_id, r.rule, r.verdict) for r in got.orderBy("page_id").collect()] == [
        (1, "a.b/x", "allow"), (2, "b", "block"), (3, None, "hold"), (4, None, "hold")]
