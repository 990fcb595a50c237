import random
import re
from collections import Counter

import pytest

from clickpath.llm.url_rules import BASE_RULES, PATTERN_RULES, RULES, Index, expression, host_and_path, judged, literal_tokens, stated_rules

PAGES = "page_id long, url string, doc string, host string, verdict string"
AWKWARD = [None, "", "://", "no scheme", "http://", "HTTP://Example.NET/en/x", "http://example.net/EN/x", "http://xnet/", "http://net/", "http://net",
           "http://a.net?x/y", "http://a.net#/", "//x.org/fr/", "https://www.example.com/de/1?q=1", "https://example.com/de", "x://y.org/fr/://z.net/",
           "http://u:p@a.b.net:80/", "http://İ.net/", "http://a.net/" + "x/" * 20_000, "ftp://h.org/casino/", "http://casino.org/", "http://mycasino.org/",
           "http://my-Casino.org/Login", "http://fast-track.org/", "http://a.org/login?x", "http://a.org/loginx", "http://a.org/x.zip", "http://a.org/x.zip?y",
           "http://adult-education.org/login", "http://a.org/fr/login", "line\nbreak://a.net/\nx"]


def base_rule(host, path):
    """The stated rules, plainly."""
    fits = []
    for text, verdict, _ in BASE_RULES:
        h, p = text[:text.index("/")], text[text.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(text), text, verdict))
    return max(fits, default=(0, None, None))[1:]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), re.split("[?#]", path)[0]


def glob(pattern, text, at=0):
    """Whether an unanchored pattern without ``|`` matches somewhere, by trying everything."""
    def edge(k):
        return not (text[k].isascii() and text[k].isalnum())

    def here(p, k):
        if not p:
            return True
        if p[0] == "*":
            return any(here(p[1:], j) for j in range(k, len(text) + 1))
        if p[0] == "^":
            return (k < len(text) and edge(k) and here(p[1:], k + 1)) or (k in (0, len(text)) and here(p[1:], k))
        return k < len(text) and text[k].lower() == p[0].lower() and here(p[1:], k + 1)

    return any(here(pattern, k) for k in range(len(text) + 1))


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "d", "h", "v") for k, u in enumerate(urls)], PAGES)


def test_stated_rules_on_awkward_urls(spark):
    urls = AWKWARD + AWKWARD[5:9]
    got = {r.doc.page_id: r for r in judged(pages(spark, urls), stated_rules(spark)).collect()}
    assert len(got) == len(urls)
    for k, url in enumerate(urls):
        host, path = split(url)
        rule, verdict = base_rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule), url
        if rule:
            assert got[k].verdict == verdict
    by_url = {u: got[k] for k, u in enumerate(urls)}
    assert by_url["http://casino.org/"].verdict == by_url["http://my-Casino.org/Login"].verdict == "block"
    assert by_url["http://mycasino.org/"].verdict == by_url["ftp://h.org/casino/"].verdict == "allow"
    assert by_url["http://fast-track.org/"].verdict == by_url["http://adult-education.org/login"].verdict == "allow"
    assert by_url["http://a.org/login?x"].pattern == "||*/login^" and by_url["http://a.org/loginx"].verdict == "allow"
    assert by_url["http://a.org/x.zip"].verdict == "block" and by_url["http://a.org/x.zip?y"].verdict == "allow"
    assert by_url["http://a.org/fr/login"].verdict == "allow"
    assert by_url[None].verdict == by_url[""].verdict == "allow"


def test_blocks_change_nothing_and_odd_rules(spark):
    rng = random.Random(1)
    urls = [f"http://{rng.choice(['a', 'b.c', 'ads.x', 'poker.z'])}.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'de', 'fr'])}/{rng.choice(['login', 'x.zip', '7'])}" for _ in range(200)]
    rows = spark.createDataFrame(BASE_RULES + PATTERN_RULES + [(None, "block", "url"), ("x", None, "url"), ("", "block", "url")], RULES)
    whole = Counter(judged(pages(spark, urls), rows).select("doc.page_id", "rule", "pattern", "verdict").collect())
    cut = Counter(judged(pages(spark, urls), rows, block_rules=9).select("doc.page_id", "rule", "pattern", "verdict").collect())
    assert whole == cut and len({r.verdict for r in whole}) == 2
    none = judged(pages(spark, urls), spark.createDataFrame([], RULES)).collect()
    assert {r.verdict for r in none} == {"allow"} and {r.rule for r in none} == {None}
    assert judged(spark.createDataFrame([], PAGES), rows).collect() == []
    with pytest.raises(ValueError):
        judged(pages(spark, urls), spark.createDataFrame([("x", "maybe", "url")], RULES))


def test_longest_prefix_wins_and_ties_are_settled(spark):
    rules = [("b.c/x", "allow", "prefix"), ("c/x/yy", "block", "prefix"), ("a.b.c", "block", "prefix"), ("c/x/zz", "block", "prefix"), ("c/x/zz", "allow", "prefix")]
    got = [(r.rule, r.verdict) for r in judged(pages(spark, ["h://a.b.c/x/yy", "h://a.b.c/x", "h://a.b.c/x/zz", "h://q.c/x/zzz"]), spark.createDataFrame(rules, RULES)).orderBy("doc.page_id").collect()]
    assert got == [("c/x/yy", "block"), ("a.b.c", "block"), ("c/x/zz", "allow"), ("c/x/zz", "allow")]


def test_index_loses_no_rule():
    """Candidates by the rarest token, then expressions: as trying every rule by brute force."""
    rng = random.Random(5)
    atoms = ["ad", "Ad", "x1", "b", "-", "/", ".", "^", "*", "é", "?"]
    rules = [("".join(rng.choice(atoms) for _ in range(rng.randint(1, 6))), "block", "url") for _ in range(300)]
    rules = [r for r in rules if not r[0].startswith("||")]
    urls = ["".join(rng.choice(["ad", "AD", "x1", "b", "-", "/", ".", "é", "?", ":", "z"]) for _ in range(rng.randint(0, 9))) for _ in range(200)]
    index = Index(rules, Counter(t for u in urls for t in set(re.findall("[a-z0-9]+", u.lower()))))
    assert index.by_token and index.always
    for url in urls:
        host, path = host_and_path(url)
        got = {rules[k][0] for k in index.candidates(url) if index.fits(k, url, host, path)}
        assert got == {p for p, _, _ in rules if glob(p, url)}, url


def test_anchors_and_tokens():
    def found(pattern, kind, text):
        return re.match(expression(pattern, kind), text, re.S | re.I | re.A) is not None

    assert found("||b.c^", "url", "http://a.b.c/x") and found("||b.c^", "url", "http://b.c") and not found("||b.c^", "url", "http://ab.c/")
    assert not found("||b.c^", "url", "http://x/http://b.c/") and found("|http:*x|", "url", "http://a/x") and not found("|http:*x|", "url", "http://a/xy")
    assert found("a*b*c|", "url", "zabcbzc") and found("^x|", "host", "a.x")
    assert literal_tokens("net/", "prefix") == {"net"} and literal_tokens("a.b/c/de", "prefix") == {"a", "b", "c"}
    assert literal_tokens("^ads^", "host") == {"ads"} and literal_tokens("ads^x*", "url") == set() and literal_tokens("||*.zip|", "url") == {"zip"}
    long = "http://a/" + "ab" * 200_000
    assert not found("a*b*a*b*q^", "url", long)
