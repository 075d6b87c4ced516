"""Url filter against plain Python."""

import random
import re
from collections import Counter

import pytest

from surgewatch.llm import common, url_filter

SCHEMA = "page_id bigint, url string, html string, host string, n int, template string"
ODD = [
    None, "", "no scheme", "://", "x://", "HTTP://A.B.ORG", "http://a.b.org/", "a://b://c/d?e#f", "h://ORG/x", "h://org",
    "h://xorg/", "h://example.org/en/1", "h://EXAMPLE.org/EN/1", "h://w.example.org/es/#x", "h://example.org/es", "h://example.org?/es/",
    "h://example.org:80/es/", "h:///path", "h://com/fr/é\nx", "h://a.com/de/*", "h://a.com/=x/~#/{*}", "h://a.net//x//y/",
    "h://long.net/" + "a/" * 3000, "h://long.net/" + "9" * 50_000, "h://hex.net/0123456789abcdef/DEADBEEF0/deadbeef",
]


def urls():
    rng = random.Random(5)
    out = list(ODD)
    for host, n in (("big.com", 900), ("m.big.com", 150), ("y.example.org", 300), ("small.com", 7), ("z.net", 40)):
        for i in range(n):
            tail = rng.choice(["", "/", ".html", "?q=1", "#top"])
            out.append(f"https://{host}/{rng.choice(['de', 'en', 'fr', 'es', 'de', 'x%d' % i])}/{rng.randrange(10_000)}{tail}")
    return out + ["h://deep.net/" + "/".join(f"s{k}" for k in range(60))] * 6 + ["https://big.com/de"] * 12


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def ruled(host, path, rules=url_filter.RULES):
    best = None, None
    for says, text in rules:
        at = text.index("/")
        if (host == text[:at] or host.endswith("." + text[:at])) and path.startswith(text[at:]):
            if best[0] is None or len(text) > len(best[0]):
                best = text, says
    return best


def shape(s):
    s = re.sub(r"(?i)(?<![0-9a-z])(?=[a-f]*[0-9])[0-9a-f]{8,}(?![0-9a-z])", "#", s)
    return re.sub("[0-9]+", "#", s)


def brute(rows):
    found = [parts_of(u) for u in rows]
    says = [ruled(*hp) for hp in found]
    n = Counter(h for h, _ in found)
    paths, seen = [], Counter()
    for host, path in found:
        parts = [s for s in path.split("/") if s]
        parts = parts[:32] + ([None] if len(parts) > 32 else [])
        paths.append(parts)
        for i, s in enumerate(parts):
            if s is not None:
                seen[host, "=", i, s] += 1
                if shape(s) != s:
                    seen[host, "~", i, shape(s)] += 1
    templates = []
    for (host, _), parts in zip(found, paths, strict=True):
        out = []
        for i, s in enumerate(parts):
            def often(kind, value, host=host, i=i):
                return seen[host, kind, i, value] >= max(5, 0.01 * n[host])
            one = "*" if s is None else "=" + s if often("=", s) else "~" + shape(s) if often("~", shape(s)) else "*"
            if one != "*" or out[-1:] != ["*"]:
                out.append(one)
        templates.append(out)
    places = {}
    for (host, _), (_, verdict), t in zip(found, says, templates, strict=True):
        for i in range(len(t) + 1):
            c = places.setdefault(host, {}).setdefault("/".join(t[:i]), [0, 0, 0])
            c[0] += 1
            c[1] += verdict is not None
            c[2] += verdict == "block"
    trees = {
        host: url_filter.judged(
            [(k, *c) for k, c in tree.items() if not k or c[0] >= max(5, 0.01 * n[host])], 0.05, 2, 0.9
        )
        for host, tree in places.items()
    }
    out = []
    for (host, path), (rule, verdict), t in zip(found, says, templates, strict=True):
        at = next(trees[host][k] for i in range(len(t), -1, -1) if (k := "/".join(t[:i])) in trees[host])
        out.append((host, path, rule, verdict or ("block" if at[3] else "allow"), at[0], at[1], at[2]))
    return out


@pytest.mark.parametrize("small", [True, False])
def test_equals_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(common, "SMALL_ROWS", 0)
        monkeypatch.setattr(url_filter, "fits_broadcast", lambda table: False)
    rows = urls()
    data = [(i if i % 9 else None, u, "x", "y", 1, "z") for i, u in enumerate(rows)]
    got = url_filter.judge_urls(spark.createDataFrame(data, SCHEMA).repartition(5))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity", "labelled"]
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    want = sorted(((i if i % 9 else None, *r) for i, r in enumerate(brute(rows))), key=key)
    found = sorted(map(tuple, got.collect()), key=key)
    assert len(found) == len(want)
    for x, y in zip(found, want, strict=True):
        assert x[:6] == y[:6] and x[6] == pytest.approx(y[6]) and x[7] == y[7]
    # A url that no rule decides, of a template whose labels all say block.
    bare = [r for r in found if r[1] == "big.com" and r[2] == "/de"]
    assert len(bare) == 12 and {(r[3], r[4], r[5]) for r in bare} == {(None, "block", "/de")}
    assert all(r[4] == "allow" for r in found if r[3] is None and "/en/" in r[2])


def test_given_labels(spark):
    names = ["buy", "read"]
    rows = [(i, f"h://shop.net/{names[i % 2]}/{i}", "", "", 0, "") for i in range(200)] + [(None, None, "", "", 0, "")]
    pages = spark.createDataFrame(rows, SCHEMA)
    said = [(r[1], r[1].startswith("h://shop.net/buy")) for r in rows[:60]] + [(None, True), (rows[0][1], None), (rows[0][1], True)]
    labels = spark.createDataFrame(said, "url string, blocked boolean")
    got = url_filter.judge_urls(pages, [], labels).collect()
    assert {(r.path.split("/")[1], r.verdict, r.labelled) for r in got if r.page_id is not None} == {("buy", "block", 30), ("read", "allow", 30)}
    assert [(r.host, r.path, r.rule, r.verdict) for r in got if r.page_id is None] == [("", "", None, "allow")]


def test_no_pages(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []


def test_alike_branches_are_merged():
    tree = [("", 400, 200, 100)]
    for key, blocked in (("=a", 50), ("=b", 50), ("=c", 0), ("=d", 0)):
        tree += [(key, 100, 50, blocked), (f"{key}/~#", 100, 50, blocked)]
    got = url_filter.judged(tree, 0.05, 2, 0.9)
    assert got["=a"] == got["=b"] and got["=a"][0] == "/(a|b)" and got["=a"][3]
    assert got["=a/~#"][0] == got["=b/~#"][0] == "/(a|b)/{#}" and got["=a/~#"][2:] == (100, True)
    assert got["=c"][0] == "/(c|d)" and not got["=d"][3]
    assert got[""][:2] == ("/", pytest.approx(0.5))


def test_what_is_below_keeps_branches_apart():
    tree = [("", 200, 0, 0), ("=a", 100, 0, 0), ("=b", 100, 0, 0), ("=a/~#", 100, 0, 0), ("=b/=x", 100, 0, 0)]
    got = url_filter.judged(tree, 0.05, 2, 0.9)
    assert got["=a"][0] == "/a" and got["=b"][0] == "/b"
    assert not any(rejected for *_, rejected in got.values())


def test_templates_without_labels_of_their_own_are_not_rejected():
    tree = [("", 120, 100, 100), ("=a", 100, 100, 100), ("=b", 20, 0, 0)]
    got = url_filter.judged(tree, 0.05, 2, 0.9)
    assert got["=a"][3] and not got["=b"][3] and got["=b"][1] == 0.5
    few = url_filter.judged([("", 10, 5, 5), ("=a", 5, 5, 5)], 0.05, 2, 0.9)
    assert not few["=a"][3]
