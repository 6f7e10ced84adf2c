from hypothesis import given, settings
from hypothesis import strategies as st

from tiermart.llm.urls import ActiveRules, apply_url_rules

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MORE = [("a.example.net", "/", "allow"), ("a.example.net", "/en/x", "block"), ("Example.NET", "/en/", "block"),
        ("net", "/en/xx/", "allow"), ("", "/", "block"), (None, "/", "block"), ("net", None, "block"), ("net", "", None)]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = min([path.index(c) for c in "?#" if c in path] or [len(path)])
    return host, path[:end]


def judge(url, rules, default="allow"):
    host, path = parse(url)
    fits = [
        (len(h) + len(p), len(h), v == "block", h.lower() + p, v)
        for h, p, v in rules
        if h and p is not None and v is not None and path.startswith(p)
        and (host == h.lower() or host.endswith("." + h.lower()))
    ]
    return (host, path, *(max(fits)[3:] if fits else (None, default)))


URLS = [
    "http://a.net/x", "https://example.net/en/1?q", "https://www.example.net/en", "http://example.com/de/",
    "http://EXAMPLE.com/de/a#b", "http://notexample.com/de/", "ftp://x.org/fr/", "http://net", "http://net?x", None, "",
    "no scheme", "http://", "http:///path", "http://a.example.net/en/xy", "http://b.a.example.net/en/x/", "http://x.net/en/xx/1",
    "http://example.net./en/", "http://.net/", "http://a..net/", "http://é.net/ü", "http://net/" + "x" * 5000,
]


def check(spark, urls, rules, parts):
    rows = [(i, u, "h", "p", "v") for i, u in enumerate(urls)] + [(None, "http://a.net/", "", "", "")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = apply_url_rules(
            spark.createDataFrame(rows, "page_id long, url string, host string, path string, verdict string"),
            spark.createDataFrame([(*r, 1) for r in rules], "host string, path string, verdict string, key int"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = [(r[0], *judge(r[1], rules)) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_rules(spark):
    check(spark, URLS, RULES, "4")
    check(spark, URLS * 3, RULES + MORE, "7")


def test_hot_host_is_divided_and_rules_reach_every_part(spark):
    check(spark, ["http://www.example.net/en/%d" % i for i in range(300)] + URLS, RULES, "5")


def test_nothing(spark):
    check(spark, [], [], "3")
    check(spark, URLS, [], "3")


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b.a", "c.b.a", "ba", "c"]), st.sampled_from(["", "/", "/x", "/x/"]), st.sampled_from(["allow", "block"])), max_size=6),
    st.sampled_from(["a", "b.a", "c.b.a", "d.b.a", "ba", "c", "x.c"]), st.sampled_from(["", "/", "/x", "/x/y", "/y"]),
)
def test_stack(rules, host, path):
    def key(h):
        return ".".join(reversed(h.split("."))) + "."

    active = ActiveRules()
    events = sorted((key(h), 0, p, v, h) for h, p, v in rules) + [(key(host), 1, path, "", host)]
    for k, kind, p, v, h in sorted(events):
        active.leave(k)
        if kind == 0:
            active.enter(k, h, p, v)
        else:
            found = active.longest(p)
    want = judge(f"x://{host}{path}", rules)
    assert (found[::-1] if found else (None, "allow")) == want[2:]
