import random

from docweave.llm import urls
from docweave.llm.common import shared_path
from docweave.llm.queries import URL_RULES, op5_url_rules


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def judged(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def check(spark, all_urls, rules, **options):
    path = urls.build_rules(spark.createDataFrame(rules, "host string, path string, verdict string"), shared_path(spark, "rules-test"), **options)
    df = spark.createDataFrame([(i, u) for i, u in enumerate(all_urls)], "page_id long, url string")
    for r in urls.judge_urls(df, path).collect():
        assert (r.host, r.path, r.rule, r.verdict) == judged(r.url, rules), r.url


def test_against_brute_force(spark):
    rng = random.Random(2)
    hosts = ["com", "example.com", "www.example.com", "a.b.net", "net", "É.com", "xexample.com", ""]
    paths = ["", "/", "/en/", "/en", "/en/x", "/é/", "/a?b", "?q=http://x.com/en/", "#://"]
    rules = [(h, p, rng.choice(["allow", "block"])) for h in hosts[:5] for p in ["", "/", "/en/", "/é/"] if rng.random() < 0.5]
    all_urls = [f"{s}{h}{p}" for s in ("http://", "HTTPS://WWW.", "no-scheme", "://") for h in hosts for p in paths] + [None, "", "a\n://Ex.COM/\nx"]
    check(spark, all_urls, rules)
    check(spark, all_urls, rules, shard_rules=2)


def test_colliding_digests_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda s, seed=0: 7)
    import numpy as np

    class Fake:
        keys = np.array([7, 7], np.uint64)
        text = np.frombuffer(b"com/net/", np.uint8)
        places = np.array([(0, 3, 1, 0, b""), (4, 3, 1, 1, b"")], urls.PLACE)

    rules = urls.Rules.__new__(urls.Rules)
    rules.seed, rules.lengths, rules.shards = 0, [1], [(np.uint64(0), np.uint64(9), Fake)]
    assert rules.find(["com/", "net/", "org/"], [3, 3, 3]).tolist() == [0, 1, -1]


def test_a_url_is_looked_up_with_the_lengths_of_its_hosts_rules_only(spark, tmp_path):
    """Many path lengths at one host cost the urls of others nothing; very long urls and repeated rows are judged whole."""
    rules = [("big.com", "/" + "x" * n, "block" if n % 2 else "allow") for n in range(60)] + [("net", "/a", "block")]
    long = "http://www.big.com/" + "x" * 50_000
    check(spark, [long, long, "http://net/a", "http://q.net/ab", "http://other.org/" + "x" * 99], rules)
    path = urls.build_rules(spark.createDataFrame(rules, "host string, path string, verdict string"), f"file://{tmp_path}/rules")
    shards = spark.read.json(f"{path}/manifest", schema=urls.MANIFEST).collect()
    found = urls.Rules(path, tuple((r.kind, r.name, int(r.low), int(r.high)) for r in shards), 0)
    asked = []
    find = found.find
    found.find = lambda strings, sizes: asked.extend(strings) or find(strings, sizes)
    assert found.judge(["a.net", "other.org"], ["/" + "a" * 99] * 2) == [("net/a", 1), None] and asked == ["net/a"]


def test_no_rules_and_no_rows(spark):
    check(spark, ["http://a.com/", None], [(None, "/", "block")])
    path = urls.build_rules(spark.createDataFrame([("com", None, "block"), ("com", "", "allow")], "host string, path string, verdict string"), shared_path(spark, "rules-test"))
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), path).count() == 0
    assert urls.judge_urls(spark.createDataFrame([("http://x.com", 5)], "url string, rule int"), path).collect()[0].asDict() == {"url": "http://x.com", "host": "x.com", "path": "", "rule": "com", "verdict": "block"}


def test_query(spark, sf):
    rules = [(*urls.parse_rule(t), v) for v, t in URL_RULES]
    known = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op5_url_rules(spark, sf).collect()
    assert len(got) == len(known)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == judged(known[r.page_id], rules)
