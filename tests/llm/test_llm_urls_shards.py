"""URL rules and shard placement against plain Python versions."""

import hashlib
import re
import time
from collections import Counter

import pytest

from encore.llm.queries import BLOCK_PATTERNS, QUERIES, SHARDS, SITE_RULES
from encore.llm.sharding import TABLE_SIZE, fill_table, place, write_shards
from encore.llm.url_rules import BlockPattern, SiteRule, judge_urls

from conftest import MEDIUM


def _brute(url, rules=SITE_RULES, patterns=BLOCK_PATTERNS):
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    host = path = ""
    if url and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
        host, slash, tail = rest.partition("/")
        host, path = lower(host), slash + tail
    fits = []
    for r, a in rules:
        site, _, start = r.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith("/" + start):
            fits.append((r, a))
    if fits:
        best = max(fits, key=lambda f: len(f[0]))
        return host, path, best[0], best[1]
    hit = any(re.search(".*".join(map(re.escape, p.lower().split("*"))), lower(url or ""), re.DOTALL) for p in patterns)
    return host, path, None, "block" if hit else "allow"


URLS = [None, "", "no scheme example.org/es/", "http://", "http://org", "http://org/", "http://EXAMPLE.org/es/x", "https://a.b.Example.ORG/en/123?x",
        "https://notexample.org/es/", "http://x.com/fr/", "http://x.com/FR/", "http://x.com/fr", "http://x.com/de/#f", "http://example.org?/es/",
        "http://example.org/en/1", "http://example.org/en/21", "ftp://y.net/WP-admin/", "http://z.net/cart/9?checkout=1", "http://z.net/?sessionid=1",
        "http://éexample.org/es/", "http://example.org.evil.net/es/", "a://b://example.org/es/", "http://x.net/" + "p/" * 50_000, "http://com/de/\n",
        "http://user@x.com:80/de/"]


def test_urls_match_brute_force(spark):
    rows = [(k if k % 5 else None, u, "clash", "clash") for k, u in enumerate(URLS + URLS[:3])]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string").repartition(3)
    out = judge_urls(df, [SiteRule(*r) for r in SITE_RULES], [BlockPattern(p) for p in BLOCK_PATTERNS])
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect())
    assert got == Counter((i, *_brute(u)) for i, u, *_ in rows)
    assert judge_urls(df.limit(0), [SiteRule("org/", "allow")]).count() == 0


def test_rules_are_tried_by_their_rarest_token(spark):
    urls = [f"http://www.site{k}.com/a/{k}" for k in range(50)] + ["http://www.rare.com/a/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = judge_urls(df, [SiteRule("rare.com/a/", "block"), SiteRule("com/a", "allow")]).collect()
    assert [r.n_tried for r in out if r.page_id < 50] == [1] * 50  # only the rule filed under com
    assert [(r.rule, r.n_tried) for r in out if r.page_id == 50] == [("rare.com/a/", 2)]


def test_many_rules(spark):
    """100,000 rules, of which a url tries those filed under its tokens; and a pattern with many stars on a long url."""
    rules = [SiteRule(f"host{k}.org/p{k % 7}/", "block" if k % 2 else "allow") for k in range(100_000)]
    urls = [f"http://www.host{k}.org/p{k % 7}/x" for k in range(0, 100_000, 997)] + ["http://host5.org/q", None]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    start = time.monotonic()
    out = {r.page_id: r for r in judge_urls(df, rules).collect()}
    took = time.monotonic() - start
    for n, k in enumerate(range(0, 100_000, 997)):
        assert (out[n].rule, out[n].verdict) == (f"host{k}.org/p{k % 7}/", "block" if k % 2 else "allow") and out[n].n_tried <= 2
    assert out[len(urls) - 2].rule is None and took < 60
    stars = BlockPattern("a*a*a*a*a*a*a*a*b/c")
    long = spark.createDataFrame([(1, "http://x/" + "a" * 100_000), (2, "http://x/" + "a" * 1000 + "zb/c")], "page_id long, url string")
    start = time.monotonic()
    assert {r.page_id: r.verdict for r in judge_urls(long, [], [stars]).collect()} == {1: "allow", 2: "block"}
    assert time.monotonic() - start < 20


def test_rule_bytes_are_bounded(spark):
    with pytest.raises(ValueError, match="max_rule_bytes"):
        judge_urls(spark.createDataFrame([(1, "u")], "page_id long, url string"), [SiteRule("org/", "allow")], max_rule_bytes=3)


def test_table_is_even_and_stable():
    table = fill_table(["a", "b", "c"], 101)
    assert set(Counter(table).values()) <= {33, 34}
    kept = [x == y for x, y in zip(table, fill_table(["a", "b", "c", "d"], 101), strict=True)]
    assert sum(kept) > 55  # about a quarter of the slots move to the new shard
    for bad in (([], 101), (["a", "a"], 101), (["a"], 100)):
        with pytest.raises(ValueError):
            fill_table(*bad)


def test_placement(spark, scratch):
    rows = [(k if k % 3 else 7, f"t{k}", "clash") for k in range(600)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(4)
    got = place(df, SHARDS).collect()
    table = fill_table(SHARDS)
    for r in got:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % TABLE_SIZE
        assert (r.slot, r.shard) == (slot, table[slot])
    assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in rows)
    write_shards(place(df, SHARDS[:5]), f"{scratch}/s")
    assert spark.read.parquet(f"{scratch}/s").count() == len(rows)
    assert place(df.limit(0), SHARDS).count() == 0


def test_query_places_every_document(spark):
    out = QUERIES["op7_sharding"](spark, MEDIUM)
    assert out.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert "BroadcastHashJoin" in out._jdf.queryExecution().toString()


def test_table_is_filled_by_turns():
    """The lookup table against a version that lets shards name their slots in full preference lists."""
    shards, size = [f"s{k}" for k in range(7)], 101
    lists = []
    for name in shards:
        h = hashlib.sha256(name.encode()).digest()
        offset, skip = int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:16], "big") % (size - 1) + 1
        lists.append([(offset + j * skip) % size for j in range(size)])
        assert sorted(lists[-1]) == list(range(size))  # a permutation: the size is a prime
    owner = {}
    for turn in range(size):
        mine = turn % len(shards)
        owner[next(slot for slot in lists[mine] if slot not in owner)] = shards[mine]
    assert fill_table(shards, size) == [owner[slot] for slot in range(size)]
