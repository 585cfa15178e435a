import pytest

from bidlake.llm import urlfilter
from bidlake.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "https://Example.ORG/es/1?x=/en/1", "http://a.example.org/en/15#t", "http://a.example.org/en/25", "http://org/", "http://org",
        "http://x.com/fr/a", "http://x.com/de/a", "http://x.com/it/a", "http://com/fr/", "http://xorg/", "http://x.org:80/", "ftp://u@x.org/p?q", "http://x.net/es/",
        "http://a..org/x", "http://.org/", "http://example.org/es", "HTTP://EXAMPLE.ORG/en/1", "x://y://example.org/en/1", "http://example.org/en/1\nrest", "http://x.com/fr/a"]


def judged(url, rules, default="allow"):
    """Host, path, rule and verdict by trying every rule."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, default)


def run(spark, rules):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id int, url string, rule string, host string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(pages, urlfilter.rule_table(spark, rules)).collect()}


@pytest.mark.parametrize("rules", [URL_RULES, [], [("org", "/", "allow"), ("org", "/", "block")], [("com", "", "block"), ("x.com", "/fr/", "allow")]])
def test_rules_against_trying_each(spark, rules):
    assert run(spark, rules) == {i: judged(u, rules) for i, u in enumerate(URLS)}


def test_large_list_joins_the_filter(spark, monkeypatch):
    rules = URL_RULES + [(f"h{i}.com", "/", "block") for i in range(300)]
    small = run(spark, rules)
    monkeypatch.setattr(urlfilter, "INLINE_BLOCKS", 1)
    assert run(spark, rules) == small == {i: judged(u, rules) for i, u in enumerate(URLS)}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id int, url string")
    assert urlfilter.judge_urls(pages, urlfilter.rule_table(spark, URL_RULES)).count() == 0


def test_filter_has_no_misses(spark):
    from pyspark.sql import functions as F
    keys = spark.range(500).select(F.concat(F.lit("h"), "id", F.lit(".net/")).alias("key"))
    table = urlfilter.bloom_blocks(keys, 32)
    both = keys.withColumn("block", urlfilter.block_of(F.col("key"), 32)).join(table, "block")
    kept = both
    for i in range(urlfilter.LANES):
        kept = kept.where(F.col(f"lane{i}").bitwiseAND(urlfilter.lane_mask(F.col("key"), i)) == urlfilter.lane_mask(F.col("key"), i))
    assert kept.count() == 500
