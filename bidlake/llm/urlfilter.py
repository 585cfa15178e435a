"""URL filter by host and path rules, with DataFrame operations only.

Listed canonical URLs (host and path of each rule) set bits in a blocked Bloom
filter: a key falls into one block of 256 bits and sets eight of them.  A
page's candidate keys (each host suffix with each listed path length) are
tried against the filter inside the scan; only possible hits leave it, for an
exact hash join that removes false positives.  Pages without a possible hit
are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlake.llm.common import stored

LANES, LANE_BITS, KEY_BITS = 4, 64, 16
INLINE_BLOCKS = 256

RULES = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("verdict", T.StringType())])


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or holds no ``://``."""
    text = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(text, r"(?s)^.*?://(.*)\z", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def lane_mask(key: Column, lane: int) -> Column:
    """The two bits that a key sets in one lane of its block."""
    bits = F.xxhash64(key, F.lit("lane"))
    places = [F.shiftright(bits, 12 * lane + 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(2)]
    first, second = (F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places)
    return first.bitwiseOR(second)


def bloom_blocks(rules: DataFrame, blocks: int) -> DataFrame:
    """The filter as a table: block and its four lanes."""
    keyed = rules.select(block_of(F.col("key"), blocks).alias("block"), *[lane_mask(F.col("key"), i).alias(f"lane{i}") for i in range(LANES)])
    return keyed.groupBy("block").agg(*[F.bit_or(f"lane{i}").alias(f"lane{i}") for i in range(LANES)])


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every suffix of the host at a dot, joined with the path's start of each listed length."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda x: x.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A rule fits its host and all subdomains if the path starts with the
    rule's; of the fitting ones the longest (host and path together) wins,
    then the longer host, then ``block``.  Without a rule the URL is not
    listed: rule null, verdict ``default``.  Null or malformed URLs have an
    empty host and path and fit nothing.  Repeated rows stay, each judged by
    itself; an empty table gives an empty result; columns of ``pages`` named
    like an added one are replaced.

    The rule list is stored once; its key count sizes the filter.  A filter of
    up to ``INLINE_BLOCKS`` blocks (8 KB) is a constant of the scan; a larger
    one stays a table that candidates join by block, which Spark broadcasts or
    shuffles by its stored size, as it does the rule list.
    """
    listed = stored(rules.select(
        F.concat("host", "path").alias("key"), F.length("host").alias("_host_length"), F.length("path").alias("_path_length"),
        F.col("verdict").alias("_verdict")).where(F.col("key").isNotNull()).distinct())
    lengths = sorted(r[0] for r in listed.select("_path_length").distinct().collect())
    count = listed.count()
    blocks = 1
    while blocks * LANES * LANE_BITS < KEY_BITS * count:
        blocks *= 2

    host, path = split_url(F.col(url))
    out = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict", "_keys")], host.alias("host"), path.alias("path"))
    unlisted = [F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")]
    if not count:
        return out.select("*", *unlisted)
    own = [F.col(f"`{c}`") for c in out.columns]
    keyed = out.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    filter_table = bloom_blocks(listed, blocks)
    if blocks <= INLINE_BLOCKS:
        words = {r["block"]: [r[f"lane{i}"] for i in range(LANES)] for r in filter_table.collect()}
        lanes = [F.array(*[F.lit(words.get(b, [0] * LANES)[i]).cast("long") for b in range(blocks)]) for i in range(LANES)]

        def possible(key: Column) -> Column:
            tests = [F.element_at(lanes[i], block_of(key, blocks) + 1).bitwiseAND(lane_mask(key, i)) == lane_mask(key, i) for i in range(LANES)]
            return tests[0] & tests[1] & tests[2] & tests[3]

        keyed = keyed.withColumn("_keys", F.filter("_keys", possible))
        missed, possible_rows = keyed.where(F.size("_keys") == 0), keyed.where(F.size("_keys") > 0)
        hits = possible_rows.withColumn("_row", F.monotonically_increasing_id()).select("_row", F.struct(*own).alias("_page"), F.explode("_keys").alias("key"))
    else:
        missed = None
        rows = keyed.withColumn("_row", F.monotonically_increasing_id()).select("_row", F.struct(*own).alias("_page"), F.explode_outer("_keys").alias("key"))
        probed = rows.withColumn("block", block_of(F.col("key"), blocks)).join(filter_table, "block", "left")
        passed = F.lit(True)
        for i in range(LANES):
            passed = passed & F.coalesce(F.col(f"lane{i}").bitwiseAND(lane_mask(F.col("key"), i)) == lane_mask(F.col("key"), i), F.lit(False))
        hits = probed.select("_row", "_page", F.when(passed, F.col("key")).alias("key"))
    best = F.max(F.when(F.col("_verdict").isNotNull(), F.struct(
        F.length("key").alias("length"), F.col("_host_length").alias("host_length"), (F.col("_verdict") == "block").alias("blocks"),
        F.col("key").alias("rule"), F.col("_verdict").alias("verdict"))))
    judged = (hits.join(listed, "key", "left").groupBy("_row").agg(F.first("_page").alias("_page"), best.alias("_best"))
              .select("_page.*", F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict")))
    return judged if missed is None else missed.select(*own, *unlisted).unionByName(judged)
