"""The registered queries of this package: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.llm import angular, decontam, htmltext, langid, lmscore, mixing, neardup, packing, quality, simplex, topk, toxicity, urlfilter
from bidlake.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# The rules of the URL filter's query (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_OP9_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut),
rules(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT n, rh || rp AS rule, rv, row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC) AS k
  FROM parts, rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (n)
"""


@register("op9_url_filter", _OP9_SQL)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge_urls(pages, urlfilter.rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


@register("op10_source_mix")
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@register("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.DedupSettings(words=3, percent=85))


@register("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(table(spark, sf_dir, "documents"))


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""


@register("op3_exact_topk", _OP3_SQL)
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op8_main_text")
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@register("op6_lm_score")
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_documents(table(spark, sf_dir, "documents"))


_WHOLE = "CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)"

_OP11_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: {_WHOLE}) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""


@register("op11_hard_negatives", _OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return angular.hard_negatives(rows, F.col("vec_id") % 50 == 0)


@register("op12_sequence_packing")
def op12_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        tokenizer = file.read()
    return packing.piece_rows(packing.packed(table(spark, sf_dir, "documents"), tokenizer, public_tokenizers.PATTERN))


def _op13_sql(rounds: int = 5) -> str:
    """The rounds written out one after the other."""
    near = """d{r} AS MATERIALIZED (
  SELECT n, v, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d, k FROM v, c{r}),
a{r} AS MATERIALIZED (SELECT n, v, k, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, k) = 1),"""
    move = """c{s} AS MATERIALIZED (
  SELECT k, coalesce(list(m ORDER BY j), any_value(c)) AS c FROM c{r} LEFT JOIN (
    SELECT k, j, CAST((t - ((t % n) + n) % n) // n AS BIGINT) AS m FROM (
      SELECT k, j, sum(x) AS t, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range(64)) AS j FROM a{r}) GROUP BY k, j)) USING (k)
  GROUP BY k),"""
    steps = "\n".join(near.format(r=r) + (move.format(r=r, s=r + 1) if r < rounds else "") for r in range(rounds + 1))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: {_WHOLE}) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v AS c FROM v WHERE vec_id IS NOT NULL
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id), v) <= 40),
{steps}
i AS (SELECT k, sum(d) AS own, any_value(sha256(array_to_string(c, ','))) AS sha FROM a{rounds} JOIN c{rounds} USING (k) GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(own AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(own) FROM i) AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a{rounds} JOIN i USING (k) JOIN v USING (n)
"""


@register("op13_centroid_clustering", _op13_sql())
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex.clusters(table(spark, sf_dir, "embeddings"))
