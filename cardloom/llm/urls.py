"""URL rules by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
MOST_BROADCAST = 100_000


def split_url(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, default: str = "allow", prefix: int = 8) -> DataFrame:
    """page_id, url, host, path, rule, verdict for every row of pages(page_id, url).

    A rule is stored as sha256 of host + path. A URL's expressions are its host suffixes (with as many labels as some
    rule has) joined to its path prefixes (as long as some rule's path); they meet the rules by the first `prefix` hex
    digits, then the whole digest has to agree. The longest rule wins; of equally long ones that with the longer host,
    then block. No rule: the default. Null urls and those without :// have an empty host and path and meet no rule.
    The rules are a driver-side list and are broadcast up to MOST_BROADCAST of them, else joined by a shuffle.
    """
    spark: SparkSession = pages.sparkSession
    pages = pages.select("page_id", "url")
    host, path = split_url(F.col("url"))
    rows = pages.select("*", F.monotonically_increasing_id().alias("rid")).withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    stored = spark.createDataFrame([(h + p, len(h + p), len(h), v) for v, h, p in rules], "rule string, length int, host_length int, verdict string")
    stored = stored.withColumn("digest", F.sha2("rule", 256)).withColumn("short", F.substring("digest", 1, prefix))
    labels, lengths = sorted({h.count(".") + 1 for _, h, _ in rules}), sorted({len(p) for _, _, p in rules})
    parts = F.split("host", r"\.")
    hosts = F.array_distinct(F.array(*[F.when(F.size(parts) >= n, F.substring_index("host", ".", -n)) for n in labels])) if labels else F.array().cast("array<string>")
    paths = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    both = F.flatten(F.transform(F.array_compact(hosts), lambda h: F.transform(F.array_compact(paths), lambda p: F.concat(h, p))))
    asked = rows.withColumn("expression", F.explode_outer(both)).withColumn("asked", F.sha2("expression", 256)).withColumn("short", F.substring("asked", 1, prefix)).drop("expression")
    side = F.broadcast(stored) if len(rules) <= MOST_BROADCAST else stored
    hit = F.when(F.col("asked") == F.col("digest"), F.struct("length", "host_length", (F.col("verdict") == "block").alias("b"), "rule", "verdict"))
    best = asked.join(side, "short", "left").groupBy("rid", "page_id", "url", "host", "path").agg(F.max(hit).alias("hit"))
    return best.select("page_id", "url", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))


def op7_url_filter(spark, sf_dir) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).drop("url")


OP7_SQL = """
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, h, f) AS (VALUES ('allow','org','/'), ('block','example.org','/es/'), ('block','example.org','/en/1'), ('allow','com','/fr/'), ('block','com','/de/')),
m AS (SELECT q.*, (SELECT max(struct_pack(l := length(h || f), r := h || f, v := verdict)) FROM r
                   WHERE (q.host = h OR ends_with(q.host, '.' || h)) AND starts_with(q.path, f)) AS b FROM q)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, b.r AS rule, coalesce(b.v, 'allow') AS verdict FROM m
"""
