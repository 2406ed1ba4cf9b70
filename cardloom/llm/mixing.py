"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, uniform

#: A source's target share of the mixture; the sources not named here share REST, in proportion to their documents.
WEIGHTS = {"src0": 0.10, "src1": 0.08, "src2": 0.06, "src3": 0.06}
REST, SEED, STEP = 0.70, 17, 200.0


def poisson(mean: float, u: Column) -> Column:
    """The smallest k whose cumulative probability is over u: a chain of comparisons, to where the tail is below 2**-53."""
    p, cdf, steps, k = math.exp(-mean), math.exp(-mean), [], 0
    top = int(mean + 12 * math.sqrt(mean) + 30)
    while k < top and cdf < 1.0:
        steps.append(cdf)
        k += 1
        p *= mean / k
        cdf += p
    return F.size(F.filter(F.array(*[F.lit(x) for x in steps]), lambda c: c <= u)) if steps else F.lit(0)


def copies(mean: float, key: list[Column], seed: int) -> Column:
    """Means over STEP are sums of independent parts of STEP, so that exp(-mean) never underflows."""
    parts, out = max(1, math.ceil(mean / STEP)), F.lit(0)
    for i in range(parts):
        out = out + poisson(mean / parts, uniform(*key, f"part{i}", seed=seed))
    return out


def rates(df: DataFrame, weights: dict[str, float], rest: float, epochs: float) -> tuple[dict[str, float], float]:
    """Mean copies of a document by named source, and of the rest; at most one row for each named source is collected."""
    named = F.when(F.col("source").isin(list(weights)), F.col("source"))
    n = {r[0]: r[1] for r in df.groupBy(named.alias("s")).count().collect()}
    total, mass = sum(n.values()), sum(w for s, w in weights.items() if n.get(s)) + (rest if n.get(None) else 0)
    rate = {s: w / mass * total * epochs / n[s] for s, w in weights.items() if n.get(s) and mass}
    return rate, rest / mass * total * epochs / n[None] if n.get(None) and mass else 0.0


def mix(df: DataFrame, weights: dict[str, float] = WEIGHTS, rest: float = REST, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """Rows repeated a Poisson number of times, with copy (from 0) and shuffle_key.

    A row's number depends only on doc_id, text and seed, so repeated rows get equal numbers. Null sources and those
    not named belong to the rest. Target weights are shares of documents. Columns that clash (copy, shuffle_key) are replaced.
    An empty table gives none. A text is hashed once, before its copies are made.
    """
    rate, other = rates(df, weights, rest, epochs)
    key = [F.col("doc_id"), F.col("__key")]
    n = F.when(F.lit(False), F.lit(0))
    for s, mean in rate.items():
        n = n.when(F.col("source") == s, copies(mean, key, seed))
    n = n.otherwise(copies(other, key, seed))
    # arrays of one keep the hash and the number from being worked out wherever they are named
    out = df.drop("copy", "shuffle_key").withColumn("__key", F.explode(F.array(F.md5(F.coalesce(F.col("text"), F.lit(""))))))
    out = out.withColumn("__n", F.explode(F.array(n))).where("__n > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("copy"))
    return out.withColumn("shuffle_key", uniform(*key, F.col("copy"), "order", seed=seed)).drop("__key", "__n")


def shuffled(df: DataFrame) -> DataFrame:
    """The rows in the order of their random keys, over all partitions. Keys are uniform, so equal parts of [0, 1) are equal shares: no pass samples them first."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.floor(F.col("shuffle_key") * parts).cast("int")
    return df.repartitionById(parts, at).sortWithinPartitions("shuffle_key", "doc_id", "copy")


def op5_mixing(spark, sf_dir) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return shuffled(mixed.select("doc_id", "source", F.col("copy").cast("long").alias("copy"), "shuffle_key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")))


#: Means are under STEP here, so one uniform number decides a row's copies.
OP5_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(strlen(text), 0) AS bytes, coalesce(doc_id::VARCHAR, '~') || ':' || md5(coalesce(text, '')) AS k, CASE WHEN source IN ({", ".join(f"'{s}'" for s in WEIGHTS)}) THEN source END AS named FROM documents),
w(s, weight) AS (VALUES {", ".join(f"('{s}', {w}::DOUBLE)" for s, w in WEIGHTS.items())}, (NULL, {REST}::DOUBLE)),
n AS (SELECT named, count(*) AS n FROM d GROUP BY 1),
r AS (SELECT named, weight / sum(weight) OVER () * sum(n) OVER () / n AS mean FROM n JOIN w ON w.s IS NOT DISTINCT FROM n.named),
c AS (SELECT named, list(cdf ORDER BY k) AS cdfs FROM (SELECT named, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY named ORDER BY k) AS cdf FROM r, range(0, 60) AS t(k)) GROUP BY 1),
u AS (SELECT doc_id, source, bytes, k, len(list_filter(cdfs, lambda x: x <= ('0x' || substr(md5('{SEED}:' || k || ':part0'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)) AS copies FROM d JOIN c ON c.named IS NOT DISTINCT FROM d.named)
SELECT doc_id, source, i AS copy, ('0x' || substr(md5('{SEED}:' || k || ':' || i || ':order'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS shuffle_key, bytes FROM u, range(0, copies) AS t(i)
"""
