"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import forget, written


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of edges(a, b).

    Each round every node hooks to its least neighbour, pointers jump twice, and edges are contracted; it ends when no
    edge joins two components. Each round's tables are written, so a lost executor costs one round at most; those of
    earlier rounds are deleted.
    """
    every = written(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    labels = written(every.select("u").union(every.select("v")).distinct().select(F.col("u").alias("node"), F.col("u").alias("component")), "labels")
    pairs = written(every.where("u <> v"), "edges")
    forget(every)
    while not pairs.isEmpty():
        hook = pairs.union(pairs.select("v", "u")).toDF("c", "to").groupBy("c").agg(F.least(F.min("to"), F.col("c")).alias("to"))
        hook = written(hook, "hooks")
        for _ in range(2):
            last, hook = hook, written(hook.join(hook.select(F.col("c").alias("to"), F.col("to").alias("next")), "to").select("c", F.col("next").alias("to")), "hooks")
            forget(last)
        last, labels = labels, written(labels.join(hook, labels.component == hook.c, "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
        forget(last)
        side = lambda x: hook.select(F.col("c").alias(x), F.col("to").alias(f"t{x}"))
        last, pairs = pairs, written(pairs.join(side("u"), "u").join(side("v"), "v").where("tu <> tv").select(F.least("tu", "tv").alias("u"), F.greatest("tu", "tv").alias("v")).distinct(), "edges")
        forget(last, hook)
    forget(pairs)
    return labels
