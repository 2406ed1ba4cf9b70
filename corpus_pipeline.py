"""Documents to shards of training text: quality rules, near duplicates, decontamination, mixing, sharding.

Each stage's rows are written as Parquet to the shared folder and read again as the next one's documents. All stages but
the last give the columns of documents; the last adds size, shard and slot. Each stage takes null, empty and very long
texts, repeated rows and an empty table: null and empty texts fail the quality rules and go, repeated rows are one near-duplicate group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import decontamination, mixing, ngram_join, quality, sharding
from cardloom.llm.common import cut, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the shared lines reject go; the others stay without the shared lines."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays, that with the least doc_id."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go. Columns named like the operator's results keep their own values."""
    named = {c: f"__own_{c}" for c in ("n_words", "n_hit", "n_items", "items", "contaminated") if c in docs.columns}
    found = decontamination.find_contamination(docs.withColumnsRenamed(named), table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*[F.col(named.get(c, c)).alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks, in random order. A null source is of the rest. Columns named like the operator's keep their own values."""
    named = {c: f"__own_{c}" for c in ("copy", "shuffle_key") if c in docs.columns}
    mixed = mixing.shuffled(mixing.mix(docs.withColumnsRenamed(named)))
    return mixed.select(*[F.col(named.get(c, c)).alias(c) for c in docs.columns])


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of equal bytes, of rows as they are read: the mixed table's parts in any order, each in its random order. Sizes
    alone are dealt and sorted, then the texts meet their places once. Clashing columns (size, shard, slot) are replaced."""
    rows = docs.drop("size", "shard", "slot").withColumn("__row", F.monotonically_increasing_id())
    placed = sharding.shard(rows.select("__row", sharding.text_size(F.col("text")).alias("bytes")), F.col("bytes"), [F.col("__row")])
    return rows.join(cut(placed.select("__row", "size", "shard", "slot"), "pipeline-places"), "__row").drop("__row")


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: The components of near duplicates and the inverted Poisson distribution have no DuckDB SQL that runs over whole tables; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
