"""Cards merged by oracle id: equal facts merge, unequal ones are quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_cards(records: DataFrame, facts: list[str]) -> tuple[DataFrame, DataFrame]:
    """records(staging_id, oracle_id, facts..): one row for each oracle id (the facts of the least staging id, how many rows agree), and (staging_id, oracle_id, code) of rows that don't.

    Aggregates only: a card that many rows share is combined before it is dealt. Rows meet their card's first facts by a
    join that may be split.
    """
    digest = F.sha2(F.to_json(F.struct(*facts), {"ignoreNullFields": "false"}), 256)
    rows = records.withColumn("__facts", digest)
    first = rows.groupBy("oracle_id").agg(F.min_by("__facts", "staging_id").alias("__first"), F.min("staging_id").alias("staging_id"), F.min_by(F.struct(*facts), "staging_id").alias("f"))
    agree = rows.groupBy("oracle_id", "__facts").agg(F.count("*").alias("n")).withColumnRenamed("__facts", "__first")
    cards = first.join(agree, ["oracle_id", "__first"]).select("oracle_id", "staging_id", "f.*", "n")
    conflicts = rows.join(first.select("oracle_id", "__first"), "oracle_id").where("__facts <> __first").select("staging_id", "oracle_id", F.lit("quality.card_facts_conflict").alias("code"))
    return cards, conflicts


def merge_provenance(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    others = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("r")).select(*key, "r.*")
