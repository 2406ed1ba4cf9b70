"""Curated rows of the dataset kinds, their counts and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import first_code, mode
from .decks import cooccurrence


def filter_records(records: DataFrame, sources: list[str] | None = None, modes: list[str] | None = None, legal: list[str] | None = None, quality: list[str] | None = None, observed_from: str | None = None, observed_until: str | None = None, current_use: list[str] | None = None, approved_only: bool = False) -> DataFrame:
    """records with exclusion_code, the first that holds: source, current use, mode, legality, quality, from, until, approval.

    Settings that are None ask nothing; nulls never pass a list. current_use lists the sources with a decision;
    approved_only asks for a true `approved`. Source ids are compared folded, with _ for -.
    """
    source = lambda c: F.translate(F.lower(F.trim(c)), "-", "_")
    within = lambda c, allowed: F.coalesce(c.isin(allowed), F.lit(False))
    folded = lambda xs: [x.strip().casefold().replace("-", "_") for x in xs]
    at, checks = F.col("observed_at"), []
    if sources is not None:
        checks.append((~within(source(F.col("source_id")), folded(sources)), "policy.dataset_source_excluded"))
    if current_use is not None:
        checks.append((~within(source(F.col("source_id")), folded(current_use)), "policy.current_use_required"))
    if modes is not None:
        checks.append((~within(mode(F.col("mode")), modes), "policy.dataset_mode_excluded"))
    if legal is not None:
        checks.append((~within(F.lower("legal_status"), legal), "legality.dataset_status_excluded"))
    if quality is not None:
        checks.append((~within(F.lower("quality_status"), quality), "quality.dataset_status_excluded"))
    if observed_from is not None:
        checks.append((F.coalesce(at < F.lit(observed_from).cast("timestamp_ntz"), F.lit(True)), "quality.dataset_observed_before"))
    if observed_until is not None:
        checks.append((F.coalesce(at >= F.lit(observed_until).cast("timestamp_ntz"), F.lit(True)), "quality.dataset_observed_after"))
    if approved_only:
        checks.append((~F.coalesce("approved", F.lit(False)), "policy.source_approval_missing"))
    return records.withColumn("exclusion_code", first_code(*checks) if checks else F.lit(None).cast("string"))


def completion_rows(dataset_id: str, assignments: DataFrame, memberships: DataFrame) -> DataFrame:
    """curated_id, record_id, split, group_ids (sorted)."""
    groups = memberships.groupBy("record_id").agg(F.array_sort(F.collect_set("group_id")).alias("group_ids"))
    rows = assignments.join(groups, "record_id", "left")
    empty = F.array().cast(groups.schema["group_ids"].dataType)
    return rows.select(F.concat_ws(":", F.lit(dataset_id), F.col("record_id").cast("string")).alias("curated_id"), "record_id", "split", F.coalesce("group_ids", empty).alias("group_ids"))


def cooccurrence_rows(dataset_id: str, deck_cards: DataFrame, assignments: DataFrame) -> DataFrame:
    """A row for each pair of each deck, with the deck's split."""
    pairs = cooccurrence(deck_cards).join(assignments.select(F.col("record_id").alias("deck_id"), "split"), "deck_id")
    ident = F.concat_ws(":", F.lit(dataset_id), *[F.col(c).cast("string") for c in ("deck_id", "kind", "left_id", "right_id")])
    return pairs.select(ident.alias("curated_id"), "deck_id", "kind", "left_id", "right_id", "split")


def reconcile(records: DataFrame, kept: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """One row: inputs, kept and excluded records, those in both, in neither, and repeated ones; consistent when the last three are 0."""
    sides = records.select(key, F.lit(1).alias("r"), F.lit(0).alias("k"), F.lit(0).alias("x")).union(kept.select(key, F.lit(0), F.lit(1), F.lit(0))).union(excluded.select(key, F.lit(0), F.lit(0), F.lit(1)))
    each = sides.groupBy(key).agg(*[F.sum(c).alias(c) for c in "rkx"])
    return each.agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("inputs"), F.coalesce(F.sum("k"), F.lit(0)).alias("kept"), F.coalesce(F.sum("x"), F.lit(0)).alias("excluded"),
        F.count_if((F.col("k") > 0) & (F.col("x") > 0)).alias("in_both"), F.count_if((F.col("k") + F.col("x") == 0) | (F.col("r") == 0)).alias("in_neither"), F.count_if((F.col("r") > 1) | (F.col("k") > 1) | (F.col("x") > 1)).alias("repeated"),
    )


def masks(deck_cards: DataFrame, dataset_id: str, index: int = 0, share: float = 0.25) -> DataFrame:
    """deck_cards with masked: of each deck's other cards the first ceil(share * n) by a hash of deck, dataset, index and card."""
    order = F.sha2(F.concat_ws(":", F.col("deck_id").cast("string"), F.lit(dataset_id), F.lit(str(index)), F.col("oracle_id").cast("string")), 256)
    others = F.col("zone") != "command"
    w = Window.partitionBy("deck_id", others)
    rows = deck_cards.withColumn("__k", F.row_number().over(w.orderBy(order, "oracle_id"))).withColumn("__n", F.count("*").over(w))
    return rows.withColumn("masked", others & (F.col("__k") <= F.ceil(F.col("__n") * share))).drop("__k", "__n")
