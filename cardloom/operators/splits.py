"""Temporal splits without leaks: provisional by date, promoted forward over groups, whole events together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import connected_components

NAMES = ("train", "validation", "test")


def provisional(observed_at: Column, train_until: str, validation_until: str) -> Column:
    return F.when(observed_at < F.lit(train_until).cast("timestamp_ntz"), "train").when(observed_at < F.lit(validation_until).cast("timestamp_ntz"), "validation").otherwise("test")


def rank(split: Column) -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in NAMES]), split)


def promote(records: DataFrame, memberships: DataFrame) -> DataFrame:
    """records(record_id, split) with each record moved to the latest split of all records that groups (record_id, group_id) chain it to."""
    # records meet by way of one representative of each group, so a group of n members has n - 1 edges; groups of one have none
    first = memberships.groupBy("group_id").agg(F.min("record_id").alias("a"), F.max("record_id").alias("z")).where("a <> z").drop("z")
    edges = memberships.join(first, "group_id").select("a", F.col("record_id").alias("b"))
    found = connected_components(edges)
    placed = records.join(found, records.record_id == found.node, "left").select("record_id", "split", F.coalesce("component", "record_id").alias("component"))
    last = placed.groupBy("component").agg(F.max(rank(F.col("split"))).alias("last"))
    return placed.join(last, "component").select("record_id", F.col("split").alias("provisional_split"), F.element_at(F.array(*[F.lit(n) for n in NAMES]), F.col("last").cast("int")).alias("split"))


def benchmark_groups(deck_cards: DataFrame, fingerprints: DataFrame, low_data_max: int = 1) -> DataFrame:
    """deck_id, benchmark, group_id: the holdout groups of the cold-start benchmarks.

    cold_fingerprint holds out equal decks, cold_command_zone equal command zones, cold_commander each commander, and
    low_data_commander each commander that low_data_max decks or fewer have.
    """
    zone = deck_cards.where("zone = 'command'").select("deck_id", F.lower(F.col("oracle_id").cast("string")).alias("c"), F.col("quantity").cast("long").alias("q"))
    cards = zone.groupBy("deck_id").agg(F.array_sort(F.collect_list(F.struct("c", "q"))).alias("cards"))
    text = F.concat(F.lit("["), F.array_join(F.transform("cards", lambda x: F.concat(F.lit('["'), x["c"], F.lit('",'), x["q"].cast("string"), F.lit("]"))), ","), F.lit("]"))
    every = fingerprints.select("deck_id", "fingerprint").join(cards, "deck_id", "left")
    commanders = zone.select("deck_id", "c").distinct()
    few = commanders.groupBy("c").agg(F.count("*").alias("n")).where(F.col("n") <= low_data_max).select("c")
    each = every.select("deck_id").join(commanders, "deck_id", "left")
    row = lambda name, ident: ("deck_id", F.lit(name).alias("benchmark"), ident.alias("group_id"))
    return (
        every.select(*row("cold_fingerprint", F.concat(F.lit("fingerprint:"), "fingerprint")))
        .union(every.select(*row("cold_command_zone", F.concat(F.lit("command-zone-"), F.left(F.sha2(F.coalesce(text, F.lit("[]")), 256), F.lit(32))))))
        .union(each.select(*row("cold_commander", F.concat(F.lit("commander:"), F.coalesce("c", F.lit("missing"))))))
        .union(commanders.join(few, "c").select(*row("low_data_commander", F.concat(F.lit("low-data-commander:"), "c"))))
    )


def tournament(records: DataFrame, train_until: str, validation_until: str) -> DataFrame:
    """records(record_id, event_id, observed_at, deck_id, complete_event, complete_decklist): split or exclusion code, and familiar or unseen.

    One incomplete record excludes its whole event; then incomplete decklists go. An event lies in one split, its latest.
    """
    w = Window.partitionBy("event_id")
    rows = records.withColumn("whole", F.bool_and("complete_event").over(w))
    rows = rows.withColumn("exclusion_code", F.when(~F.col("whole"), "quality.event_incomplete").when(~F.col("complete_decklist"), "quality.decklist_incomplete"))
    rows = rows.withColumn("r", F.when(F.col("exclusion_code").isNull(), rank(provisional(F.col("observed_at"), train_until, validation_until))))
    rows = rows.withColumn("split", F.element_at(F.array(*[F.lit(n) for n in NAMES]), F.max("r").over(w).cast("int"))).withColumn("split", F.when(F.col("exclusion_code").isNull(), F.col("split")))
    known = rows.where("split = 'train' and deck_id is not null").select("deck_id").distinct().withColumn("known", F.lit(True))
    rows = rows.join(known, "deck_id", "left")
    stratum = F.when(F.col("split").isNotNull(), F.when(F.col("known"), "familiar").otherwise("unseen"))
    return rows.select("record_id", "event_id", "split", "exclusion_code", stratum.alias("stratum"))


def leakage(memberships: DataFrame, assignments: DataFrame) -> DataFrame:
    """group_id, splits of the groups that lie in more than one split."""
    found = memberships.join(assignments.select("record_id", "split"), "record_id").groupBy("group_id").agg(F.array_sort(F.collect_set("split")).alias("splits"))
    return found.where(F.size("splits") > 1)


def leakage_status(memberships: DataFrame, events: DataFrame, assignments: DataFrame) -> DataFrame:
    """One row: groups and events(record_id, event_id) that lie in more than one split, and PASS when there are none."""
    groups = leakage(memberships, assignments).agg(F.count("*").alias("cross_split_groups"))
    across = leakage(events.select("record_id", F.col("event_id").alias("group_id")), assignments).agg(F.count("*").alias("cross_split_events"))
    return groups.crossJoin(across).withColumn("status", F.when(F.col("cross_split_groups") + F.col("cross_split_events") == 0, "PASS").otherwise("FAIL"))  # rows of one
