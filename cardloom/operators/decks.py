"""Decks as rows (deck_id, zone, oracle_id, quantity): fingerprints, exact and revision groups, near duplicates."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import forget, written
from .graph import connected_components

COMMAND = "command"
#: Cards are counted by so many hashes of them, to put rare ones first.
COUNTED = 1 << 16
#: A deck's sketch: its copies by so many hashes of their cards, a byte each, eight in a long.
BINS = 16


def canonical_json(deck_cards: DataFrame) -> DataFrame:
    """deck_id, json: command zone and other zones, each sorted, keys in order, in the shape that fingerprints are taken of."""
    cards = F.sort_array(F.collect_list(F.struct(F.lower(F.col("oracle_id").cast("string")).alias("oracle_id"), F.col("quantity").cast("long").alias("quantity"))))
    zones = deck_cards.groupBy("deck_id", "zone").agg(cards.alias("cards"))
    decks = zones.groupBy("deck_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("zone") != COMMAND, F.struct("zone", "cards")))).alias("z"),
        F.coalesce(F.max(F.when(F.col("zone") == COMMAND, F.col("cards"))), F.array().cast("array<struct<oracle_id:string,quantity:bigint>>")).alias("command_zone"),
    )
    shape = F.struct(F.transform("z", lambda x: F.struct(x["cards"].alias("cards"), x["zone"].alias("zone"))).alias("card_zones"), "command_zone", F.lit("commander").alias("format"))
    return decks.select("deck_id", F.to_json(shape, {"ignoreNullFields": "false"}).alias("json"))


def fingerprint(deck_cards: DataFrame) -> DataFrame:
    return canonical_json(deck_cards).select("deck_id", F.sha2("json", 256).alias("fingerprint"))


def exact_groups(occurrences: DataFrame) -> DataFrame:
    """occurrences(fingerprint, source_id): groups of two or more, with their sources."""
    groups = occurrences.groupBy("fingerprint").agg(F.count("*").alias("occurrences"), F.array_sort(F.collect_set("source_id")).alias("sources"))
    return groups.where("occurrences > 1").withColumn("cross_source", F.size("sources") > 1)


def revision_groups(occurrences: DataFrame) -> DataFrame:
    """occurrences(source_id, source_deck_id, deck_id, observed_at and, if there, source_snapshot_id, raw_object_id): groups of two or
    more in the order of time (none first), deck, snapshot and object, named by a hash of their key. A group is one source's
    revisions of one deck."""
    order = F.array_sort(F.collect_list(F.struct("observed_at", "deck_id", *[c for c in ("source_snapshot_id", "raw_object_id") if c in occurrences.columns])))
    ordered = F.to_json(F.struct(F.col("source_deck_id").cast("string").alias("source_deck_id"), F.col("source_id").alias("source_id"), F.lit("source-deck-revision-v1").alias("version")))
    groups = occurrences.groupBy("source_id", "source_deck_id").agg(F.transform(order, lambda x: x["deck_id"]).alias("deck_ids")).where(F.size("deck_ids") > 1)
    return groups.withColumn("group_id", F.concat(F.lit("revision-"), F.left(F.sha2(ordered, 256), F.lit(32))))


def canonical_decks(deck_cards: DataFrame) -> DataFrame:
    """canonical_deck_id (the fingerprint), deck_id (the least of the equal decks)."""
    found = fingerprint(deck_cards).groupBy(F.unhex("fingerprint").alias("f")).agg(F.min("deck_id").alias("deck_id"))
    return found.select(F.lower(F.hex("f")).alias("canonical_deck_id"), "deck_id")


def sketch(bins: list[Column], total: Column) -> list[Column]:
    """Longs of eight bins each, a byte a bin: its copies in units of unit(total), rounded up."""
    part = lambda b, k: F.shiftleft(F.ceil(b / unit(total)).cast("long"), 8 * (k % 8))
    return [reduce(Column.bitwiseOR, [part(b, k) for k, b in enumerate(bins[i : i + 8])]) for i in range(0, len(bins), 8)]


def unit(total: Column) -> Column:
    return F.floor(total / 255) + 1


def most_common(one: list[Column], total1: Column, two: list[Column], total2: Column) -> Column:
    """At least as many copies as two decks of these sketches have in common."""
    bin_of = lambda s, k, total: F.shiftrightunsigned(s, 8 * k).bitwiseAND(F.lit(255)) * unit(total)
    return reduce(Column.__add__, [F.least(bin_of(a, k, total1), bin_of(b, k, total2)) for a, b in zip(one, two, strict=True) for k in range(8)])


def near_duplicate_pairs(deck_cards: DataFrame, threshold: float = 0.92) -> DataFrame:
    """left_id < right_id, similarity: sum of least quantities over sum of greatest, by (zone, oracle_id), at threshold or over.

    A deck is the multiset of its card copies, cards of rare hashes first. Two decks at threshold or over have
    threshold / (1 + threshold) of both totals in common, so the first card that they share has few copies before it: at
    most total - threshold * total in the greater deck, total - 2 * threshold / (1 + threshold) * total in the smaller.
    Only decks that share such a card meet, on one equi-join, and only where that card with the copies after it, and the
    decks' sketches, allow as many common copies; no pair is lost. Those that are left are added up over whole decks.
    Equal decks are one, named by the least id: they make no pairs of their own.
    """
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    share = threshold / (1 + threshold)
    canonical = written(canonical_decks(deck_cards).select("deck_id"), "canonical")
    add_up = lambda df: df.groupBy("deck_id", "zone", "oracle_id").agg(F.sum("quantity").cast("long").alias("q"))
    items = add_up(deck_cards.join(canonical, "deck_id", "left_semi")).withColumn("h", F.xxhash64("zone", "oracle_id"))
    counted = F.pmod("h", F.lit(COUNTED)).alias("counted")
    counts = written(items.groupBy(counted).agg(F.count("*").alias("decks")), "card-counts")  # COUNTED rows at most
    deck = Window.partitionBy("deck_id")
    before = deck.orderBy("decks", "zone", "oracle_id").rowsBetween(Window.unboundedPreceding, -1)
    mine = F.pmod(F.shiftrightunsigned("h", 40), F.lit(BINS))
    rows = items.select("*", counted).join(F.broadcast(counts), "counted").select(
        "deck_id", "h", "q", F.sum("q").over(deck).alias("total"), F.coalesce(F.sum("q").over(before), F.lit(0)).alias("before"),
        *[F.sum(F.when(mine == k, F.col("q")).otherwise(0)).over(deck).alias(f"bin{k}") for k in range(BINS)],
    )
    # one copy more than needed: rounding can't lose a pair
    within = lambda part: F.col("before") <= F.col("total") - F.ceil(F.col("total") * part) + 1
    parts = sketch([F.col(f"bin{k}") for k in range(BINS)], F.col("total"))
    first = rows.where(within(threshold)).select("deck_id", "h", "total", "q", (F.col("total") - F.col("before") - F.col("q")).alias("rest"), within(2 * share).alias("early"), *[x.alias(f"s{i}") for i, x in enumerate(parts)])
    first = written(first, "first-cards")
    named = lambda df, n: df.select("h", *[F.col(c).alias(n + c) for c in df.columns if c not in ("h", "early")])
    one, two = named(first.where("early"), "a"), named(first, "b")
    t1, t2, least = F.col("atotal"), F.col("btotal"), (F.col("atotal") + F.col("btotal")) * F.lit(share) - F.lit(1e-6)
    side = lambda n: [F.col(f"{n}s{i}") for i in range(len(parts))]
    smaller = (t1 < t2) | ((t1 == t2) & (F.col("adeck_id") < F.col("bdeck_id")))
    met = one.join(two, "h").where(smaller & (t1 >= t2 * F.lit(threshold) - F.lit(1e-6)) & (F.least("aq", "bq") + F.least("arest", "brest") >= least) & (most_common(side("a"), t1, side("b"), t2) >= least))
    ab = F.col("adeck_id") < F.col("bdeck_id")
    asked = met.select(F.least("adeck_id", "bdeck_id").alias("left_id"), F.greatest("adeck_id", "bdeck_id").alias("right_id"), F.when(ab, t1).otherwise(t2).alias("t1"), F.when(ab, t2).otherwise(t1).alias("t2"))
    asked = written(asked.distinct(), "near")
    forget(first, counts, canonical)
    known = asked.select(F.col("left_id").alias("deck_id")).union(asked.select("right_id")).distinct()
    own = written(add_up(deck_cards.join(known, "deck_id", "left_semi")), "near-decks")
    left = asked.join(own.select(F.col("deck_id").alias("left_id"), "zone", "oracle_id", F.col("q").alias("q1")), "left_id")
    both = left.join(own.select(F.col("deck_id").alias("right_id"), "zone", "oracle_id", F.col("q").alias("q2")), ["right_id", "zone", "oracle_id"])
    common = both.groupBy("left_id", "right_id", "t1", "t2").agg(F.sum(F.least("q1", "q2")).alias("m"))
    similarity = F.col("m") / (F.col("t1") + F.col("t2") - F.col("m"))
    return common.select("left_id", "right_id", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def near_duplicate_clusters(deck_cards: DataFrame, threshold: float = 0.92, version: str = "near-duplicate-v1") -> DataFrame:
    """cluster_id, component (least deck id), canonical_deck_ids: the closure of the pairs; the id hashes the algorithm, the members' fingerprints and the threshold."""
    pairs = near_duplicate_pairs(deck_cards, threshold).select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))
    found = connected_components(pairs).withColumnRenamed("node", "deck_id")
    prints = fingerprint(deck_cards.join(found, "deck_id", "left_semi")).withColumnRenamed("fingerprint", "canonical_deck_id")
    members = found.join(prints, "deck_id").groupBy("component").agg(F.array_sort(F.collect_list("canonical_deck_id")).alias("canonical_deck_ids"))
    body = F.concat(F.lit('{"algorithm":"quantity_weighted_jaccard","canonical_deck_ids":'), F.to_json("canonical_deck_ids"), F.lit(f',"threshold":{json.dumps(threshold)},"version":{json.dumps(version)}}}'))
    return members.select("component", "canonical_deck_ids", F.concat(F.lit("near-"), F.left(F.sha2(body, 256), F.lit(32))).alias("cluster_id"))


def cooccurrence(deck_cards: DataFrame) -> DataFrame:
    """deck_id, kind, left_id, right_id: each commander with each other card, and each unordered pair of other cards."""
    cards = deck_cards.select("deck_id", "zone", "oracle_id").distinct()
    commanders = cards.where(F.col("zone") == COMMAND).select("deck_id", F.col("oracle_id").alias("left_id"))
    others = cards.where(F.col("zone") != COMMAND).select("deck_id", F.col("oracle_id").alias("right_id")).distinct()
    with_commander = commanders.join(others, "deck_id").select("deck_id", F.lit("commander_card").alias("kind"), "left_id", "right_id")
    pairs = others.select("deck_id", F.col("right_id").alias("left_id")).join(others, "deck_id").where("left_id < right_id").select("deck_id", F.lit("card_card").alias("kind"), "left_id", "right_id")
    return with_commander.union(pairs)


def zone_totals(deck_cards: DataFrame) -> DataFrame:
    """Rows of a card within a zone added up; a card's printings stay apart where they are known."""
    key = ["deck_id", "zone", "oracle_id", *[c for c in ("printing_id",) if c in deck_cards.columns]]
    return deck_cards.groupBy(*key).agg(F.sum("quantity").cast("long").alias("quantity"), F.count("*").alias("entries"))
