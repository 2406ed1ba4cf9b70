"""Effective-dated rulesets, legality and quality of decks, eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import findings, first_code

# The findings that leave a deck's legality open.
UNKNOWN = ("legality.ruleset_unresolved", "legality.ruleset_ambiguous", "legality.card_fact_missing", "legality.command_zone_unverified")


def applicable_ruleset(decks: DataFrame, rulesets: DataFrame) -> DataFrame:
    """decks(deck_id, observed_at) with ruleset_version and selection_code: of the rulesets in force the latest; several latest are ambiguous, none is unresolved.

    rulesets(ruleset_version, effective_from, effective_until) is a driver-side list of dates, so it is broadcast.
    """
    on = F.expr("effective_from <= to_date(observed_at) and (effective_until is null or to_date(observed_at) < effective_until)")
    met = decks.join(F.broadcast(rulesets), on, "left")
    best = met.groupBy("deck_id", "observed_at").agg(F.max("effective_from").alias("latest"), F.collect_list(F.struct("effective_from", "ruleset_version")).alias("all"))
    top = F.filter("all", lambda x: x["effective_from"] == F.col("latest"))
    code = F.when(F.col("latest").isNull(), "legality.ruleset_unresolved").when(F.size(top) > 1, "legality.ruleset_ambiguous")
    return best.select("deck_id", "observed_at", F.when(code.isNull(), F.get(top, F.lit(0))["ruleset_version"]).alias("ruleset_version"), code.alias("selection_code"))


def legality(decks: DataFrame, deck_cards: DataFrame, facts: DataFrame, rulesets: DataFrame, verified_command_zone: bool = False) -> DataFrame:
    """decks(deck_id, ruleset_version, selection_code): findings (sorted) and status; any finding of UNKNOWN makes it unknown, any other illegal.

    Each deck is judged by its own ruleset. facts(oracle_id, colors array, legal, is_basic_land). rulesets(ruleset_version,
    required_total, copy_limit, min_commanders, max_commanders, banned array, banned_as_companion array, unlimited array,
    overrides map of copy limits): a driver-side list, so it is broadcast. Command zone and mainboard count; of the
    other zones the companion alone matters.
    """
    rules = F.broadcast(rulesets)
    chosen = decks.where("selection_code is null").select("deck_id", "ruleset_version")
    counted = deck_cards.where(F.col("zone").isin("command", "mainboard", "companion"))
    part = lambda zone: F.sum(F.when(F.col("zone") == zone, F.col("quantity")).otherwise(0))
    copies = counted.groupBy("deck_id", "oracle_id").agg(part("command").alias("cq"), part("mainboard").alias("mq"), *[F.bool_or(F.col("zone") == z).alias(z) for z in ("command", "mainboard", "companion")])
    rows = copies.join(chosen, "deck_id").join(facts.withColumn("__fact", F.lit(True)), "oracle_id", "left").join(rules, "ruleset_version")
    played = F.col("command") | F.col("mainboard")
    has = F.col("__fact").isNotNull() & played
    listed = lambda c: F.array_contains(c, F.col("oracle_id"))
    limit = F.coalesce(F.try_element_at("overrides", F.col("oracle_id")), F.col("copy_limit"))
    each = rows.groupBy("deck_id").agg(
        F.sum(F.col("cq") + F.col("mq")).alias("total"), F.sum("cq").alias("commanders"), F.bool_or("mainboard").alias("main"),
        F.bool_or(F.col("__fact").isNull() & played).alias("missing"),
        F.bool_or(has & ~F.col("is_basic_land") & ~listed("unlimited") & (F.col("cq") + F.col("mq") > limit)).alias("singleton"),
        F.bool_or(has & ~F.coalesce("legal", F.lit(False))).alias("not_legal"),
        F.bool_or(has & listed("banned")).alias("banned"),
        F.bool_or(F.col("command") & listed("banned")).alias("commander_banned"),
        F.bool_or(F.col("companion") & listed("banned_as_companion")).alias("companion_banned"),
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("command") & has, F.col("colors"))))).alias("allowed"),
        F.array_distinct(F.flatten(F.collect_list(F.when(has, F.col("colors"))))).alias("used"),
    )
    d = decks.join(each, "deck_id", "left").join(rules.select("ruleset_version", "required_total", "min_commanders", "max_commanders"), "ruleset_version", "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    none = F.lit(0)
    found = findings(
        (~flag("main"), "legality.mainboard_missing"),
        (~F.coalesce(F.col("commanders"), none).between(F.col("min_commanders"), F.col("max_commanders")), "legality.command_zone_size_invalid"),
        (F.lit(not verified_command_zone), "legality.command_zone_unverified"),
        (F.coalesce(F.col("total"), none) != F.col("required_total"), "legality.deck_size_invalid"),
        (flag("missing"), "legality.card_fact_missing"),
        (flag("singleton"), "legality.singleton_violation"),
        (flag("not_legal"), "legality.card_not_commander_legal"),
        (F.size(F.array_except("used", "allowed")) > 0, "legality.color_identity_violation"),
        (flag("banned"), "legality.banned_card"),
        (flag("commander_banned"), "legality.commander_banned"),
        (flag("companion_banned"), "legality.banned_as_companion"),
    )
    out = d.select("deck_id", F.when(F.col("selection_code").isNotNull(), F.array("selection_code")).otherwise(found).alias("findings"))
    unknown = F.arrays_overlap("findings", F.array(*[F.lit(x) for x in UNKNOWN]))
    return out.withColumn("status", F.when(unknown, "unknown").when(F.size("findings") > 0, "illegal").otherwise("legal"))


def quality(decks: DataFrame) -> DataFrame:
    """decks(deck_id, has_mainboard, resolution_rate, quarantined): findings and status."""
    found = findings((~F.col("has_mainboard"), "quality.mainboard_missing"), (F.coalesce("resolution_rate", F.lit(1.0)) < 1, "quality.card_resolution_incomplete"))
    return decks.select("deck_id", found.alias("findings"), F.when(F.col("quarantined"), "quarantined").when(F.size(found) > 0, "review").otherwise("accepted").alias("status"))


def eligibility(records: DataFrame, statuses: tuple[str, ...] = ("accepted",), legal_only: bool = False, complete: bool = True, resolved: bool = True) -> DataFrame:
    """records(..., complete_decklist, resolution_complete, legal_status, quality_status) with exclusion_code, the first that holds. A null status has not been evaluated."""
    checks = [(~F.col("complete_decklist"), "quality.decklist_incomplete")] if complete else []
    if resolved:
        checks += [(~F.col("resolution_complete"), "resolution.card_unresolved")]
    if legal_only:
        checks += [(F.col("legal_status").isNull(), "legality.evaluation_missing"), (F.col("legal_status") != "legal", "legality.deck_not_eligible")]
    checks += [(F.col("quality_status").isNull(), "quality.evaluation_missing"), (~F.col("quality_status").isin(*statuses), "quality.deck_not_eligible")]
    return records.withColumn("exclusion_code", first_code(*checks))


def exclusion_rollup(records: DataFrame, id_column: str) -> DataFrame:
    return records.where("exclusion_code is not null").groupBy("exclusion_code").agg(F.count("*").alias("n"), F.min(id_column).alias("first_id"))


def complete_pods(entries: DataFrame) -> DataFrame:
    """entries(pod_id, seat, result): pods of two seats or more, each taken once, all with win, loss or draw."""
    pods = entries.groupBy("pod_id").agg(F.count("*").alias("seats"), F.countDistinct("seat").alias("distinct_seats"), F.bool_and(F.coalesce(F.col("result").isin("win", "loss", "draw"), F.lit(False))).alias("known"))
    return pods.where("seats >= 2 and seats = distinct_seats and known").select("pod_id", "seats")


def first_claims(outcomes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row of each structure, the first by order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return outcomes.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def latest_evaluations(evaluations: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of several evaluations of one record the last by order; a max over structs, which is combined before rows are dealt."""
    rest = [c for c in evaluations.columns if c not in (*key, *order)]
    best = evaluations.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("__e"))
    return best.select(*key, *[F.col(f"__e.{c}").alias(c) for c in (*order, *rest)])


def only_context(items: DataFrame, contexts: DataFrame, key: str, value: str) -> DataFrame:
    """items with `value` where just one of contexts has the key; none or several leave a finding."""
    found = contexts.groupBy(key).agg(F.count("*").alias("__n"), F.min(value).alias("__v"))
    rows = items.join(found, key, "left")
    code = F.when(F.col("__n").isNull(), "quality.pod_context_missing").when(F.col("__n") > 1, "quality.event_context_ambiguous")
    return rows.withColumns({value: F.when(F.col("__n") == 1, F.col("__v")), "finding_code": code}).drop("__n", "__v")
