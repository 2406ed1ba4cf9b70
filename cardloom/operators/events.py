"""Pods, event observations and combinations: findings of each, and what is curated or set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import UUID, findings

# Results, states and formats that are known, and the findings that set a record aside.
RESULTS = ("win", "loss", "draw", "bye", "unknown")
POD_STATES = ("complete", "incomplete", "cancelled", "unknown")
FORMATS = ("commander", "edh", "cedh", "c-edh")
ROLES = ("required", "commander", "enabler")
POD_BLOCKING = ("quality.pod_not_multiplayer", "quality.pod_seat_missing", "quality.pod_seat_duplicate", "quality.pod_deck_unresolved", "quality.pod_status_unknown", "quality.pod_source_not_complete", "quality.pod_result_ambiguous")
OBSERVATION_BLOCKING = ("quality.event_id_mismatch", "quality.event_evidence_mismatch", "quality.event_format_unknown", "quality.non_commander_event", "quality.observation_time_missing", "quality.canonical_deck_missing", "quality.result_semantics_missing", "quality.aggregate_record_incomplete")
COMBO_BLOCKING = ("quality.combo_required_cards_missing", "quality.combo_requirements_missing", "quality.combo_results_missing", "quality.combo_card_invalid", "quality.combo_commander_id_invalid")


def quoted(c: Column) -> Column:
    """Percent-encoded but for letters, digits and -._~"""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def scoped_id(kind: str, source: Column, value: Column) -> Column:
    """kind:source:value, each part quoted, so no value can look like two parts."""
    return F.concat_ws(":", F.lit(kind), quoted(source), quoted(value))


def participant(source: Column, event: Column, opaque: Column, name: Column, keep_opaque: bool = False) -> Column:
    """struct(reference_id, scope, findings): the source's own id if it may be kept, else a hash of the folded name within the event; no name is returned."""
    folded = F.nullif(F.trim(F.regexp_replace(F.lower(name), r"\s+", " ")), F.lit(""))
    text = F.to_json(F.array(F.lit("event"), scoped_id("event", source, event), folded))
    by_name = F.when(folded.isNotNull() & event.isNotNull(), F.concat(F.lit("event:"), F.left(F.sha2(text, 256), F.lit(32))))
    kept = F.when(opaque.isNotNull(), scoped_id("participant", source, opaque)) if keep_opaque else F.lit(None).cast("string")
    codes = findings((kept.isNull() & opaque.isNotNull(), "quality.participant_source_id_not_retained"), (kept.isNull() & by_name.isNull(), "quality.participant_missing"))
    return F.struct(F.coalesce(kept, by_name).alias("reference_id"), F.when(kept.isNotNull(), "source").when(by_name.isNotNull(), "event").otherwise("none").alias("scope"), codes.alias("findings"))


def curated(df: DataFrame, blocking: tuple[str, ...]) -> DataFrame:
    """df(findings) with status: QUARANTINED where a finding blocks."""
    return df.withColumn("status", F.when(F.arrays_overlap("findings", F.array(*[F.lit(x) for x in blocking])), "QUARANTINED").otherwise("CURATED"))


def pods(tables: DataFrame, members: DataFrame) -> DataFrame:
    """pod_id, members, findings, status for each of tables(pod_id, source_status).

    members(pod_id, seat, canonical_deck_id, result, points, placement, participant_findings array). One member's finding
    is the pod's; the members of a pod are added up, never listed.
    """
    some = lambda c: F.bool_or(F.coalesce(c, F.lit(False)))
    found = members.groupBy("pod_id").agg(
        F.count("*").alias("members"), some(F.col("seat").isNull() | (F.col("seat") < 1)).alias("seat_missing"), F.count_distinct("seat").alias("seats"),
        some(F.col("canonical_deck_id").isNull()).alias("no_deck"), some(F.col("result").isNull() | ~F.col("result").isin(*RESULTS)).alias("ambiguous"),
        some(F.isnan("points") | (F.abs("points") == float("inf"))).alias("points"), some(F.col("placement") < 1).alias("placement"),
        F.array_distinct(F.flatten(F.collect_set("participant_findings"))).alias("people"),
    )
    d = tables.join(found, "pod_id", "left").withColumn("members", F.coalesce("members", F.lit(0)))
    state = F.lower(F.trim("source_status"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    own = findings(
        (F.col("members") < 2, "quality.pod_not_multiplayer"), (flag("seat_missing"), "quality.pod_seat_missing"),
        (~flag("seat_missing") & (F.col("seats") < F.col("members")), "quality.pod_seat_duplicate"), (flag("no_deck"), "quality.pod_deck_unresolved"),
        (state.isNull() | ~state.isin(*POD_STATES), "quality.pod_status_unknown"), (state.isin("incomplete", "cancelled"), "quality.pod_source_not_complete"),
        (flag("ambiguous"), "quality.pod_result_ambiguous"), (flag("points"), "quality.pod_points_invalid"), (flag("placement"), "quality.pod_placement_invalid"),
    )
    every = F.array_sort(F.array_union(own, F.coalesce("people", F.array().cast("array<string>"))))
    return curated(d.select("pod_id", "members", every.alias("findings")), POD_BLOCKING)


def observations(standings: DataFrame, events: DataFrame) -> DataFrame:
    """observation_id, findings, status for each of standings(observation_id, event_id, source_id, source_snapshot_id,
    canonical_deck_id, observed_at, wins, losses, draws, semantics, participant_findings array) with its events(event_id,
    source_id, source_snapshot_id, format, observed_at). A standing without its event is a mismatch."""
    e = events.select("event_id", F.col("source_id").alias("e_source"), F.col("source_snapshot_id").alias("e_snapshot"), "format", F.col("observed_at").alias("e_at"), F.lit(True).alias("e_there"))
    d = standings.join(e, "event_id", "left")
    there = F.col("e_there").isNotNull()
    own = findings(
        (~there, "quality.event_id_mismatch"),
        (there & ~(F.col("e_source").eqNullSafe(F.col("source_id")) & F.col("e_snapshot").eqNullSafe(F.col("source_snapshot_id"))), "quality.event_evidence_mismatch"),
        (F.col("format").isNull(), "quality.event_format_unknown"), (~F.lower(F.trim("format")).isin(*FORMATS), "quality.non_commander_event"),
        (F.coalesce("observed_at", "e_at").isNull(), "quality.observation_time_missing"), (F.col("canonical_deck_id").isNull(), "quality.canonical_deck_missing"),
        (F.col("semantics").isNull(), "quality.result_semantics_missing"), (F.col("wins").isNull() | F.col("losses").isNull() | F.col("draws").isNull(), "quality.aggregate_record_incomplete"),
    )
    every = F.array_sort(F.array_union(own, F.coalesce("participant_findings", F.array().cast("array<string>"))))
    return curated(d.select("observation_id", every.alias("findings")), OBSERVATION_BLOCKING)


def combo_cards(cards: DataFrame) -> DataFrame:
    """cards(combo_id, oracle_id, role, quantity) summed by (combo_id, oracle_id, role); bad ids and quantities are left out."""
    good = F.coalesce(F.col("oracle_id").rlike(UUID) & (F.col("quantity") >= 1), F.lit(False))
    return cards.where(good).groupBy("combo_id", F.lower("oracle_id").alias("oracle_id"), "role").agg(F.sum("quantity").cast("long").alias("quantity"))


def combos(records: DataFrame, cards: DataFrame) -> DataFrame:
    """combo_id, required, optional, findings, status for each of records(combo_id, requirements, results arrays, compatible
    boolean, commanders array) with its cards(combo_id, oracle_id, role, quantity)."""
    good = F.coalesce(F.col("oracle_id").rlike(UUID) & (F.col("quantity") >= 1), F.lit(False))
    held = lambda *roles: F.array_sort(F.collect_set(F.when(good & F.col("role").isin(*roles), F.lower("oracle_id"))))
    found = cards.groupBy("combo_id").agg(held(*ROLES).alias("required"), held("optional").alias("optional"), F.bool_or(~good).alias("invalid"))
    d = records.join(found, "combo_id", "left")
    none = F.array().cast("array<string>")
    size = lambda c: F.size(F.coalesce(F.col(c), none))
    yes, has = F.col("compatible"), size("commanders") > 0
    bad = F.exists(F.coalesce("commanders", none), lambda x: F.coalesce(~x.rlike(UUID), F.lit(True)))
    own = findings(
        (F.coalesce(~yes, F.lit(False)) & has, "quality.combo_compatibility_conflict"), (yes.isNull() & has, "quality.combo_compatibility_unresolved"),
        (F.coalesce(yes, F.lit(False)) & bad, "quality.combo_commander_id_invalid"), (F.coalesce(yes, F.lit(False)) & ~has, "quality.combo_compatibility_unscoped"),
        (size("required") == 0, "quality.combo_required_cards_missing"), (size("requirements") == 0, "quality.combo_requirements_missing"),
        (size("results") == 0, "quality.combo_results_missing"), (F.coalesce("invalid", F.lit(False)), "quality.combo_card_invalid"),
    )
    return curated(d.select("combo_id", F.coalesce("required", none).alias("required"), F.coalesce("optional", none).alias("optional"), own.alias("findings")), COMBO_BLOCKING)
