import datetime
import hashlib
import urllib.parse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardloom.functions import scalars
from cardloom.operators import decks, events, graph, reports, resolution, rules, splits

A, B, C, D, E_ = ("11111111-1111-4111-8111-111111111111", "22222222-2222-4222-8222-222222222222", "33333333-3333-4333-8333-333333333333", "44444444-4444-4444-8444-444444444444", "55555555-5555-4555-8555-555555555555")


def cards(spark, rows):
    return spark.createDataFrame(rows, "deck_id string, zone string, oracle_id string, quantity int")


def test_fingerprint_golden(spark):
    got = decks.fingerprint(cards(spark, [("d", "command", A, 1), ("d", "mainboard", B, 1)])).first()
    assert got.fingerprint == "a15de215dbd5b7f2295fb2d1836519dd0c4b27ec7e40cf140cbd205641f44625"


def test_fingerprint_ignores_case_and_order(spark):
    one = [("d", "command", A, 1), ("d", "mainboard", B, 2), ("d", "mainboard", C, 1)]
    two = [("e", "mainboard", C.upper(), 1), ("e", "command", A, 1), ("e", "mainboard", B, 2)]
    assert decks.fingerprint(cards(spark, one + two)).select("fingerprint").distinct().count() == 1


def test_exact_and_revision_groups(spark):
    rows = spark.createDataFrame([("f", "s1"), ("f", "s2"), ("g", "s1")], "fingerprint string, source_id string")
    got = decks.exact_groups(rows).collect()
    assert [(r.fingerprint, r.occurrences, r.cross_source) for r in got] == [("f", 2, True)]
    t = datetime.datetime
    rows = spark.createDataFrame([("s1", "x", 1, t(2024, 1, 2), "b"), ("s1", "x", 2, t(2024, 1, 1), "a"), ("s1", "x", 4, None, "a"), ("s2", "x", 3, None, "a")], "source_id string, source_deck_id string, deck_id long, observed_at timestamp_ntz, source_snapshot_id string")
    assert [r.deck_ids for r in decks.revision_groups(rows).collect()] == [[4, 2, 1]]


def test_near_duplicates(spark):
    rows = cards(spark, [("x", "command", A, 1), *[("x", "mainboard", i, 1) for i in (B, C, D)], ("y", "command", A, 1), *[("y", "mainboard", i, 1) for i in (B, C, E_)]])
    assert [round(r.similarity, 9) for r in decks.near_duplicate_pairs(rows, 0.55).collect()] == [0.6]
    prints = sorted(r.fingerprint for r in decks.fingerprint(rows).collect())
    got = decks.near_duplicate_clusters(rows, 0.55).first()
    body = f'{{"algorithm":"quantity_weighted_jaccard","canonical_deck_ids":["{prints[0]}","{prints[1]}"],"threshold":0.55,"version":"near-duplicate-v1"}}'
    assert (got.component, got.canonical_deck_ids, got.cluster_id) == ("x", prints, "near-" + hashlib.sha256(body.encode()).hexdigest()[:32])
    assert decks.near_duplicate_clusters(rows, 0.92).count() == 0
    same = rows.union(rows.where("deck_id = 'x'").withColumn("deck_id", F.explode(F.array(*[F.lit(f"x{i}") for i in range(50)]))))
    assert [(r.left_id, r.right_id) for r in decks.near_duplicate_pairs(same, 0.55).collect()] == [("x", "y")]  # equal decks make no pairs


def test_cooccurrence(spark):
    rows = cards(spark, [("d", "command", A, 1), ("d", "mainboard", B, 1), ("d", "mainboard", C, 1)])
    assert decks.cooccurrence(rows).count() == 3


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, edges):
    root = {i: i for e in edges for i in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root}


def test_promotion(spark):
    records = spark.createDataFrame([(1, "train"), (2, "train"), (3, "test"), (4, "validation"), (5, "train")], "record_id long, split string")
    groups = spark.createDataFrame([(1, "g"), (2, "g"), (2, "h"), (3, "h"), (4, "i")], "record_id long, group_id string")
    out = splits.promote(records, groups)
    assert {r.record_id: r.split for r in out.collect()} == {1: "test", 2: "test", 3: "test", 4: "validation", 5: "train"}
    assert splits.leakage(groups, records).count() == 1 and splits.leakage(groups, out).count() == 0


def test_tournament(spark):
    t = lambda y: datetime.datetime(y, 1, 1)
    rows = [(1, "e", t(2024), "A", True, True), (2, "f", t(2026), "A", True, True), (3, "f", t(2026), "B", True, True), (4, "g", t(2024), "A", False, True), (5, "g", t(2024), "B", True, True)]
    df = spark.createDataFrame(rows, "record_id long, event_id string, observed_at timestamp_ntz, deck_id string, complete_event boolean, complete_decklist boolean")
    got = {r.record_id: (r.split, r.stratum, r.exclusion_code) for r in splits.tournament(df, "2025-01-01", "2025-06-01").collect()}
    assert got[1] == ("train", "familiar", None) and got[2][:2] == ("test", "familiar") and got[3][:2] == ("test", "unseen")
    assert got[4][2] == got[5][2] == "quality.event_incomplete"


def test_ruleset(spark):
    d = datetime.date
    sets = spark.createDataFrame([("a", d(2020, 1, 1), d(2021, 1, 1)), ("b", d(2020, 6, 1), None), ("c", d(2022, 1, 1), None), ("d", d(2022, 1, 1), None)], "ruleset_version string, effective_from date, effective_until date")
    rows = spark.createDataFrame([(1, datetime.datetime(2019, 1, 1)), (2, datetime.datetime(2020, 7, 1)), (3, datetime.datetime(2023, 1, 1))], "deck_id long, observed_at timestamp_ntz")
    got = {r.deck_id: (r.ruleset_version, r.selection_code) for r in rules.applicable_ruleset(rows, sets).collect()}
    assert got == {1: (None, "legality.ruleset_unresolved"), 2: ("b", None), 3: (None, "legality.ruleset_ambiguous")}


SETS = "ruleset_version string, required_total int, copy_limit int, min_commanders int, max_commanders int, banned array<string>, banned_as_companion array<string>, unlimited array<string>, overrides map<string,int>"


def test_legality_by_ruleset(spark):
    """Each deck is judged by its own ruleset's lists; what isn't known beats what is illegal."""
    facts = spark.createDataFrame([(A, ["W"], True, False), (B, ["W"], True, False), (C, ["U"], False, False), (D, [], True, True)], "oracle_id string, colors array<string>, legal boolean, is_basic_land boolean")
    sets = spark.createDataFrame([("r1", 4, 1, 1, 1, [], [B], [], {}), ("r2", 4, 1, 1, 1, [A], [], [B], {}), ("r3", 4, 1, 2, 2, [], [], [], {B: 3})], SETS)
    base = lambda d: [(d, "command", A, 1), (d, "mainboard", B, 3)]
    rows = base("d1") + [("d1", "companion", B, 1)] + base("d2") + base("d3") + [("d4", "command", A, 1), ("d4", "mainboard", C, 1), ("d4", "mainboard", D, 2), ("d4", "sideboard", E_, 9)] + [("d5", "command", A, 1), ("d5", "mainboard", E_, 9)] + [("d6", "command", A, 4)]
    chosen = spark.createDataFrame([("d1", "r1", None), ("d2", "r2", None), ("d3", "r3", None), ("d4", "r1", None), ("d5", "r1", None), ("d6", "r1", None), ("d7", None, "legality.ruleset_ambiguous"), ("d8", "r1", None)], "deck_id string, ruleset_version string, selection_code string")
    got = {r.deck_id: (r.status, r.findings) for r in rules.legality(chosen, cards(spark, rows), facts, sets, True).collect()}
    code = lambda *xs: [f"legality.{x}" for x in xs]
    assert got == {
        "d1": ("illegal", code("banned_as_companion", "singleton_violation")), "d2": ("illegal", code("banned_card", "commander_banned")), "d3": ("illegal", code("command_zone_size_invalid")),
        "d4": ("illegal", code("card_not_commander_legal", "color_identity_violation")), "d5": ("unknown", code("card_fact_missing", "deck_size_invalid")),
        "d6": ("illegal", code("command_zone_size_invalid", "mainboard_missing", "singleton_violation")), "d7": ("unknown", code("ruleset_ambiguous")), "d8": ("illegal", code("command_zone_size_invalid", "deck_size_invalid", "mainboard_missing")),
    }
    assert rules.legality(chosen.where("deck_id = 'd3'"), cards(spark, rows), facts, sets).first().status == "unknown"


def test_eligibility_codes(spark):
    rows = [(1, False, True, "legal", "accepted"), (2, True, False, "legal", "accepted"), (3, True, True, None, "accepted"), (4, True, True, "illegal", "accepted"), (5, True, True, "legal", None), (6, True, True, "legal", "review"), (7, True, True, "legal", "accepted")]
    df = spark.createDataFrame(rows, "id long, complete_decklist boolean, resolution_complete boolean, legal_status string, quality_status string")
    got = {r.id: r.exclusion_code for r in rules.eligibility(df, legal_only=True).collect()}
    assert got == {1: "quality.decklist_incomplete", 2: "resolution.card_unresolved", 3: "legality.evaluation_missing", 4: "legality.deck_not_eligible", 5: "quality.evaluation_missing", 6: "quality.deck_not_eligible", 7: None}
    assert {r.id: r.exclusion_code for r in rules.eligibility(df, complete=False, resolved=False).collect()} == {1: None, 2: None, 3: None, 4: None, 5: "quality.evaluation_missing", 6: "quality.deck_not_eligible", 7: None}


def test_recommended_use(spark):
    rows = [("a", 5, 1, 3, 9, 9), ("b", 5, 1, 3, 9, 9), ("c", 5, 0, 3, 9, 9), ("d", 5, 0, 3, 8, 9), ("e", 0, 9, 0, 0, 0), ("f", 0, 0, 2, 0, 0)]
    df = spark.createDataFrame(rows, "source_id string, usable_outcomes long, full_pods long, complete_decks long, resolved_cards long, cards long")
    got = {r.source_id: r.recommended_use for r in reports.recommended_use(df, ["a"]).collect()}
    assert got == {"a": "research_only", "b": "performance_modeling_candidate", "c": "deck_completion_training_candidate", "d": "deck_completion_training_conditional", "e": "audit_only", "f": "deck_completion_training_conditional"}


def test_resolution_cascade(spark):
    ident = "struct<priority:int,name:string,value:string>"
    items = [
        ("both", "Sol Ring", [(0, "uuid", "u1"), (1, "oracleId", "o1")]), ("conflict", "Sol Ring", [(0, "uuid", "u1"), (1, "oracleId", "o2")]), ("printings", "x", [(0, "uuid", "u1"), (1, "setId", "u9")]),
        ("unknown id", "ＳＯＬ  ring", [(0, "uuid", "no")]), ("agree", "Fire", []), ("differ", "Ice", []), ("face", "Ember", []), ("alias", "Solly", []), ("dangling", "Ghost", []), ("two", "Twin", []), ("none", "zzz", []), ("null", None, None),
    ]
    items = spark.createDataFrame(items, f"item_id string, value string, identifiers array<{ident}>")
    kind = "name string, oracle_id string, printing_id string, face_id string"
    ids = spark.createDataFrame([("uuid", "u1", "o1", "p1", None), ("oracleId", "o1", "o1", None, None), ("oracleId", "o2", "o2", None, None), ("setId", "u9", "o1", "p9", None)], "name string, value string, oracle_id string, printing_id string, face_id string")
    names = spark.createDataFrame([("Sol Ring", "o1", None, None), ("Fire", "o3", None, None), ("Ice", "o4", None, None), ("twin", "o5", None, None), ("TWIN", "o6", None, None)], kind)
    faces = spark.createDataFrame([("Fire", "o3", None, None), ("ice", "o3", None, None), ("Ember", "o3", None, "f1")], kind)
    aliases = spark.createDataFrame([("solly", "o1", None, None), ("Ghost", "o99", None, None)], kind)
    got = {r.item_id: tuple(r)[1:] for r in resolution.resolve(items, ids, names, faces, aliases).collect()}
    assert got == {
        "both": ("source_identifier", "resolved", "o1", "p1", None, 1, None), "conflict": ("source_identifier", "ambiguous", None, None, None, 2, "resolution.conflicting_identifiers"),
        "printings": ("source_identifier", "ambiguous", None, None, None, 2, "resolution.conflicting_identifiers"), "unknown id": ("exact_name", "resolved", "o1", None, None, 1, None),
        "agree": ("exact_name", "resolved", "o3", None, None, 1, None), "differ": ("exact_name", "ambiguous", None, None, None, 2, "resolution.ambiguous_name"), "face": ("split_face", "resolved", "o3", None, "f1", 1, None),
        "alias": ("alias", "resolved", "o1", None, None, 1, None), "dangling": ("alias", "unresolved", None, None, None, 0, "resolution.alias_target_unresolved"),
        "two": ("exact_name", "ambiguous", None, None, None, 2, "resolution.ambiguous_name"), "none": ("none", "unresolved", None, None, None, 0, "resolution.unresolved_name"), "null": ("none", "unresolved", None, None, None, 0, "resolution.unresolved_name"),
    }


def test_pod_findings(spark):
    tables = spark.createDataFrame([("ok", "Complete "), ("alone", "complete"), ("bad", None), ("off", "cancelled"), ("empty", "complete")], "pod_id string, source_status string")
    none, lost = [], ["quality.participant_missing"]
    rows = [("ok", 1, "d", "win", 3.0, 1, none), ("ok", 2, "e", "loss", None, None, lost), ("alone", 1, "d", "win", None, None, none), ("bad", 1, None, "hm", float("inf"), 0, none), ("bad", 1, "e", "win", None, None, none), ("off", None, "d", "bye", None, None, none), ("off", 2, "e", "draw", None, None, none)]
    members = spark.createDataFrame(rows, "pod_id string, seat long, canonical_deck_id string, result string, points double, placement long, participant_findings array<string>")
    got = {r.pod_id: (r.status, [x.removeprefix("quality.") for x in r.findings]) for r in events.pods(tables, members).collect()}
    assert got == {
        "ok": ("CURATED", ["participant_missing"]), "alone": ("QUARANTINED", ["pod_not_multiplayer"]), "off": ("QUARANTINED", ["pod_seat_missing", "pod_source_not_complete"]), "empty": ("QUARANTINED", ["pod_not_multiplayer"]),
        "bad": ("QUARANTINED", ["pod_deck_unresolved", "pod_placement_invalid", "pod_points_invalid", "pod_result_ambiguous", "pod_seat_duplicate", "pod_status_unknown"]),
    }


def test_scoped_ids(spark):
    got = spark.createDataFrame([("a b", "x:y/é~*"), ("a%20b", "-._~")], "s string, v string").select(events.scoped_id("event", F.col("s"), F.col("v")).alias("i")).collect()
    want = [":".join(urllib.parse.quote(x, safe="-._~") for x in ("event", s, v)) for s, v in (("a b", "x:y/é~*"), ("a%20b", "-._~"))]
    assert [r.i for r in got] == want


def test_participants(spark):
    rows = spark.createDataFrame([("s", "e1", "p1", " Ann  B"), ("s", "e2", None, "ann b"), ("s", None, None, "ann"), ("s", "e1", None, "ANN b")], "s string, e string, o string, n string")
    got = [r.p for r in rows.select(events.participant(F.col("s"), F.col("e"), F.col("o"), F.col("n")).alias("p")).collect()]
    assert got[0].reference_id == got[3].reference_id != got[1].reference_id and got[0].findings == ["quality.participant_source_id_not_retained"]
    assert (got[2].reference_id, got[2].scope, got[2].findings) == (None, "none", ["quality.participant_missing"])
    kept = rows.select(events.participant(F.col("s"), F.col("e"), F.col("o"), F.col("n"), True).alias("p")).first().p
    assert (kept.reference_id, kept.scope, kept.findings) == ("participant:s:p1", "source", [])


def test_pod_results(spark):
    rows = spark.createDataFrame([("first", "a", "a", 1), (None, "a", "a", 1), ("Unknown", "b", "a", 1), (None, "a", "a", 2), ("hm", "a", "a", 1), ("second", "b", "b", 1)], "r string, p string, w string, n int")
    got = [r.x for r in rows.select(scalars.pod_result(F.col("r"), F.col("p"), F.col("w"), F.col("n")).alias("x")).collect()]
    assert got == ["win", "win", "loss", "unknown", "ambiguous", "loss"]


def test_combos(spark):
    records = spark.createDataFrame([("ok", ["r"], ["x"], True, [A]), ("bare", [], None, None, []), ("conflict", ["r"], ["x"], False, [A]), ("bad", ["r"], ["x"], True, ["no"])], "combo_id string, requirements array<string>, results array<string>, compatible boolean, commanders array<string>")
    held = spark.createDataFrame([("ok", A, "required", 1), ("ok", A.upper(), "required", 2), ("ok", B, "optional", 1), ("conflict", A, "enabler", 1), ("bad", A, "required", 0), ("bad", B, "commander", 1)], "combo_id string, oracle_id string, role string, quantity int")
    got = {r.combo_id: (r.status, r.required, [x.removeprefix("quality.combo_") for x in r.findings]) for r in events.combos(records, held).collect()}
    assert got == {
        "ok": ("CURATED", [A], []), "bare": ("QUARANTINED", [], ["required_cards_missing", "requirements_missing", "results_missing"]),
        "conflict": ("CURATED", [A], ["compatibility_conflict"]), "bad": ("QUARANTINED", [B], ["card_invalid", "commander_id_invalid"]),
    }
    assert sorted(tuple(r) for r in events.combo_cards(held).where("combo_id = 'ok'").collect()) == [("ok", A, "required", 3), ("ok", B, "optional", 1)]


def test_benchmark_groups(spark):
    rows = cards(spark, [("x", "command", A, 1), ("x", "mainboard", B, 1), ("y", "command", A, 1), ("y", "mainboard", C, 1), ("z", "mainboard", C, 1)])
    prints = spark.createDataFrame([("x", "f1"), ("y", "f2"), ("z", "f3")], "deck_id string, fingerprint string")
    got = {(r.deck_id, r.benchmark): r.group_id for r in splits.benchmark_groups(rows, prints, 2).collect()}
    zone = "command-zone-" + hashlib.sha256(f'[["{A}",1]]'.encode()).hexdigest()[:32]
    assert got["x", "cold_command_zone"] == got["y", "cold_command_zone"] == zone != got["z", "cold_command_zone"]
    assert got["x", "cold_fingerprint"] == "fingerprint:f1" and got["z", "cold_commander"] == "commander:missing" and got["y", "low_data_commander"] == f"low-data-commander:{A}"
    assert splits.benchmark_groups(rows, prints, 1).where("benchmark = 'low_data_commander'").count() == 0


def test_names(spark):
    items = spark.createDataFrame([("1", " Sol  RING"), ("2", "Fire"), ("3", "Twin"), ("4", "no")], "item_id string, value string")
    names = spark.createDataFrame([("Sol Ring", A), ("Twin", B), ("twin", C)], "name string, oracle_id string")
    faces = spark.createDataFrame([("fire", D)], "name string, oracle_id string")
    got = {r.item_id: (r.method, r.status, r.oracle_id) for r in resolution.by_name(items, names, faces).collect()}
    assert got == {"1": ("exact_name", "resolved", A), "2": ("split_face", "resolved", D), "3": ("exact_name", "ambiguous", None), "4": (None, "unresolved", None)}


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.decklist(F.lit("1 Sol Ring\n2 Island")).alias("good"), scalars.decklist(F.lit("1 Sol Ring\nIsland")).alias("bad"),
        scalars.mode(F.lit(" cEDH ")).alias("m"), scalars.mode(F.lit("tournament"), True).alias("t"), scalars.mode(F.lit(None).cast("string")).alias("u"),
        scalars.pod_result(F.lit("Winner")).alias("r"), scalars.pod_result(F.lit("hm")).alias("a"), scalars.placement(F.lit("third")).alias("p"),
        scalars.event_time(F.lit("1700000000")).alias("s"), scalars.event_time(F.lit("1700000000000")).alias("ms"),
        scalars.type_line(F.lit("Legendary Creature — Elf Druid")).alias("type"), scalars.name_key_any(F.lit("ＳＴＲＡßＥ  x")).alias("n"),
    ).first()
    assert [tuple(x) for x in row.good] == [(1, "Sol Ring"), (2, "Island")] and row.bad is None
    assert (row.m, row.t, row.u, row.r, row.a, row.p) == ("competitive", "competitive", "unknown", "win", "ambiguous", 3)
    assert row.s == row.ms and row.n == "strasse x"
    assert (row.type.supertypes, row.type.types, row.type.subtypes) == (["Legendary"], ["Creature"], ["Elf", "Druid"])


def test_ranking(spark):
    rows = spark.createDataFrame([("e", 3.0, "a", True), ("e", 2.0, "b", False), ("e", 1.0, "c", True)], "example_id string, score double, item_id string, relevant boolean")
    got = reports.ranking_metrics(rows, 2).first()
    assert (got.recall, got.reciprocal_rank) == (0.5, 1.0) and got.ndcg == pytest.approx(1 / (1 + 0.6309297535714575), abs=1e-9)


def test_pods(spark):
    rows = spark.createDataFrame([("p", 1, "win"), ("p", 2, "loss"), ("q", 1, "win"), ("q", 1, "loss"), ("r", 1, "win"), ("r", 2, None)], "pod_id string, seat int, result string")
    assert [r.pod_id for r in rules.complete_pods(rows).collect()] == ["p"]
