"""The operators over the driver's tables: an order is a deck, a part a card, an event hour a pod, a day a tournament."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.storage import forget, written
from ..operators import catalog, datasets, decks, events, reports, resolution, rules, splits

TRAIN_UNTIL, VALIDATION_UNTIL = "1999-01-01", "2000-07-01"
NEAR = 0.6


def t(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def deck_cards(spark, d) -> DataFrame:
    """Lines summed by (order, part); the least part of an order is its command zone. Lines are dealt by order once, for whatever is asked of whole decks."""
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("deck_id"), F.col("l_partkey").alias("oracle_id"), F.col("l_quantity").cast("int").alias("quantity"))
    cards = lines.repartition("deck_id").groupBy("deck_id", "oracle_id").agg(F.sum("quantity").alias("quantity"))
    first = F.min("oracle_id").over(Window.partitionBy("deck_id"))
    return cards.select("deck_id", F.when(F.col("oracle_id") == first, "command").otherwise("mainboard").alias("zone"), "oracle_id", "quantity")


def occurrences(spark, d) -> DataFrame:
    return t(spark, d, "orders").select(F.col("o_orderkey").alias("deck_id"), F.col("o_orderpriority").alias("source_id"), F.col("o_custkey").alias("source_deck_id"), F.col("o_orderdate").alias("observed_at"))


def printed(spark, d) -> DataFrame:
    return occurrences(spark, d).join(decks.fingerprint(deck_cards(spark, d)), "deck_id")


def q_exact(spark, d):
    return decks.exact_groups(printed(spark, d)).select("fingerprint", "occurrences", F.concat_ws(",", "sources").alias("sources"), "cross_source")


def q_revision(spark, d):
    out = decks.revision_groups(occurrences(spark, d))
    return out.select("group_id", "source_id", "source_deck_id", F.concat_ws(",", F.transform("deck_ids", lambda x: x.cast("string"))).alias("deck_ids"))


def q_near_pairs(spark, d):
    return decks.near_duplicate_pairs(deck_cards(spark, d), NEAR).withColumn("similarity", F.round("similarity", 9))


def q_near_clusters(spark, d):
    return decks.near_duplicate_clusters(deck_cards(spark, d), NEAR).select("cluster_id", F.col("component").alias("first_id"), F.concat_ws(",", "canonical_deck_ids").alias("canonical_deck_ids"))


def memberships(spark, d, every=False) -> DataFrame:
    """Exact, revision and near groups of the orders, written once: several steps read them. Exact groups of one, which link
    nothing, are there if `every` is true. Ids are bytes, a kind and a hash; named() gives their text, in the same order."""
    kind = lambda k, c: F.concat(F.lit(bytes([k])), F.unhex(c)).alias("group_id")
    near = written(decks.near_duplicate_clusters(deck_cards(spark, d), NEAR).select(F.explode("canonical_deck_ids").alias("fingerprint"), "cluster_id"), "near-groups")
    near = near.select(F.unhex("fingerprint").alias("print"), kind(1, F.substring_index("cluster_id", "-", -1)))
    prints = written(occurrences(spark, d).select("deck_id").join(decks.fingerprint(deck_cards(spark, d)), "deck_id").select(F.col("deck_id").alias("record_id"), F.unhex("fingerprint").alias("print")), "prints")
    shared = prints if every else prints.join(prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1"), "print", "left_semi")
    exact = shared.select("record_id", F.concat(F.lit(bytes([0])), "print").alias("group_id"))
    revision = decks.revision_groups(occurrences(spark, d)).select(F.explode("deck_ids").alias("record_id"), kind(2, F.substring_index("group_id", "-", -1)))
    out = written(exact.union(revision).union(prints.join(near, "print").select("record_id", "group_id")), "memberships")
    forget(prints)
    return out


def named(group_id) -> Column:
    text = F.lower(F.hex(group_id))
    kinds = F.array(*[F.lit(x) for x in ("exact:", "near:near-", "revision:revision-")])
    return F.concat(F.element_at(kinds, F.substring(text, 1, 2).cast("int") + 1), F.substring(text, 3, 1 << 20))


def q_provisional(spark, d):
    return occurrences(spark, d).select(F.col("deck_id").alias("record_id"), splits.provisional(F.col("observed_at"), TRAIN_UNTIL, VALIDATION_UNTIL).alias("split"))


def q_promoted(spark, d, groups=None):
    return splits.promote(q_provisional(spark, d), groups if groups is not None else memberships(spark, d))


def q_split_counts(spark, d):
    return q_promoted(spark, d).groupBy("provisional_split", "split").agg(F.count("*").alias("n"))


def q_leakage(spark, d):
    """Groups that the provisional splits would tear apart."""
    return splits.leakage(memberships(spark, d), q_provisional(spark, d)).select(named("group_id").alias("group_id"), F.concat_ws(",", "splits").alias("splits"))


def q_leakage_after(spark, d):
    """The same over promoted splits: none."""
    groups = memberships(spark, d)
    return splits.leakage(groups, written(q_promoted(spark, d, groups), "promoted")).select(named("group_id").alias("group_id"), F.concat_ws(",", "splits").alias("splits"))


def entries(spark, d) -> DataFrame:
    """Seats of hourly pods."""
    e = t(spark, d, "events").select("event_id", F.date_trunc("hour", "ts").alias("pod_id"), F.col("user_id").alias("seat"), "event_type", F.col("ts"))
    result = F.when(F.col("event_type") == "purchase", "win").when(F.col("event_type") == "error", "unknown").when(F.col("event_type") == "view", "draw").otherwise("loss")
    return e.withColumn("result", result)


def q_complete_pods(spark, d):
    return rules.complete_pods(entries(spark, d)).withColumn("pod_id", F.date_format("pod_id", "yyyy-MM-dd HH"))


def q_tournament(spark, d):
    o = t(spark, d, "orders")
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("has", F.lit(True))
    records = o.join(lines, "o_orderkey", "left").select(F.col("o_orderkey").alias("record_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_id"), F.col("o_orderdate").alias("observed_at"), F.col("o_custkey").alias("deck_id"), (F.col("o_totalprice") > 2000).alias("complete_event"), F.col("has").isNotNull().alias("complete_decklist"))
    return splits.tournament(records, TRAIN_UNTIL, VALIDATION_UNTIL)


def rulesets(spark) -> DataFrame:
    day = datetime.date
    return spark.createDataFrame([("r1", day(1995, 6, 1), day(1997, 1, 1)), ("r2", day(1996, 6, 1), day(1999, 1, 1)), ("r3", day(1999, 1, 1), None), ("r4", day(2000, 1, 1), None), ("r4b", day(2000, 1, 1), day(2000, 7, 1))], "ruleset_version string, effective_from date, effective_until date")


def ruleset_lists(spark, d) -> DataFrame:
    """What each ruleset asks; the lists name parts by key, as many for any size of the tables."""
    rows = [("r1", 100, 40, 1, 20, [3, 7, 11], [5, 50], [2], {4: 10}), ("r2", 120, 30, 1, 30, [7, 13], [], [], {}), ("r3", 100, 45, 1, 50, [], [50], [1, 2, 3], {5: 50}), ("r4", 80, 20, 5, 25, [1, 2], [], [], {}), ("r4b", 90, 20, 1, 25, [4], [9], [6], {8: 5})]
    return spark.createDataFrame(rows, "ruleset_version string, required_total int, copy_limit int, min_commanders int, max_commanders int, banned array<long>, banned_as_companion array<long>, unlimited array<long>, overrides map<long,int>")


def q_ruleset(spark, d):
    return rules.applicable_ruleset(occurrences(spark, d).select("deck_id", "observed_at"), rulesets(spark)).select("deck_id", "ruleset_version", "selection_code")


def facts(spark, d) -> DataFrame:
    return t(spark, d, "part").select(F.col("p_partkey").alias("oracle_id"), F.array(F.col("p_type")).alias("colors"), (F.col("p_size") > 2).alias("legal"), (F.col("p_size") == 50).alias("is_basic_land"))


def q_legality(spark, d):
    """The greatest part of an order is also its companion."""
    cards = deck_cards(spark, d)
    companions = cards.groupBy("deck_id").agg(F.lit("companion").alias("zone"), F.max("oracle_id").alias("oracle_id"), F.lit(1).cast("long").alias("quantity"))
    out = rules.legality(q_ruleset(spark, d), cards.union(companions), facts(spark, d), ruleset_lists(spark, d), verified_command_zone=True)
    return out.select("deck_id", F.concat_ws(",", "findings").alias("findings"), "status")


def q_legality_counts(spark, d):
    return q_legality(spark, d).groupBy("status").agg(F.count("*").alias("n"))


def graded(spark, d) -> DataFrame:
    lines = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("deck_id")).agg(F.avg((F.col("l_returnflag") != "R").cast("double")).alias("resolution_rate"))
    return occurrences(spark, d).join(lines, "deck_id", "left").select("deck_id", F.col("resolution_rate").isNotNull().alias("has_mainboard"), "resolution_rate", (F.col("source_deck_id") % 50 == 0).alias("quarantined"))


def q_quality(spark, d):
    return rules.quality(graded(spark, d)).select("deck_id", F.concat_ws(",", "findings").alias("findings"), "status")


def judged(spark, d) -> DataFrame:
    g = graded(spark, d)
    q = rules.quality(g).select("deck_id", F.col("status").alias("quality_status"))
    l = q_legality(spark, d).select("deck_id", F.col("status").alias("legal_status"))
    rows = g.join(q, "deck_id").join(l, "deck_id").select("deck_id", F.col("has_mainboard").alias("complete_decklist"), (F.coalesce("resolution_rate", F.lit(0.0)) >= 0.5).alias("resolution_complete"), "legal_status", "quality_status")
    return rules.eligibility(rows, ("accepted", "review"), legal_only=True)


def q_exclusions(spark, d):
    return judged(spark, d).select("deck_id", "exclusion_code")


def q_exclusion_rollup(spark, d):
    return rules.exclusion_rollup(judged(spark, d), "deck_id")


def q_cooccurrence(kind):
    def run(spark, d):
        return decks.cooccurrence(deck_cards(spark, d)).where(F.col("kind") == kind).groupBy("left_id", "right_id").agg(F.count("*").alias("decks"))

    return run


def q_lift(spark, d):
    pairs = decks.cooccurrence(deck_cards(spark, d)).where("kind = 'commander_card'").select(F.col("left_id").alias("commander"), F.col("right_id").alias("card"), "deck_id")
    return reports.lift(pairs)


def q_names(spark, d):
    c = t(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("item_id"), F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("value"))
    p = t(spark, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("item_id"), F.upper("p_name").alias("value"))
    u = t(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("item_id"), F.concat("n_name", F.lit("?")).alias("value"))
    names = t(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("oracle_id")).union(t(spark, d, "part").select("p_name", F.col("p_partkey").cast("string")))
    return resolution.by_name(c.union(p).union(u), names)


def q_identifiers(spark, d):
    o = t(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("item_id"), F.array(F.struct(F.lit(0).alias("priority"), F.lit("uuid").alias("name"), F.col("l_partkey").cast("string").alias("value")), F.struct(F.lit(1).alias("priority"), F.lit("oracleId").alias("name"), (F.col("l_partkey") + F.col("l_linenumber") % 2).cast("string").alias("value"))).alias("identifiers")).dropDuplicates(["item_id"])
    p = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("value"), F.col("p_partkey").cast("string").alias("oracle_id"))
    index = p.select(F.lit("uuid").alias("name"), "value", "oracle_id").union(p.select(F.lit("oracleId"), "value", "oracle_id"))
    return resolution.by_identifier(o, index)


def metrics(spark, d) -> DataFrame:
    o = occurrences(spark, d).join(decks.fingerprint(deck_cards(spark, d)).withColumnRenamed("fingerprint", "canonical_deck_id"), "deck_id", "left")
    g = graded(spark, d).select("deck_id", "has_mainboard", "resolution_rate")
    q = rules.quality(graded(spark, d)).select("deck_id", F.col("status").alias("quality_status"))
    legal = q_legality(spark, d).select("deck_id", F.col("status").alias("legal_status"))
    lines = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("deck_id")).agg(F.count("*").alias("cards"), F.count_if(F.col("l_returnflag") == "R").alias("unresolved_cards"))
    status = t(spark, d, "orders").select(F.col("o_orderkey").alias("deck_id"), scalars.mode(F.regexp_replace("o_orderstatus", "F", " cEDH")).alias("mode"))
    rows = o.join(g, "deck_id").join(q, "deck_id").join(legal, "deck_id").join(status, "deck_id").join(lines, "deck_id", "left")
    return rows.select("deck_id", "source_id", "canonical_deck_id", "observed_at", F.col("has_mainboard").alias("complete"), (F.coalesce("resolution_rate", F.lit(0.0)) == 1).alias("resolved"), ((F.col("source_deck_id") % 3 == 0) & (F.col("source_id") != "5-LOW")).alias("usable_outcome"), ((F.col("source_deck_id") % 5 == 0) & (F.col("source_id") != "2-HIGH")).alias("full_pod"), F.coalesce("cards", F.lit(0)).alias("cards"), F.coalesce("unresolved_cards", F.lit(0)).alias("unresolved_cards"), "legal_status", "quality_status", "mode", F.when(F.col("has_mainboard"), 1).otherwise(0).alias("commanders"))


def q_summary(spark, d):
    return reports.recommended_use(reports.source_summary(metrics(spark, d)), ["4-NOT SPECIFIED"])


def q_overlap(spark, d):
    return reports.overlap(metrics(spark, d))


def q_first_claim(spark, d):
    o = occurrences(spark, d).select("source_id", "source_deck_id", "deck_id", "observed_at")
    return rules.first_claims(o, ["source_id", "source_deck_id"], ["observed_at", "deck_id"])


def q_modes(spark, d):
    e = t(spark, d, "events").select(scalars.mode(F.regexp_replace("event_type", "click", " cEDH ")).alias("mode"), scalars.mode(F.regexp_replace("event_type", "view", "Tournament"), True).alias("report_mode"))
    return e.groupBy("mode", "report_mode").agg(F.count("*").alias("n"))


def q_decklist(spark, d):
    e = t(spark, d, "orders").join(t(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lists = e.groupBy("o_orderkey").agg(F.concat_ws("\n", F.array_sort(F.collect_list(F.concat(F.when(F.col("p_size") == 7, "x").otherwise(F.col("l_quantity").cast("int").cast("string")), F.lit(" "), "p_name")))).alias("text"))
    return lists.select("o_orderkey", F.size(F.coalesce(scalars.decklist(F.col("text")), F.array().cast("array<struct<quantity:int,name:string>>"))).cast("long").alias("lines"), scalars.decklist(F.col("text")).isNotNull().alias("valid"))


def q_top(spark, d):
    return reports.top_commanders(deck_cards(spark, d))


def q_popularity(spark, d):
    return reports.popularity(deck_cards(spark, d))


def q_ranking(spark, d):
    """Popularity (all decks) ranks each deck's customers' cards; the relevant ones are the costly lines."""
    cards = deck_cards(spark, d).join(reports.popularity(deck_cards(spark, d)).select("oracle_id", "decks"), "oracle_id")
    ranked = cards.where("zone = 'mainboard'").select(F.col("deck_id").alias("example_id"), F.col("decks").alias("score"), F.col("oracle_id").alias("item_id"), (F.col("quantity") >= 25).alias("relevant"))
    return reports.ranking_metrics(ranked, 3)


def q_mask(spark, d):
    e = t(spark, d, "events").select("event_id", F.create_map(F.lit("E-Mail"), F.col("user_id").cast("string"), F.lit("type"), F.col("event_type")).alias("m"))
    return e.select("event_id", F.to_json(scalars.masked(F.col("m"))).alias("payload"))


def part_facts(spark, d) -> DataFrame:
    """Parts as staged rows of a card named by their name: brands that differ from the first row's conflict."""
    return t(spark, d, "part").select(F.col("p_partkey").alias("staging_id"), F.col("p_name").alias("oracle_id"), F.col("p_brand").alias("brand"))


def q_catalog(spark, d):
    return catalog.merge_cards(part_facts(spark, d), ["brand"])[0]


def q_conflicts(spark, d):
    return catalog.merge_cards(part_facts(spark, d), ["brand"])[1]


def q_completion_rows(spark, d):
    groups = memberships(spark, d, every=True)
    rows = datasets.completion_rows("orders", written(q_promoted(spark, d, groups).select("record_id", "split"), "promoted"), groups)
    return rows.withColumn("group_ids", F.concat_ws(",", F.transform("group_ids", named)))


def q_reconciliation(spark, d):
    every = judged(spark, d)
    return datasets.reconcile(occurrences(spark, d).select("deck_id"), every.where("exclusion_code is null"), every.where("exclusion_code is not null"), "deck_id")


def q_masks(spark, d):
    return datasets.masks(deck_cards(spark, d), "orders", 0, 0.25).where("masked").select("deck_id", "oracle_id")


def q_filter(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderpriority").alias("source_id"), scalars.mode(F.col("o_orderstatus")).alias("mode"), F.col("o_orderdate").alias("observed_at"))
    rows = rows.withColumn("approved", F.col("record_id") % 7 != 0)
    out = datasets.filter_records(rows, sources=["1-URGENT", "2-HIGH", "5-LOW"], modes=["f", "o"], observed_from="1996-01-01", observed_until="2000-01-01", current_use=["1-urgent", "5-Low"], approved_only=True)
    return out.groupBy("exclusion_code").agg(F.count("*").alias("n"))


def q_benchmark_groups(spark, d):
    cards = deck_cards(spark, d)
    return splits.benchmark_groups(cards, decks.fingerprint(cards), 3)


def q_card_resolution(spark, d):
    """Lines ask for their part by key and supplier, some by a name alone; part names are full names, part types face names, brands aliases."""
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    p = t(spark, d, "part")
    by_id = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    ident = lambda i, name, value: F.struct(F.lit(i).alias("priority"), F.lit(name).alias("name"), value.alias("value"))
    items = by_id.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("item_id"), F.lit("").alias("value"), F.array(ident(0, "uuid", text("l_partkey")), ident(1, "oracleId", (F.col("l_partkey") + F.col("l_linenumber") % 2).cast("string"))).alias("identifiers"))
    empty = F.array().cast("array<struct<priority:int,name:string,value:string>>")
    asked = lambda df, tag, key, name: df.select(F.concat(F.lit(tag), text(key)).alias("item_id"), F.upper(name).alias("value"), empty.alias("identifiers"))
    items = items.union(asked(p, "n", "p_partkey", "p_name")).union(asked(p, "f", "p_partkey", "p_type")).union(asked(p, "a", "p_partkey", "p_brand")).union(asked(t(spark, d, "nation"), "x", "n_nationkey", "n_name"))
    row = lambda df, name, oracle: df.select(F.col(name).alias("name"), oracle.alias("oracle_id"), none.alias("printing_id"), none.alias("face_id"))
    ids = p.select(F.lit("uuid").alias("name"), text("p_partkey").alias("value"), text("p_partkey").alias("oracle_id"), text("p_partkey").alias("printing_id"), none.alias("face_id"))
    ids = ids.union(p.select(F.lit("oracleId"), text("p_partkey"), text("p_partkey"), none, none))
    faces = row(p.where("p_size < 3"), "p_type", text("p_partkey")).union(row(p.where("p_size = 9"), "p_name", text("p_partkey")))
    brands = p.groupBy("p_brand").agg(F.min("p_partkey").alias("k")).withColumn("k", F.when(F.col("p_brand") == "Brand#3", -1).otherwise(F.col("k")))
    return resolution.resolve(items, ids, row(p, "p_name", text("p_partkey")), faces, row(brands, "p_brand", text("k")))


def q_resolution_report(spark, d):
    return reports.resolution_report(q_card_resolution(spark, d))


def q_dedup_report(spark, d):
    exact = written(decks.exact_groups(printed(spark, d)).drop("sources"), "exact-groups")
    revisions = written(decks.revision_groups(occurrences(spark, d)).select("source_id"), "revision-groups")
    return reports.deduplication_report(exact, revisions, decks.near_duplicate_clusters(deck_cards(spark, d), NEAR), NEAR)


def q_finding_counts(spark, d):
    return reports.finding_counts(q_legality(spark, d).select(F.split("findings", ",").alias("findings")).where("findings[0] <> ''"))


def pod_members(spark, d) -> DataFrame:
    """Events of an hour sit at one table; a player's key gives the rest."""
    e = entries(spark, d)
    people = events.participant(F.lit("hours"), F.date_format("pod_id", "yyyy-MM-dd HH"), F.when(F.col("event_id") % 9 == 0, F.col("event_id").cast("string")), F.when(F.col("event_id") % 10 < 9, F.concat(F.lit(" Player  "), F.col("seat").cast("string"))))
    return e.select(F.date_format("pod_id", "yyyy-MM-dd HH").alias("pod_id"), "event_id", F.col("seat").cast("long").alias("seat"), F.when(F.col("event_id") % 97 != 0, F.col("event_id").cast("string")).alias("canonical_deck_id"), "result", F.col("seat").cast("double").alias("points"), (F.col("event_id") % 50).alias("placement"), people.alias("person"))


def q_pods(spark, d):
    members = pod_members(spark, d).withColumn("participant_findings", F.col("person.findings"))
    tables = members.groupBy("pod_id").agg(F.min("event_id").alias("k")).select("pod_id", F.when(F.col("k") % 11 == 0, "Cancelled ").when(F.col("k") % 7 == 0, F.lit(None)).when(F.col("k") % 5 == 0, "paused").otherwise("complete").alias("source_status"))
    return events.pods(tables, members).select("pod_id", "members", F.concat_ws(",", "findings").alias("findings"), "status")


def q_participants(spark, d):
    return pod_members(spark, d).select("event_id", "person.reference_id", "person.scope", F.concat_ws(",", "person.findings").alias("findings"))


def q_observations(spark, d):
    """An order is a standing in its customer's event."""
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("event_id"), F.lit("s").alias("source_id"), F.col("c_nationkey").alias("source_snapshot_id"), F.when(F.col("c_nationkey") == 3, F.lit(None)).when(F.col("c_nationkey") < 20, " cEDH ").otherwise("modern").alias("format"), F.when(F.col("c_custkey") % 2 == 0, F.lit("1999-01-01").cast("timestamp_ntz")).alias("observed_at"))
    o = t(spark, d, "orders").join(t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left")
    k = F.col("o_orderkey")
    rows = o.select(k.alias("observation_id"), F.when(k % 31 == 0, -1).otherwise(F.col("o_custkey")).alias("event_id"), F.lit("s").alias("source_id"), F.when(k % 29 == 0, -1).otherwise(F.col("c_nationkey")).alias("source_snapshot_id"), F.when(k % 23 != 0, k.cast("string")).alias("canonical_deck_id"), F.when(k % 19 != 0, F.col("o_orderdate")).alias("observed_at"), F.when(k % 17 != 0, 1).alias("wins"), F.lit(0).alias("losses"), F.when(k % 13 != 0, 0).alias("draws"), F.when(k % 11 != 0, "match").alias("semantics"), F.array().cast("array<string>").alias("participant_findings"))
    return events.observations(rows, c).select("observation_id", F.concat_ws(",", "findings").alias("findings"), "status")


def q_combos(spark, d):
    """A customer's orders are the cards of a combination, by role; ids are the keys written as UUIDs, bad for some."""
    uuid = lambda c: F.concat(F.lit("ABCDEF00-0000-4000-8000-"), F.lpad(c.cast("string"), 12, "0"))
    o = t(spark, d, "orders")
    cards = o.select(F.col("o_custkey").alias("combo_id"), F.when(F.col("o_orderkey") % 41 == 0, "no").otherwise(uuid(F.col("o_orderkey") % 50)).alias("oracle_id"), F.when(F.col("o_orderstatus") == "F", "required").when(F.col("o_orderstatus") == "O", "optional").otherwise("enabler").alias("role"), (F.col("o_orderkey") % 37).cast("int").alias("quantity"))
    c, k = t(spark, d, "customer"), F.col("c_custkey")
    texts = lambda cond: F.when(cond, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    records = c.select(k.alias("combo_id"), texts(k % 7 != 0).alias("requirements"), texts(k % 5 != 0).alias("results"), F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("compatible"), F.when(k % 4 == 0, F.array(uuid(k))).when(k % 4 == 1, F.array(F.lit("bad"))).otherwise(F.array().cast("array<string>")).alias("commanders"))
    return events.combos(records, cards).select("combo_id", F.size("required").alias("required"), F.size("optional").alias("optional"), F.concat_ws(",", "findings").alias("findings"), "status")


def q_audit(spark, d):
    o = t(spark, d, "orders")
    sources = o.groupBy(F.col("o_orderpriority").alias("source_id")).agg(F.count_distinct(F.to_date("o_orderdate")).alias("tournaments"), F.count_if(F.col("o_totalprice") > 2000).alias("event_observations"), F.count_distinct("o_custkey").alias("pods"), F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("complete_pods"))
    return reports.dataset_audit(metrics(spark, d), sources, ["1-URGENT", "2-HIGH", "4-NOT SPECIFIED"], ["4-NOT SPECIFIED"])


def train_cards(spark, d) -> DataFrame:
    train = q_provisional(spark, d).where("split = 'train'").select(F.col("record_id").alias("deck_id"))
    return deck_cards(spark, d).join(train, "deck_id", "left_semi")


def recommended(spark, d) -> DataFrame:
    """Decks that aren't in train ask by their commander; popularity is that of train."""
    cards = train_cards(spark, d)
    tests = q_provisional(spark, d).where("split <> 'train'").select(F.col("record_id").alias("deck_id"))
    examples = deck_cards(spark, d).where("zone = 'command'").join(tests, "deck_id", "left_semi").select(F.col("deck_id").alias("example_id"), F.col("oracle_id").alias("commander"))
    return reports.recommendations(examples, reports.commander_popularity(cards), reports.popularity(cards), 5)


def q_coverage(spark, d):
    return reports.coverage(recommended(spark, d), t(spark, d, "part"), reports.popularity(train_cards(spark, d)))


def q_evaluations(spark, d):
    """A line evaluates its order's part; the last shipped wins, then the last line."""
    e = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.col("l_partkey").alias("deck_id"), F.col("l_shipdate").alias("evaluated_at"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("status"))
    return rules.latest_evaluations(e, ["record_id", "deck_id"], ["evaluated_at", "line", "status"])


def q_context(spark, d):
    c = t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("item"), F.col("o_orderkey").alias("event_id"))
    return rules.only_context(t(spark, d, "customer").select(F.col("c_custkey").alias("item")), c, "item", "event_id")


def q_leakage_status(spark, d):
    groups = memberships(spark, d)
    events_of = t(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), F.date_format("o_orderdate", "yyyy-MM").alias("event_id"))
    return splits.leakage_status(groups, events_of, written(q_promoted(spark, d, groups), "promoted"))


def q_zones(spark, d):
    l = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("deck_id"), F.lower("l_returnflag").alias("zone"), F.col("l_partkey").alias("oracle_id"), F.col("l_suppkey").alias("printing_id"), F.col("l_quantity").cast("int").alias("quantity"))
    return decks.zone_totals(l)


def q_pod_decks(spark, d):
    """Events of complete pods only."""
    e = entries(spark, d)
    return e.join(rules.complete_pods(e), "pod_id", "left_semi").select("event_id", F.date_format("pod_id", "yyyy-MM-dd HH").alias("pod_id"))


def q_mask_stages(spark, d):
    """Early, middle and late stages of a deck: three, two and one quarters of its other cards are hidden."""
    stage = lambda name, share: datasets.masks(deck_cards(spark, d), f"orders-{name}", 0, share).where("masked").groupBy("deck_id").agg(F.count("*").alias("hidden"), F.min("oracle_id").alias("first_hidden")).withColumn("stage", F.lit(name))
    return stage("early", 0.75).union(stage("middle", 0.5)).union(stage("late", 0.25))


QUERIES = {
    "deck_fingerprint": lambda s, d: decks.fingerprint(deck_cards(s, d)), "exact_duplicates": q_exact, "revision_groups": q_revision,
    "near_duplicate_pairs": q_near_pairs, "near_duplicate_clusters": q_near_clusters,
    "temporal_split": q_provisional, "promoted_split": q_promoted, "split_counts": q_split_counts,
    "leakage_report": q_leakage, "leakage_after_promotion": q_leakage_after,
    "complete_pods": q_complete_pods, "tournament_split": q_tournament,
    "ruleset_asof": q_ruleset, "legality_findings": q_legality, "legality_status": q_legality_counts, "quality_status": q_quality,
    "exclusion_codes": q_exclusions, "exclusion_rollup": q_exclusion_rollup,
    "cooccurrence_commander_card": q_cooccurrence("commander_card"), "cooccurrence_card_card": q_cooccurrence("card_card"), "pmi_lift": q_lift,
    "name_resolution": q_names, "identifier_resolution": q_identifiers,
    "source_summary": q_summary, "cross_source_overlap": q_overlap, "first_claim_outcome": q_first_claim, "mode_histogram": q_modes,
    "decklist_parse": q_decklist, "top_commanders": q_top, "card_popularity": q_popularity, "benchmark_ndcg": q_ranking, "privacy_mask": q_mask,
    "card_catalog": q_catalog, "card_conflicts": q_conflicts, "completion_rows": q_completion_rows, "dataset_reconciliation": q_reconciliation, "completion_masks": q_masks, "dataset_filter": q_filter,
    "benchmark_groups": q_benchmark_groups, "card_resolution": q_card_resolution, "resolution_report": q_resolution_report, "deduplication_report": q_dedup_report, "finding_counts": q_finding_counts,
    "pod_normalization": q_pods, "participant_references": q_participants, "event_observations": q_observations, "combo_normalization": q_combos,
    "dataset_audit": q_audit, "recommendations": recommended, "recommendation_coverage": q_coverage, "latest_evaluations": q_evaluations, "event_context": q_context, "leakage_status": q_leakage_status, "zone_totals": q_zones, "complete_pod_entries": q_pod_decks, "mask_stages": q_mask_stages,
    "commander_popularity": lambda s, d: reports.commander_popularity(deck_cards(s, d)),
}
