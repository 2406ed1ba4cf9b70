"""Source metrics, audit rollups, commander popularity and ranking metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def source_summary(decks: DataFrame) -> DataFrame:
    """decks(deck_id, source_id, canonical_deck_id, observed_at, complete, resolved, usable_outcome, full_pod, cards, unresolved_cards,
    legal_status, quality_status, mode, commanders): one row for each source and, with a null source, for all."""
    known = lambda c, v: F.count_if(F.coalesce(F.col(c) == v, F.lit(False)))
    return decks.rollup("source_id").agg(
        F.count("*").alias("decks"),
        F.count_distinct("canonical_deck_id").alias("distinct_decks"),
        (F.count("*") - F.count_distinct("canonical_deck_id")).alias("exact_duplicates"),
        F.count_if("complete").alias("complete_decks"),
        F.count_if("resolved").alias("resolved_decks"),
        F.count_if("usable_outcome").alias("usable_outcomes"),
        F.count_if("full_pod").alias("full_pods"),
        F.sum("cards").alias("cards"),
        F.sum(F.col("cards") - F.col("unresolved_cards")).alias("resolved_cards"),
        F.sum("unresolved_cards").alias("unresolved_cards"),
        F.count_if(F.col("commanders") > 0).alias("commander_decks"),
        F.count_if(F.col("commanders") == 0).alias("missing_commander"),
        known("legal_status", "unknown").alias("legality_unknown"),
        known("legal_status", "legal").alias("legal_decks"),
        known("quality_status", "accepted").alias("quality_accepted"),
        known("mode", "competitive").alias("competitive_decks"),
        known("mode", "unknown").alias("mode_unknown"),
        F.count_if(F.col("observed_at").isNull()).alias("missing_observed_at"),
        F.min("observed_at").alias("first_observed"),
        F.max("observed_at").alias("last_observed"),
    )


def recommended_use(summary: DataFrame, research_only: list[str] | None = None) -> DataFrame:
    """The first that holds: research only (a list of sources), performance modelling (usable outcomes and full pods),
    completion training (complete decklists and all cards resolved), conditional training, audit only."""
    use = (
        F.when(F.coalesce(F.col("source_id").isin(research_only or []), F.lit(False)), "research_only")
        .when((F.col("usable_outcomes") > 0) & (F.col("full_pods") > 0), "performance_modeling_candidate")
        .when((F.col("complete_decks") > 0) & (F.col("resolved_cards") == F.col("cards")) & (F.col("cards") > 0), "deck_completion_training_candidate")
        .when(F.col("complete_decks") > 0, "deck_completion_training_conditional")
        .otherwise("audit_only")
    )
    return summary.withColumn("recommended_use", use)


def overlap(decks: DataFrame) -> DataFrame:
    """canonical_deck_id in two sources or more."""
    return decks.groupBy("canonical_deck_id").agg(F.count_distinct("source_id").alias("sources"), F.count("*").alias("occurrences")).where("sources > 1")


def top_commanders(deck_cards: DataFrame, n: int = 10) -> DataFrame:
    return deck_cards.where("zone = 'command'").groupBy("oracle_id").agg(F.count_distinct("deck_id").alias("decks")).orderBy(F.desc("decks"), "oracle_id").limit(n)


def popularity(deck_cards: DataFrame) -> DataFrame:
    cards = deck_cards.where("zone <> 'command'").groupBy("oracle_id").agg(F.count_distinct("deck_id").alias("decks"))
    return cards.withColumn("is_long_tail", F.col("decks") == 1)


def lift(pairs: DataFrame, alpha: float = 1.0) -> DataFrame:
    """pairs(commander, card, deck_id): smoothed log P(card | commander) - log P(card)."""
    both = pairs.groupBy("commander", "card").agg(F.count("*").alias("together"))
    per = both.groupBy("commander").agg(F.sum("together").alias("of_commander"))
    card = both.groupBy("card").agg(F.sum("together").alias("of_card"))
    total = both.agg(F.sum("together").alias("total"), F.count_distinct("card").alias("cards"))
    rows = both.join(per, "commander").join(card, "card").crossJoin(F.broadcast(total))  # total is one row
    p = (F.col("together") + alpha) / (F.col("of_commander") + alpha * F.col("cards"))
    q = (F.col("of_card") + alpha) / (F.col("total") + alpha * F.col("cards"))
    return rows.select("commander", "card", "together", F.round(F.log(p) - F.log(q), 9).alias("lift"))


def ranking_metrics(ranked: DataFrame, k: int = 25) -> DataFrame:
    """ranked(example_id, score, item_id, relevant): recall@k, ndcg@k and reciprocal rank of each example."""
    w = Window.partitionBy("example_id").orderBy(F.desc("score"), "item_id")
    rows = ranked.withColumn("rank", F.row_number().over(w))
    gain = F.when(F.col("relevant") & (F.col("rank") <= k), 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)
    found = rows.groupBy("example_id").agg(F.count_if("relevant").alias("n"), F.count_if(F.col("relevant") & (F.col("rank") <= k)).alias("hits"), F.sum(gain).alias("dcg"), F.min(F.when(F.col("relevant"), F.col("rank"))).alias("first"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    return found.where("n > 0").select("example_id", (F.col("hits") / F.col("n")).alias("recall"), F.round(F.col("dcg") / ideal, 9).alias("ndcg"), (1 / F.col("first")).alias("reciprocal_rank"))


def finding_counts(records: DataFrame) -> DataFrame:
    """records(findings array): how many records have each code."""
    return records.select(F.explode(F.array_distinct("findings")).alias("finding_code")).groupBy("finding_code").agg(F.count("*").alias("n"))


def resolution_report(resolved: DataFrame) -> DataFrame:
    """One row of counts over resolved(method, status): entries, statuses, and the methods of those resolved."""
    by = lambda m: F.count_if((F.col("status") == "resolved") & (F.col("method") == m)).alias(f"{m}_matches")
    methods = ("source_identifier", "exact_identifier", "exact_name", "split_face", "alias")
    out = resolved.agg(F.count("*").alias("total_entries"), *[F.count_if(F.col("status") == s).alias(f"{s}_entries") for s in ("resolved", "ambiguous", "unresolved", "rejected")], *[by(m) for m in methods])
    exact = sum((F.col(f"{m}_matches") for m in methods[1:4]), F.col(f"{methods[0]}_matches"))
    return out.withColumn("exact_matches", exact).withColumn("failure_count", F.col("ambiguous_entries") + F.col("unresolved_entries") + F.col("rejected_entries"))


def deduplication_report(exact: DataFrame, revisions: DataFrame, clusters: DataFrame, threshold: float, version: str = "near-duplicate-v1") -> DataFrame:
    """One row: exact groups, occurrences in them, groups of several sources, revision groups and near-duplicate clusters."""
    a = exact.agg(F.count("*").alias("exact_duplicate_groups"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("exact_duplicate_occurrences"), F.count_if("cross_source").alias("cross_source_exact_groups"))
    b, c = revisions.agg(F.count("*").alias("revision_groups")), clusters.agg(F.count("*").alias("near_duplicate_clusters"))
    # three rows of one
    return a.crossJoin(b).crossJoin(c).select("*", F.lit("quantity_weighted_jaccard").alias("near_duplicate_algorithm"), F.lit(version).alias("near_duplicate_version"), F.lit(float(threshold)).alias("near_duplicate_threshold"))


def dataset_audit(decks: DataFrame, sources: DataFrame, allowed: list[str], research_only: list[str]) -> DataFrame:
    """One row over decks, as source_summary takes them, and sources(source_id, tournaments, event_observations, pods, complete_pods).

    Missing values count as missing, never as negative evidence. Suitability looks at decks of allowed sources that aren't research only.
    """
    fit = F.col("source_id").isin(allowed) & ~F.col("source_id").isin(research_only or [""])
    has = F.col("commanders") > 0
    whole = F.col("complete") & has
    shared = overlap(decks.where("canonical_deck_id is not null"))
    of_mode = lambda m: F.count_if(whole & (F.coalesce("mode", F.lit("unknown")) == m)).alias(f"{m}_decks")
    out = decks.agg(
        F.count("*").alias("total_decks"), F.count_if("complete").alias("complete_decklists"), F.count_if(whole).alias("complete_commander_decks"), F.count_if(F.coalesce(F.col("legal_status") == "unknown", F.lit(False))).alias("legality_unknown"),
        F.count_if(~F.col("resolved")).alias("unresolved_decks"), F.coalesce(F.sum("unresolved_cards"), F.lit(0)).alias("unresolved_cards"), F.count_if("usable_outcome").alias("usable_outcomes"), F.count_if("full_pod").alias("full_pods"),
        of_mode("casual"), of_mode("competitive"), of_mode("unknown"), F.count_if(~has).alias("missing_commander"), F.count_if(F.col("observed_at").isNull()).alias("missing_observed_at"), F.count_if(F.col("mode").isNull()).alias("missing_mode"),
        F.count_if(~F.col("complete")).alias("incomplete_decklist"), F.min("observed_at").alias("first_observed"), F.max("observed_at").alias("last_observed"),
        F.count_if(fit & whole).alias("__whole"), F.count_if(fit & ~F.col("resolved")).alias("__open"), F.count_if(fit & F.col("usable_outcome")).alias("__outcomes"), F.count_if(fit & F.col("full_pod")).alias("__pods"),
    )
    out = out.crossJoin(shared.agg(F.count("*").alias("cross_source_decks"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("cross_source_records")))  # rows of one
    out = out.crossJoin(sources.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tournaments", "event_observations", "pods", "complete_pods")]))
    training = F.when(F.col("__whole") == 0, "not_suitable").when((F.col("unresolved_cards") > 0) | (F.col("__open") > 0), "conditional").otherwise("suitable")
    performance = F.when((F.col("__outcomes") > 0) & (F.col("__pods") > 0), "suitable").when(F.col("__outcomes") > 0, "conditional").otherwise("not_suitable")
    return out.withColumns({"deck_completion_training": training, "performance_modeling": performance}).drop("__whole", "__open", "__outcomes", "__pods")


def commander_popularity(deck_cards: DataFrame) -> DataFrame:
    """commander, card, decks: how many decks with that commander have the card."""
    cards = deck_cards.select("deck_id", "zone", "oracle_id").distinct()
    one = cards.where("zone = 'command'").select("deck_id", F.col("oracle_id").alias("commander"))
    return one.join(cards.where("zone <> 'command'").select("deck_id", F.col("oracle_id").alias("card")).distinct(), "deck_id").groupBy("commander", "card").agg(F.count("*").alias("decks"))


def recommendations(examples: DataFrame, by_commander: DataFrame, popular: DataFrame, k: int = 25) -> DataFrame:
    """example_id, rank, card, score: for each of examples(example_id, commander) the k cards that most decks of its commander
    have (ties: the card's order); a commander without decks gets the most popular cards of all.

    The k best are taken by commander before examples meet them, so a commander that many examples share is ranked once.
    """
    rank = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("decks"), "card"))).where(F.col("rank") <= k)
    own = rank(by_commander, "commander").select("commander", "rank", "card", F.col("decks").alias("score"))
    top = popular.select(F.col("oracle_id").alias("card"), "decks").orderBy(F.desc("decks"), "card").limit(k)  # at most k rows
    rest = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("decks"), "card"))).select("rank", "card", F.col("decks").alias("score"))
    known = own.select("commander").distinct()
    cold = examples.join(known, "commander", "left_anti").select("example_id").crossJoin(F.broadcast(rest))
    return examples.join(own, "commander").select("example_id", "rank", "card", "score").union(cold)


def coverage(recommended: DataFrame, catalog: DataFrame, prevalence: DataFrame) -> DataFrame:
    """One row: unique recommended cards, their share of the catalog, and the mean number of decks of a recommendation."""
    seen = recommended.agg(F.count_distinct("card").alias("unique_cards")).crossJoin(catalog.agg(F.count("*").alias("n")))  # rows of one
    mean = recommended.join(prevalence.select(F.col("oracle_id").alias("card"), "decks"), "card", "left").agg(F.avg(F.coalesce("decks", F.lit(0))).alias("m"))
    return seen.crossJoin(mean).select("unique_cards", F.round(F.col("unique_cards") / F.col("n"), 9).alias("catalog_coverage"), F.round("m", 6).alias("mean_prevalence"))
