"""The queries of plans.queries in SQL."""

DC = """dc AS (SELECT l_orderkey AS deck_id, l_partkey AS oracle_id, sum(CAST(l_quantity AS INT))::BIGINT AS quantity FROM lineitem GROUP BY ALL),
dz AS (SELECT deck_id, CASE WHEN oracle_id = min(oracle_id) OVER (PARTITION BY deck_id) THEN 'command' ELSE 'mainboard' END AS zone, oracle_id, quantity FROM dc)"""
FP = DC + """,
zj AS (SELECT deck_id, zone, '[' || string_agg('{"oracle_id":"' || oracle_id || '","quantity":' || quantity || '}', ',' ORDER BY oracle_id::VARCHAR, quantity) || ']' AS cards FROM dz GROUP BY ALL),
fp AS (SELECT deck_id, sha256('{"card_zones":[' || coalesce(max('{"cards":' || cards || ',"zone":"mainboard"}') FILTER (zone = 'mainboard'), '') || '],"command_zone":' || coalesce(max(cards) FILTER (zone = 'command'), '[]') || ',"format":"commander"}') AS fingerprint FROM zj GROUP BY 1)"""
REV = """rv AS (SELECT 'revision-' || left(sha256('{"source_deck_id":"' || o_custkey || '","source_id":"' || o_orderpriority || '","version":"source-deck-revision-v1"}'), 32) AS group_id,
  o_orderpriority AS source_id, o_custkey AS source_deck_id, list(o_orderkey ORDER BY o_orderdate, o_orderkey) AS ids FROM orders GROUP BY ALL HAVING count(*) > 1)"""
PS = """ps AS (SELECT o_orderkey AS record_id, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 1 WHEN o_orderdate < TIMESTAMP '2000-07-01' THEN 2 ELSE 3 END AS r FROM orders)"""
NEAR = FP + """,
rp AS (SELECT min(deck_id) AS deck_id FROM fp GROUP BY fingerprint),
dr AS (SELECT dz.* FROM dz JOIN rp USING (deck_id)),
tt AS (SELECT deck_id, sum(quantity) AS total FROM dr GROUP BY 1),
np AS (SELECT a.deck_id AS left_id, b.deck_id AS right_id, sum(least(a.quantity, b.quantity)) AS m FROM dr a JOIN dr b ON a.zone = b.zone AND a.oracle_id = b.oracle_id AND a.deck_id < b.deck_id GROUP BY ALL),
pairs AS (SELECT left_id, right_id, m / (x.total + y.total - m) AS similarity FROM np JOIN tt x ON x.deck_id = left_id JOIN tt y ON y.deck_id = right_id WHERE m / (x.total + y.total - m) >= 0.6)"""
CLUSTERS = NEAR + """,
ne AS (SELECT left_id AS x, right_id AS y FROM pairs UNION SELECT right_id, left_id FROM pairs),
nr(x, y) AS (SELECT x, x FROM ne UNION SELECT nr.x, ne.y FROM nr JOIN ne ON nr.y = ne.x),
nc AS (SELECT x, min(y) AS c FROM nr GROUP BY 1),
ng AS (SELECT c, list(fingerprint ORDER BY fingerprint) AS ids FROM nc JOIN fp ON fp.deck_id = x GROUP BY 1),
cl AS (SELECT 'near-' || left(sha256('{"algorithm":"quantity_weighted_jaccard","canonical_deck_ids":["' || array_to_string(ids, '","') || '"],"threshold":0.6,"version":"near-duplicate-v1"}'), 32) AS cluster_id, c AS first_id, ids FROM ng)"""
MEM = CLUSTERS + ", " + REV + """,
mem AS (SELECT o_orderkey AS record_id, 'exact:' || fingerprint AS group_id FROM orders JOIN fp ON deck_id = o_orderkey UNION ALL SELECT unnest(ids), 'revision:' || group_id FROM rv
  UNION ALL SELECT deck_id, 'near:' || cluster_id FROM (SELECT cluster_id, unnest(ids) AS fingerprint FROM cl) JOIN fp USING (fingerprint) JOIN orders ON o_orderkey = deck_id), """ + PS
CC = MEM + """,
eg AS (SELECT DISTINCT a.record_id AS x, b.record_id AS y FROM mem a JOIN mem b USING (group_id)),
re(x, y) AS (SELECT record_id, record_id FROM ps UNION SELECT re.x, eg.y FROM re JOIN eg ON re.y = eg.x),
pr AS (SELECT x AS record_id, max(q.r) AS last, any_value(p.r) AS r FROM re JOIN ps q ON q.record_id = re.y JOIN ps p ON p.record_id = re.x GROUP BY x),
promoted AS (SELECT record_id, ['train','validation','test'][r] AS provisional_split, ['train','validation','test'][last] AS split FROM pr)"""
RS = """rs(v, f, u) AS (VALUES ('r1', DATE '1995-06-01', DATE '1997-01-01'), ('r2', DATE '1996-06-01', DATE '1999-01-01'), ('r3', DATE '1999-01-01', NULL), ('r4', DATE '2000-01-01', NULL), ('r4b', DATE '2000-01-01', DATE '2000-07-01')),
mt AS (SELECT o_orderkey AS deck_id, v, f, max(f) OVER (PARTITION BY o_orderkey) AS mf FROM orders LEFT JOIN rs ON f <= o_orderdate::DATE AND (u IS NULL OR o_orderdate::DATE < u)),
sel AS (SELECT deck_id, CASE WHEN count(v) = 1 THEN max(v) END AS ruleset_version, CASE WHEN count(v) = 0 THEN 'legality.ruleset_unresolved' WHEN count(v) > 1 THEN 'legality.ruleset_ambiguous' END AS selection_code FROM mt WHERE f IS NULL OR f = mf GROUP BY 1)"""
LEG = DC + ", " + RS + """,
rl(v, total, lim, lo, hi, banned, companions, unlimited, overrides) AS (VALUES ('r1', 100, 40, 1, 20, [3, 7, 11], [5, 50], [2], MAP {4: 10}), ('r2', 120, 30, 1, 30, [7, 13], []::INT[], []::INT[], MAP {}::MAP(INT, INT)),
  ('r3', 100, 45, 1, 50, []::INT[], [50], [1, 2, 3], MAP {5: 50}), ('r4', 80, 20, 5, 25, [1, 2], []::INT[], []::INT[], MAP {}::MAP(INT, INT)), ('r4b', 90, 20, 1, 25, [4], [9], [6], MAP {8: 5})),
cd AS (SELECT dz.*, p_partkey IS NOT NULL AS has, p_type, p_size, rl.*, oracle_id = max(oracle_id) OVER (PARTITION BY deck_id) AS companion FROM dz JOIN sel USING (deck_id) JOIN rl ON v = ruleset_version LEFT JOIN part ON oracle_id = p_partkey),
cm AS (SELECT deck_id, list(DISTINCT p_type) FILTER (p_type IS NOT NULL) AS allowed FROM cd WHERE zone = 'command' GROUP BY 1),
ag AS (SELECT deck_id, any_value(total) AS required, any_value(lo) AS lo, any_value(hi) AS hi, sum(quantity) AS total, sum(quantity) FILTER (zone = 'command') AS cq, bool_or(zone = 'mainboard') AS main, bool_or(NOT has) AS missing,
  coalesce(bool_or(has AND p_size <> 50 AND NOT list_contains(unlimited, oracle_id::INT) AND quantity > coalesce(overrides[oracle_id::INT], lim)), false) AS single, coalesce(bool_or(has AND p_size <= 2), false) AS illegal,
  coalesce(bool_or(has AND list_contains(banned, oracle_id::INT)), false) AS banned, coalesce(bool_or(zone = 'command' AND list_contains(banned, oracle_id::INT)), false) AS cb,
  coalesce(bool_or(companion AND list_contains(companions, oracle_id::INT)), false) AS co, coalesce(bool_or(has AND NOT list_contains(coalesce(allowed, []), p_type)), false) AS ci FROM cd JOIN cm USING (deck_id) GROUP BY 1),
fi AS (SELECT sel.deck_id, CASE WHEN selection_code IS NOT NULL THEN [selection_code] ELSE list_sort(list_filter([
  CASE WHEN NOT coalesce(main, false) THEN 'legality.mainboard_missing' END, CASE WHEN coalesce(cq, 0) NOT BETWEEN coalesce(lo, rl.lo2) AND coalesce(hi, rl.hi2) THEN 'legality.command_zone_size_invalid' END,
  CASE WHEN coalesce(total, 0) <> coalesce(required, rl.total2) THEN 'legality.deck_size_invalid' END, CASE WHEN missing THEN 'legality.card_fact_missing' END, CASE WHEN single THEN 'legality.singleton_violation' END,
  CASE WHEN illegal THEN 'legality.card_not_commander_legal' END, CASE WHEN ci THEN 'legality.color_identity_violation' END, CASE WHEN banned THEN 'legality.banned_card' END, CASE WHEN cb THEN 'legality.commander_banned' END,
  CASE WHEN co THEN 'legality.banned_as_companion' END], lambda x: x IS NOT NULL)) END AS f
  FROM sel LEFT JOIN ag USING (deck_id) LEFT JOIN (SELECT v, total AS total2, lo AS lo2, hi AS hi2 FROM rl) rl ON rl.v = ruleset_version),
lg AS (SELECT deck_id, array_to_string(f, ',') AS findings, CASE WHEN list_has_any(f, ['legality.ruleset_unresolved','legality.ruleset_ambiguous','legality.card_fact_missing']) THEN 'unknown' WHEN len(f) > 0 THEN 'illegal' ELSE 'legal' END AS status FROM fi)"""
GR = """gr AS (SELECT o_orderkey AS deck_id, rate, rate IS NOT NULL AS has, o_custkey % 50 = 0 AS quarantined FROM orders LEFT JOIN (SELECT l_orderkey, avg(CASE WHEN l_returnflag <> 'R' THEN 1.0::DOUBLE ELSE 0 END) AS rate FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
qu AS (SELECT deck_id, concat_ws(',', CASE WHEN coalesce(rate, 1) < 1 THEN 'quality.card_resolution_incomplete' END, CASE WHEN NOT has THEN 'quality.mainboard_missing' END) AS findings, CASE WHEN quarantined THEN 'quarantined' WHEN NOT has OR rate < 1 THEN 'review' ELSE 'accepted' END AS status FROM gr)"""
EX = LEG + ", " + GR + """,
ex AS (SELECT deck_id, CASE WHEN NOT has THEN 'quality.decklist_incomplete' WHEN coalesce(rate, 0) < 0.5 THEN 'resolution.card_unresolved' WHEN lg.status <> 'legal' THEN 'legality.deck_not_eligible' WHEN qu.status = 'quarantined' THEN 'quality.deck_not_eligible' END AS exclusion_code FROM gr JOIN lg USING (deck_id) JOIN qu USING (deck_id))"""
ME = FP + ", " + GR + ", " + LEG.removeprefix(DC + ", ") + """,
li AS (SELECT l_orderkey AS deck_id, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS un FROM lineitem GROUP BY 1),
me AS (SELECT o_orderpriority AS source_id, fingerprint AS canonical_deck_id, o_orderdate AS observed_at, has AS complete, coalesce(rate, 0) = 1 AS resolved, o_custkey % 3 = 0 AND o_orderpriority <> '5-LOW' AS usable, o_custkey % 5 = 0 AND o_orderpriority <> '2-HIGH' AS pod,
  coalesce(li.n, 0) AS cards, coalesce(li.un, 0) AS un, lg.status AS legal, qu.status AS quality, CASE o_orderstatus WHEN 'F' THEN 'competitive' ELSE lower(o_orderstatus) END AS mode
  FROM orders LEFT JOIN fp ON fp.deck_id = o_orderkey JOIN gr ON gr.deck_id = o_orderkey JOIN lg ON lg.deck_id = o_orderkey JOIN qu ON qu.deck_id = o_orderkey LEFT JOIN li ON li.deck_id = o_orderkey)"""
CO = DC + """,
cc AS (SELECT a.oracle_id AS commander, b.oracle_id AS card FROM dz a JOIN dz b ON a.deck_id = b.deck_id AND a.zone = 'command' AND b.zone = 'mainboard')"""

RES = """it AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS item_id, l_partkey AS a, l_partkey + l_linenumber % 2 AS b FROM lineitem),
ri AS (SELECT item_id, x.p_partkey AS x, y.p_partkey AS y FROM it LEFT JOIN part x ON a = x.p_partkey LEFT JOIN part y ON b = y.p_partkey),
nm AS (SELECT lower(p_name) AS k, count(DISTINCT p_partkey) AS n, min(p_partkey::VARCHAR) AS id, list_sort(list(DISTINCT p_partkey::VARCHAR)) AS ids FROM part GROUP BY 1),
fc AS (SELECT k, count(DISTINCT id) AS n, min(id) AS id, list_sort(list(DISTINCT id)) AS ids FROM (SELECT lower(p_type) AS k, p_partkey::VARCHAR AS id FROM part WHERE p_size < 3 UNION ALL SELECT lower(p_name), p_partkey::VARCHAR FROM part WHERE p_size = 9) GROUP BY 1),
al AS (SELECT lower(p_brand) AS k, CASE WHEN p_brand <> 'Brand#3' THEN min(p_partkey)::VARCHAR END AS id FROM part GROUP BY p_brand),
qs AS (SELECT 'n' || p_partkey AS item_id, lower(p_name) AS k FROM part UNION ALL SELECT 'f' || p_partkey, lower(p_type) FROM part UNION ALL SELECT 'a' || p_partkey, lower(p_brand) FROM part UNION ALL SELECT 'x' || n_nationkey, lower(n_name) FROM nation),
rn AS (SELECT item_id, CASE WHEN nm.k IS NOT NULL THEN 'exact_name' WHEN fc.k IS NOT NULL THEN 'split_face' WHEN al.k IS NOT NULL THEN 'alias' ELSE 'none' END AS method,
  CASE WHEN nm.k IS NOT NULL AND fc.k IS NOT NULL AND (nm.ids <> fc.ids OR nm.n > 1) THEN len(list_distinct(list_concat(nm.ids, fc.ids))) WHEN nm.k IS NOT NULL THEN nm.n WHEN fc.k IS NOT NULL THEN fc.n WHEN al.id IS NOT NULL THEN 1 ELSE 0 END AS candidates, CASE WHEN nm.k IS NOT NULL THEN nm.id WHEN fc.k IS NOT NULL THEN fc.id ELSE al.id END AS id
  FROM qs LEFT JOIN nm ON nm.k = qs.k LEFT JOIN fc ON fc.k = qs.k LEFT JOIN al ON al.k = qs.k),
res AS (SELECT item_id, method, CASE candidates WHEN 0 THEN 'unresolved' WHEN 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN candidates = 1 THEN id END AS oracle_id, NULL::VARCHAR AS printing_id, NULL::VARCHAR AS face_id, candidates::INT AS candidates,
    CASE WHEN candidates = 1 THEN NULL WHEN candidates > 1 THEN 'resolution.ambiguous_name' WHEN method = 'alias' THEN 'resolution.alias_target_unresolved' ELSE 'resolution.unresolved_name' END AS finding_code FROM rn
  UNION ALL SELECT item_id, CASE WHEN x IS NOT NULL THEN 'source_identifier' WHEN y IS NOT NULL THEN 'exact_identifier' ELSE 'none' END, CASE WHEN coalesce(x, y) IS NULL THEN 'unresolved' WHEN x <> y THEN 'ambiguous' ELSE 'resolved' END, CASE WHEN x <> y THEN NULL ELSE coalesce(x, y)::VARCHAR END, CASE WHEN x <> y THEN NULL ELSE x::VARCHAR END, NULL,
    CASE WHEN coalesce(x, y) IS NULL THEN 0 WHEN x <> y THEN 2 ELSE 1 END, CASE WHEN coalesce(x, y) IS NULL THEN 'resolution.unresolved_name' WHEN x <> y THEN 'resolution.conflicting_identifiers' END FROM ri)"""
REC = DC + ", " + PS + """,
tr AS (SELECT dz.* FROM dz JOIN ps ON record_id = deck_id WHERE r = 1),
cp AS (SELECT a.oracle_id AS commander, b.oracle_id AS card, count(*) AS decks FROM tr a JOIN tr b ON a.deck_id = b.deck_id AND a.zone = 'command' AND b.zone = 'mainboard' GROUP BY ALL),
pop AS (SELECT oracle_id AS card, count(DISTINCT deck_id) AS decks FROM tr WHERE zone = 'mainboard' GROUP BY 1),
exa AS (SELECT deck_id AS example_id, oracle_id AS commander FROM dz JOIN ps ON record_id = deck_id WHERE r > 1 AND zone = 'command'),
own AS (SELECT commander, row_number() OVER (PARTITION BY commander ORDER BY decks DESC, card) AS rank, card, decks AS score FROM cp QUALIFY rank <= 5),
alt AS (SELECT row_number() OVER (ORDER BY decks DESC, card) AS rank, card, decks AS score FROM pop QUALIFY rank <= 5),
rec AS (SELECT example_id, rank, card, score FROM exa JOIN own USING (commander) UNION ALL SELECT example_id, rank, card, score FROM exa, alt WHERE commander NOT IN (SELECT commander FROM cp))"""
PODS = """pm AS (SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS pod_id, event_id, user_id AS seat, CASE WHEN event_id % 97 <> 0 THEN event_id END AS deck, event_id % 50 AS placement, event_id % 9 = 0 AS opaque, event_id % 10 < 9 AND user_id IS NOT NULL AS named FROM events)"""

SQL = {
    "deck_fingerprint": f"WITH {FP} SELECT * FROM fp",
    "exact_duplicates": f"WITH {FP} SELECT fingerprint, count(*) AS occurrences, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS sources, count(DISTINCT o_orderpriority) > 1 AS cross_source FROM fp JOIN orders ON deck_id = o_orderkey GROUP BY 1 HAVING count(*) > 1",
    "revision_groups": f"WITH {REV} SELECT group_id, source_id, source_deck_id, array_to_string(ids, ',') AS deck_ids FROM rv",
    "near_duplicate_pairs": f"WITH {NEAR} SELECT left_id, right_id, round(similarity, 9) AS similarity FROM pairs",
    "near_duplicate_clusters": f"WITH RECURSIVE {CLUSTERS} SELECT cluster_id, first_id, array_to_string(ids, ',') AS canonical_deck_ids FROM cl",
    "temporal_split": f"WITH {PS} SELECT record_id, ['train','validation','test'][r] AS split FROM ps",
    "promoted_split": f"WITH RECURSIVE {CC} SELECT * FROM promoted",
    "split_counts": f"WITH RECURSIVE {CC} SELECT provisional_split, split, count(*) AS n FROM promoted GROUP BY ALL",
    "leakage_report": f"WITH RECURSIVE {MEM} SELECT group_id, string_agg(DISTINCT ['train','validation','test'][r], ',' ORDER BY ['train','validation','test'][r]) AS splits FROM mem JOIN ps USING (record_id) GROUP BY 1 HAVING count(DISTINCT r) > 1",
    "leakage_after_promotion": f"WITH RECURSIVE {CC} SELECT group_id, string_agg(DISTINCT split, ',') AS splits FROM mem JOIN promoted USING (record_id) GROUP BY 1 HAVING count(DISTINCT split) > 1",
    "complete_pods": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS pod_id, count(*) AS seats FROM events GROUP BY 1 HAVING count(*) >= 2 AND count(*) = count(DISTINCT user_id) AND bool_and(event_type <> 'error')",
    "tournament_split": """WITH rec AS (SELECT o_orderkey AS record_id, strftime(o_orderdate, '%Y-%m-%d') AS event_id, o_orderdate, o_custkey, bool_and(o_totalprice > 2000) OVER (PARTITION BY strftime(o_orderdate, '%Y-%m-%d')) AS whole, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS cd FROM orders),
c AS (SELECT *, CASE WHEN NOT whole THEN 'quality.event_incomplete' WHEN NOT cd THEN 'quality.decklist_incomplete' END AS exclusion_code FROM rec),
s AS (SELECT *, CASE WHEN exclusion_code IS NULL THEN CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '2000-07-01' THEN 'validation' ELSE 'test' END END AS split FROM c)
SELECT record_id, event_id, split, exclusion_code, CASE WHEN split IS NOT NULL THEN CASE WHEN o_custkey IN (SELECT o_custkey FROM s WHERE split = 'train') THEN 'familiar' ELSE 'unseen' END END AS stratum FROM s""",
    "ruleset_asof": f"WITH {RS} SELECT * FROM sel",
    "legality_findings": f"WITH {LEG} SELECT * FROM lg",
    "legality_status": f"WITH {LEG} SELECT status, count(*) AS n FROM lg GROUP BY 1",
    "quality_status": f"WITH {GR} SELECT * FROM qu",
    "exclusion_codes": f"WITH {EX} SELECT * FROM ex",
    "exclusion_rollup": f"WITH {EX} SELECT exclusion_code, count(*) AS n, min(deck_id) AS first_id FROM ex WHERE exclusion_code IS NOT NULL GROUP BY 1",
    "cooccurrence_commander_card": f"WITH {CO} SELECT commander AS left_id, card AS right_id, count(*) AS decks FROM cc GROUP BY ALL",
    "cooccurrence_card_card": f"WITH {DC} SELECT a.oracle_id AS left_id, b.oracle_id AS right_id, count(*) AS decks FROM dz a JOIN dz b ON a.deck_id = b.deck_id AND a.zone = 'mainboard' AND b.zone = 'mainboard' AND a.oracle_id < b.oracle_id GROUP BY ALL",
    "pmi_lift": f"WITH {CO}, b AS (SELECT commander, card, count(*) AS together FROM cc GROUP BY ALL) SELECT commander, card, together, round(ln((together + 1.0::DOUBLE) / (sum(together) OVER (PARTITION BY commander) + 1.0::DOUBLE * (SELECT count(DISTINCT card) FROM b))) - ln((sum(together) OVER (PARTITION BY card) + 1.0::DOUBLE) / (sum(together) OVER () + 1.0::DOUBLE * (SELECT count(DISTINCT card) FROM b))), 9) AS lift FROM b",
    "name_resolution": """WITH i AS (SELECT 'c' || c_custkey AS item_id, lower(c_name) AS k FROM customer UNION ALL SELECT 'p' || p_partkey, lower(p_name) FROM part UNION ALL SELECT 'n' || n_nationkey, lower(n_name) || '?' FROM nation),
n AS (SELECT k, count(DISTINCT id) AS n, min(id) AS id FROM (SELECT lower(c_name) AS k, c_custkey::VARCHAR AS id FROM customer UNION ALL SELECT lower(p_name), p_partkey::VARCHAR FROM part) GROUP BY 1)
SELECT item_id, CASE WHEN n IS NOT NULL THEN 'exact_name' END AS method, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status, CASE WHEN n = 1 THEN id END AS oracle_id, coalesce(n, 0) AS candidates FROM i LEFT JOIN n USING (k)""",
    "identifier_resolution": """WITH i AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS item_id, l_partkey AS a, l_partkey + l_linenumber % 2 AS b FROM lineitem),
m AS (SELECT item_id, x.p_partkey AS x, y.p_partkey AS y FROM i LEFT JOIN part x ON a = x.p_partkey LEFT JOIN part y ON b = y.p_partkey)
SELECT item_id, CASE WHEN x IS NOT NULL THEN 'source_identifier' WHEN y IS NOT NULL THEN 'exact_identifier' END AS method, CASE WHEN coalesce(x, y) IS NULL THEN 'unresolved' WHEN x <> y THEN 'ambiguous' ELSE 'resolved' END AS status,
  CASE WHEN coalesce(x <> y, false) THEN NULL ELSE coalesce(x, y)::VARCHAR END AS oracle_id, CASE WHEN x <> y THEN 'resolution.conflicting_identifiers' END AS finding_code FROM m""",
    "source_summary": f"""WITH {ME}, s AS (SELECT source_id, count(*) AS decks, count(DISTINCT canonical_deck_id) AS distinct_decks, count(*) - count(DISTINCT canonical_deck_id) AS exact_duplicates, count(*) FILTER (complete) AS complete_decks, count(*) FILTER (resolved) AS resolved_decks, count(*) FILTER (usable) AS usable_outcomes, count(*) FILTER (pod) AS full_pods,
  sum(cards)::BIGINT AS cards, sum(cards - un)::BIGINT AS resolved_cards, sum(un)::BIGINT AS unresolved_cards, count(*) FILTER (complete) AS commander_decks, count(*) FILTER (NOT complete) AS missing_commander, count(*) FILTER (legal = 'unknown') AS legality_unknown, count(*) FILTER (legal = 'legal') AS legal_decks,
  count(*) FILTER (quality = 'accepted') AS quality_accepted, count(*) FILTER (mode = 'competitive') AS competitive_decks, count(*) FILTER (mode = 'unknown') AS mode_unknown, count(*) FILTER (observed_at IS NULL) AS missing_observed_at, min(observed_at) AS first_observed, max(observed_at) AS last_observed FROM me GROUP BY ROLLUP (source_id))
SELECT *, CASE WHEN source_id = '4-NOT SPECIFIED' THEN 'research_only' WHEN usable_outcomes > 0 AND full_pods > 0 THEN 'performance_modeling_candidate' WHEN complete_decks > 0 AND resolved_cards = cards AND cards > 0 THEN 'deck_completion_training_candidate' WHEN complete_decks > 0 THEN 'deck_completion_training_conditional' ELSE 'audit_only' END AS recommended_use FROM s""",
    "cross_source_overlap": f"WITH {ME} SELECT canonical_deck_id, count(DISTINCT source_id) AS sources, count(*) AS occurrences FROM me GROUP BY 1 HAVING count(DISTINCT source_id) > 1",
    "first_claim_outcome": "SELECT o_orderpriority AS source_id, o_custkey AS source_deck_id, o_orderkey AS deck_id, o_orderdate AS observed_at FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
    "mode_histogram": "SELECT CASE event_type WHEN 'click' THEN 'competitive' ELSE event_type END AS mode, CASE event_type WHEN 'view' THEN 'competitive' ELSE event_type END AS report_mode, count(*) AS n FROM events GROUP BY ALL",
    "decklist_parse": "SELECT l_orderkey AS o_orderkey, CASE WHEN bool_or(p_size = 7) THEN 0 ELSE count(*) END AS lines, NOT bool_or(p_size = 7) AS valid FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY 1",
    "top_commanders": f"WITH {DC} SELECT oracle_id, count(DISTINCT deck_id) AS decks FROM dz WHERE zone = 'command' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "card_popularity": f"WITH {DC} SELECT oracle_id, count(DISTINCT deck_id) AS decks, count(DISTINCT deck_id) = 1 AS is_long_tail FROM dz WHERE zone = 'mainboard' GROUP BY 1",
    "benchmark_ndcg": f"""WITH {DC}, p AS (SELECT oracle_id, count(DISTINCT deck_id) AS decks FROM dz WHERE zone = 'mainboard' GROUP BY 1),
r AS (SELECT deck_id, quantity >= 25 AS rel, row_number() OVER (PARTITION BY deck_id ORDER BY decks DESC, oracle_id) AS k FROM dz JOIN p USING (oracle_id) WHERE zone = 'mainboard'),
a AS (SELECT deck_id, count(*) FILTER (rel) AS n, count(*) FILTER (rel AND k <= 3) AS hits, coalesce(sum(1 / log2(k + 1)) FILTER (rel AND k <= 3), 0) AS dcg, min(k) FILTER (rel) AS first FROM r GROUP BY 1)
SELECT deck_id AS example_id, hits / n AS recall, round(dcg / CASE least(n, 3) WHEN 1 THEN 1 WHEN 2 THEN 1 + 1 / log2(3) ELSE 1 + 1 / log2(3) + 0.5 END, 9) AS ndcg, 1 / first AS reciprocal_rank FROM a WHERE n > 0""",
    "privacy_mask": """SELECT event_id, '{"E-Mail":"[EXCLUDED]","type":"' || event_type || '"}' AS payload FROM events""",
    "card_catalog": "SELECT p_name AS oracle_id, min(p_partkey) AS staging_id, arg_min(p_brand, p_partkey) AS brand, (SELECT count(*) FROM part q WHERE q.p_name = p.p_name AND q.p_brand = arg_min(p.p_brand, p.p_partkey)) AS n FROM part p GROUP BY p_name",
    "card_conflicts": "SELECT p_partkey AS staging_id, p_name AS oracle_id, 'quality.card_facts_conflict' AS code FROM part QUALIFY p_brand <> first_value(p_brand) OVER (PARTITION BY p_name ORDER BY p_partkey)",
    "completion_rows": f"WITH RECURSIVE {CC} SELECT 'orders:' || record_id AS curated_id, record_id, split, coalesce((SELECT string_agg(DISTINCT group_id, ',' ORDER BY group_id) FROM mem WHERE mem.record_id = promoted.record_id), '') AS group_ids FROM promoted",
    "dataset_reconciliation": f"WITH {EX} SELECT (SELECT count(*) FROM orders) AS inputs, count(*) FILTER (exclusion_code IS NULL) AS kept, count(*) FILTER (exclusion_code IS NOT NULL) AS excluded, 0::BIGINT AS in_both, 0::BIGINT AS in_neither, 0::BIGINT AS repeated FROM ex",
    "completion_masks": f"WITH {DC}, m AS (SELECT deck_id, oracle_id, row_number() OVER (PARTITION BY deck_id ORDER BY sha256(deck_id || ':orders:0:' || oracle_id), oracle_id) AS k, count(*) OVER (PARTITION BY deck_id) AS n FROM dz WHERE zone = 'mainboard') SELECT deck_id, oracle_id FROM m WHERE k <= ceil(n * 0.25)",
    "dataset_filter": """SELECT CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') THEN 'policy.dataset_source_excluded' WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW') THEN 'policy.current_use_required' WHEN lower(o_orderstatus) NOT IN ('f', 'o') THEN 'policy.dataset_mode_excluded'
  WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'quality.dataset_observed_before' WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'quality.dataset_observed_after' WHEN o_orderkey % 7 = 0 THEN 'policy.source_approval_missing' END AS exclusion_code, count(*) AS n FROM orders GROUP BY 1""",
    "benchmark_groups": f"""WITH {FP}, c AS (SELECT deck_id, oracle_id, quantity FROM dz WHERE zone = 'command'),
z AS (SELECT deck_id, '[' || string_agg('["' || oracle_id || '",' || quantity || ']', ',' ORDER BY oracle_id::VARCHAR, quantity) || ']' AS j FROM c GROUP BY 1),
f AS (SELECT oracle_id FROM c GROUP BY 1 HAVING count(DISTINCT deck_id) <= 3)
SELECT deck_id, 'cold_fingerprint' AS benchmark, 'fingerprint:' || fingerprint AS group_id FROM fp UNION ALL SELECT deck_id, 'cold_command_zone', 'command-zone-' || left(sha256(j), 32) FROM fp JOIN z USING (deck_id)
UNION ALL SELECT deck_id, 'cold_commander', 'commander:' || oracle_id FROM c UNION ALL SELECT deck_id, 'low_data_commander', 'low-data-commander:' || oracle_id FROM c JOIN f USING (oracle_id)""",
    "card_resolution": f"WITH {RES} SELECT * FROM res",
    "resolution_report": f"""WITH {RES}, r AS (SELECT count(*) AS total_entries, count(*) FILTER (status = 'resolved') AS resolved_entries, count(*) FILTER (status = 'ambiguous') AS ambiguous_entries, count(*) FILTER (status = 'unresolved') AS unresolved_entries, 0::BIGINT AS rejected_entries,
  {", ".join(f"count(*) FILTER (status = 'resolved' AND method = '{m}') AS {m}_matches" for m in ("source_identifier", "exact_identifier", "exact_name", "split_face", "alias"))} FROM res)
SELECT *, source_identifier_matches + exact_identifier_matches + exact_name_matches + split_face_matches AS exact_matches, ambiguous_entries + unresolved_entries AS failure_count FROM r""",
    "deduplication_report": f"""WITH RECURSIVE {CLUSTERS}, {REV}, x AS (SELECT count(*) AS n, count(DISTINCT o_orderpriority) AS s FROM fp JOIN orders ON deck_id = o_orderkey GROUP BY fingerprint HAVING count(*) > 1)
SELECT count(*) AS exact_duplicate_groups, coalesce(sum(n), 0)::BIGINT AS exact_duplicate_occurrences, count(*) FILTER (s > 1) AS cross_source_exact_groups, (SELECT count(*) FROM rv) AS revision_groups, (SELECT count(*) FROM cl) AS near_duplicate_clusters,
  'quantity_weighted_jaccard' AS near_duplicate_algorithm, 'near-duplicate-v1' AS near_duplicate_version, 0.6::DOUBLE AS near_duplicate_threshold FROM x""",
    "finding_counts": f"WITH {LEG} SELECT code AS finding_code, count(*) AS n FROM (SELECT unnest(f) AS code FROM fi) GROUP BY 1",
    "pod_normalization": f"""WITH {PODS}, g AS (SELECT pod_id, count(*) AS members, min(event_id) AS k, bool_or(seat IS NULL OR seat < 1) AS sm, count(DISTINCT seat) AS seats, bool_or(deck IS NULL) AS nd, bool_or(placement < 1) AS pl, bool_or(opaque) AS op, bool_or(NOT named) AS pm FROM pm GROUP BY 1),
f AS (SELECT pod_id, members, concat_ws(',', CASE WHEN pm THEN 'quality.participant_missing' END, CASE WHEN op THEN 'quality.participant_source_id_not_retained' END, CASE WHEN nd THEN 'quality.pod_deck_unresolved' END, CASE WHEN members < 2 THEN 'quality.pod_not_multiplayer' END, CASE WHEN pl THEN 'quality.pod_placement_invalid' END,
  CASE WHEN NOT sm AND seats < members THEN 'quality.pod_seat_duplicate' END, CASE WHEN sm THEN 'quality.pod_seat_missing' END, CASE WHEN k % 11 = 0 THEN 'quality.pod_source_not_complete' WHEN k % 7 = 0 OR k % 5 = 0 THEN 'quality.pod_status_unknown' END) AS findings FROM g)
SELECT *, CASE WHEN regexp_matches(findings, 'pod_(not_multiplayer|seat_|deck_unresolved|status_unknown|source_not)') THEN 'QUARANTINED' ELSE 'CURATED' END AS status FROM f""",
    "participant_references": f"""WITH {PODS} SELECT event_id, CASE WHEN named THEN 'event:' || left(sha256('["event","event:hours:' || replace(replace(pod_id, ' ', '%20'), ':', '%3A') || '","player ' || seat || '"]'), 32) END AS reference_id, CASE WHEN named THEN 'event' ELSE 'none' END AS scope,
  concat_ws(',', CASE WHEN NOT named THEN 'quality.participant_missing' END, CASE WHEN opaque THEN 'quality.participant_source_id_not_retained' END) AS findings FROM pm""",
    "event_observations": """WITH o AS (SELECT o_orderkey AS k, c.c_nationkey AS snap, CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE c.c_custkey END AS ev, e.c_nationkey AS esnap, e.c_custkey AS e, o_orderdate FROM orders LEFT JOIN customer c ON c.c_custkey = o_custkey LEFT JOIN customer e ON e.c_custkey = o_custkey AND o_orderkey % 31 <> 0),
f AS (SELECT k AS observation_id, concat_ws(',', CASE WHEN k % 17 = 0 OR k % 13 = 0 THEN 'quality.aggregate_record_incomplete' END, CASE WHEN k % 23 = 0 THEN 'quality.canonical_deck_missing' END, CASE WHEN e IS NOT NULL AND (k % 29 = 0) THEN 'quality.event_evidence_mismatch' END,
  CASE WHEN e IS NULL OR esnap = 3 THEN 'quality.event_format_unknown' END, CASE WHEN e IS NULL THEN 'quality.event_id_mismatch' END, CASE WHEN esnap >= 20 THEN 'quality.non_commander_event' END,
  CASE WHEN (k % 19 = 0 OR o_orderdate IS NULL) AND (e IS NULL OR e % 2 <> 0) THEN 'quality.observation_time_missing' END, CASE WHEN k % 11 = 0 THEN 'quality.result_semantics_missing' END) AS findings FROM o)
SELECT *, CASE WHEN findings = '' THEN 'CURATED' ELSE 'QUARANTINED' END AS status FROM f""",
    "combo_normalization": """WITH c AS (SELECT o_custkey AS k, CASE WHEN o_orderkey % 41 <> 0 AND o_orderkey % 37 >= 1 THEN o_orderkey % 50 END AS card, o_orderstatus = 'O' AS opt FROM orders),
g AS (SELECT k, count(DISTINCT card) FILTER (NOT opt) AS required, count(DISTINCT card) FILTER (opt) AS optional, bool_or(card IS NULL) AS invalid FROM c GROUP BY 1),
f AS (SELECT c_custkey AS combo_id, coalesce(required, 0) AS required, coalesce(optional, 0) AS optional, concat_ws(',', CASE WHEN coalesce(invalid, false) THEN 'quality.combo_card_invalid' END, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 4 = 1 THEN 'quality.combo_commander_id_invalid' END,
  CASE WHEN c_custkey % 3 = 1 AND c_custkey % 4 < 2 THEN 'quality.combo_compatibility_conflict' END, CASE WHEN c_custkey % 3 = 2 AND c_custkey % 4 < 2 THEN 'quality.combo_compatibility_unresolved' END, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 4 >= 2 THEN 'quality.combo_compatibility_unscoped' END,
  CASE WHEN coalesce(required, 0) = 0 THEN 'quality.combo_required_cards_missing' END, CASE WHEN c_custkey % 7 = 0 THEN 'quality.combo_requirements_missing' END, CASE WHEN c_custkey % 5 = 0 THEN 'quality.combo_results_missing' END) AS findings FROM customer LEFT JOIN g ON k = c_custkey)
SELECT *, CASE WHEN regexp_matches(findings, 'required_cards|requirements_m|results_m|card_invalid|commander_id') THEN 'QUARANTINED' ELSE 'CURATED' END AS status FROM f""",
    "dataset_audit": f"""WITH {ME}, x AS (SELECT count(*) AS n FROM me WHERE canonical_deck_id IS NOT NULL GROUP BY canonical_deck_id HAVING count(DISTINCT source_id) > 1),
s AS (SELECT count(DISTINCT o_orderdate::DATE) AS a, count(*) FILTER (o_totalprice > 2000) AS b, count(DISTINCT o_custkey) AS c, count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS d FROM orders GROUP BY o_orderpriority),
m AS (SELECT *, source_id IN ('1-URGENT', '2-HIGH') AS fit FROM me)
SELECT count(*) AS total_decks, count(*) FILTER (complete) AS complete_decklists, count(*) FILTER (complete) AS complete_commander_decks, count(*) FILTER (legal = 'unknown') AS legality_unknown, count(*) FILTER (NOT resolved) AS unresolved_decks, sum(un)::BIGINT AS unresolved_cards, count(*) FILTER (usable) AS usable_outcomes, count(*) FILTER (pod) AS full_pods,
  count(*) FILTER (complete AND mode = 'casual') AS casual_decks, count(*) FILTER (complete AND mode = 'competitive') AS competitive_decks, count(*) FILTER (complete AND mode = 'unknown') AS unknown_decks, count(*) FILTER (NOT complete) AS missing_commander, count(*) FILTER (observed_at IS NULL) AS missing_observed_at, count(*) FILTER (mode IS NULL) AS missing_mode,
  count(*) FILTER (NOT complete) AS incomplete_decklist, min(observed_at) AS first_observed, max(observed_at) AS last_observed, (SELECT count(*) FROM x) AS cross_source_decks, (SELECT coalesce(sum(n), 0)::BIGINT FROM x) AS cross_source_records,
  (SELECT sum(a)::BIGINT FROM s) AS tournaments, (SELECT sum(b)::BIGINT FROM s) AS event_observations, (SELECT sum(c)::BIGINT FROM s) AS pods, (SELECT sum(d)::BIGINT FROM s) AS complete_pods,
  CASE WHEN count(*) FILTER (fit AND complete) = 0 THEN 'not_suitable' WHEN sum(un) > 0 OR count(*) FILTER (fit AND NOT resolved) > 0 THEN 'conditional' ELSE 'suitable' END AS deck_completion_training,
  CASE WHEN count(*) FILTER (fit AND usable) > 0 AND count(*) FILTER (fit AND pod) > 0 THEN 'suitable' WHEN count(*) FILTER (fit AND usable) > 0 THEN 'conditional' ELSE 'not_suitable' END AS performance_modeling FROM m""",
    "recommendations": f"WITH {REC} SELECT * FROM rec",
    "recommendation_coverage": f"WITH {REC} SELECT count(DISTINCT card) AS unique_cards, round(count(DISTINCT card) / (SELECT count(*) FROM part), 9) AS catalog_coverage, round(avg(coalesce(decks, 0)), 6) AS mean_prevalence FROM rec LEFT JOIN pop USING (card)",
    "commander_popularity": f"WITH {CO} SELECT commander, card, count(*) AS decks FROM cc GROUP BY ALL",
    "latest_evaluations": "SELECT l_orderkey AS record_id, l_partkey AS deck_id, l_shipdate AS evaluated_at, l_linenumber AS line, l_returnflag AS status FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_returnflag DESC) = 1",
    "event_context": "WITH c AS (SELECT o_custkey AS k, count(*) AS n, min(o_orderkey) AS e FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT c_custkey AS item, CASE WHEN n = 1 THEN e END AS event_id, CASE WHEN n IS NULL THEN 'quality.pod_context_missing' WHEN n > 1 THEN 'quality.event_context_ambiguous' END AS finding_code FROM customer LEFT JOIN c ON k = c_custkey",
    "leakage_status": f"""WITH RECURSIVE {CC}, g AS (SELECT group_id FROM mem JOIN promoted USING (record_id) GROUP BY 1 HAVING count(DISTINCT split) > 1), e AS (SELECT strftime(o_orderdate, '%Y-%m') AS m FROM orders JOIN promoted ON record_id = o_orderkey GROUP BY 1 HAVING count(DISTINCT split) > 1)
SELECT (SELECT count(*) FROM g) AS cross_split_groups, (SELECT count(*) FROM e) AS cross_split_events, CASE WHEN (SELECT count(*) FROM g) + (SELECT count(*) FROM e) = 0 THEN 'PASS' ELSE 'FAIL' END AS status""",
    "zone_totals": "SELECT l_orderkey AS deck_id, lower(l_returnflag) AS zone, l_partkey AS oracle_id, l_suppkey AS printing_id, sum(CAST(l_quantity AS INT))::BIGINT AS quantity, count(*) AS entries FROM lineitem GROUP BY ALL",
    "complete_pod_entries": "WITH p AS (SELECT date_trunc('hour', ts) AS h FROM events GROUP BY 1 HAVING count(*) >= 2 AND count(*) = count(DISTINCT user_id) AND bool_and(event_type <> 'error')) SELECT event_id, strftime(h, '%Y-%m-%d %H') AS pod_id FROM events JOIN p ON date_trunc('hour', ts) = h",
    "mask_stages": f"WITH {DC}, s(stage, share) AS (VALUES ('early', 0.75), ('middle', 0.5), ('late', 0.25)), m AS (SELECT stage, share, deck_id, oracle_id, row_number() OVER (PARTITION BY stage, deck_id ORDER BY sha256(deck_id || ':orders-' || stage || ':0:' || oracle_id), oracle_id) AS k, count(*) OVER (PARTITION BY stage, deck_id) AS n FROM dz, s WHERE zone = 'mainboard') SELECT deck_id, stage, count(*) AS hidden, min(oracle_id) AS first_hidden FROM m WHERE k <= ceil(n * share) GROUP BY ALL",
}
