"""What near-duplicate groups, splits and resolution keep and read on the way to their results."""

import random
from pathlib import Path

from cardloom.operators import decks, graph, resolution


def test_only_near_decks_meet(spark, monkeypatch):
    """Pairs are those of brute force, and few others are looked at although every deck shares its rarest cards with others."""
    r, rows = random.Random(1), []
    for i in range(300):
        cards = {f"rare{i % 60}": r.randint(10, 20), **{f"c{r.randrange(4000)}": r.randint(1, 30) for _ in range(r.randint(3, 60))}}
        if i % 10 == 9:
            cards = {c: max(1, q + r.randint(-1, 1)) for c, q in last.items()}
        last = cards
        rows += [(i, "mainboard", c, q) for c, q in cards.items()]
    whole, seen = {}, {}
    for i, _, c, q in rows:
        whole.setdefault(i, {})[c] = q
    want = {}
    for a in whole:
        for b in whole:
            if a < b:
                m = sum(min(q, whole[b].get(c, 0)) for c, q in whole[a].items())
                j = m / (sum(whole[a].values()) + sum(whole[b].values()) - m)
                if j >= 0.55:
                    want[a, b] = round(j, 9)
    keep = decks.written
    monkeypatch.setattr(decks, "written", lambda df, tag: seen.setdefault(tag, keep(df, tag)))
    got = decks.near_duplicate_pairs(spark.createDataFrame(rows, "deck_id long, zone string, oracle_id string, quantity int"), 0.55)
    assert {(x.left_id, x.right_id): round(x.similarity, 9) for x in got.collect()} == want and len(want) > 20
    assert seen["near"].count() <= 4 * len(want)  # 600 pairs share a rare card


def test_components_leave_one_table(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    was = set(shared.iterdir())
    got = graph.connected_components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
    assert {x.component for x in got.collect()} == {0}
    assert len(set(shared.iterdir()) - was) == 1


def test_names_with_many_candidates(spark):
    """An item meets the number of its name's candidates, not the list of them."""
    names = spark.range(300).selectExpr("'Ring' as name", "cast(id as string) as oracle_id", "cast(null as string) as printing_id", "cast(null as string) as face_id")
    items = spark.range(50).selectExpr("cast(id as string) as item_id", "'ring' as value", "cast(array() as array<struct<priority:int,name:string,value:string>>) as identifiers")
    ids = names.limit(0).selectExpr("name", "name as value", "oracle_id", "printing_id", "face_id")
    got = resolution.resolve(items, ids, names, names.where("oracle_id < 20"), names.limit(0))
    assert {tuple(r)[1:] for r in got.collect()} == {("exact_name", "ambiguous", None, None, None, 300, "resolution.ambiguous_name")}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "Expand" not in plan
