import json

import pytest
from pyspark.sql import types as T

from cardloom.sources import nested, tables
from cardloom.streaming import intake


def raw(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return nested.raw_objects(spark, str(tmp_path / name))


def test_cards(spark, tmp_path):
    card = {"uuid": "u1", "name": "Fire // Ice", "cardParts": ["Fire", "Ice"], "legalities": {"commander": "Legal"}}
    face = {"uuid": "u2", "name": "Day", "faceName": "Day", "side": "a"}
    got = nested.cards(raw(spark, tmp_path, "a.json", json.dumps({"meta": {}, "data": {"X/1": {"code": "X", "releaseDate": "2020-02-03", "cards": [card, face]}}})))
    assert [(r.uuid, r.locator, str(r.released_at)) for r in got.orderBy("uuid").collect()] == [("u1", "/data/X~11/cards/0", "2020-02-03"), ("u2", "/data/X~11/cards/1", "2020-02-03")]
    assert sorted((r.face_id, r.face_name) for r in nested.faces(got).collect()) == [("u1#part-0", "Fire"), ("u1#part-1", "Ice"), ("u2", "Day")]


def test_deck_product(spark, tmp_path):
    got = nested.deck_product_cards(raw(spark, tmp_path, "d.json", json.dumps({"name": "D", "commander": [{"name": "A", "count": 1}], "mainBoard": [{"name": "B", "count": 99}], "sideBoard": []})))
    assert sorted((r.zone, r.name, r.quantity) for r in got.collect()) == [("command", "A", 1), ("mainboard", "B", 99)]


def test_events(spark, tmp_path):
    event = {"TID": "t", "startDate": "2024-05-01T00:00:00Z", "attendees": [{"email": "x@example.org"}], "standings": [{"player_id": "p", "place": 1}], "rounds": [{"round": 1, "tables": [{"tableId": "1", "winner_id": "p", "players": [{"player_id": "p", "seat": 1}, {"player_id": "q"}]}, {"tableId": "2", "players": [{"player_id": "r"}]}]}]}
    rows = nested.events(raw(spark, tmp_path, "e.json", json.dumps([event])))
    assert "attendees" not in rows.columns
    assert [(r.event_id, r.place, r.locator) for r in nested.standings(rows).collect()] == [("t", 1, "/0/standings/0")]
    got = nested.pod_entries(rows).orderBy("pod_id", "seat").collect()
    assert [(r.pod_id, r.seat, r.won, r.finding_code) for r in got] == [("1", 1, True, None), ("1", 2, False, None), ("2", 1, None, "parse.topdeck_ambiguous_result_semantics")]


def test_combos_and_ndjson(spark, tmp_path):
    got = nested.combos(raw(spark, tmp_path, "c.json", json.dumps({"results": [{"id": "1", "uses": [], "produces": ["x"]}]}))).first()
    assert got.findings == ["parse.combo_uses_missing"]
    (tmp_path / "n.ndjson").write_text('{"TID":"a"}\n{broken\n{"TID":"b"}\n')
    rows = nested.ndjson(spark, str(tmp_path / "n.ndjson"), nested.TOURNAMENT).collect()
    assert sorted((r.doc.TID if r.doc else "", r.finding_code) for r in rows) == [("", "parse.malformed_json"), ("a", None), ("b", None)]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, x string")
    m = tables.write_immutable(df, str(tmp_path / "t"), ["id"])
    assert m["rows"] == 2 and tables.verify(spark, m) and not tables.verify(spark, m | {"digest": "0"})
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_immutable(df, str(tmp_path / "t"), ["id"])
    with pytest.raises(ValueError, match="repeated"):
        tables.write_immutable(df.union(df), str(tmp_path / "u"), ["id"])
    o = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "path string, bytes long, sha256 string")
    e = spark.createDataFrame([("a", 1, "z"), ("c", 1, "y")], "path string, bytes long, sha256 string")
    assert {r.path: r.code for r in tables.verify_objects(o, e).collect()} == {"a": "integrity.sha256_mismatch", "b": "integrity.object_unexpected", "c": "integrity.object_missing"}


def test_stream(spark, tmp_path):
    schema = T.StructType.fromDDL("record_id long, observed_at timestamp")
    spark.sql("select 1L as record_id, timestamp'2024-01-01' as observed_at union all select 1L, timestamp'2024-01-01' union all select 2L, timestamp'2024-01-02'").write.parquet(str(tmp_path / "in"))
    intake.append(intake.new_records(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
