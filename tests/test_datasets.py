import datetime
import io
import zipfile

from pyspark.sql import functions as F

from cardloom.operators import catalog, datasets
from cardloom.sources import strict


def test_filters_and_reconciliation(spark):
    t = datetime.datetime
    rows = spark.createDataFrame([(1, "a", "casual", t(2024, 1, 1)), (2, "b", "casual", t(2024, 1, 1)), (3, "a", None, t(2024, 1, 1)), (4, "a", "casual", t(2020, 1, 1)), (5, "a", "casual", None)], "record_id long, source_id string, mode string, observed_at timestamp_ntz")
    out = datasets.filter_records(rows, sources=["a"], modes=["casual"], observed_from="2023-01-01").cache()
    assert {r.record_id: r.exclusion_code for r in out.collect()} == {1: None, 2: "policy.dataset_source_excluded", 3: "policy.dataset_mode_excluded", 4: "quality.dataset_observed_before", 5: "quality.dataset_observed_before"}
    kept, gone = out.where("exclusion_code is null"), out.where("exclusion_code is not null")
    assert tuple(datasets.reconcile(rows, kept, gone, "record_id").first()) == (5, 1, 4, 0, 0, 0)
    assert datasets.reconcile(rows, kept, gone.where("record_id > 2"), "record_id").first().in_neither == 1


def test_rows_and_masks(spark):
    cards = spark.createDataFrame([("d", "command", "a", 1), *[("d", "mainboard", x, 1) for x in "bcdefghi"]], "deck_id string, zone string, oracle_id string, quantity int")
    where = spark.createDataFrame([("d", "train")], "record_id string, split string")
    groups = spark.createDataFrame([("d", "near:x"), ("d", "exact:y")], "record_id string, group_id string")
    assert tuple(datasets.completion_rows("ds", where, groups).first()) == ("ds:d", "d", "train", ["exact:y", "near:x"])
    rows = datasets.cooccurrence_rows("ds", cards, where)
    assert rows.count() == 8 + 28 and rows.where("curated_id = 'ds:d:card_card:b:c'").count() == 1
    one, two = (sorted(r.oracle_id for r in datasets.masks(cards, "ds", i).where("masked").collect()) for i in (0, 1))
    assert len(one) == len(two) == 2 and "a" not in one + two


def test_catalog(spark):
    rows = spark.createDataFrame([("s1", "o", "x", 1), ("s2", "o", "x", 1), ("s3", "o", "y", 1), ("s4", "p", None, 2)], "staging_id string, oracle_id string, name string, value int")
    cards, conflicts = catalog.merge_cards(rows, ["name", "value"])
    assert sorted(map(tuple, cards.collect())) == [("o", "s1", "x", 1, 2), ("p", "s4", None, 2, 1)]
    assert [tuple(r) for r in conflicts.collect()] == [("s3", "o", "quality.card_facts_conflict")]
    last = catalog.merge_provenance(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, n int, v string"), ["k"], ["n"])
    assert [tuple(r) for r in last.collect()] == [("a", 2, "y")]


def test_strict(spark):
    texts = spark.createDataFrame([(1, '{"a":1,"a":2}'), (2, "[NaN]"), (3, "{"), (4, '{"a":{"b":1}}'), (5, None)], "id long, text string")
    assert {r.id: r.findings for r in strict.json_findings(texts).collect()} == {1: ["parse.duplicate_key"], 2: ["parse.non_finite_number"], 3: ["parse.malformed_json"], 4: [], 5: ["parse.malformed_json"]}
    files = spark.createDataFrame([("f", bytearray("é\r\n\nxy".encode()))], "path string, content binary")
    assert [(r.line, r.start, r.end, r.text) for r in strict.line_ranges(files).collect()] == [(0, 0, 2, "é"), (2, 5, 7, "xy")]
    masked = spark.createDataFrame([('{"x":[{"E-Mail":"a","n":1}]}',), ("{",)], "j string").select(strict.mask_json(F.col("j")).alias("j")).collect()
    assert [r.j for r in masked] == ['{"x":[{"E-Mail":"[EXCLUDED]","n":1}]}', None]


def test_archives(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.json", "{}")
        z.writestr("../b.json", "{}")
        z.writestr("c.json", "0" * 1_000_000)
    files = spark.createDataFrame([("z", bytearray(out.getvalue())), ("n", bytearray(b"no"))], "path string, content binary")
    got = {(r.path, r.member): r.finding_code for r in strict.archive_members(files).collect()}
    assert got == {("z", "a.json"): None, ("z", "../b.json"): "integrity.archive_path_unsafe", ("z", "c.json"): "integrity.archive_ratio_exceeded", ("n", None): "integrity.archive_unreadable"}
