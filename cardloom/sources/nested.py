"""Raw nested JSON to one row for each record: card sets, deck products, tournaments, combos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import event_time

CARD = "struct<uuid:string,name:string,setCode:string,number:string,layout:string,manaCost:string,manaValue:double,colors:array<string>,colorIdentity:array<string>,type:string,keywords:array<string>,text:string,faceName:string,side:string,cardParts:array<string>,legalities:map<string,string>,identifiers:map<string,string>>"
CARD_SETS = f"data map<string,struct<code:string,name:string,releaseDate:string,cards:array<{CARD}>>>"
ENTRY = "struct<name:string,count:int>"
DECK_PRODUCT = f"name string, code string, releaseDate string, type string, commander array<{ENTRY}>, mainBoard array<{ENTRY}>, sideBoard array<{ENTRY}>"
PLAYER = "struct<player_id:string,seat:int,result:string>"
TABLE = f"struct<tableId:string,winner_id:string,status:string,players:array<{PLAYER}>>"
STANDING = "struct<player_id:string,name:string,decklist:string,place:int,wins:int,losses:int,draws:int>"
TOURNAMENT = f"TID string, tournamentName string, startDate string, format string, standings array<{STANDING}>, rounds array<struct<round:int,tables:array<{TABLE}>>>"
COMBO = "id string, status string, description string, uses array<struct<card:struct<oracleId:string,name:string>,quantity:int>>, produces array<string>"


def raw_objects(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256, text of every raw file; contents stay on the executors that read them."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.col("content").cast("string").alias("text"))


def parsed(raw: DataFrame, schema: str, column: str = "text") -> DataFrame:
    """raw with doc (null where the text isn't such JSON) and finding_code."""
    doc = F.from_json(column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    ok = F.try_parse_json(F.col(column)).isNotNull()
    return raw.withColumn("doc", F.when(ok, doc)).withColumn("finding_code", F.when(~ok, "parse.malformed_json"))


def pointer(*parts: Column | str) -> Column:
    """A JSON pointer; / and ~ in parts are escaped."""
    escape = lambda c: F.replace(F.replace(c.cast("string"), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    return F.concat(*[x for p in parts for x in (F.lit("/"), F.lit(p) if isinstance(p, str) else escape(p))])


def cards(raw: DataFrame) -> DataFrame:
    """A row for each card of each set, with its locator."""
    sets = parsed(raw, CARD_SETS).where("doc is not null").select("path", F.explode("doc.data").alias("set_code", "s"))
    each = sets.select("path", "set_code", "s.releaseDate", F.posexplode("s.cards").alias("i", "card"))
    return each.select("path", pointer("data", F.col("set_code"), "cards", F.col("i")).alias("locator"), "set_code", F.to_date("releaseDate").alias("released_at"), "card.*")


def faces(card_rows: DataFrame) -> DataFrame:
    """A row for each face: rows with a face name or a side, and the parts of split cards as id#part-i."""
    own = card_rows.where("faceName is not null or side is not null").select(F.col("uuid").alias("face_id"), F.coalesce("faceName", "name").alias("face_name"), "side")
    parts = card_rows.where("faceName is null and side is null").select("uuid", F.posexplode("cardParts").alias("i", "face_name"))
    return own.unionByName(parts.select(F.concat("uuid", F.lit("#part-"), "i").alias("face_id"), "face_name", F.lit(None).cast("string").alias("side")))


def deck_product_cards(raw: DataFrame) -> DataFrame:
    """deck, zone, name, quantity of deck products."""
    d = parsed(raw, DECK_PRODUCT).where("doc is not null").select("path", "doc.*")
    zones = [d.select("path", F.col("name").alias("deck"), F.lit(z).alias("zone"), F.explode(c).alias("e")) for c, z in (("commander", "command"), ("mainBoard", "mainboard"), ("sideBoard", "sideboard"))]
    out = zones[0].unionByName(zones[1]).unionByName(zones[2])
    return out.select("path", "deck", "zone", "e.name", F.col("e.count").alias("quantity"))


def events(raw: DataFrame) -> DataFrame:
    """A row for each tournament of files that hold an array of them; personal fields are never read."""
    many = parsed(raw, f"array<struct<{_inline(TOURNAMENT)}>>").where("doc is not null")
    rows = many.select("path", F.posexplode("doc").alias("i", "e"))
    return rows.select("path", pointer(F.col("i")).alias("locator"), "e.*").withColumn("observed_at", event_time(F.col("startDate")))


def _inline(ddl: str) -> str:
    out, depth = [], 0
    fields, start = [], 0
    for i, c in enumerate(ddl):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            fields.append(ddl[start:i])
            start = i + 1
    for f in [*fields, ddl[start:]]:
        name, kind = f.strip().split(" ", 1)
        out.append(f"{name}:{kind}")
    return ",".join(out)


def standings(event_rows: DataFrame) -> DataFrame:
    return event_rows.select(F.col("TID").alias("event_id"), "observed_at", F.posexplode("standings").alias("i", "s"), "locator").select("event_id", "observed_at", F.concat("locator", F.lit("/standings/"), "i").alias("locator"), "s.*")


def pod_entries(event_rows: DataFrame) -> DataFrame:
    """A row for each seat of each table of each round; a table without winner, status and results gets a finding."""
    r = event_rows.select(F.col("TID").alias("event_id"), F.posexplode("rounds").alias("r", "round"))
    t = r.select("event_id", "r", F.col("round.round").alias("round_number"), F.posexplode("round.tables").alias("t", "table"))
    silent = F.col("table.winner_id").isNull() & F.col("table.status").isNull() & ~F.exists("table.players", lambda p: p["result"].isNotNull())
    rows = t.withColumn("finding_code", F.when(silent, "parse.topdeck_ambiguous_result_semantics")).select("*", F.posexplode("table.players").alias("p", "player"))
    return rows.select("event_id", "round_number", F.col("table.tableId").alias("pod_id"), F.coalesce("player.seat", F.col("p") + 1).alias("seat"), "player.player_id", "player.result", (F.col("player.player_id") == F.col("table.winner_id")).alias("won"), "finding_code")


def combos(raw: DataFrame) -> DataFrame:
    """A row for each combo of a page (results) or a bulk file (variants); missing fields and empty lists are findings."""
    kind = f"array<struct<{_inline(COMBO)}>>"
    p = parsed(raw, f"results {kind}, variants {kind}").where("doc is not null")
    rows = p.select("path", F.posexplode(F.coalesce("doc.variants", "doc.results")).alias("i", "c")).select("path", "i", "c.*")
    codes = F.array_compact(F.array(F.when(F.col("id").isNull(), "parse.combo_id_missing"), F.when(F.coalesce(F.size("uses"), F.lit(0)) < 1, "parse.combo_uses_missing"), F.when(F.coalesce(F.size("produces"), F.lit(0)) < 1, "parse.combo_produces_missing")))
    return rows.withColumn("findings", codes)


def ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A row for each line, bad ones with a finding; the scan goes on."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).where(F.trim("text") != "")
    return parsed(lines, schema)
