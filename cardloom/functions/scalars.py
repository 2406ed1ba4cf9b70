"""Column functions of the domain: names, modes, results, dates, decklists, codes."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The results of a pod seat and what they mean.
RESULTS = {"win": "win", "won": "win", "winner": "win", "first": "win", "loss": "loss", "lost": "loss", "draw": "draw", "tie": "draw", "bye": "bye", "unknown": "unknown", "second": "loss", "third": "loss", "fourth": "loss"}
PLACEMENTS = {"winner": 1, "first": 1, "second": 2, "third": 3, "fourth": 4}
UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def name_key(c: Column) -> Column:
    """Lower case, single spaces: what full Unicode folding gives for ASCII names."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


@F.pandas_udf(StringType())
def unicode_name_key(names: pd.Series) -> pd.Series:
    """NFKC, casefold, single spaces; for names that aren't ASCII."""
    return names.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKC", x).casefold().split()))


def name_key_any(c: Column) -> Column:
    return F.when(c.rlike(r"^[\x00-\x7F]*$"), name_key(c)).otherwise(unicode_name_key(c))


def first_text(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def mode(c: Column, for_report: bool = False) -> Column:
    m = F.lower(F.trim(c))
    competitive = ["cedh", "tournament"] if for_report else ["cedh"]
    return F.when(m.isNull() | (m == ""), "unknown").when(m.isin(competitive), "competitive").otherwise(m)


def pod_result(c: Column, player: Column | None = None, winner: Column | None = None, winners_at_table: Column | None = None) -> Column:
    """A seat's result. Where it is missing or unknown, a table's winner id decides, if just one player of the table has it."""
    r = F.lower(F.trim(c))
    named = F.when(r.isNull(), "unknown").otherwise(F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in RESULTS.items() for x in kv]), r), F.lit("ambiguous")))
    if player is None:
        return named
    return F.when((named == "unknown") & player.isNotNull() & winner.isNotNull() & (winners_at_table == 1), F.when(player == winner, "win").otherwise("loss")).otherwise(named)


def placement(c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in PLACEMENTS.items() for x in kv]), F.lower(F.trim(c)))


def positive_int(c: Column) -> Column:
    n = F.trim(c.cast("string")).try_cast("int")
    return F.when(n > 0, n).otherwise(0)


def event_time(c: Column) -> Column:
    """Epoch seconds, epoch milliseconds over 1e11, or ISO-8601 (without a zone: UTC)."""
    n = c.try_cast("double")
    return F.when(n > 1e11, F.timestamp_millis(n.cast("long"))).when(n.isNotNull(), F.timestamp_seconds(n)).otherwise(F.try_to_timestamp(c))


def decklist(text: Column) -> Column:
    """array<struct<quantity, name>> of lines `quantity name`; null when a line is anything else."""
    lines = F.filter(F.split(text, r"\r\n|\n|\r"), lambda x: F.trim(x) != "")
    line = r"^\s*([1-9][0-9]*)\s+(\S.+?)\s*$"
    rows = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, line, 1).try_cast("int").alias("quantity"), F.regexp_extract(x, line, 2).alias("name")))
    return F.when(F.size(lines) > 0, F.when(F.forall(lines, lambda x: x.rlike(line)), rows))


def type_line(c: Column) -> Column:
    """struct(supertypes, types, subtypes)."""
    halves = F.split(F.regexp_replace(c, "—", "-"), "-", 2)
    left = F.filter(F.split(F.trim(halves[0]), r"\s+"), lambda w: w != "")
    # The supertypes.
    fixed = F.array(*[F.lit(x) for x in ("Basic", "Legendary", "Snow", "World")])
    right = F.when(F.size(halves) > 1, F.filter(F.split(F.trim(F.get(halves, F.lit(1))), r"\s+"), lambda w: w != "")).otherwise(F.array().cast("array<string>"))
    return F.struct(F.filter(left, lambda w: F.array_contains(fixed, w)).alias("supertypes"), F.filter(left, lambda w: ~F.array_contains(fixed, w)).alias("types"), right.alias("subtypes"))


def findings(*conditions: tuple[Column, str]) -> Column:
    """The sorted codes of the conditions that hold."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in conditions])))


def first_code(*conditions: tuple[Column, str]) -> Column:
    """The code of the first condition that holds."""
    return F.coalesce(*[F.when(c, F.lit(code)) for c, code in conditions])


def masked(values: Column, markers: tuple[str, ...] = ("email", "discord", "phone", "name")) -> Column:
    """map<string,string> with the values of keys that name personal data replaced."""
    fold = lambda k: F.regexp_replace(F.lower(k), r"[^\p{L}\p{N}]", "")
    return F.transform_values(values, lambda k, v: F.when(fold(k).rlike("|".join(markers)), "[EXCLUDED]").otherwise(v))
