"""Quality rules: figures of each text, and lines that many documents of a host share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut, table

SPACE = b" \t\n\v\f\r"
NOT_CODE_POINTS = SPACE + bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
WINDOW, FEWEST_WORDS, MOST_REPEATED = 8, 20, 30
#: A line is boilerplate of a host when over MOST_DOCS distinct texts and over MOST_SHARE of its distinct texts hold it.
MOST_DOCS, MOST_SHARE = 30, 0.01
#: A document is depleted when less than LEAST_LEFT of its words is left.
LEAST_LEFT = 0.3
FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(w: list[bytes], k: int = WINDOW) -> int:
    """Words in k-word windows that occur twice or more, the first included."""
    n = len(w) - k + 1
    if n < 2 or len(set(w)) == len(w):
        return 0
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(x, len(ids)) for x in w], np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + (a[j : j + n] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    seen, mark = {}, np.zeros(len(w), bool)
    for i in np.flatnonzero(twice):  # equal hashes are compared word by word
        first = seen.setdefault(tuple(w[i : i + k]), i)
        if first != i:
            mark[first : first + k] = mark[i : i + k] = True
    return int(mark.sum())


def figures(text: bytes | None) -> tuple[tuple, list[int], list[int]]:
    """The five figures; the hashes and word counts of the distinct normalised lines with a word."""
    text = text or b""
    seen, dups, lines = set(), 0, {}
    for line in text.split(b"\n"):
        w = line.split()
        if w:
            dups += line in seen
            seen.add(line)
            h = xxhash.xxh3_64_intdigest(b" ".join(w).lower()) - (1 << 63)
            lines[h] = lines.get(h, 0) + len(w)
    w = text.split()
    return (len(w), len(text.translate(None, NOT_CODE_POINTS)), len(text) - len(text.translate(None, SYMBOLS)), dups, repeated_words(w)), list(lines), list(lines.values())


def measured(docs: DataFrame, host: str) -> DataFrame:
    """For each row: __rid, its host and a hash of its text, FIGURES, and the distinct lines' hashes and words."""
    docs = docs.select("doc_id", F.coalesce(F.col(host), F.lit("")).alias("host"), "text", F.monotonically_increasing_id().alias("__rid"))
    schema = StructType([*[f for f in docs.schema if f.name != "text"], *StructType.fromDDL(f"text_hash long, {FIGURES}, lines array<long>, line_words array<long>").fields])

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got = [figures(t) for t in texts]
            out = [batch.column(f) for f in ("doc_id", "host", "__rid")] + [pa.array([xxhash.xxh3_64_intdigest(t or b"") - (1 << 63) for t in texts], pa.int64())]
            out += [pa.array([g[0][i] for g in got], pa.int64()) for i in range(5)]
            out += [pa.array([g[i] for g in got], pa.list_(pa.int64())) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, schema)


def boilerplate(rows: DataFrame, most_docs: int, most_share: float) -> DataFrame:
    """host, line of the lines over the limits. Equal texts of a host count as one document."""
    per_host = rows.groupBy("host", "text_hash").agg(F.min("__rid").alias("__rid"))
    firsts = cut(per_host, "quality-texts")
    n = firsts.groupBy("host").agg(F.count("*").alias("texts"))
    # first copies only; both sides come from written tables, so a hot text can be split
    lines = rows.select("__rid", "host", "text_hash", "lines").join(firsts, ["__rid", "host", "text_hash"], "left_semi").select("host", F.explode("lines").alias("line"))
    shared = lines.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > most_docs)
    return cut(cut(shared, "quality-shared").join(cut(n, "quality-hosts"), "host").where(F.col("docs") > most_share * F.col("texts")).select("host", "line"), "quality-lines")


def judge(docs: DataFrame, host: str = "source", most_docs: int = MOST_DOCS, most_share: float = MOST_SHARE, least_left: float = LEAST_LEFT) -> DataFrame:
    """For each row of docs: __rid, doc_id, the five figures, base_failed, n_line_words (words in removed lines), removed (the lines' hashes), kept.

    Lines are normalised by A-Z lower-casing and single spaces and counted by host: in how many distinct texts each
    occurs. Lines over both limits are removed; a document with less than least_left of its words left is depleted
    and rejected, and so is one that fails the base rules. A null host is the empty one. Null and empty texts have no words and fail.
    """
    rows = cut(measured(docs, host), "quality-measured")
    bad = boilerplate(rows, most_docs, most_share)
    each = rows.select("__rid", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("__rid", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    removed = each.join(bad, ["host", "line"]).groupBy("__rid").agg(F.sum("words").alias("n_line_words"), F.collect_set("line").alias("removed"))
    out = rows.drop("lines", "line_words", "host", "text_hash").join(removed, "__rid", "left").withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)))
    out = out.withColumn("base_failed", F.expr(f"n_words < {FEWEST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & ((F.col("n_words") - F.col("n_line_words")) >= least_left * F.col("n_words")))


def op8_quality(spark, sf_dir) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_line_words")


def without_lines(text: bytes, removed: set[int]) -> bytes:
    """The text without the lines whose hash, as in figures(), is removed."""

    def stays(line):
        w = line.split()
        return not w or xxhash.xxh3_64_intdigest(b" ".join(w).lower()) - (1 << 63) not in removed

    return b"\n".join(filter(stays, text.split(b"\n")))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The documents that the rules keep, without the lines over the limits, in their own columns; n_chars follows a text that changed."""
    verdicts = cut(judge(docs, **limits).where("kept").select("__rid", F.col("removed").alias("__removed")), "quality-kept")
    rows = docs.withColumn("__rid", F.monotonically_increasing_id()).join(verdicts, "__rid").drop("__rid").withColumn("text", F.col("text").cast("binary"))

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("text")
            texts = [t if not gone else without_lines(t, set(gone)) for t, gone in zip(b.column(at).to_pylist(), b.column("__removed").to_pylist(), strict=True)]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    out = rows.mapInArrow(run, rows.schema).withColumn("text", F.col("text").cast("string"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__removed").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS s FROM w, unnest(range(1, len(ws) - {WINDOW} + 2)) AS x(i)),
h AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, s) > 1),
p AS (SELECT rid, count(DISTINCT k) AS n FROM h, unnest(range(i, i + {WINDOW})) AS x(k) GROUP BY 1),
l AS (SELECT rid, host, t, translate(array_to_string(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n FROM w, unnest(ls) AS y(x)),
m AS (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY 1),
b AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT t) AS docs FROM l GROUP BY ALL) JOIN m USING (host) WHERE docs > {MOST_DOCS} AND docs > {MOST_SHARE}::DOUBLE * texts),
o AS (SELECT rid, sum(n) AS n FROM l JOIN b USING (host, line) GROUP BY 1),
f AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  coalesce(p.n, 0) AS n_repeat_words, coalesce(o.n, 0)::BIGINT AS n_line_words FROM w LEFT JOIN p USING (rid) LEFT JOIN o USING (rid))
SELECT *, n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND (n_words - n_line_words) >= {LEAST_LEFT}::DOUBLE * n_words AS kept FROM f
"""
