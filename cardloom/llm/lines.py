"""Repeated runs of lines, found by what they hold and removed where their bytes agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: A chunk ends after a line whose rolling hash over ROLL lines is less than those of both its neighbours, so chunks
#: have two lines or more (but for a text's first and last), three on average.
ROLL = 2
#: A run of lines of more than MOST_WORDS words that occurs before is removed, wherever it starts and ends.
MOST_WORDS = 50
BLANK = " \t\v\f\r"


def let(value: Column, then) -> Column:
    """then(value), with value worked out once for a row; a plain column may be put in wherever it is named, lambdas included."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def split_lines(text: Column | str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def count_words(line: Column) -> Column:
    trimmed = F.btrim(line, F.lit(BLANK))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, "[ \\t\\x0B\\f\\r]+"))).otherwise(0)


def filled(lines: Column) -> Column:
    """The places of the lines with a word."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.length(F.btrim(F.get(lines, i), F.lit(BLANK))) > 0)


def chunk_ends(hashes: Column, roll: int) -> Column:
    """How many lines each chunk and those before it hold. The rolling hashes over the last `roll` line hashes decide, so
    that lines put in or taken out move the boundaries near them only."""
    rolled = F.transform(hashes, lambda x, i: F.xxhash64(*[F.get(hashes, i - j) for j in range(roll - 1, 0, -1)], x))

    def ends(r):
        least = lambda i: (F.get(r, i) < F.get(r, i - 1)) & (F.get(r, i) < F.get(r, i + 1))
        return F.filter(F.sequence(F.lit(1), F.size(r)), lambda i: (i == F.size(r)) | F.coalesce((i > roll) & least(i - 1), F.lit(False)))

    return let(rolled, ends)


def chunk_spans(hashes: Column, places: Column, roll: int) -> Column:
    """The chunks of two lines or more as spans of the lines with a word."""
    before = F.transform(places, lambda o, k: F.array_repeat(k, o - F.coalesce(F.get(places, k - 1), F.lit(-1))))
    tail = F.array_repeat(F.size(places), F.size(hashes) - F.coalesce(F.get(places, F.size(places) - 1), F.lit(-1)))

    def spans(e, rank):
        starts = F.concat(F.array(F.lit(0)), F.slice(e, 1, F.size(e) - 1))
        made = F.zip_with(starts, e, lambda s, t: F.struct(F.get(rank, s).alias("at"), (F.get(rank, t) - F.get(rank, s)).alias("n"), (t - s).alias("lines"), F.xxhash64(F.lit(1), F.slice(hashes, s + 1, t - s)).alias("h")))
        return F.transform(F.filter(made, lambda c: (c["lines"] > 1) & (c["n"] > 0)), lambda c: F.struct(c["at"].alias("at"), c["n"].alias("n"), c["h"].alias("h")))

    return let(F.concat(F.flatten(before), tail), lambda rank: let(chunk_ends(hashes, roll), lambda e: spans(e, rank)))


def run_spans(words: Column, hashes: Column, most: int) -> Column:
    """For each line with a word, the shortest run of over `most` words that starts there, and that which ends there.

    The lines alone decide how long these runs are, so a passage of over `most` words gives the same runs wherever it
    stands, and those within it cover all its lines: a line with too few words from it to the end is in the run that
    ends with the passage.
    """

    def spans(owner, starts):
        last = lambda k: F.get(owner, F.get(starts, k) + most)
        first = lambda k: F.get(owner, F.coalesce(F.get(starts, k + 1), F.size(owner)) - 1 - most)
        forward = F.transform(starts, lambda p, k: F.struct(k.alias("at"), (last(k) - k + 1).alias("n")))
        back = F.transform(starts, lambda p, k: F.struct(F.when(last(first(k)) != k, first(k)).alias("at"), (k - first(k) + 1).alias("n")))
        found = F.filter(F.concat(forward, back), lambda c: c["at"].isNotNull() & c["n"].isNotNull())
        return F.transform(found, lambda c: F.struct(c["at"].alias("at"), c["n"].alias("n"), F.xxhash64(F.lit(0), F.slice(hashes, c["at"] + 1, c["n"])).alias("h")))

    owner = F.flatten(F.transform(words, lambda n, k: F.array_repeat(k, n)))  # the line of each word
    starts = lambda o: F.array_compact(F.transform(o, lambda x, i: F.when((i == 0) | (F.get(o, i - 1) != x), i)))
    return let(owner, lambda o: let(starts(o), lambda s: spans(o, s)))


def spans_of(text: Column | str, roll: int, most: int) -> Column:
    """array of struct(at, n, h): first line and number of lines, among the lines with a word, and their hash."""

    def both(lines, hashes, places):
        words = F.transform(places, lambda i: count_words(F.get(lines, i)))
        own = F.transform(places, lambda i: F.get(hashes, i))
        return F.concat(chunk_spans(hashes, places, roll), let(words, lambda w: let(own, lambda h: run_spans(w, h, most))))

    return let(split_lines(text), lambda lines: let(F.transform(lines, lambda x: F.xxhash64(x)), lambda hashes: let(filled(lines), lambda places: both(lines, hashes, places))))


def body(lines: Column, places: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.transform(F.slice(places, at + 1, n), lambda i: F.get(lines, i)), "\n")


def dedup_lines(docs: DataFrame, roll: int = ROLL, most: int = MOST_WORDS) -> DataFrame:
    """docs with clean (the text without its repeated runs), n_chunks, n_removed (chunks that lost lines), n_removed_lines.

    Two kinds of runs are compared over all documents: those of over `most` words, one long line included, wherever they
    start and end, and chunks of two lines or more of any size. The first occurrence (by doc_id, then row, then place) stays;
    each later one that doesn't overlap it and whose lines equal the first's byte by byte is removed, with the blank lines in it
    (lines without a word aren't compared). Runs that share a hash but not their bytes stay. Null texts stay null; empty
    ones, repeated rows and ties are handled as any text (of two equal rows one keeps its lines). Columns that clash are replaced.
    """
    docs = docs.drop("clean", "n_chunks", "n_removed", "n_removed_lines").withColumn("__rid", F.monotonically_increasing_id())
    each = cut(docs.select("__rid", "doc_id", F.explode(spans_of("text", roll, most)).alias("c")).select("__rid", "doc_id", "c.at", "c.n", "c.h"), "lines-spans")
    # hashes first: only repeated ones go on; the written table lets a hot hash be split in the join
    repeated = cut(each.groupBy("h").agg(F.count("*").alias("k"), F.min(F.struct("doc_id", "__rid", "at")).alias("first")).where("k > 1").select("h", F.col("first.__rid").alias("frid"), F.col("first.at").alias("fat")), "lines-repeated")
    # merged at every size: the plan that holds for a large corpus, with a hot hash split, also runs on a small one
    later = each.join(repeated.hint("merge"), "h").where("__rid <> frid or at >= fat + n").select("__rid", "frid", "at", "n", (F.col("at") - F.col("fat")).alias("off"))
    # runs that meet at the same offset are one: their bytes are fetched once
    w = Window.partitionBy("__rid", "frid", "off").orderBy("at", "n")
    opened = later.withColumn("__new", F.coalesce(F.col("at") > F.max(F.col("at") + F.col("n")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)))
    joined = opened.withColumn("__run", F.sum(F.col("__new").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = joined.groupBy("__rid", "frid", "off", "__run").agg(F.min("at").alias("at"), F.max(F.col("at") + F.col("n")).alias("end"))
    runs = cut(runs.select("__rid", "frid", (F.col("at") - F.col("off")).alias("fat"), "at", (F.col("end") - F.col("at")).alias("n")), "lines-runs")
    firsts = docs.select(F.col("__rid").alias("frid"), "text").join(cut(runs.select("frid").distinct(), "lines-sources").hint("merge"), "frid")
    found = firsts.join(runs.hint("merge"), "frid")
    fetched = let(split_lines("text"), lambda lines: let(filled(lines), lambda places: body(lines, places, F.col("fat"), F.col("n"))))
    gone = cut(found.select("__rid", "at", "n", fetched.alias("body")), "lines-bodies").groupBy("__rid").agg(F.collect_list(F.struct("at", "n", "body")).alias("__gone"))
    out = docs.join(cut(gone, "lines-gone").hint("merge"), "__rid", "left")

    def removed(lines, places):
        same = F.filter(F.coalesce("__gone", F.array()), lambda g: body(lines, places, g["at"], g["n"]) == g["body"])
        return F.flatten(F.transform(same, lambda g: F.sequence(F.get(places, g["at"]), F.get(places, g["at"] + g["n"] - 1))))

    def result(lines, ends, gone):
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        starts = lambda k: F.coalesce(F.get(ends, k - 1), F.lit(0))
        owner = F.flatten(F.transform(ends, lambda e, k: F.array_repeat(k, e - starts(k))))  # the chunk of each line
        lost = let(owner, lambda o: F.size(F.array_distinct(F.transform(gone, lambda i: F.get(o, i)))))
        return let(kept, lambda k: F.struct(F.array_join(F.transform(k, lambda i: F.get(lines, i)), "\n").alias("clean"), F.size(ends).alias("chunks"), lost.alias("lost"), (F.size(lines) - F.size(k)).alias("less")))

    hashes = lambda lines: F.transform(lines, lambda x: F.xxhash64(x))
    made = let(split_lines("text"), lambda lines: let(removed(lines, filled(lines)), lambda gone: let(let(hashes(lines), lambda h: chunk_ends(h, roll)), lambda ends: result(lines, ends, gone))))
    out = out.withColumn("__made", made).withColumns({
        "clean": F.when(F.col("text").isNotNull(), F.col("__made.clean")),
        "n_chunks": F.col("__made.chunks").cast("long"),
        "n_removed": F.col("__made.lost").cast("long"),
        "n_removed_lines": F.col("__made.less").cast("long"),
    })
    return out.drop("__rid", "__gone", "__made")


def op4_line_dedup(spark, sf_dir) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_chunks", "n_removed", "n_removed_lines", F.sha2(F.coalesce("clean", F.lit("")), 256).alias("clean_sha256"))
