"""Benchmark passages in documents, found by Wu-Manber search over words."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, table, with_text

WINDOW = 13
#: Items whose texts are searched at once; a larger benchmark is searched in blocks. A byte of text costs about 120 in a searcher's tables.
BLOCK_BYTES = 1 << 20
FIGURES, HITS = "n_words long, n_hit long, items array<string>", "hit binary, names array<string>"
#: Words are digits, a-z and all that isn't ASCII; A-Z lower-cased, the rest of ASCII is space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class Searcher:
    """One table set for each length m of the patterns: shift by the last two words (one for m = 1), bucket by them.

    A block of words that no pattern has lets the search skip m - 1 words; a block at distance d from the end of some
    pattern lets it skip d; at d = 0 the bucket's patterns are compared word by word.
    """

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        by: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            w = words(text)
            m = min(window, len(w))
            for i in range(len(w) - m + 1 if w else 0):
                by[m][tuple(w[i : i + m])].add(name)
        self.tables = []
        for m, patterns in sorted(by.items()):
            b = min(2, m)
            shift, bucket = {}, defaultdict(list)
            for p, names in patterns.items():
                for end in range(b, m + 1):
                    block = p[end - 2] + b" " + p[end - 1] if b == 2 else p[0]
                    shift[block] = min(shift.get(block, m), m - end)
                bucket[p[m - 2] + b" " + p[m - 1] if b == 2 else p[0]].append((list(p), names))
            self.tables.append((m, b, shift, dict(bucket)))

    def find(self, w: list[bytes]) -> tuple[int, set[str]]:
        """Words inside any occurrence, and the items."""
        hit, names, n = bytearray(len(w)), set(), len(w)
        for m, b, shift, bucket in self.tables:
            i, far = m - 1, m - b + 1
            while i < n:
                block = w[i - 1] + b" " + w[i] if b == 2 else w[i]
                s = shift.get(block, far)
                if s:
                    i += s
                    continue
                start = i - m + 1
                got = w[start : i + 1]
                for p, found in bucket[block]:
                    if p == got:
                        hit[start : i + 1] = b"\1" * m
                        names |= found
                i += 1
        return hit, names


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, n_hit, n_items, items (sorted), contaminated.

    Words are compared after lower-casing A-Z. Null and empty texts have no words. A null item_id counts as the item
    named by the empty string; repeated ids are one item. An empty benchmark contaminates nothing, empty docs give no
    rows; repeated rows are searched each. Columns of docs that clash are replaced.

    The benchmark's size is checked: up to block_bytes it is one block, searched in the documents' own rows without a
    shuffle. A larger one is dealt by hash into blocks of about half of that; each is fetched, broadcast, searched and let go in a job of
    its own, so one block's tables are in memory at a time, and the hit words of all blocks are put together at the end.
    """
    docs = docs.drop("n_words", "n_hit", "n_items", "items", "contaminated")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").cast("binary").alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first().n
    count = 1 if total <= block_bytes else -(-2 * total // block_bytes)
    spark, found = docs.sparkSession, []
    if count > 1:
        docs = docs.withColumn("__rid", F.monotonically_increasing_id())
    for k in range(count):
        own = items if count == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k)
        held = [(r.i, None if r.t is None else bytes(r.t)) for r in own.collect()]  # a block
        block = spark.sparkContext.broadcast(held)
        if count == 1:
            out = with_text(docs, lambda texts, searcher: [figures(*searcher.find(w), len(w)) for w in map(words, texts)], FIGURES, lambda: Searcher(block.value, window))
            break
        hits = with_text(docs.select("__rid", "text"), lambda texts, searcher: [(bytes(h) if any(h) else None, sorted(n)) for h, n in (searcher.find(words(t)) for t in texts)], HITS, lambda: Searcher(block.value, window))
        found.append(cut(hits.where("hit is not null").select("__rid", "hit", "names"), "contamination-hits"))
        block.destroy()
    else:
        every = reduce(DataFrame.union, found).groupBy("__rid").agg(F.collect_list("hit").alias("__hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("items"))
        rows = docs.join(cut(every, "contamination-found"), "__rid", "left").drop("__rid").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        out = with_text(rows, lambda texts, _, hits: [(len(words(t)), sum(map(any, zip(*h, strict=True))) if h else 0) for t, h in zip(texts, hits, strict=True)], "n_words long, n_hit long", lambda: None, "__hits").drop("__hits")
    out = out.withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
    return out.select(*[c for c in docs.columns if c != "__rid"], "n_words", "n_hit", "n_items", "items", "contaminated")


def figures(hit: bytearray, names: set[str], n: int) -> tuple:
    return n, sum(hit), sorted(names)


def op6_decontamination(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(i) WHERE len(w) > 0),
g AS (SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM d, (SELECT DISTINCT m FROM p) AS ms, unnest(range(1, len(w) - m + 2)) AS t(i) WHERE len(w) >= m),
h AS (SELECT g.rid, g.i, g.m, p.item FROM g JOIN p ON g.s = p.s AND g.m = p.m),
n AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT rid, i, m FROM h) AS o, unnest(range(i, i + m)) AS t(k) GROUP BY rid),
a AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) AS o GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN a USING (rid)
"""
