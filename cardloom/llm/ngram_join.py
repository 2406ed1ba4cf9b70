"""Exact n-gram Jaccard join: rare-first prefixes, length, positional and suffix filters, one check for each pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, forget, table

WORDS, SHARE = 5, 75
#: The frequent shingles that the order puts last: at most so many, from counts within chunks of CHUNK shingles.
FREQUENT, CHUNK, LEAST_IN_CHUNK = 50_000, 1 << 20, 4
#: A shingle of up to FEW texts has all its pairs looked at; the texts of others meet pivots first, in so many rounds.
FEW, PIVOT_ROUNDS = 6, 3
#: Bins of parities for each shingle, and the most in all.
BINS, MOST_BINS = 4, 1 << 17
#: Texts of either side that one block of pairs is verified with.
BLOCK = 64, 256
#: Bins of the sketches that pairs are filtered by first, in words of 64. Sets of more shingles also have wide ones, of as many
#: bins as shingles or more: texts that share a passage alone fill half of the bins of a short one, fewer than a link of long sets allows.
SKETCH = 1024
A, B, ONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(31)


class Known(dict):
    """Words' 8-byte hashes."""

    def __missing__(self, word: bytes) -> bytes:
        h = self[word] = xxhash.xxh3_64_digest(word)
        return h


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text; words' hashes are remembered up to a bound."""

    def __init__(self, k: int = WORDS, most: int = 500_000):
        self.k, self.most, self.known = k, most, Known()

    def shingles(self, text: bytes | None) -> np.ndarray:
        w = text.lower().split() if text else []
        if not w:
            return np.empty(0, np.int64)
        if len(self.known) > self.most:
            self.known.clear()
        a = np.frombuffer(b"".join(map(self.known.__getitem__, w)), np.uint64)
        k = min(self.k, len(w))
        n = len(a) - k + 1
        h = np.full(n, k, np.uint64)
        for j in range(k):
            h ^= a[j : j + n]
            h *= A
            h ^= h >> ONE
        h *= B
        h ^= h >> ONE
        h = h.view(np.int64)
        h.sort()
        return h[np.concatenate(([True], h[1:] != h[:-1]))]


def parities(x: np.ndarray) -> bytes:
    """The parities of the counts of shingle hashes in bins, by the hashes' last bits: a power of two of bins, BINS for each hash or more."""
    bins = min(1 << max(6, (BINS * len(x) - 1).bit_length()), MOST_BINS)
    return np.packbits(np.bincount(x & (bins - 1), minlength=bins) & 1).tobytes()


def sketch(x: np.ndarray) -> np.ndarray:
    """Parities of the counts of shingle hashes in SKETCH bins, as 64-bit words."""
    return np.packbits(np.bincount(x & (SKETCH - 1), minlength=SKETCH) & 1).view(np.int64)


def wide_sketch(x: np.ndarray) -> np.ndarray:
    """The same in a power of two of bins, one for each hash or more; of SKETCH hashes or fewer none."""
    if len(x) <= SKETCH:
        return np.empty(0, np.int64)
    bins = min(1 << (len(x) - 1).bit_length(), MOST_BINS)
    return np.packbits(np.bincount(x & (bins - 1), minlength=bins) & 1).view(np.int64)


def unlike(a: bytes, b: bytes) -> int:
    """In how many bins parities differ: at most as many shingles are in one of both sets alone. The longer is folded to the other's bins."""
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        h = len(a) // 2
        a = (int.from_bytes(a[:h]) ^ int.from_bytes(a[h:])).to_bytes(h)
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def required(n: Column, m: Column, share: int) -> Column:
    """The least overlap of sets of n and m that link: (100 + share) * overlap >= share * (n + m), in whole numbers."""
    return F.floor((share * (n + m) + (100 + share - 1)) / F.lit(100 + share)).cast("long")


def frequent(docs: DataFrame, k: int) -> dict[int, int]:
    """Estimated counts of frequent shingles: at most FREQUENT rows come to the driver. They decide the order alone, never a result."""

    def run(batches):
        s, held, n = Shingler(k), [], 0

        def out():
            v, c = np.unique(np.concatenate(held), return_counts=True)
            v, c = v[c >= LEAST_IN_CHUNK], c[c >= LEAST_IN_CHUNK]
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(c, pa.int64())], names=["h", "c"])

        for b in batches:
            for t in b.column("text").to_pylist():
                if len(x := s.shingles(t)):
                    held.append(x)
                    n += len(x)
                if n >= CHUNK:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    return {r.h: r.c for r in counts.where(f"c >= {4 * LEAST_IN_CHUNK}").orderBy(F.desc("c"), "h").limit(FREQUENT).collect()}


def prefixes(docs: DataFrame, order: dict[int, int], k: int, share: int) -> DataFrame:
    """For each row: __rid, doc_id, node (its text's hash), n (set size), prefix (its first shingles, rare first), light (how many of those aren't frequent), bits, sketch and wide (the parities of its shingles)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((np.array(sorted(order), np.int64), np.array([order[h] for h in sorted(order)], np.int64)))

    def run(batches):
        s, (hs, cs) = Shingler(k), shared.value
        for b in batches:
            n, light, prefix, bits, words, wide = [], [], [], [], [], []
            for t in b.column("text").to_pylist():
                x = s.shingles(t)
                p = len(x) + 1 - -(-share * len(x) // 100) if len(x) else 0
                if len(hs) and len(x):
                    at = np.minimum(np.searchsorted(hs, x), len(hs) - 1)
                    f = np.where(hs[at] == x, cs[at], 0)
                    o = np.lexsort((x, f))[:p]
                    first, ll = x[o], int((f[o] == 0).sum())
                else:
                    first, ll = x[:p], p
                n.append(len(x))
                bits.append(parities(x) if len(x) else b"")
                words.append(sketch(x))
                wide.append(wide_sketch(x))
                light.append(ll)
                prefix.append(first)
            yield pa.RecordBatch.from_arrays([b.column("__rid"), b.column("doc_id"), b.column("node"), pa.array(n, pa.int64()), pa.array(light, pa.int32()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary()), pa.array(words, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.int64()))], names=["__rid", "doc_id", "node", "n", "light", "prefix", "bits", "sketch", "wide"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("__rid", "doc_id", "node", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"__rid long, doc_id {kind}, node long, n long, light int, prefix array<long>, bits binary, sketch array<long>, wide array<long>")


def packed(docs: DataFrame) -> DataFrame:
    """node, __rid, z: texts compressed before any of them is dealt."""

    def run(batches):
        c = zstandard.ZstdCompressor(level=3)
        for b in batches:
            z = [c.compress(t or b"") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("__rid"), pa.array(z, pa.binary())], names=["node", "__rid", "z"])

    return docs.select("node", "__rid", F.col("text").cast("binary").alias("text")).mapInArrow(run, "node long, __rid long, z binary")


def verified(pairs: DataFrame, texts: DataFrame, k: int, share: int) -> DataFrame:
    """Of distinct pairs (a, b) those that link, by the overlap of their whole sets."""

    def run(batches):
        s, d = Shingler(k), zstandard.ZstdDecompressor()
        for batch in batches:
            keep, last = [], (None, None)
            for b, x, y in zip(batch.column("b").to_pylist(), batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                if last[0] != b:  # the join leaves rows of the same b together
                    last = (b, s.shingles(d.decompress(y)))
                x, y = s.shingles(d.decompress(x)), last[1]
                need = -(-share * (len(x) + len(y)) // (100 + share))
                keep.append(len(np.intersect1d(x, y, assume_unique=True)) >= need)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # only texts that are asked for are dealt: where pairs are few, their nodes are broadcast
    side = lambda node, text: texts.join(pairs.select(F.col(node).alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias(node), F.col("z").alias(text))
    return pairs.select("a", "b").join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def alike(x: str, y: str, n: Column, m: Column, share: int) -> Column:
    """Suffix filter on sketches x and y of sets of n and m: they may differ in no more bins than linked sets in shingles."""
    differ = sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(SKETCH // 64)), F.lit(0))
    return differ <= n + m - 2 * required(n, m, share)


def alike_wide(x: str, y: str, n: Column, m: Column, share: int) -> Column:
    """The same on wide sketches, where both sets have one; the longer is folded to the other's bins (sets of such sizes that link differ by a factor of two at most)."""
    x, y = F.col(x), F.col(y)
    xor = lambda p, q: p.bitwiseXOR(q)
    half = lambda z: (F.size(z) / 2).cast("int")
    folded = lambda z: F.zip_with(F.slice(z, 1, half(z)), F.slice(z, half(z) + 1, half(z)), xor)
    a, b = F.when(F.size(x) > F.size(y), folded(x)).otherwise(x), F.when(F.size(y) > F.size(x), folded(y)).otherwise(y)
    differ = F.aggregate(F.zip_with(a, b, xor), F.lit(0), lambda s, z: s + F.bit_count(z))
    return (F.size(x) == 0) | (F.size(y) == 0) | (differ <= n + m - 2 * required(n, m, share))


def plausible(pairs: DataFrame, sizes: DataFrame, share: int) -> DataFrame:
    """Suffix filter: of pairs (a, b, k) those whose parities allow sets that differ in as few shingles as a link needs; short sketches first, so that few pairs carry long ones."""
    side = lambda x, own: sizes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col(own).alias(f"r{x}"))
    pairs = pairs.join(side("a", "sketch"), "a").join(side("b", "sketch"), "b").where(alike("ra", "rb", F.col("na"), F.col("nb"), share)).select("a", "b", "k")

    def run(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "ra", "rb")), strict=True):
                need = -(-share * (n + m) // (100 + share))
                keep.append(unlike(x, y) <= n + m - 2 * need)
            yield batch.select(["a", "b", "k"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a", "bits"), "a").join(side("b", "bits"), "b").select("a", "b", "k", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long, k long")


def blocks_of(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) as x, y and their block h, i, j. In a group's pairs one side, x, is that of the fewer pairs a text (then the lesser hash); texts of
    that side whose least partner, h, is the same meet in blocks of about BLOCK texts of x and y, dealt by hash."""
    many = pairs.select(F.col("a").alias("t")).union(pairs.select("b")).groupBy("t").agg(F.count("*").alias("d"))
    of = lambda t: many.select(F.col("t").alias(t), F.col("d").alias(f"d{t}"))
    first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    sided = cut(pairs.join(of("a"), "a").join(of("b"), "b").select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("y")), "ngram-sided")
    hubs = sided.join(sided.groupBy("x").agg(F.min("y").alias("h")), "x")
    counts = hubs.groupBy("h").agg(F.approx_count_distinct("x").alias("nx"), F.approx_count_distinct("y").alias("ny"))
    deal = lambda t, n, size: F.pmod(F.xxhash64(t), F.ceil(F.col(n) / size))
    return hubs.join(counts, "h").select("x", "y", "h", deal("x", "nx", BLOCK[0]).alias("i"), deal("y", "ny", BLOCK[1]).alias("j"))


def verified_in_blocks(pairs: DataFrame, texts: DataFrame, k: int, share: int) -> DataFrame:
    """As verified(), for groups with many pairs a text: a text goes once to each block that has pairs of it, and not to each pair.

    A block holds about the texts that BLOCK says, however large its group is.
    """
    rows = cut(blocks_of(pairs), "ngram-blocks")
    asked = rows.select("h", "i", "j", "x").union(rows.select("h", "i", "j", "y")).distinct().toDF("h2", "i2", "j2", "node")
    held = asked.join(texts, "node")

    def run(pairs, held):
        s, d = Shingler(k), zstandard.ZstdDecompressor()
        sets = {n: s.shingles(d.decompress(z)) for n, z in zip(held.column("node").to_pylist(), held.column("z").to_pylist(), strict=True)}
        bits = {n: parities(x) for n, x in sets.items()}
        a, b = [], []
        for n, m in zip(pairs.column("x").to_pylist(), pairs.column("y").to_pylist(), strict=True):
            x, y = sets[n], sets[m]
            need = -(-share * (len(x) + len(y)) // (100 + share))
            if min(len(x), len(y)) >= need and unlike(bits[n], bits[m]) <= len(x) + len(y) - 2 * need and len(np.intersect1d(x, y, assume_unique=True)) >= need:
                a.append(min(n, m))
                b.append(max(n, m))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("h", "i", "j").cogroup(held.groupBy("h2", "i2", "j2")).applyInArrow(run, "a long, b long")


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels(node, c) after links(a, b): components hook to their least neighbour, pointers jump, and the rest is contracted, until no link joins two."""
    on = lambda side: labels.select(F.col("node").alias(side), F.col("c").alias(f"c{side}"))
    edges = cut(links.join(on("a"), "a").join(on("b"), "b").where("ca <> cb").select(F.least("ca", "cb").alias("u"), F.greatest("ca", "cb").alias("v")).distinct(), "ngram-edges")
    while not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).toDF("c", "to")
        hook = cut(both.groupBy("c").agg(F.least(F.min("to"), F.col("c")).alias("to")), "ngram-hooks")
        for _ in range(2):
            last, hook = hook, cut(hook.join(hook.select(F.col("c").alias("to"), F.col("to").alias("next")), "to").select("c", F.col("next").alias("to")), "ngram-hooks")
            forget(last)
        last, labels = labels, cut(labels.join(hook, "c", "left").select("node", F.coalesce("to", "c").alias("c")), "ngram-labels")
        forget(last)
        h = lambda x: hook.select(F.col("c").alias(x), F.col("to").alias(f"t{x}"))
        last, edges = edges, cut(edges.join(h("u"), "u").join(h("v"), "v").where("tu <> tv").select(F.least("tu", "tv").alias("u"), F.greatest("tu", "tv").alias("v")).distinct(), "ngram-edges")
        forget(last, hook)
    forget(edges)
    return labels


def told_apart(docs: DataFrame) -> DataFrame:
    """docs with node, a 64-bit hash of the text. Texts that share it but not a second hash get nodes of their own, so only 128 equal bits make texts one."""
    both = docs.withColumns({"node": F.xxhash64("text"), "__other": F.xxhash64(F.lit(1), F.col("text"))})
    clash = cut(both.groupBy("node").agg(F.min("__other").alias("lo"), F.max("__other").alias("hi")).where("lo <> hi").select("node", F.lit(True).alias("__clash")), "ngram-clash")
    if not clash.isEmpty():
        both = both.join(clash, "node", "left").withColumn("node", F.when(F.col("__clash"), F.xxhash64("node", "__other")).otherwise(F.col("node"))).drop("__clash")
    return both.drop("__other")


def components(docs: DataFrame, k: int = WORDS, share: int = SHARE) -> DataFrame:
    """For each row of docs(doc_id, text): __rid, doc_id, n_shingles, component_id (the least doc_id reachable by links, itself included).

    Two texts link when 100 * |A & B| >= share * |A | B| over their sets of distinct k-word shingles (64-bit hashes;
    A-Z lower-cased). Equal texts (by 128 bits of hashes) are one node and are never paired. Shingles are ordered rare first; two linked texts
    share one within their prefixes. A shingle of up to FEW texts has all its pairs looked at. Of a more common one's
    texts one is the pivot; the others meet it, in rounds with other pivots, and a pair already joined by links isn't
    looked at again. The last round takes all pairs of a shingle that are still in two components and whose sketches allow a link,
    and fetches texts by blocks of them. All pairs pass
    the length, position and suffix filters first and are verified once: no link between components is lost. No cap:
    a shingle's texts are split over tasks by the join. Null and empty texts have no shingles and link with
    nothing; null doc_ids are ignored as component ids unless there is no other; repeated rows share a component.
    """
    docs = told_apart(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("__rid")))
    rows = cut(prefixes(docs, frequent(docs, k), k, share), "ngram-prefixes")
    flat = rows.where("n > 0").select("__rid", "light", F.posexplode("prefix").alias("pos", "s"))
    w = Window.partitionBy("s")
    light = flat.where("pos < light").select("s", "__rid", "pos").withColumns({"lo": F.min("__rid").over(w), "hi": F.max("__rid").over(w)}).where("lo <> hi").drop("lo", "hi")
    heavy = flat.where("pos >= light").select("s", "__rid", "pos")
    met = cut(light.union(heavy), "ngram-met")
    common = cut(met.join(rows.select("__rid", "node", "n"), "__rid").groupBy("s", "node").agg(F.min("n").alias("n"), F.min("pos").alias("pos")), "ngram-shared")
    # shingles of one text and its copies go
    held_by = cut(common.groupBy("s").agg(F.count("*").alias("texts")).where("texts > 1"), "ngram-shingles")
    shared = cut(common.join(held_by, "s"), "ngram-shared")
    forget(met, common, held_by)
    nodes = cut(shared.select("node").distinct(), "ngram-nodes")
    reps = cut(rows.where("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "__rid")).alias("r")).join(nodes, "node", "left_semi").select("node", "r.__rid"), "ngram-reps")
    sizes = cut(rows.select("node", "__rid", "n", "bits", "sketch", "wide").join(reps, ["node", "__rid"], "left_semi").drop("__rid"), "ngram-sizes")
    members = cut(rows.select("__rid", "doc_id", "node", "n"), "ngram-rows")
    forget(rows)
    labels = nodes.withColumn("c", F.col("node"))

    def near(n, m, i, j):
        """Length and position: what can still be common after the places i and j."""
        need = required(n, m, share)
        return (F.least(n, m) * 100 >= F.greatest(n, m) * share) & (F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1) >= need)

    def meeting(rows):
        """Pairs a < b of texts that share a shingle, with how many, each once. Rows with c, sketch and prev (the text's shingle before this one) pair over two components
        only, where the sketches allow a link, and not at a shingle that follows another that both share, as near copies share
        runs of them: the first of the run has the pair. All are conditions of the join, so that a group's hopeless pairs are never rows."""
        kept = [x for x in ("node", "n", "pos", "c", "sketch", "wide", "prev") if x in rows.columns]
        one, two = (rows.select("s", *[F.col(x).alias(f"{x}{i}") for x in kept]) for i in (1, 2))
        both = one.join(two, "s").where((F.col("node1") < F.col("node2")) & near(F.col("n1"), F.col("n2"), F.col("pos1"), F.col("pos2")))
        if "c" in kept:
            both = both.where((F.col("c1") != F.col("c2")) & F.coalesce(F.col("prev1") != F.col("prev2"), F.lit(True)) & alike("sketch1", "sketch2", F.col("n1"), F.col("n2"), share) & alike_wide("wide1", "wide2", F.col("n1"), F.col("n2"), share))
        return both.groupBy(F.col("node1").alias("a"), F.col("node2").alias("b")).agg(F.count("*").alias("k"))

    def with_pivots(open_, r):
        """Pairs of texts with their shingles' pivots, where the two lie in different components."""
        pivot = F.min(F.struct(F.xxhash64("node", F.lit(r)).alias("rank"), "node", "n", "pos", "c"))
        mixed = cut(open_.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), pivot.alias("p")).where("lo <> hi").select("s", "p"), "ngram-pivots")
        pairs = open_.join(mixed, "s").where((F.col("c") != F.col("p.c")) & near(F.col("n"), F.col("p.n"), F.col("pos"), F.col("p.pos")))
        return pairs.groupBy(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).agg(F.count("*").alias("k"))

    few, many = shared.where(F.col("texts") <= FEW), shared.where(F.col("texts") > FEW)
    first = meeting(few).union(with_pivots(many.withColumn("c", F.col("node")), 0)).groupBy("a", "b").agg(F.sum("k").alias("k"))
    first = cut(plausible(first, sizes, share), "ngram-pairs")
    alive = cut(first.select("a").union(first.select("b")).union(many.select("node")).distinct().toDF("node"), "ngram-alive")
    wanted = cut(reps.join(alive, "node", "left_semi"), "ngram-wanted")
    # merged at every size, here and below: the plan that holds for a large corpus also runs on a small one
    texts = cut(packed(docs).join(wanted.hint("merge"), ["node", "__rid"], "left_semi").drop("__rid"), "ngram-texts")
    forget(reps, alive, wanted)
    seen = None

    def ask(labels, pairs, seen, best):
        """Verify pairs that lie in two components and weren't asked before; of each text's pairs only the best, if so asked."""
        side = lambda x: labels.select(F.col("node").alias(x), F.col("c").alias(f"c{x}"))
        apart = pairs.join(side("a"), "a").join(side("b"), "b").where("ca <> cb").select("a", "b", "k")
        if seen is not None:
            apart = apart.join(seen, ["a", "b"], "left_anti")
        if best:
            top = apart.select(F.col("a").alias("x"), "a", "b", "k").union(apart.select(F.col("b"), "a", "b", "k")).groupBy("x").agg(F.max(F.struct("k", "a", "b")).alias("t"))
            apart = top.select("t.a", "t.b", "t.k").distinct()
        asked = cut(apart, "ngram-asked").select("a", "b")
        if asked.isEmpty():
            return labels, seen
        links = cut(verified(asked, texts, k, share), "ngram-links")
        labels = merge(labels, links)
        forget(links)
        return labels, asked if seen is None else seen.union(asked)

    for best in (True, False):
        labels, seen = ask(labels, first, seen, best)
    rest = many.drop("texts")
    forget(first)
    last = shared
    for r in range(1, PIVOT_ROUNDS + 1):
        # the rows of shingles whose texts lie in several components; a shingle within one is done with for good
        labelled = cut(rest.join(labels.hint("merge"), "node"), "ngram-open")
        forget(last)
        mixed = cut(labelled.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("s"), "ngram-mixed")
        last = cut(labelled.join(mixed.hint("merge"), "s", "left_semi"), "ngram-rest")
        forget(labelled, mixed)
        rest = last.drop("c")
        if r < PIVOT_ROUNDS:
            pairs = cut(with_pivots(last, r), "ngram-pairs")
            labels, seen = ask(labels, plausible(pairs, sizes, share), seen, True)
            forget(pairs)
            continue
        before = F.lag("s").over(Window.partitionBy("node").orderBy("pos", "s"))  # a text has no more rows than its prefix has shingles
        sketched = last.withColumn("prev", before).join(sizes.select("node", "sketch", "wide").hint("merge"), "node")
        pairs = cut(meeting(sketched).select("a", "b").join(seen, ["a", "b"], "left_anti") if seen is not None else meeting(sketched).select("a", "b"), "ngram-pairs")
        if not pairs.isEmpty():
            links = cut(verified_in_blocks(pairs, texts, k, share), "ngram-links")
            labels = merge(labels, links)
            forget(links)
        forget(pairs)
    own = cut(members.join(labels, "node", "left").withColumn("c", F.when(F.col("n") > 0, F.coalesce("c", "node"))), "ngram-members")
    least = cut(own.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id")), "ngram-least")
    forget(last, texts, sizes, members, labels, nodes)
    out = own.join(least, "c", "left")
    return out.select("__rid", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "c")


def op10_ngram_join(spark, sf_dir) -> DataFrame:
    return components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the least doc_id (of repeated rows the first read); texts without words all stay."""
    found = cut(components(docs), "ngram-components")
    first = found.where("c is not null").groupBy("c").agg(F.min(F.struct("doc_id", "__rid")).alias("r")).select("r.__rid")
    kept = cut(first.union(found.where("c is null").select("__rid")), "ngram-kept")
    return docs.withColumn("__rid", F.monotonically_increasing_id()).join(kept.hint("merge"), "__rid", "left_semi").drop("__rid")


OP10_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(w[i:i + {WORDS - 1}], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS m FROM s a JOIN s b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * m >= {SHARE} * (x.n + y.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT r.a AS rid, min(d.doc_id) AS component_id FROM r JOIN d ON d.rid = r.b GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d JOIN c USING (rid) LEFT JOIN n USING (rid)
"""
