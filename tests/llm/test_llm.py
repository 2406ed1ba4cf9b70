"""Each text operator against brute force, with nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import collections
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.llm import decontamination, licenses, lines, lm, mixing, ngram_join, pii, quality, sharding, urls
from cardloom.llm.common import cut, uniform

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def text_of(r, n, vocabulary=40):
    return " ".join(f"w{r.randrange(vocabulary)}x" + ("\n" if r.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    out = []
    for i in range(60):
        t = text_of(r, r.randrange(5, 120), 4000)
        out.append((i, t, "en", f"src{i % 5}", len(t)))
    base = out[7][1].split(" ") + [f"k{j}" for j in range(60)]
    for i in range(60, 75):  # near copies, chained
        w = list(base)
        for _ in range(r.randrange(0, 4)):
            w[r.randrange(len(w))] = f"z{r.randrange(999)}"
        out.append((i, " ".join(w), "en", "src0", 0))
    out += [(75, None, None, None, None), (76, "", "en", "src1", 0), (None, "a b", "en", None, 3), (78, "one two", "en", "src2", 7), (79, "One  TWO", "en", "src2", 8)]
    out += [out[3], out[3]]  # repeated rows
    out.append((80, "word " * 30000, "en", "src3", 150000))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return cut(spark.createDataFrame(rows, DOCS).repartition(5), "docs")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def collected(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def lower(t):
    return (t or "").encode().lower()


def test_ngram_join(docs, rows, none):
    sets = []
    for _, t, *_ in rows:
        w = lower(t).split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, row in enumerate(rows):
        ids[find(i)].append(row[0])
    want = sorted(((row[0], len(sets[i]), min([x for x in ids[find(i)] if x is not None], default=None) if sets[i] else row[0]) for i, row in enumerate(rows)), key=str)
    assert collected(ngram_join.components(docs), "doc_id", "n_shingles", "component_id") == want
    assert ngram_join.components(none).count() == 0
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({find(i) for i in range(len(rows)) if sets[i]}) + sum(not s for s in sets)


def test_ngram_join_pivots(spark):
    """A large group of near copies around one text, few of them like each other."""
    r = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    data = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randrange(0, 6)):
            w[r.randrange(80)] = f"e{r.randrange(10**6)}"
        data.append((i, " ".join(w)))
    got = {x.doc_id: x.component_id for x in ngram_join.components(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(76)} for _, t in data]
    root = list(range(60))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: find(i) for i in range(60)}


def test_ngram_join_long(spark):
    """Long texts that share a passage, some near copies of each other with sizes on both sides of a power of two: the same groups as by comparing all."""
    r = random.Random(12)
    passage = [f"p{i}" for i in range(60)]
    data = []
    for g in range(12):
        own = [f"t{g}w{i}" for i in range(r.choice([1000, 1500, 2080, 2300]))]
        for c in range(3):
            w = own[: len(own) - c * r.randrange(len(own) // 8)] + passage
            for _ in range(r.randrange(25)):
                w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
            data.append((len(data), " ".join(w)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {x.doc_id: x.component_id for x in ngram_join.components(cut(spark.createDataFrame(data, "doc_id long, text string").repartition(3), "long")).collect()}
    assert got == {i: find(i) for i in range(len(data))} and len(set(got.values())) > 12 > len(data) // 4
    pairs = [(a, b) for a in range(len(data)) for b in range(a)]  # the filter loses no link and drops texts that only share the passage
    s = ngram_join.Shingler()
    hashes = [s.shingles(t.encode()) for _, t in data]
    rows = [(a, b, len(hashes[a]), len(hashes[b]), ngram_join.wide_sketch(hashes[a]).tolist(), ngram_join.wide_sketch(hashes[b]).tolist()) for a, b in pairs if 4 * min(len(hashes[a]), len(hashes[b])) >= 3 * max(len(hashes[a]), len(hashes[b]))]
    df = spark.createDataFrame(rows, "a long, b long, n long, m long, x array<long>, y array<long>")
    kept = {(x.a, x.b) for x in df.where(ngram_join.alike_wide("x", "y", F.col("n"), F.col("m"), 75)).collect()}
    linked = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert linked <= kept and len(kept) < 0.2 * len(rows)


def test_ngram_join_blocks(spark, monkeypatch):
    """Blocks of pairs give the links that a check of each pair gives, for groups of many sizes and blocks of few texts; each pair lies in one block."""
    r = random.Random(9)
    data, groups = [], []
    for g in range(4):
        base = [f"g{g}b{i}" for i in range(60)]
        groups.append(range(len(data), len(data) + (3, 9, 20, 40)[g]))
        for i in groups[-1]:
            w = list(base)
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(60)] = f"e{r.randrange(10**6)}"
            data.append((i, " ".join(w)))
    pairs = [(a, b) for g in groups for a in g for b in g if a < b and r.random() < 0.8]
    texts = cut(ngram_join.packed(spark.createDataFrame([(i, i, t) for i, t in data], "node long, __rid long, text string")).drop("__rid"), "texts")
    asked = cut(spark.createDataFrame(pairs, "a long, b long"), "pairs")
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for _, t in data]
    want = sorted((a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    assert 0 < len(want) < len(pairs)
    assert sorted(map(tuple, ngram_join.verified(asked, texts, 5, 75).collect())) == want
    monkeypatch.setattr(ngram_join, "BLOCK", (4, 8))
    assert sorted(map(tuple, ngram_join.verified_in_blocks(asked, texts, 5, 75).collect())) == want
    rows = ngram_join.blocks_of(asked).collect()
    assert sorted((min(x.x, x.y), max(x.x, x.y)) for x in rows) == sorted(pairs) and len({(x.h, x.i, x.j) for x in rows}) > 8


def test_decontamination(spark, docs, rows, none):
    bench = [(1, rows[3][1]), (2, rows[60][1]), (2, "One Two"), (3, None), (4, ""), (None, "zz qq")]
    b = spark.createDataFrame(bench, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t).decode())
    items = collections.defaultdict(set)
    for i, t in bench:
        w = words(t)
        m = min(13, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            items[tuple(w[k : k + m])].add("" if i is None else str(i))
    want = []
    for i, t, *_ in rows:
        w, hit, names = words(t), set(), set()
        for m in {len(x) for x in items}:
            for k in range(len(w) - m + 1):
                if (x := tuple(w[k : k + m])) in items:
                    hit |= set(range(k, k + m))
                    names |= items[x]
        want.append((i, len(w), len(hit), len(names), ",".join(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    for size in (1 << 20, 100):  # in one block, in many
        got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in decontamination.find_contamination(docs, b, block_bytes=size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert decontamination.find_contamination(none, b).count() == 0
    assert not any(r.contaminated for r in decontamination.find_contamination(docs, b.limit(0)).collect())


def test_pii(spark, none):
    base = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(k, m):
        d = re.sub("[^0-9]", "", m)
        luhn = sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0
        return k == "email" or (k == "ip" and all(int(x) <= 255 for x in m.split("."))) or (k == "card" and 13 <= len(d) <= 19 and luhn) or (k == "phone" and 9 <= len(d) <= 15)

    r, pieces = random.Random(1), ["a@b.c", "a@b.cx_y@d.e", "x@y", "1.2.3.4", "001.2.3.4.5", "300.1.1.1", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (869) 555-7420", "+1 2", "é", " ", "\n", "@", "+", "-", "7", ".", "😀", "a", "+44 20 7946 0958 "]
    data = [(i, "".join(r.choice(pieces) for _ in range(r.randrange(30)))) for i in range(300)] + [(300, None), (301, ""), (302, "9" * 60000), (303, "a" * 60000 + "@b.c")]
    got = {x.doc_id: x for x in pii.find_pii(spark.createDataFrame(data, "doc_id long, text string").withColumn("spans", uniform("x", seed=1))).collect()}
    for i, t in data:
        want = [(n, m.start(), m.end()) for n, (k, p) in enumerate(base.items()) for m in re.finditer(p, t or "") if ok(k, m[0])]
        assert [tuple(x) for x in got[i].base_spans] == want, t
        assert set(want) <= {tuple(x) for x in got[i].spans}
        assert got[i].n_email == sum(w[0] == 0 for w in want)
    assert pii.find_pii(none).count() == 0
    texts = [(1, "mail é a@b.cd now"), (2, None), (3, ""), (4, "none"), (5, "+44 20 7946 0958 😀 x@y.org"), (5, "+44 20 7946 0958 😀 x@y.org")]
    assert [r.text for r in pii.redact(spark.createDataFrame(texts, "doc_id long, text string")).orderBy("doc_id").collect()] == ["mail é [email] now", None, "", "none", "[phone] 😀 [email]", "[phone] 😀 [email]"]


def test_pii_wide(spark):
    """Spans of the wide generators: hidden forms of what the base forms teach are found, however often a text occurs; broken ones aren't."""
    r = random.Random(4)
    base = [(i, f"mail to user{i}@host{i % 7}.org or call +1 202 555 {1000 + i} at host 10.0.{i % 200}.7") for i in range(200)]
    base += [(1000 + i, f"bad a{i}@b{i}.7 and host 300.{i}.1.1 and 400.1.{i}.2") for i in range(60)]
    hidden, broken = "mail to someone [at] example [dot] com please", "host 900 . 1 . 2 . 3 and me [at] b [dot] 7 here"
    for n in (1, 5, 40):
        data = base + [(2000 + i, hidden) for i in range(n)] + [(3000 + i, broken) for i in range(n)]
        r.shuffle(data)
        got = collections.defaultdict(set)
        for x in pii.find_pii(spark.createDataFrame(data, "doc_id long, text string")).collect():
            got[x.doc_id // 1000].add(tuple(tuple(s) for s in x.spans) if x.doc_id >= 2000 else ())
        assert got[2] == {((0, 8, 38),)} and got[3] == {()}, n
    assert hidden[8:38] == "someone [at] example [dot] com"


def test_pii_linear(spark):
    """Tens of thousands of spans in one text are found in seconds, in their places."""
    text = " ".join(f"10.{i % 250}.{i // 250}.1é" for i in range(30_000))
    began = time.time()
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pii.find_pii(df).first()
    want = [(1, m.start(), m.end()) for m in re.finditer(r"[0-9.]+", text)]
    assert [tuple(x) for x in got.base_spans] == want and time.time() - began < 60
    assert pii.redact(df).first().text == " ".join(["[ip]é"] * 30_000)


def test_sharding(spark, docs, rows, none):
    got = sharding.shard(docs.select("doc_id", sharding.text_size(docs.text).alias("b")), F.col("b"), [F.col("doc_id")], 4).collect()
    assert len(got) == len(rows)
    at = collections.defaultdict(list)
    for x in got:
        at[x.shard].append(x)
    assert set(at) <= set(range(4))
    for s in at.values():
        assert sorted(x.slot for x in s) == list(range(len(s)))
    order = [(-1 if x.doc_id is None else x.doc_id) for x in sorted(got, key=lambda x: (x.shard, x.slot))]
    assert order == sorted(order)
    assert sharding.shard(none.select("doc_id", sharding.text_size(none.text).alias("b")), F.col("b"), [F.col("doc_id")]).count() == 0


def test_sharding_clash(spark):
    df = spark.createDataFrame([(2, "b", 9, 9, 9), (1, "a", 9, 9, 9)], "doc_id long, text string, size int, shard int, slot int")
    got = sharding.shard(df, F.col("size"), [F.col("doc_id")], 2)
    assert sorted(got.columns) == ["doc_id", "shard", "size", "slot", "text"]
    assert sorted((r.doc_id, r["size"], r.shard, r.slot) for r in got.select("doc_id", "size", "shard", "slot").collect()) == [(1, 9, 0, 0), (2, 9, 1, 0)]


def test_sharding_query(spark, rows, tmp_path):
    """The whole query against prefix sums in Python: rows in order of id, hash, size; the middle byte gives the shard."""
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    size = lambda t: len((t or "").encode()) + 16
    crc = lambda t: zlib.crc32((t or "").encode())
    order = sorted(((-1 if i is None else i, crc(t), size(t), i) for i, t, *_ in rows), key=lambda x: x[:3])
    total, run, want, slots = sum(x[2] for x in order), 0, [], collections.Counter()
    for _, c, n, i in order:
        s = min(39, (2 * run + n) * 40 // (2 * total))
        want.append((i, n, c, "bytes", s, slots[s], None))
        slots[s] += 1
        run += n
    got = sharding.op3_sharding(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_sharding_balance(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("doc_id"), (F.col("id") % 7 + 10).alias("b"))
    sizes = collections.Counter()
    for x in sharding.shard(df, F.col("b"), [F.col("doc_id")]).collect():
        sizes[x.shard] += x.size
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 2 * 16


def test_mixing(spark, docs, none):
    for mean in (0.0, 0.3, 2.5, 40.0, 700.0):
        k = np.array([x.n for x in spark.range(4000).select(mixing.copies(mean, [F.col("id")], 9).alias("n")).collect()])
        assert abs(k.mean() - mean) < 5 * math.sqrt(mean / 4000) + 1e-9 and (mean == 0 or abs(k.var() / mean - 1) < 0.15)
    big = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.when(F.col("id") % 3 > 0, "src0").otherwise("src9").alias("source"))
    n = collections.Counter(r.source for r in mixing.mix(big, {"src0": 0.25}, 0.75).collect())
    assert abs(n["src0"] / sum(n.values()) - 0.25) < 0.02
    assert mixing.mix(none).count() == 0
    got = collections.defaultdict(set)
    for r in mixing.shuffled(mixing.mix(docs)).collect():
        got[r.doc_id, r.text].add(r.copy)
    assert all(v == set(range(len(v))) for v in got.values())


def test_urls(spark):
    data = ["http://a.Example.ORG/es/x", "https://example.org/en/123?q", "https://xexample.org/es/", "http://org", "http://org/", "ftp://a.com/fr/#x", "http://com/de/", "http://b.com/en", "no", None, "", "http://a.b/?http://org/", "http://" + "a." * 5000 + "com/de/" + "x" * 5000]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(list(enumerate(data)), "page_id long, url string")).collect()}
    for i, u in enumerate(data):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
        host, path = m[1].lower(), m[2]
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits) if fits else (0, None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, best[1], best[2])
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_quality(spark, docs, rows, none):
    def brute(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, dup = set(), 0
        for x in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in seen
                seen.add(x)
        at = collections.defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i : i + 8])].append(i)
        mark = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(mark)

    extra = [(100, "é #*\n\né #*\n ü\x85x " * 9, "en", "s", 0), (101, " ".join("a b c d e f g h".split() * 3), "en", "s", 0)]
    df = docs.union(spark.createDataFrame(extra, DOCS))
    got = collected(quality.judge(df), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = [(i, *(b := brute(t)), b[0] < 20 or 100 * b[4] > 30 * b[0]) for i, t, *_ in [*rows, *extra]]
    assert got == sorted(want, key=str)
    assert quality.judge(none).count() == 0 and quality.keep_good(none).columns == none.columns


def test_quality_lines(spark):
    """A line of 40 different documents of a host goes; the same text copied 40 times counts once."""
    own = lambda i: " ".join(f"o{i}n{j}" for j in range(30))
    data = [(i, "Shared  footer line\n" + own(i), "a") for i in range(40)] + [(100 + i, own(999), "a") for i in range(40)] + [(200 + i, "Shared footer line\n" + own(1000 + i), "b") for i in range(5)]
    data += [(300 + i, "shared Footer line\n" * 20 + own(2000 + i)[:20], "a") for i in range(2)]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(data, "doc_id long, text string, source string"), most_share=0.0).collect()}
    assert got[0].n_line_words == 3 and got[0].kept and got[100].n_line_words == 0 and got[100].kept and got[200].n_line_words == 0
    assert got[300].n_line_words == 60 and not got[300].kept


def test_quality_removes_lines(spark):
    """Kept documents lose the lines over the limits, however they are written, and no others; n_chars follows."""
    own = lambda i: " ".join(f"o{i}é{j}" for j in range(30))
    data = [(i, f"{own(i)}\n\n  shared  Footer line\nend {i}" if i % 2 else f"Shared footer line\n{own(i)}", "a", 7) for i in range(40)]
    data += [(100, f"Shared footer line\n{own(100)}", "b", 7), (101, "Shared footer line\n" * 30 + own(101)[:20], "a", 7)]
    df = cut(spark.createDataFrame(data, "doc_id long, text string, source string, n_chars int"), "shared-lines")
    out = quality.keep_good(df, most_share=0.0)
    got = {r.doc_id: r for r in out.collect()}
    assert out.schema == df.schema and set(got) == {*range(40), 100}
    for i in range(40):
        assert got[i].text == (f"{own(i)}\n\nend {i}" if i % 2 else own(i)) and got[i].n_chars == len(got[i].text)
    assert got[100].text == data[40][1] and got[100].n_chars == 7


def test_licenses(spark, none):
    t = dict(reversed(licenses.TEMPLATES))  # of each name the first, a short notice
    mit, bsd3 = licenses.MIT, dict(licenses.TEMPLATES)["BSD-3-Clause"]
    filler = " ".join(f"word{i}" for i in range(300))
    data = [
        (1, f"abc\n{t['MIT']}\nxyz"), (2, "Licensed under the apache   license, version 2.0"), (3, "licensed things are here and there"), (4, None), (5, ""), (6, "w " * 50000),
        (7, t["GPL-3.0"].replace(" ", "\n")), (8, f"Copyright X. {t['MIT']} Have fun, all of you, with it"), (9, f"{filler} {mit} {filler}"), (10, f"{filler}\n\nCopyright Y\n\n{mit}\n\n{filler}"),
        (11, f"{filler}\n" + bsd3.replace(" of ", "\nof ") + f"\n{filler}"), (12, f"{filler} Licensed under\nthe Apache License,\nVersion 2.0. {filler}"), (13, f"{filler} {licenses.gnu('General Public License', 2)}"), (13, t["MIT"]), (14, mit[:200]),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("licenses", F.lit(1)).withColumn("score", F.lit("kept"))
    out = licenses.find_licenses(df)
    assert out.columns == ["doc_id", "text", "score", "licenses"]
    got = collections.defaultdict(set)
    for r in out.collect():
        got[r.doc_id] |= {x.license for x in r.licenses}
    want = {1: {"MIT"}, 2: {"Apache-2.0"}, 7: {"GPL-3.0"}, 8: {"MIT"}, 9: {"MIT"}, 10: {"MIT"}, 11: {"BSD-3-Clause"}, 12: {"Apache-2.0"}, 13: {"GPL-2.0", "MIT"}}
    assert got == {i: want.get(i, set()) for i, _ in data}
    assert licenses.find_licenses(none).count() == 0
    m = licenses.Matcher(licenses.TEMPLATES, 0.5)
    r = random.Random(2)
    for _ in range(400):  # the size bounds lose nothing; ties go to the first name
        w = r.choice(licenses.TEMPLATES)[1].split()
        u = licenses.words(" ".join(w[r.randrange(2) : len(w) - r.randrange(3)] + ["x"] * r.randrange(4)).encode())
        a = licenses.bigrams(u)
        best = min(((-2 * len(a & x) / (len(a) + n), n2) for n, n2, _, x in m.sets), default=(0, "")) if a else (0, "")
        found = m.unit(u)
        assert (found is None) == (-best[0] < 0.5) and (found is None or found == (-best[0], best[1]))


def test_license_runs():
    """The runs found are those of brute force over all places: the best of those that overlap, and none is missed."""
    r = random.Random(5)
    m = licenses.Matcher([("A", "a b c d e"), ("B", "p q r s t u v w")], 0.6)
    for _ in range(300):
        w = [r.choice("abcdepqrstuvwxyz").encode() for _ in range(r.randrange(6))]
        for _ in range(r.randrange(3)):
            x = list(r.choice(["abcde", "pqrstuvw"]))
            x[r.randrange(len(x))] = r.choice("az")
            w += [c.encode() for c in x] + [b"z"] * r.randrange(4)
        got = {name: [] for _, name, _, _ in m.sets}
        for score, name, at, n in m.windows(w):
            got[name].append((at, at + n, score))
        for size, name, length, own in m.sets:
            every = {}
            for at in range(max(1, len(w) - length + 1)):
                a = licenses.bigrams(w[at : at + length])
                if a and 2 * len(a & own) / (len(a) + size) >= 0.6:
                    every[at] = 2 * len(a & own) / (len(a) + size)
            for at, end, score in got[name]:
                assert every[at] == score
            for at in every:  # each place that holds is a run or overlaps one
                assert any(lo < at + length and at < hi for lo, hi, _ in got[name]), (w, name, at)
            if every:
                assert max(every.values()) == max(x[2] for x in got[name])


def test_lines(spark, none):
    r = random.Random(4)
    line = lambda: " ".join(f"l{r.randrange(10**6)}" for _ in range(6))
    passage = [line() for _ in range(12)]
    data = []
    for i in range(30):
        own = [line() for _ in range(10)]
        data.append((i, "\n".join(own[: i % 10] + (passage if i % 2 == 0 else []) + own[i % 10 :])))
    data += [(30, None), (31, ""), (32, "\n\n\n"), (5, data[5][1])]
    got = lines.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert len(got) == len(data)
    for x in got:
        if x.doc_id in (30, 31, 32):
            assert x.clean == x.text
        elif x.doc_id % 2 == 0 and x.doc_id:
            assert x.n_removed_lines >= 6  # most of the passage
        elif x.doc_id != 5:
            assert x.clean == x.text
        if x.text:
            assert len(x.text.split("\n")) - x.n_removed_lines == (len(x.clean.split("\n")) if x.clean else 0) or not x.clean
    assert sorted(x.n_removed > 0 for x in got if x.doc_id == 5) == [False, True]
    assert lines.dedup_lines(none).count() == 0


def test_lines_runs(spark):
    """A repeated run of over 50 words goes whatever stands around it, one line or many, the run's ends included; first copies, runs of 50 words and overlaps with the first stay."""
    r = random.Random(6)
    line = lambda n: " ".join(f"l{r.randrange(10**9)}" for _ in range(n))
    own = lambda: [line(r.randrange(1, 30)) for _ in range(r.randrange(1, 6))]
    data, want, i = [], {}, 0
    for sizes in ([51], [80], [30, 30], [5, 46], [46, 5], [5, 30, 30], [30, 30, 5], [20, 20, 20], [60, 1, 60], [13] * 4, [11] * 5, [1] * 51):
        passage = [line(n) for n in sizes]
        for copy in range(6):
            a, b = own(), own()
            text = a + (passage[:1] + [" "] * copy + passage[1:] if copy < 3 and len(passage) > 1 else passage) + b
            data.append((i, "\n".join(text)))
            want[i] = "\n".join(a + b) if copy else "\n".join(text)
            i += 1
    single = line(50)
    for copy in range(2):  # one line of 50 words isn't over the limit; it stands between own lines
        data.append((i, f"{line(3)}\n{single}\n{line(4)}"))
        want[i] = data[-1][1]
        i += 1
    whole = line(60)
    data += [(i, whole), (i + 1, whole), (i + 2, "\n".join([line(30)] * 3)), (i + 3, None)]
    want |= {i: whole, i + 1: "", i + 3: None}
    got = {x.doc_id: x for x in lines.dedup_lines(cut(spark.createDataFrame(data, "doc_id long, text string").repartition(3), "runs")).collect()}
    for k, clean in want.items():
        assert got[k].clean == clean, k
    assert got[i + 1].n_removed_lines == got[i + 1].n_removed == 1


def test_lm_base(docs, rows, none):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = collections.Counter()
    for i, t, *_ in rows:
        if not out(i):
            counts.update([*lower(t).split(), None])
    n, v = sum(counts.values()), len(counts)
    lm.COMMON_WORDS, was = 50, lm.COMMON_WORDS
    got = collected(lm.score(docs.select("doc_id", "text"), held), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    lm.COMMON_WORDS = was
    want = []
    for i, t, *_ in rows:
        w = [*lower(t).split(), None]
        want.append((i, out(i), len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    for g, x in zip(got, sorted(want, key=str), strict=True):
        assert g[:5] == x[:5] and g[5] == pytest.approx(x[5])
    assert lm.score(none.select("doc_id", "text"), held).count() == 0


def vocabulary(r, n=300, ends=9):
    counts = np.zeros(500, np.int64)
    counts[r.permutation(500)[:n]] = (2000 / (1 + np.arange(n))).astype(np.int64) + 1
    return lm.Vocabulary(counts, ends)


def test_lm_model():
    """Gradients agree with differences; probabilities of all items add up to one; no place looks ahead."""
    r = np.random.default_rng(1)
    v = vocabulary(r)
    assert v.item.max() == v.unseen and len(set(v.item)) == 301 and 0 <= v.end < v.unseen and v.bounds[-1] == v.unseen + 1
    p = {k: a.astype(np.float64) for k, a in lm.start(v).items()}
    x, y, w, _ = lm.windows(v, [r.integers(0, v.unseen + 1, 100)])
    assert w.sum() == 101
    grad = lm.backward(p, v, x, y, w)
    rows = np.zeros_like(p["E"])
    rows[grad["E"][0]] = grad["E"][1]
    grad["E"] = rows
    loss = lambda: -(lm.target_logs(p, v, x, y) * w.ravel()).sum() / w.sum()
    for k in p:
        for _ in range(3):
            i = tuple(r.integers(0, n) for n in p[k].shape)
            p[k][i] += 1e-4
            up = loss()
            p[k][i] -= 2e-4
            down = loss()
            p[k][i] += 1e-4
            assert (up - down) / 2e-4 == pytest.approx(grad[k][i], rel=0.02, abs=1e-6)
    one = x[2:3]
    logs = np.array([lm.target_logs(p, v, one, np.full((1, lm.STRIDE), i)) for i in range(v.unseen + 1)])
    assert np.allclose(np.exp(logs).sum(0), 1)
    z = x.copy()
    z[:, 20] = 3
    a, b = (lm.target_logs(p, v, q, y).reshape(len(x), lm.STRIDE) for q in (x, z))
    assert np.allclose(a[:, : 20 - lm.LEAD], b[:, : 20 - lm.LEAD]) and not np.allclose(a, b)


def test_lm_large_logits():
    """Gradients agree with differences and probabilities add up to one for logits far beyond what exponentials hold."""
    r = np.random.default_rng(4)
    v = vocabulary(r)
    p = {k: a.astype(np.float64) for k, a in lm.start(v).items()}
    p["U"], p["W"] = p["U"] * 60, p["W"] * 60
    x, y, w, _ = lm.windows(v, [r.integers(0, v.unseen + 1, 100)])
    logs = np.array([lm.target_logs(p, v, x[2:3], np.full((1, lm.STRIDE), i)) for i in range(v.unseen + 1)])
    assert logs.min() < -60 and np.allclose(np.exp(logs).sum(0), 1)
    grad = lm.backward(p, v, x, y, w)
    loss = lambda: -(lm.target_logs(p, v, x, y) * w.ravel()).sum() / w.sum()
    for k in ("U", "W"):
        for i in zip(*np.unravel_index(np.argsort(-abs(grad[k]), axis=None)[:20], grad[k].shape), strict=True):
            p[k][i] += 1e-5
            up = loss()
            p[k][i] -= 2e-5
            down = loss()
            p[k][i] += 1e-5
            assert (up - down) / 2e-5 == pytest.approx(grad[k][i], rel=0.02, abs=1e-6)


def test_lm_subwords():
    """Whole texts are split as their words are one by one."""
    s = lm.Subwords(lm.TOKENIZER)
    for text in ("", "the whole job", "zqxj\u00a0v\u3000w | 日本語 <|endoftext|> \0 never \0", "a " * 300 + "b" * 2000 + " é" * 600):
        for words in (lm.tokens(text.encode()), lm.tokens(text.encode()) + [b"\xff\xfe"]):
            cuts = [x[i : i + lm.LONGEST_PIECE] for x in (b" " + w for w in words) for i in range(0, len(x), lm.LONGEST_PIECE)]
            assert s.ids(words).tolist() == [i for c in cuts for i in s.core.encode_single_piece(c)]


def test_lm_splits_once(spark, monkeypatch):
    """Each text is split into subwords once, for counts, training and scores."""
    made = []
    monkeypatch.setattr(lm, "cut", lambda df, tag: made.append((tag, c := cut(df, tag))) or c)
    df = spark.createDataFrame([(1, "one two"), (2, None), (3, "one two")], "doc_id long, text string")
    assert lm.score(df, F.col("doc_id") == 2).count() == 3
    ids = [c for tag, c in made if tag == "lm-ids"]
    assert len(ids) == 1 and sorted(len(r.ids) > 0 for r in ids[0].collect()) == [False, True, True]


def test_parities_bound_differences():
    """Bins whose parities differ are never more than the shingles that differ, for sets of unlike sizes too."""
    r = np.random.default_rng(3)
    for n, m in ((1, 1), (5, 40), (300, 300), (300, 900), (40_000, 70_000)):
        common = r.integers(-(2**62), 2**62, min(n, m) // 2)
        a, b = (np.unique(np.concatenate([common, r.integers(-(2**62), 2**62, k - len(common))])) for k in (n, m))
        differ = len(np.setxor1d(a, b))
        assert ngram_join.unlike(ngram_join.parities(a), ngram_join.parities(b)) <= differ
        assert ngram_join.unlike(ngram_join.parities(a), ngram_join.parities(a)) == 0
        assert sum(int(x).bit_count() for x in (ngram_join.sketch(a) ^ ngram_join.sketch(b)).view(np.uint64)) <= differ


def test_lm_windows():
    v = vocabulary(np.random.default_rng(2))
    sizes = (0, 1, 15, 16, 17, 23, 24, 25, 300, 0)
    texts = [np.arange(n) % 50 for n in sizes]
    x, y, w, owner = lm.windows(v, texts)
    for i, seq in enumerate(texts):
        own = owner == i
        assert list(y[own][w[own]]) == [*seq, v.end]
        assert [*x[own][:, lm.LEAD :][w[own]]] == [v.bos, *seq]
        whole = np.concatenate([np.full(lm.LEAD + 1, v.bos), seq])
        for k, row in enumerate(x[own]):  # each window goes on where its place in the text is
            held = whole[k * lm.STRIDE : k * lm.STRIDE + lm.CONTEXT]
            assert list(row[: len(held)]) == list(held)


def test_lm_learns(spark):
    """Held-out texts of a language that the others show score far better than by counts alone; the same for any partitions."""
    r = random.Random(7)
    follow = {i: [r.randrange(40) for _ in range(3)] for i in range(40)}

    def text():
        w = [r.randrange(40)]
        while len(w) < 60:
            w.append(r.choice(follow[w[-1]]))
        return " ".join(f"word{i}" for i in w)

    data = [(i, text()) for i in range(2000)] + [(2000, None), (2001, ""), (2002, "unseen 日本語 words")] + [(2003, "x")] * 3
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("score", F.lit("kept out"))
    held = F.col("doc_id") % 5 == 1
    one, six = ({(x.doc_id, x.held_out): x.score for x in lm.score(cut(df.repartition(n), "lm-docs"), held).collect()} for n in (1, 6))
    assert all(one[k] == pytest.approx(six[k], rel=1e-5, abs=1e-4) for k in one)
    s = lm.Subwords(lm.TOKENIZER)
    ids = {i: s.ids(lm.tokens((t or "").encode())) for i, t in data}
    counts = collections.Counter(int(x) for i, t in data if i % 5 != 1 for x in [*ids[i], -1])
    n = sum(counts.values())
    tests = [i for i in range(2000) if i % 5 == 1]
    unigram = sum(math.log10(counts[int(x)] / n) for i in tests for x in [*ids[i], -1])
    assert sum(one[i, True] for i in tests) > 0.75 * unigram
    assert lm.score(df.limit(0), held).count() == 0


def test_lm_trains_on_all(spark, monkeypatch):
    """Every subword and end of the training texts is a target once, whatever the number of groups; a group's order is the rows'."""
    r = random.Random(8)
    data = [(i, " ".join(f"w{r.randrange(50)}" for _ in range(n))) for i, n in enumerate([0, 1, 20, 31, 32, 33, 70, 500] * 6)]
    s = lm.Subwords(lm.TOKENIZER)
    counts = np.zeros(s.size, np.int64)
    for _, t in data:
        np.add.at(counts, s.ids(lm.tokens(t.encode())), 1)
    v = lm.Vocabulary(counts, len(data))
    rows = []
    monkeypatch.setattr(lm, "cut", lambda df, tag: rows.append(c := cut(df, tag)) or c)
    monkeypatch.setattr(lm, "forget", lambda *_: None)
    monkeypatch.setattr(lm, "GROUP", 500)
    df = spark.createDataFrame(data, "doc_id long, text string")
    one = lm.train(df.repartition(1), v, int(counts.sum()) + len(data), lm.TOKENIZER)
    assert sum(x.n for c in rows for x in c.where("i = 0").collect()) == counts.sum() + len(data)
    two = lm.train(df.repartition(7), v, int(counts.sum()) + len(data), lm.TOKENIZER)
    assert all(np.allclose(one[k], two[k], atol=1e-6) for k in one)


def test_pipeline(spark, tmp_path, rows):
    import corpus_pipeline

    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows[20][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, str(tmp_path)), "stage")
        seen.append(docs)
    assert all(d.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", ")] for d in seen[:-1])
    first = {r.doc_id for r in seen[0].collect()}
    assert 75 not in first and 76 not in first and 80 not in first and 60 in first
    second = [r.doc_id for r in seen[1].collect()]
    assert len(second) == len(set(second)) and len([i for i in second if 60 <= i < 75]) < 15
    assert {r.doc_id for r in seen[2].collect()} == set(second) - {20}
    assert seen[4].count() == seen[3].count() and {"shard", "slot", "size", "text"} <= set(seen[4].columns)
