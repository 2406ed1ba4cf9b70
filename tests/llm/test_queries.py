"""The registered text queries against their SQL over the smallest tables, and the whole pipeline against brute force."""

import collections
import hashlib
import math
import random
import re
from pathlib import Path

import pytest

import corpus_pipeline
from cardloom.llm import mixing, registry

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(str([one(r[i]) for i in order]) for r in data)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    if not Path(DATA).exists():
        pytest.skip("no tables")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = registry.QUERIES[name](spark, DATA)
    got = con.execute(registry.SQL[name])
    columns = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, got.fetchall())


def lower(t):
    return (t or "").encode().lower().decode()


def quality(rows):
    """Base rules, and lines of over 30 texts and over a hundredth of a source's texts."""
    texts, lines = collections.defaultdict(set), collections.defaultdict(set)
    key = lambda x: lower(" ".join(x.split()))
    for _, t, _, s, _ in rows:
        texts[s or ""].add(t or "")
        for x in (t or "").split("\n"):
            if x.split():
                lines[s or "", key(x)].add(t)
    bad = {k for k, v in lines.items() if len(v) > 30 and len(v) > 0.01 * len(texts[k[0]])}
    out = []
    for i, t, lang, s, n in rows:
        w = (t or "").split()
        grams = collections.Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        again = {x for j in range(len(w) - 7) if grams[tuple(w[j : j + 8])] > 1 for x in range(j, j + 8)}
        gone = [x for x in (t or "").split("\n") if (s or "", key(x)) in bad]
        if len(w) >= 20 and 100 * len(again) <= 30 * len(w) and len(w) - sum(len(x.split()) for x in gone) >= 0.3 * len(w):
            left = "\n".join(x for x in t.split("\n") if (s or "", key(x)) not in bad)
            out.append((i, left, lang, s, len(left) if gone else n))
    return out


def near(rows):
    sets = []
    for _, t, *_ in rows:
        w = lower(t).split()
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    first = {}
    for k in range(len(rows)):
        g = find(k) if sets[k] else ("alone", k)
        first[g] = min(first.get(g, k), k, key=lambda x: (rows[x][0] is not None, rows[x][0] or 0))
    return [rows[k] for k in sorted(first.values())]


def clean(rows, bench):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    items = {tuple(w[k : k + min(13, len(w))]) for _, t in bench if (w := words(t)) for k in range(max(1, len(w) - 12))}
    out = []
    for r in rows:
        w, hit = words(r[1]), set()
        for m in {len(x) for x in items}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in items:
                    hit |= set(range(k, k + m))
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def mixed(rows):
    named = lambda s: s if s in mixing.WEIGHTS else None
    n = collections.Counter(named(r[3]) for r in rows)
    weight = {s: (mixing.WEIGHTS[s] if s else mixing.REST) for s in n}
    out = []
    for r in rows:
        mean = weight[named(r[3])] / sum(weight.values()) * len(rows) / n[named(r[3])]
        key = f"{mixing.SEED}:{'~' if r[0] is None else r[0]}:{hashlib.md5((r[1] or '').encode()).hexdigest()}:part0"
        u, k, p = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52, 0, math.exp(-mean)
        total = p
        while total <= u:
            k += 1
            p *= mean / k
            total += p
        out += [r] * k
    return out


def test_pipeline_brute_force(spark, tmp_path):
    """run() over documents of all kinds gives the rows that the five stages' rules give in Python, in shards of equal bytes."""
    r = random.Random(11)
    words = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    rows = [(i, " ".join(words(r.randrange(5, 90))), "en", f"src{i % 6}", 0) for i in range(150)]
    rows += [(200 + i, "shared footer LINE\n" + " ".join(words(40)), "en", "src0", 0) for i in range(45)]
    base = words(120)
    for i in range(300, 330):
        w = list(base)
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = f"z{r.randrange(99)}"
        rows.append((i, " ".join(w), "en", "src1", 0))
    rows += [(400, None, None, None, None), (401, "", "en", "src1", 0), (402, "a b c " * 40, "en", "src2", 0), (403, " ".join(words(3000)), "fr", None, 7), rows[3], rows[3], rows[40]]
    bench = [(1, rows[10][1]), (2, " ".join(rows[250 - 100][1].split()[5:25])), (3, None)]
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = mixed(clean(near(quality(rows)), bench))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str((x.doc_id, x.text, x.lang, x.source, x.n_chars)) for x in got) == sorted(map(str, want))
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for x in got:
        assert x["size"] == len((x.text or "").encode()) + 16
        sizes[x.shard] += x["size"]
        slots[x.shard].append(x.slot)
    most = max(x["size"] for x in got)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(sizes) <= set(range(40))
    assert all(abs(v - sum(sizes.values()) / 40) <= 2 * most for v in sizes.values())


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
