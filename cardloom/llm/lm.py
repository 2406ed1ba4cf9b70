"""Language-model scores: a causal self-attention model over subword ids, and a smoothed unigram base score."""

from __future__ import annotations

import base64
import math
from collections import Counter
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, cut, forget, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A class is a run of items, by count, with a share of up to 1 / CLASSES of all or one item, and of at most MOST_ITEMS.
CLASSES, MOST_ITEMS = 32, 256
WIDTH, CONTEXT, STRIDE, BATCH = 16, 24, 16, 512
LEAD = CONTEXT - STRIDE
#: Windows that are computed at once, so that what they need stays in a core's cache, and windows that are scored at once.
BLOCK, SCORED = 64, 4096
LEAST_SUM, MOST_SUM = 1e-25, 1e25
#: All windows of the training texts train the weights once: in so many rounds, by groups of about so many subwords a round.
ROUNDS, GROUP, STEP, SEED = 4, 1 << 20, 0.02, 5
#: Words whose counts every task holds, of those with a share of 1 / (20 * COMMON_WORDS) or more; the others' counts come by a join.
COMMON_WORDS = 100_000
#: Longer words are cut into pieces of so many bytes before they are split into subwords, which keeps the time linear.
LONGEST_PIECE = 512
#: Which places each scored place sees: itself and those before it.
SEES = np.tril(np.ones((CONTEXT, CONTEXT), np.float32))[LEAD:]
#: Pieces that weights are cut into to be summed, each in one place.
PARTS = 16


def tokens(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def kind_of(size: int):
    return np.uint16 if size <= 1 << 16 else np.uint32


class Subwords:
    """Subword ids of words, each split with one space before it."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = max(ranks.values()) + 1
        self.kind = kind_of(self.size)
        # Without a special token, tiktoken looks for an empty one at every place.
        self.core = tiktoken.Encoding("words", pat_str=r" [^ ]+", mergeable_ranks=ranks, special_tokens={"\0 never \0": self.size})._core_bpe

    def ids(self, words: list[bytes]) -> np.ndarray:
        try:
            if max(map(len, words), default=LONGEST_PIECE) < LONGEST_PIECE:
                return np.frombuffer(self.core.encode_to_tiktoken_buffer((b" " + b" ".join(words)).decode(), set()), np.uint32).astype(self.kind)
        except UnicodeDecodeError:
            pass
        pieces = (w[j : j + LONGEST_PIECE] for w in (b" " + w for w in words) for j in range(0, len(w), LONGEST_PIECE))
        return np.array([i for x in pieces for i in self.core.encode_single_piece(x)], self.kind)


@lru_cache(maxsize=1)
def subwords_of(path: str) -> Subwords:
    """One table for all tasks of a Python worker, which from now on keeps the memory of freed arrays: glibc returns less to
    the system once a large block was freed, and new pages cost a quarter of the time of a window."""
    np.empty(24 << 20, np.uint8)
    return Subwords(path)


class Vocabulary:
    """The items that the model knows: each subword id that the training texts hold and the text's end, by count, then one
    for all other ids (no text tells them apart, so each has an equal part of that item's probability). Classes are runs of items."""

    def __init__(self, counts: np.ndarray, ends: int):
        ids = np.flatnonzero(counts)
        c = np.append(counts[ids], ends).astype(np.float64)
        order = np.lexsort((np.append(ids, len(counts)), -c))
        rank = np.empty(len(order), np.intp)
        rank[order] = np.arange(len(order))
        self.unseen, self.bos = len(order), len(order) + 1
        self.item = np.full(len(counts), self.unseen, np.intp)
        self.item[ids], self.end = rank[:-1], int(rank[-1])
        self.share = np.append(c[order], 0) + 0.5
        self.share /= self.share.sum()
        starts, held = [0], 0.0
        for i, s in enumerate(self.share):
            if held and (held + s > 1 / CLASSES or i - starts[-1] >= MOST_ITEMS):
                starts.append(i)
                held = 0.0
            held += s
        self.bounds = np.array([*starts, len(self.share)])
        self.cls = np.repeat(np.arange(len(starts), dtype=np.uint16), np.diff(self.bounds))
        self.unseen_log = -math.log(max(1, len(counts) - len(ids)))


def start(v: Vocabulary) -> dict[str, np.ndarray]:
    """The weights before training: class and item probabilities are the corpus shares."""
    r = np.random.default_rng(SEED)
    f = lambda *s: (r.standard_normal(s) * 0.1).astype(np.float32)
    classes = np.add.reduceat(v.share, v.bounds[:-1])
    p = {"E": f(v.bos + 1, WIDTH), "P": f(CONTEXT, WIDTH), "M": f(WIDTH, WIDTH), "N": f(WIDTH, WIDTH), "U": f(WIDTH, len(classes)).T, "W": f(v.unseen + 1, WIDTH)}
    p["U"] = np.column_stack([p["U"], np.log(classes).astype(np.float32)])  # what the state's last place, which is one, adds
    p["W"] = np.column_stack([p["W"], np.log(v.share / classes[v.cls]).astype(np.float32)])
    return p


def attend(p, x):
    """The state at the last STRIDE places of windows x with a one after it, and what backward needs. M joins queries and keys, N values and output."""
    h = p["E"].take(x, 0)
    h += p["P"]
    late = np.ascontiguousarray(h[:, LEAD:])
    q = (late.reshape(-1, WIDTH) @ p["M"]).reshape(late.shape)
    e = q @ np.ascontiguousarray(h.transpose(0, 2, 1))
    np.clip(e, -60, 60, out=e)  # in place of taking off the largest: the exponentials stay finite
    np.exp(e, out=e)
    e *= SEES
    e /= (e.reshape(-1, CONTEXT) @ np.ones(CONTEXT, e.dtype)).reshape(*e.shape[:2], 1)
    o = (e @ h).reshape(-1, WIDTH)
    z = np.ones((len(o), WIDTH + 1), o.dtype)
    np.add(late.reshape(-1, WIDTH), o @ p["N"], out=z[:, :WIDTH])
    return z, (h, late, q, e, o)


def fit(sums) -> bool:
    """Whether all sums of exponentials are in range; if not, they are taken again less each row's largest logit."""
    return sums.min() > LEAST_SUM and sums.max() < MOST_SUM


def log_shares(z, U, target):
    """Natural logs of the targets' shares by logits z @ U.T."""
    y = z @ U.T
    at = np.arange(0, y.size, y.shape[1]) + target
    own, one = y.reshape(-1).take(at), np.ones(y.shape[1], y.dtype)
    np.exp(y, out=y)
    sums = y @ one
    if not fit(sums):
        y = z @ U.T
        y -= y.max(1, keepdims=True)
        own = y.reshape(-1).take(at)
        sums = np.exp(y) @ one
    return own - np.log(sums)


def by_class(v: Vocabulary, c: np.ndarray):
    """An order of targets by their classes c, and for each class of two items or more that occurs its part of the order, its first item and the one after its last."""
    order = np.argsort(c, kind="stable")
    at = np.searchsorted(c[order], np.arange(len(v.bounds)))
    return order, [(slice(at[k], at[k + 1]), v.bounds[k], v.bounds[k + 1]) for k in np.flatnonzero((np.diff(v.bounds) > 1) & (np.diff(at) > 0))]


@np.errstate(over="ignore", invalid="ignore")
def target_logs(p, v: Vocabulary, x, target) -> np.ndarray:
    """Natural logs of the targets' probabilities at the scored places: of its class, and of the item within it."""
    t = target.ravel()
    c = v.cls[t]
    z, out = np.empty((len(t), WIDTH + 1), p["U"].dtype), np.empty(len(t), p["U"].dtype)
    for i in range(0, len(x), BLOCK):
        at = slice(i * STRIDE, (i + BLOCK) * STRIDE)
        z[at], _ = attend(p, x[i : i + BLOCK])
        out[at] = log_shares(z[at], p["U"], c[at])
    order, parts = by_class(v, c)
    z, t, inner = z.take(order, 0), t.take(order), np.zeros_like(out)
    for at, lo, hi in parts:
        step = max(BLOCK, (BLOCK << 10) // (hi - lo))
        for i in range(at.start, at.stop, step):
            part = slice(i, min(i + step, at.stop))
            inner[part] = log_shares(z[part], p["W"][lo:hi], t[part] - lo)
    out[order] += inner
    return out


def cross(z, U, target, scale, parts):
    """The gradients for z and U of the scaled cross entropy against target, by parts: of rows at, the logits are z[at] @ U[lo:hi].T."""
    sums, gz = np.ones_like(scale), np.zeros_like(z)
    for less in (False, True):
        gU = np.zeros_like(U)
        for at, lo, hi in parts:
            own, rows = z[at], U[lo:hi]
            y = own @ rows.T
            if less:
                y -= y.max(1, keepdims=True)
            np.exp(y, out=y)
            total = np.matmul(y, np.ones(hi - lo, y.dtype), out=sums[at])
            y.reshape(-1)[np.arange(-lo, y.size - lo, hi - lo) + target[at]] -= total
            np.matmul(y, rows, out=gz[at])
            gU[lo:hi] += y.T @ (own * (scale[at] / total)[:, None])
        if fit(sums):
            break
    gz *= (scale / sums)[:, None]
    return gz, gU


@np.errstate(over="ignore", invalid="ignore")
def backward(p, v: Vocabulary, x, target, weight):
    """Gradients of the mean cross entropy of windows x against target, over places of weight 1; that of E as (items, rows)."""
    t = target.ravel()
    scale = (weight.ravel() / max(float(weight.sum()), 1.0)).astype(p["U"].dtype)
    c = v.cls[t]
    grad = {k: np.zeros_like(p[k]) for k in ("P", "M", "N")}
    z, blocks, kept = np.empty((len(t), WIDTH + 1), p["U"].dtype), [slice(i, i + BLOCK) for i in range(0, len(x), BLOCK)], []
    places = [slice(b.start * STRIDE, b.stop * STRIDE) for b in blocks]
    for b, at in zip(blocks, places, strict=True):
        z[at], held = attend(p, x[b])
        kept.append(held)
    gz, grad["U"] = cross(z, p["U"], c, scale, [(at, 0, len(p["U"])) for at in places])
    order, parts = by_class(v, c)
    inner, grad["W"] = cross(z.take(order, 0), p["W"], t.take(order), scale.take(order), parts)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    gz += inner.take(back, 0)
    gh = np.empty((*x.shape, WIDTH), gz.dtype)
    for b, at, (h, late, q, e, o) in zip(blocks, places, kept, strict=True):
        g, to = np.ascontiguousarray(gz[at, :WIDTH]), gh[b]
        grad["N"] += o.T @ g
        go = (g @ p["N"].T).reshape(late.shape)
        gs = go @ np.ascontiguousarray(h.transpose(0, 2, 1))
        np.matmul(e.transpose(0, 2, 1), go, out=to)
        gs *= e
        gs -= e * (gs.reshape(-1, CONTEXT) @ np.ones(CONTEXT, gs.dtype)).reshape(*gs.shape[:2], 1)
        gq = (gs @ h).reshape(-1, WIDTH)
        to += gs.transpose(0, 2, 1) @ q
        grad["M"] += late.reshape(-1, WIDTH).T @ gq
        g += gq @ p["M"].T
        to[:, LEAD:] += g.reshape(late.shape)
        grad["P"] += to.sum(0)
    flat = x.ravel().astype(np.uint16 if v.bos < 1 << 16 else np.uint32)  # short integers are sorted by radix
    order = np.argsort(flat, kind="stable")
    flat = flat.take(order)
    at = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    grad["E"] = flat[at].astype(np.intp), np.add.reduceat(gh.reshape(-1, WIDTH).take(order, 0), at, axis=0)
    return grad


class Adam:
    """Steps of Adam from the weights p; a row of E moves when its item is in the windows."""

    def __init__(self, p: dict[str, np.ndarray], step: float):
        self.p, self.step, self.t = {k: x.copy() for k, x in p.items()}, step, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def take(self, grad) -> None:
        self.t += 1
        rate, root = self.step / (1 - 0.9**self.t), 1 / (1 - 0.99**self.t)
        for k, g in grad.items():
            at, g = g if k == "E" else (None, g)
            m, v, p = (a[k] if at is None else a[k].take(at, 0) for a in (self.m, self.v, self.p))
            m += 0.1 * (g - m)
            g *= g
            v += 0.01 * (g - v)
            g = v * root
            np.sqrt(g, out=g)
            g += 1e-8
            np.divide(m, g, out=g)
            g *= rate
            p -= g
            if at is not None:
                self.m[k][at], self.v[k][at], self.p[k][at] = m, v, p


def windows(v: Vocabulary, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets, the places that count, and the text of each window, so that each item of each of texts and its end is a target once.

    Windows overlap, and each is scored at its last STRIDE places, after LEAD places of context (starts before the text in the first window).
    """
    n = np.array([len(x) + 1 for x in texts], np.intp)
    count = -(-n // STRIDE)
    bos, end = np.full(LEAD + 1, v.bos, np.intp), np.full(STRIDE, v.end, np.intp)
    seq = np.concatenate([a for x, k in zip(texts, count * STRIDE - n + 1, strict=True) for a in (bos, x, end[:k])])
    size, owner = LEAD + 1 + count * STRIDE, np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = (np.repeat(np.cumsum(size) - size, count) + nth * STRIDE)[:, None] + np.arange(CONTEXT)
    counts = (nth * STRIDE)[:, None] + np.arange(STRIDE) < n[owner][:, None]
    return seq[at], seq[at[:, LEAD:] + 1], counts, owner


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), c over all rows; each task adds up what it holds before rows are dealt."""

    def run(batches):
        held = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])

        for b in batches:
            for t in b.column("text").to_pylist():
                held.update(tokens(t))
                if len(held) > 300_000:
                    yield out()
                    held.clear()
        yield out()

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def count_subwords(encoded: DataFrame, size: int) -> np.ndarray:
    """Counts of all subword ids in encoded(ids); as many rows as the vocabulary has come to the driver."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                ids = b"".join(b.column("ids").slice(lo, SLICE).to_pylist())
                total += np.bincount(np.frombuffer(ids, kind_of(size)), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "c"])

    out = np.zeros(size, np.int64)
    for r in encoded.select("ids").mapInArrow(run, "id long, c long").groupBy("id").agg(F.sum("c").alias("c")).collect():
        out[r.id] = r.c
    return out


def learnt_group(p, v: Vocabulary, texts: list[np.ndarray], step: float) -> tuple[dict[str, np.ndarray], int]:
    """The weights after one pass over the windows of texts (arrays of items), in their order, and the number of targets."""
    adam, left = Adam(p, step), None
    for i in range(0, len(texts), SLICE):
        part = windows(v, texts[i : i + SLICE])[:3]
        if left is not None:
            part = [np.concatenate(a) for a in zip(left, part, strict=True)]
        whole = len(part[0]) if i + SLICE >= len(texts) else len(part[0]) // BATCH * BATCH
        for j in range(0, whole, BATCH):
            adam.take(backward(adam.p, v, *(a[j : min(j + BATCH, whole)] for a in part)))
        left = [a[whole:] for a in part]
    return adam.p, sum(len(x) + 1 for x in texts)


def row_hash():
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text")).alias("h")


def train(docs: DataFrame, v: Vocabulary, targets: int, path: str) -> dict[str, np.ndarray]:
    """The weights that learn() gives for docs(doc_id, text)."""

    def encode(batches):
        s = subwords_of(path)
        for b in batches:
            ids = [s.ids(tokens(t)).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("h"), pa.array(ids, pa.binary())], names=["h", "ids"])

    return learn(docs.select(row_hash(), F.col("text").cast("binary").alias("text")).mapInArrow(encode, "h long, ids binary"), v, targets)


def learn(encoded: DataFrame, v: Vocabulary, targets: int) -> dict[str, np.ndarray]:
    """Local training on encoded(h, ids) in ROUNDS rounds: a row's hash gives its round and group; each group starts from the last round's
    weights, goes once over its windows in the order of hashes and gives its weights, which are averaged by targets.

    Every window of every training text is read once. Rounds, groups and orders follow from the rows alone, so the
    weights don't depend on partitions. A group holds about GROUP subwords; their number grows with the corpus.
    """
    spark = encoded.sparkSession
    groups = max(1, -(-targets // (ROUNDS * GROUP)))
    tasks = min(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))  # a task adds up its groups' weights before they are dealt
    p = start(v)
    names, shapes = list(p), {k: a.shape for k, a in p.items()}
    flat = np.concatenate([p[k].ravel() for k in names])
    key = encoded.select("h", "ids", F.pmod("h", F.lit(ROUNDS)).alias("r"), F.pmod(F.floor(F.col("h") / ROUNDS), F.lit(groups)).alias("g"))
    width = kind_of(len(v.item))
    for r in range(ROUNDS):
        now = spark.sparkContext.broadcast((flat, v))

        def run(batches, now=now, r=r):
            flat, v = now.value
            p, at = {}, 0
            for k in names:
                n = math.prod(shapes[k])
                p[k], at = flat[at : at + n].reshape(shapes[k]), at + n
            total, count, held, group = np.zeros(len(flat)), 0, [], None

            def add():
                nonlocal total, count
                if held:
                    q, n = learnt_group(p, v, [v.item[x] for x in held], STEP / (1 + r))
                    total += n * np.concatenate([q[k].ravel() for k in names])
                    count += n
                    held.clear()

            for b in batches:
                for g, ids in zip(b.column("g").to_pylist(), b.column("ids").to_pylist(), strict=True):
                    if g != group:
                        add()
                        group = g
                    held.append(np.frombuffer(ids, width))
            add()
            if count:
                cuts = [a.tobytes() for a in np.array_split(total, PARTS)]
                yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([count] * PARTS, pa.int64()), pa.array(cuts, pa.binary())], names=["i", "n", "w"])

        def summed(batches):
            held = {}
            for b in batches:
                for i, n, w in zip(*(b.column(c).to_pylist() for c in ("i", "n", "w")), strict=True):
                    old = held.get(i, (0, 0.0))
                    held[i] = old[0] + n, old[1] + np.frombuffer(w)
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()), pa.array([w.tobytes() for _, w in held.values()], pa.binary())], names=["i", "n", "w"])

        texts = key.where(F.col("r") == r).select("h", "g", "ids")
        part = texts.repartition(tasks, "g").sortWithinPartitions("g", "h", "ids").select("g", "ids").mapInArrow(run, "i int, n long, w binary")
        got = cut(part.repartition(PARTS, "i").mapInArrow(summed, "i int, n long, w binary"), "lm-weights")
        rows = sorted(got.collect(), key=lambda x: x.i)  # PARTS rows, as many bytes as the weights have
        forget(got)
        now.destroy()
        if rows:
            flat = np.concatenate([np.frombuffer(x.w) / x.n for x in rows]).astype(np.float32)
    out, at = {}, 0
    for k in names:
        n = math.prod(shapes[k])
        out[k], at = flat[at : at + n].reshape(shapes[k]), at + n
    return out


def score(docs: DataFrame, held_out, path: str = TOKENIZER) -> DataFrame:
    """For each row of docs(doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; no other column.

    Rows where held_out is false are learnt from; all are scored. Tokens are A-Z lower-cased words and one end. The base
    score is the sum of log10((c + 0.5) / (N + 0.5 * (V + 1))). The model's score is the sum of log10 probabilities of the
    text's subword ids and its end. Null and empty texts are an end alone; without training rows N, V and all counts are 0.
    Repeated rows are scored and counted each. `path` is a tokenizer's vocabulary that every executor can open.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", held_out.alias("held_out"), F.monotonically_increasing_id().alias("__rid"))
    learnt = rows.where("not held_out")
    words = cut(count_words(learnt), "lm-words")
    ends = learnt.count()
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = total.n + ends, total.v + (ends > 0)
    base = math.log10(n + 0.5 * (v + 1))
    common = {bytes(r.word): math.log10(r.c + 0.5) for r in words.where(F.col("c") >= n / (20 * COMMON_WORDS)).orderBy(F.desc("c"), "word").limit(COMMON_WORDS).collect()}
    known = spark.sparkContext.broadcast(common)
    end = math.log10(ends + 0.5)

    def encode(batches):
        s, common = subwords_of(path), known.value
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                b, cols = whole.slice(lo, SLICE), [[], [], [], [], []]
                for t in b.column("text").to_pylist():
                    w = tokens(t)
                    logs = np.fromiter(map(common.get, w, repeat(math.nan)), np.float64, len(w))
                    rare = np.flatnonzero(np.isnan(logs)).tolist()
                    held = len(w) - len(rare)
                    row = len(w) + 1, held + (ends > 0), float(np.nansum(logs)) + end - (held + 1) * base, [w[j] for j in rare], s.ids(w).tobytes()
                    for c, x in zip(cols, row, strict=True):
                        c.append(x)
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in ("__rid", "doc_id", "held_out", "h")), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                    names=["__rid", "doc_id", "held_out", "h", "n_tokens", "n_known", "base_score", "rare", "ids"],
                )

    shape = f"__rid long, doc_id {kind}, held_out boolean, h long, n_tokens long, n_known long, base_score double, rare array<binary>, ids binary"
    encoded = cut(rows.select("__rid", "doc_id", "held_out", row_hash(), F.col("text").cast("binary").alias("text")).mapInArrow(encode, shape), "lm-ids")
    counts = count_subwords(encoded.where("not held_out"), subwords_of(path).size)
    voc = Vocabulary(counts, ends)
    model = learn(encoded.where("not held_out"), voc, int(counts.sum()) + ends)
    shared = spark.sparkContext.broadcast((voc, model))

    def run(batches):
        subwords_of(path)
        voc, p = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                b = whole.slice(lo, SLICE)
                texts = [voc.item[np.frombuffer(x, kind_of(len(voc.item)))] for x in b.column("ids").to_pylist()]
                x, y, m, owner = windows(voc, texts)
                out = np.array([(x == voc.unseen).sum() for x in texts]) * voc.unseen_log
                for i in range(0, len(x), SCORED):
                    logs = target_logs(p, voc, x[i : i + SCORED], y[i : i + SCORED]).reshape(-1, STRIDE)
                    out += np.bincount(owner[i : i + SCORED], (logs * m[i : i + SCORED]).sum(1, dtype=np.float64), len(out))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out / math.log(10))], names=[*names, "score"])

    names = ["__rid", "doc_id", "held_out", "n_tokens", "n_known", "base_score"]
    shape = f"__rid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = cut(encoded.select(*names, "ids").mapInArrow(run, shape), "lm-scored")
    rare = encoded.select("__rid", F.explode("rare").alias("word")).join(words, "word", "left")
    rest = rare.groupBy("__rid").agg(F.count("c").alias("k"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5)) - F.lit(base)).alias("b"))
    out = scored.join(rest, "__rid", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("b", F.lit(0.0))).alias("base_score"), "score")


def op9_lm_score(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1)
