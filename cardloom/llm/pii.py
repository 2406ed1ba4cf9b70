"""Personal data: overlapping candidates, boosted trees over their format and context, calibrated thresholds.

Everything on the path of the rows is DataFrame expressions. Training sees counts of rows by feature bins, a table whose
size is bounded by the product of the bins, and not the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

KINDS = ("email", "ip", "card", "phone")
#: Leftmost matches as the plain patterns give them. Possessive runs keep the search linear in long runs; \G lets a
#: match begin right where the last one ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: High-recall generators; their spans overlap the base ones and each other.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\[dot\]|\(dot\))\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\x20?\.\x20?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]?[0-9]{2,6}){2,4}(?![0-9])",
    "phone": r"(?<![0-9+.])(?:00[1-9][0-9]{0,2}|\([0-9]{2,4}\)|[0-9]{3})[\x20./-]?[0-9]{3,4}[\x20./-][0-9]{3,5}(?![0-9.])",
}
#: A cheap test that a text can hold a match at all.
NEEDS = {"email": r"@|\[at\]|\(at\)", "ip": r"[0-9]\x20?\.\x20?[0-9]", "card": r"[0-9][\x20._/-]?[0-9]", "phone": r"[0-9]"}
CONTEXT, ROUNDS, RATE, LEAST_PRECISION = 24, 20, 0.3, 0.98
FEATURES = {"digits": 6, "length": 6, "separators": 4, "before": 3, "after": 3, "cue": 2, "same": 3}
#: An e-mail address that can be one: dots within its parts alone, a last label of letters.
MAILBOX = r"^[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}$"
MATCHED = "array<struct<kind:int,base:boolean,of:int,i:int,p:int,pb:int,m:string,l:string,r:string,c:string>>"
SPAN = "array<struct<kind:int,s:int,e:int>>"


def matches(text: Column, pattern: str, of: int) -> Column:
    """Each match, with the length in code points and in bytes of the piece between it and the last one, the characters beside it and those before it, up to the last match. One pass over the text."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def one(x, i, q, f):
        p = F.get(q, i)
        return F.struct(
            F.lit(of % len(KINDS)).alias("kind"), F.lit(of < len(KINDS)).alias("base"), F.lit(of).alias("of"), i.alias("i"), F.length(p).alias("p"), F.octet_length(p).alias("pb"), x.alias("m"),
            F.when((p == "") & (i > 0), F.right(F.get(f, i - 1), F.lit(1))).otherwise(F.right(p, F.lit(1))).alias("l"),
            F.coalesce(F.nullif(F.left(F.get(q, i + 1), F.lit(1)), F.lit("")), F.left(F.get(f, i + 1), F.lit(1)), F.lit("")).alias("r"),
            F.right(p, F.lit(CONTEXT)).alias("c"),
        )

    # both arrays are worked out once: lambdas name them as variables
    rows = F.get(F.transform(F.array(F.struct(pieces.alias("q"), found.alias("f"))), lambda v: F.transform(v["f"], lambda x, i: one(x, i, v["q"], v["f"]))), F.lit(0))
    return F.when(text.rlike(NEEDS[KINDS[of % len(KINDS)]]), rows).otherwise(F.array().cast(MATCHED))


def luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")
    d = F.transform(F.filter(back, lambda c: c != ""), lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(d, F.lit(0), lambda a, b: a + b) % 10 == 0


def plain(kind: Column, m: Column) -> Column:
    """A match without what only hides it: [at] and [dot] written out, spaces around the signs of e-mails and ips."""
    mail = F.regexp_replace(F.regexp_replace(m, r"\x20?(?:\[at\]|\(at\)|@)\x20?", "@"), r"\x20?(?:\[dot\]|\(dot\))\x20?", ".")
    return F.when(kind == 0, mail).when(kind == 1, F.replace(m, F.lit(" "), F.lit(""))).otherwise(m)


def valid(kind: Column, m: Column) -> Column:
    """The base rules' check of a match."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    octet = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])?"
    fits = F.when(kind == 1, m.rlike(rf"^(?:{octet})(?:\.{octet}){{3}}$"))
    return F.when(kind == 0, True).when(kind == 1, fits).when(kind == 2, F.when(n.between(13, 19), luhn(digits)).otherwise(False)).otherwise(n.between(9, 15))


def candidates(docs: DataFrame) -> DataFrame:
    """__rid and one row for each span: kind, s, e, sb, eb (code points and bytes), base (a match of the plain pattern), ok (the base check holds), well (it can be real: of e-mails the mailbox rules too), and the features.

    A row without a span has none here. Texts move nowhere: matches are found in their own row with the pieces between
    them, and running sums of lengths give their places, over rows that hold no text. The time is linear in a text's spans.
    """
    text = F.col("text")
    rows = docs.select("__rid", F.explode(F.concat(*[matches(text, group[k], j * len(KINDS) + i) for j, group in enumerate((BASE, WIDE)) for i, k in enumerate(KINDS)])).alias("c")).select("__rid", "c.*")
    digits = F.length(F.regexp_replace("m", "[^0-9]", ""))
    rows = rows.withColumn("t", plain(F.col("kind"), F.col("m")))
    ok = valid(F.col("kind"), F.when(F.col("base"), F.col("m")).otherwise(F.col("t")))
    rows = rows.select(
        "__rid", "kind", "base", "of", "i", "p", "pb", F.length("m").alias("n"), F.octet_length("m").alias("nb"),
        ok.alias("ok"), (ok & ((F.col("kind") != 0) | F.col("t").rlike(MAILBOX))).alias("well"), (F.crc32(F.lower("t").cast("binary")) % 2).cast("int").alias("fold"),
        F.when(digits < 4, 0).when(digits < 9, 1).when(digits < 13, 2).when(digits < 16, 3).when(digits < 20, 4).otherwise(5).alias("digits"),
        F.when(F.length("t") < 8, 0).when(F.length("t") < 12, 1).when(F.length("t") < 16, 2).when(F.length("t") < 20, 3).when(F.length("t") < 32, 4).otherwise(5).alias("length"),
        F.least(F.length(F.regexp_replace("t", r"[A-Za-z0-9.@]", "")), F.lit(3)).alias("separators"),
        F.when(F.col("l") == "", 0).when(F.col("l").rlike(r"\s"), 1).otherwise(2).alias("before"),
        F.when(F.col("r") == "", 0).when(F.col("r").rlike(r"[\s.,;:!?]"), 1).otherwise(2).alias("after"),
        F.col("c").rlike(r"(?i)(mail|phone|tel|call|fax|card|visa|host|server|\bip\b|contact|reach)").cast("int").alias("cue"),
        F.least(F.size(F.array_distinct(F.split(F.regexp_replace("m", "[^0-9]", ""), ""))) / 3, F.lit(2)).cast("int").alias("same"),
    )
    w = Window.partitionBy("__rid", "of").orderBy("i")
    e, eb = F.sum(F.col("p") + F.col("n")).over(w), F.sum(F.col("pb") + F.col("nb")).over(w)
    rows = rows.withColumns({"e": e.cast("int"), "eb": eb.cast("int")}).withColumns({"s": F.col("e") - F.col("n"), "sb": F.col("eb") - F.col("nb")})
    return rows.drop("of", "i", "p", "pb", "n", "nb")


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def boost(cells: list[tuple[tuple[int, ...], float, float]]) -> list[tuple]:
    """Trees of depth two on (bins, positives, negatives) by Newton steps of the logistic loss; each is nested tuples (feature, threshold, left, right)."""

    def leaf(idx):
        g, h = sum(grad[i] for i in idx), sum(hess[i] for i in idx)
        return RATE * g / (h + 1.0)

    def grow(idx, depth):
        g, h = sum(grad[i] for i in idx), sum(hess[i] for i in idx)
        best = (1e-6, None)
        if depth:
            for f in range(len(cells[0][0])):
                for t in sorted({cells[i][0][f] for i in idx})[:-1]:
                    gl = sum(grad[i] for i in idx if cells[i][0][f] <= t)
                    hl = sum(hess[i] for i in idx if cells[i][0][f] <= t)
                    gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                    if gain > best[0]:
                        best = (gain, (f, t))
        if best[1] is None:
            return leaf(idx)
        f, t = best[1]
        return (f, t, grow([i for i in idx if cells[i][0][f] <= t], depth - 1), grow([i for i in idx if cells[i][0][f] > t], depth - 1))

    score, trees = [0.0] * len(cells), []
    for _ in range(ROUNDS if cells else 0):
        p = [sigmoid(s) for s in score]
        grad = [c[1] - (c[1] + c[2]) * q for c, q in zip(cells, p, strict=True)]
        hess = [(c[1] + c[2]) * q * (1 - q) for c, q in zip(cells, p, strict=True)]
        trees.append(grow(list(range(len(cells))), 2))
        score = [s + value(trees[-1], c[0]) for s, c in zip(score, cells, strict=True)]
    return trees


def value(tree, bins) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if bins[tree[0]] <= tree[1] else tree[3]
    return tree


def expression(tree, names: list[str]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(F.col(names[tree[0]]) <= tree[1], expression(tree[2], names)).otherwise(expression(tree[3], names))


def threshold(cells, trees) -> float:
    """The least score from which, held-out cells taken from the top, the share of positives stays at LEAST_PRECISION or more. With no held-out cells the middle, 0; where even the best score is too often wrong, none."""
    found, pos, n, cut_at = {}, 0.0, 0.0, math.inf
    for bins, p, q in cells:
        s = round(sum(value(t, bins) for t in trees), 9)
        a = found.setdefault(s, [0.0, 0.0])
        a[0] += p
        a[1] += p + q
    for s in sorted(found, reverse=True):
        pos, n = pos + found[s][0], n + found[s][1]
        if pos >= LEAST_PRECISION * n and found[s][0] >= LEAST_PRECISION * found[s][1]:
            cut_at = s
    return cut_at if found else 0.0


def located(docs: DataFrame) -> DataFrame:
    """The spans to redact, each once: __rid, kind, s, e, sb, eb, is_base."""
    found = cut(candidates(docs), "pii-candidates")
    names = list(FEATURES)
    # labelled are base matches that can be real, and all candidates that can't; at most 2 folds x 4 kinds x 7776 bins
    labelled = found.where("(base and well) or not well")
    counts = labelled.groupBy("fold", "kind", *names).agg(F.count_if("well").cast("double").alias("p"), F.count_if(~F.col("well")).cast("double").alias("q")).collect()
    accept = F.lit(False)
    for k in range(len(KINDS)):
        learn, check = (sorted((tuple(int(r[n]) for n in names), r.p, r.q) for r in counts if r.kind == k and r.fold == f) for f in (0, 1))
        trees = boost(learn)
        at = threshold(check, trees)
        if at < math.inf:
            score = F.lit(0.0)
            for t in trees:
                score = score + expression(t, names)
            accept = accept | ((F.col("kind") == k) & (F.round(score, 6) >= round(at, 6)))
    rows = found.withColumn("is_base", F.col("base") & F.col("ok")).where(F.col("is_base") | (~F.col("base") & F.col("well") & accept))
    rows = rows.groupBy("__rid", "kind", "s", "e").agg(F.min("sb").alias("sb"), F.min("eb").alias("eb"), F.bool_or("is_base").alias("is_base"))
    # a span lies inside a base span when one that starts no later ends no sooner
    reach = F.max(F.when(F.col("is_base"), F.col("e"))).over(Window.partitionBy("__rid").orderBy("s").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("reach", reach).where("is_base or reach is null or reach < e").drop("reach")


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone, base_spans and spans (arrays of struct kind, s, e; code points, e exclusive).

    Base spans are the plain patterns' leftmost matches that pass their check; they always stay. The wide generators'
    other spans are scored by boosted trees, one set for each kind, over their form (with what hides it undone) and
    context. No labels exist: positive examples are base matches that can be real, negative ones are candidates of both
    generators that can't (a checksum, digits, an octet or a mailbox is wrong). The trees learn from half of the forms, by a hash;
    the other half calibrates the threshold to LEAST_PRECISION. A wide span is kept when it can be real, scores over
    the threshold and doesn't lie inside a base span. How often a text occurs changes no rule.
    A null text is the empty one. Repeated rows are judged each by itself. Columns that clash are replaced.
    """
    docs = docs.drop("n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans").withColumn("__rid", F.monotonically_increasing_id())
    rows = located(docs.select("__rid", F.coalesce(F.col(text), F.lit("")).alias("text")))
    span = F.struct("kind", "s", "e")
    per = rows.groupBy("__rid").agg(F.array_sort(F.collect_list(F.when(F.col("is_base"), span))).alias("base_spans"), F.array_sort(F.collect_list(span)).alias("spans"))
    out = docs.join(cut(per, "pii-spans"), "__rid", "left").withColumns({c: F.coalesce(c, F.array().cast(SPAN)) for c in ("base_spans", "spans")})
    of_kind = lambda i: F.size(F.filter("base_spans", lambda x: x["kind"] == i)).cast("long")
    return out.withColumns({f"n_{k}": of_kind(i) for i, k in enumerate(KINDS)}).drop("__rid")


def joined(c: str) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(c, lambda x: F.concat_ws(":", F.element_at(kind, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the spans of `text` replaced by [kind]; spans that overlap are replaced as one, by the kind of the first (the longest, then the kinds' order).

    Texts are cut by bytes, so the time is linear in a text's length. Null texts stay null.
    """
    docs = docs.withColumn("__rid", F.monotonically_increasing_id())
    w = Window.partitionBy("__rid").orderBy("sb", F.desc("eb"), "kind")
    rows = located(docs.select("__rid", F.coalesce(F.col(text), F.lit("")).alias("text")))
    rows = rows.withColumn("last", F.max("eb").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("one", F.count_if(F.col("last").isNull() | (F.col("sb") >= F.col("last"))).over(w))
    whole = rows.groupBy("__rid", "one").agg(F.min("sb").alias("sb"), F.max("eb").alias("eb"), F.min_by("kind", F.struct("sb", -F.col("eb"), "kind")).alias("kind"))
    per = cut(whole.groupBy("__rid").agg(F.array_sort(F.collect_list(F.struct("sb", "eb", "kind"))).alias("__spans")), "pii-redacted")
    kind, raw = F.array(*[F.lit(k) for k in KINDS]), F.col(text).cast("binary")
    part = lambda lo, n: F.substring(raw, lo + 1, n).cast("string")

    def piece(x, i):
        lo = F.coalesce(F.get("__spans", i - 1)["eb"], F.lit(0))
        return F.concat(part(lo, x["sb"] - lo), F.lit("["), F.element_at(kind, x["kind"] + 1), F.lit("]"))

    last = F.element_at("__spans", -1)["eb"]
    made = F.concat(F.array_join(F.transform("__spans", piece), ""), part(last, F.octet_length(text) - last))
    return docs.join(per, "__rid", "left").withColumn(text, F.when(F.col("__spans").isNotNull() & F.col(text).isNotNull(), made).otherwise(F.col(text))).drop("__rid", "__spans")


def op2_pii(spark, sf_dir) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"))
