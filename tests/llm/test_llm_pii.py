import hashlib
import random
import re

from llm_fixtures import documents, empty, frame, prose
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabwatch.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def rules(text):
    spans = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, p) in enumerate(RULES.items())
        for m in re.finditer(p, text or "")
        if valid(kind, m[0])
    ]
    return sorted(spans)


ODD = [
    "a@b.cd@e.fg x@y@z.com a@b.c_d@e.fg foo@bar. foo@bar..com é@ü.de q.w+e%r@h-i.j-k.lm",
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255 1.2.3.256 12.34.56 1.2.3.4567",
    "4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111-0 0000000000000000 5 6 7 " + "1" * 40,
    "+1 (555) 123-4567 +12 ++49 30 1234567. +1234567890123456 +1-2 +(5) +9 ().- 8",
    "日本 +44 20 7946 0958 né a.b@c.org, 10.0.0.1;4012888888881881",
    "1" * 5000 + "." + "a." * 3000 + "@" + "b." * 3000,
    "call (212) 555-0187 x12 now or write joe (at) mail.example.com",
]


def people(n=300):
    rng = random.Random(8)
    rows = []
    for k in range(n):
        digits = [4, *[rng.randrange(10) for _ in range(14)]]
        digits.append(next(c for c in range(10) if luhn("".join(map(str, [*digits, c])))))
        parts = [
            f"{prose(rng, 'en', 4).strip()}{k}@mail{k % 7}.example.com".replace(" ", "").replace("\n", "").replace(",", ""),
            f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", ".".join(str(rng.randrange(256)) for _ in range(4)),
            "".join(map(str, digits)), f"order {rng.randrange(10**9, 10**10)}", f"key={rng.randrange(10**15, 10**16)}x",
        ]
        text = prose(rng, "en", 15) + " " + rng.choice(parts) + " " + prose(rng, "de", 9)
        rows.append((k, text, "en", "a", len(text), *["x"] * 9))
    return rows


def check(rows, trees, spark):
    got = pii.find(frame(spark, rows), trees).collect()
    wanted = []
    for row in rows:
        spans = rules(row[1])
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        counts = [sum(s[3] == kind for s in spans) for kind in RULES]
        wanted.append((row[0], *counts, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(wanted, key=str)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        order = [(int(a), list(RULES).index(k)) for k, a, _ in spans]
        assert order == sorted(order)
        base = {f"{k}:{a}:{b}" for a, _, b, k in rules(texts[r["doc_id"]])} if r["doc_id"] is not None else set()
        assert base <= set(r["spans"].split(",")) | {""}
    return got


def test_rules_on_odd_texts(spark):
    rows = [(k, t, "en", "a", 0, *["x"] * 9) for k, t in enumerate(ODD)] + documents()
    check(rows, pii.Trees([], [], None), spark)


def test_trees_add_spans_and_keep_the_rules(spark):
    rows = people()
    trees = pii.fit(frame(spark, rows))
    assert trees.trees and len(trees.trees) == len(trees.weights)
    check(rows, trees, spark)
    low = pii.Trees(trees.trees, trees.weights, -100.0)  # every candidate passes
    more = check(rows + [(5000 + k, t, "en", "a", 0, *["x"] * 9) for k, t in enumerate(ODD)], low, spark)
    by_id = {r["doc_id"]: r for r in more}
    spans = [s.split(":") for s in by_id[5006]["spans"].split(",")]
    hits = {ODD[6][int(a) : int(b)] for _, a, b in spans}
    assert "(212) 555-0187" in hits and "joe (at) mail.example.com" in hits
    for r in more:  # no two added spans, and none and a rule's, overlap
        own = [s.split(":") for s in r["spans"].split(",") if s]
        base = {f"{k}:{a}:{b}" for a, _, b, k in rules(dict((x[0], x[1]) for x in rows).get(r["doc_id"]))}
        added = [(int(a), int(b)) for k, a, b in own if f"{k}:{a}:{b}" not in base]
        assert all(x[1] <= y[0] for x, y in zip(sorted(added), sorted(added)[1:])) or r["doc_id"] >= 5000


def test_margin_is_the_models(spark):
    """The CASE expressions score as the fitted model does: a tree of its printed form, by hand."""
    tree = pii._parse("Tree 0 (weight 1.0):\n  If (feature 3 <= 2.5)\n   If (feature 4 <= 1.0)\n    Predict: -1.0\n   Else (feature 4 > 1.0)\n    Predict: 0.5\n  Else (feature 3 > 2.5)\n   Predict: 2.0")
    assert tree == [(3, 2.5, (4, 1.0, -1.0, 0.5), 2.0)]


def test_empty(spark):
    assert pii.find(empty(spark), pii.fit(empty(spark))).count() == 0


def test_fitted_threshold_adds_what_the_rules_miss(spark):
    trees = pii.fit(frame(spark, people(1500)))
    assert trees.threshold is not None
    texts = {7000: "please write to joe (at) mail.example.com about the house", 7001: "the water and house of 1 (212) 555-0187 under people", 7002: "order 1234567890 from the people"}
    rows = [(k, t, "en", "a", 0, *["x"] * 9) for k, t in texts.items()]
    spans = {r["doc_id"]: r["spans"] for r in check(rows, trees, spark)}
    assert "email" in spans[7000] and "phone" in spans[7001] and spans[7002] == ""


def test_every_document_is_learned_from(spark):
    """Among 12 000 documents the rare ones decide the threshold: 48 phone numbers are enough, a third of them are not."""
    order = F.concat(F.lit("the house of order "), F.col("id") + 1_000_000_000, F.lit(" under people"))
    phone = F.concat(F.lit("the people call +1 (212) 555-"), F.lpad(F.col("id").cast("string"), 5, "0"), F.lit(" after water"))
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 250 == 0, phone).otherwise(order).alias("text"))
    counts = {r["label"]: r["n"] for r in pii._learned(docs, "doc_id", "text").groupBy("label").agg(F.sum("n").alias("n")).collect()}
    assert counts == {0.0: 2 * 11_952 + 48, 1.0: 48}  # a number is proposed as card and as phone
    assert pii.fit(docs).threshold is not None


def test_documents_without_digits_are_learned_from(spark):
    mail = F.concat(F.lit("write to joe@"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"), F.lit(".example.com now"))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, mail).otherwise("call 1 2 3 4 5 6 7 8 9 times").alias("text"))
    trees = pii.fit(docs)
    assert trees.threshold is not None
    text = "please write to joe (at) mail.example.com now"
    assert pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), trees).head()["spans"] == "email:16:41"


def test_counted_rows_give_the_limits_of_single_rows(spark):
    """Rows that count n times stand for n rows, and every value that occurs is a limit, in more rows than Spark would look at."""
    rng = random.Random(3)
    rows = [(float(k in (7_000, 7_001)), float(k), float(rng.randrange(1, 4))) for k in range(11_000)]
    table = spark.createDataFrame(rows, "label double, length double, n double")
    single = table.select("label", "length", F.explode(F.array_repeat(F.lit(1.0), F.col("n").cast("int"))).alias("n"))
    counted, each = (pii._boosted(VectorAssembler(inputCols=["length"], outputCol="features").transform(t), 33_000, 10_999) for t in (table, single))
    limits = lambda node: {node[1]} | limits(node[2]) | limits(node[3]) if isinstance(node, tuple) else set()
    assert {6999.5, 7001.5} <= limits(counted.trees[0]) and limits(counted.trees[0]) == limits(each.trees[0])
