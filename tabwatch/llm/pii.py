"""Personal data: rules for certain spans, and boosted trees over generated candidates for more.

Rules find e-mail addresses, IP addresses, card and phone numbers, each from left to right without overlap.
High-recall generators propose further, overlapping spans that look like one of them. Gradient-boosted trees
score a candidate by its format and context; they learn from all documents, as counts of equal descriptions. Spans
that a rule confirms are rewritten there into forms that it misses, and the candidates on these are the positive ones;
those that overlap no rule span are the others. A threshold is calibrated on all documents, each scored by trees that
learned without it.
Rule spans always stay; a candidate is added if it passes the threshold and overlaps none of them.

Only built-in expressions are used: the trees become CASE expressions, so that a document is read once, in
one projection, without a shuffle; only the counts that the trees learn from are shuffled.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Parts that the documents are dealt into for the threshold.
FOLDS = 4
#: Descriptions that a task works on while trees are learned.
ROWS = 20_000
ROUNDS, DEPTH = 12, 3
#: Least precision on held-out candidates, least number of candidates above the threshold.
PRECISION, LEAST = 0.98, 20
CONTEXT = 24

# Fixed patterns of the rules. Look-behinds and possessive loops only save time: a match can start where the
# last one ended or where a run begins, and no loop needs to give back what it took.
_RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_GENERATORS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.,])[0-9]{1,5}(?:[.,][0-9]{1,5}){3}(?![0-9])",
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){8,18}(?![0-9A-Za-z])",
}
_HINTS = r"(?i)tel|phone|call|mobil|fax|mail|contact|card|visa|pay|host|server|addr"
_SECRETS = r"(?i)pass|token|key|secret|version|order|isbn|invoice"
FEATURES = (
    "is_email", "is_ip", "is_card", "length", "digits", "spaces", "dots", "dashes", "parens",
    "left_space", "left_sign", "right_letter", "left_digits", "left_letters", "hint", "secret", "valid",
)


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of all matches, in code points: the texts between matches give the places."""
    pairs = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
        lambda hit, gap: F.struct(F.coalesce(hit, F.lit("")).alias("hit"), F.length(gap).alias("gap")),
    )
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["hit"])
        found = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.when(x["hit"] == "", state["out"]).otherwise(F.concat(state["out"], F.array(found))).alias("out"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """Digits from the last one on, every second doubled, the digits of each summed: a multiple of ten."""
    reverse = F.split(F.reverse(_digits(hit)), "")
    values = F.transform(F.filter(reverse, lambda d: d != ""), lambda d, k: (d.cast("int") * (1 + k % 2)))
    return F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == "ip":
        return hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return n.between(14, 19) & _luhn(hit)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _may_hold(kind: str, text: Column) -> Column:
    """A quick test that a text with such a span passes."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike("[0-9]")


def rule_spans(text: Column) -> Column:
    """array<struct<start, rank, end, kind>> in the order of start and kind; a null text counts as empty."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")

    def of(kind: str) -> Column:
        hits = F.filter(_spans(text, _RULES[kind]), lambda s: _valid(kind, s["hit"]))
        rank = F.lit(KINDS.index(kind))
        spans = F.transform(
            hits, lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))
        )
        return F.when(_may_hold(kind, text), spans).otherwise(none)

    return F.array_sort(F.concat(*map(of, KINDS)))


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{pattern}]", "")).cast("double")


def candidate_spans(text: Column) -> Column:
    """array<struct<start, rank, end, kind, features>> of all generators; a number is proposed as card and as phone."""

    def described(kind: str, s: Column) -> Column:
        hit = s["hit"]
        left = F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
        last, right = F.right(left, F.lit(1)), F.substring(text, s["end"] + 1, F.lit(1))
        flag = lambda c: c.cast("double")
        values = (
            flag(F.lit(kind == "email")), flag(F.lit(kind == "ip")), flag(F.lit(kind == "card")),
            F.length(hit).cast("double"), _count(hit, "0-9"), _count(hit, " "), _count(hit, "."), _count(hit, r"\-"), _count(hit, "()"),
            flag(last == " "), flag(last.isin("=", ":", "#", "/")), flag(right.rlike("[A-Za-z]")),
            _count(left, "0-9"), _count(left, "A-Za-z"), flag(left.rlike(_HINTS)), flag(left.rlike(_SECRETS)),
            flag(_valid(kind, hit)),
        )
        features = [v.alias(name) for name, v in zip(FEATURES, values, strict=True)]
        return F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), *features
        )

    fields = "".join(f",{name}:double" for name in FEATURES)
    none = F.array().cast(f"array<struct<start:int,rank:int,end:int,kind:string{fields}>>")
    marked = F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
    number = text.rlike("[0-9]")
    proposed = (("email", "email", marked), ("ip", "ip", number), ("number", "card", number), ("number", "phone", number))

    def of(source: str, kind: str, may: Column) -> Column:
        return F.when(may, F.transform(_spans(text, _GENERATORS[source]), lambda s: described(kind, s))).otherwise(none)

    return F.concat(*[of(*x) for x in proposed])


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


@dataclass
class Trees:
    """Boosted trees as nested (feature, limit, left, right) tuples with leaf values, their weights and the threshold."""

    trees: list
    weights: list[float]
    threshold: float | None

    def margin(self, candidate: Column) -> Column:
        def value(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, limit, left, right = node
            return F.when(candidate[FEATURES[feature]] <= limit, value(left)).otherwise(value(right))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            total = total + value(tree) * weight
        return total


def _parse(text: str) -> list:
    """Trees from the model's printed form: `If (feature k <= x)` / `Else (...)` lines, then `Predict: v`."""
    trees = []

    def node(lines):
        line = next(lines)
        if m := re.match(r"Predict: (\S+)", line):
            return float(m[1])
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        left = node(lines)
        next(lines)  # Else
        return int(m[1]), float(m[2]), left, node(lines)

    for part in re.split(r"Tree \d+ \(weight [^)]*\):", text)[1:]:
        trees.append(node(x.strip() for x in part.strip().split("\n")))
    return trees


def _rewritten(span: Column, hit: Column) -> Column:
    """A confirmed span in a form that its rule misses: at-signs in brackets, no plus sign, dots between groups of a card."""
    sign = F.element_at(F.array(*map(F.lit, (" (at) ", "(at)", " [at] ", "[at]"))), F.pmod(F.xxhash64(hit), F.lit(4)).cast("int") + 1)
    return (
        F.when(span["kind"] == "email", F.concat(F.substring_index(hit, "@", 1), sign, F.substring_index(hit, "@", -1)))
        .when(span["kind"] == "phone", F.substring(hit, 2, 1_000_000))
        .when(span["kind"] == "card", F.regexp_replace(_digits(hit), r"([0-9]{4})(?=[0-9])", "$1."))
    )


def _learned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """fold, label, FEATURES, n: how often each description of a candidate to learn from occurs, over all documents."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    fold = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit("pii")), F.lit(FOLDS)).cast("int")
    spans = docs.select(fold.alias("fold"), text.alias("text")).withColumn("rules", rule_spans(F.col("text")))
    missed = F.filter(candidate_spans(F.col("text")), lambda c: ~F.exists("rules", lambda r: _overlaps(r, c)))
    missed = spans.select("fold", F.explode(missed).alias("c")).select("fold", F.lit(0.0).alias("label"), "c")

    def form(r: Column) -> Column:
        text = F.col("text")
        before = F.substring(text, F.greatest(r["start"] - CONTEXT + 1, F.lit(1)), F.least(r["start"], F.lit(CONTEXT)))
        new, after = _rewritten(r, F.substring(text, r["start"] + 1, r["end"] - r["start"])), F.substring(text, r["end"] + 1, F.lit(CONTEXT))
        return F.struct(r["rank"].alias("rank"), F.length(before).alias("start"), F.length(new).alias("n"), F.concat(before, new, after).alias("text"))

    forms = spans.select("fold", F.explode(F.transform("rules", form)).alias("f")).where("f.text is not null").select("fold", "f.*")
    made = forms.select("fold", "rank", "start", "n", F.explode(candidate_spans(F.col("text"))).alias("c"))
    made = made.where((F.col("c.start") < F.col("start") + F.col("n")) & (F.col("start") < F.col("c.end")))
    made = made.select("fold", (F.col("c.rank") == F.col("rank")).cast("double").alias("label"), "c")
    return missed.unionByName(made).select("fold", "label", *[F.col(f"c.{f}") for f in FEATURES]).groupBy("fold", "label", *FEATURES).agg(F.count("*").cast("double").alias("n"))


def _boosted(table: DataFrame, rows: int, most: int) -> Trees:
    """Trees from rows that count n times each. rows: no fewer than there are; most: the greatest value of a feature, all being counts.

    Spark looks for the limits of splits in max(maxBins ** 2, 10 000) rows and tries each value if these are fewer than
    maxBins: with so many bins that is every value in all rows. (46 340: the square stays an int.)
    """
    bins = min(max(64, math.isqrt(rows) + 1, most + 2), 46_340)
    model = GBTClassifier(featuresCol="features", labelCol="label", weightCol="n", maxIter=ROUNDS, maxDepth=DEPTH, maxBins=bins, seed=6).fit(table)
    return Trees(_parse(model.toDebugString), list(model.treeWeights), None)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees that learned from all documents, and a threshold that all documents calibrated.

    For the threshold the documents are dealt into folds by a hash of their id, and trees that learned from the other
    folds score each. Without candidates of both sorts outside of every fold, or if no threshold is precise enough, no
    candidate is ever added.
    """
    learned = _learned(docs, id_col, text_col).persist()
    sorts = learned.groupBy("fold", "label").agg(F.count("*").alias("rows"), F.max(F.greatest(*FEATURES)).alias("most")).collect()
    rows, most = sum(r["rows"] for r in sorts), int(max((r["most"] for r in sorts), default=0))
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(learned.coalesce(rows // ROWS + 1)).persist()
    try:
        if len({r["label"] for r in sorts}) < 2:
            return Trees([], [], None)
        folds = [f for f in range(FOLDS) if len({r["label"] for r in sorts if r["fold"] != f}) == 2]
        parts = [table, *[table.where(F.col("fold") != f) for f in folds]]
        with ThreadPool(2) as pool:  # each waits for many short jobs; more at once take more of the driver's memory
            trees, *others = pool.map(inheritable_thread_target(docs.sparkSession)(lambda part: _boosted(part, rows, most)), parts)
        if len(folds) < FOLDS:
            return trees
        margins = [F.when(F.col("fold") == f, t.margin(F.struct(*FEATURES))) for f, t in zip(folds, others, strict=True)]
        levels = table.select(F.floor(F.coalesce(*margins) * 20).alias("level"), "label", "n")
        levels = levels.groupBy("level").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n"))
        good = n = 0
        for row in levels.orderBy(F.desc("level")).collect():
            good, n = good + row["good"], n + row["n"]
            if n >= LEAST and good >= PRECISION * n:
                trees.threshold = row["level"] / 20
        return trees
    finally:
        table.unpersist()
        learned.unpersist()


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every whole text.

    Spans are kind:start:end in code points, by start and kind. Counts and base_sha256 are those of the rules,
    `spans` has the added ones too. A null text counts as empty; repeated rows give repeated results; other
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("rules", rule_spans(F.col("text")))
    plain = lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    if trees.threshold is None:
        every = F.col("rules")
    else:
        rows = rows.withColumn("candidates", candidate_spans(F.col("text")))
        scored = F.transform("candidates", lambda c: F.struct(trees.margin(c).alias("score"), plain(c).alias("s")))
        passed = F.filter(scored, lambda c: (c["score"] >= trees.threshold) & ~F.exists("rules", lambda r: _overlaps(r, c["s"])))
        rows = rows.withColumn("passed", passed)
        # of added spans that overlap, the best stays; of equally good ones the first
        better = lambda o, c: (o["score"] > c["score"]) | ((o["score"] == c["score"]) & (o["s"] < c["s"]))
        best = F.filter("passed", lambda c: ~F.exists("passed", lambda o: _overlaps(o["s"], c["s"]) & better(o, c)))
        every = F.array_sort(F.concat("rules", F.transform(best, lambda c: c["s"])))

    def number(kind: str) -> Column:
        return F.size(F.filter("rules", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *map(number, KINDS), F.sha2(_joined(F.col("rules")).cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans"))
