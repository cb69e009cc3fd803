"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents are cut into blocks of words; each source's blocks are put in a hashed order and its target is the
prefix of that order (a second pass over it once the first is used up), which fixes how many blocks the source
gives. The tree then halves the output shards again and again: at each node the number of blocks of every source
that go left is drawn from the multivariate hypergeometric distribution, so that every shard gets an exact quota
of every source. Shards take disjoint ranges of the hashed order and shuffle what they hold by another hash.

Only DataFrame expressions are used. Hashed orders are ranked in two levels, (source, bucket) and then all
buckets of a source, so that a source with most of the rows is spread over BUCKETS tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.llm.arrow import unused
from tabwatch.session import stored

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET, MOST_PASSES = 1.5, 2.0
BLOCK_WORDS = 256
WHOLE = 1 << 40  # more words than any document has
SHARDS = 16
BUCKETS = 4096
SEED = 10
#: The table of quotas is broadcast if it has at most so many numbers.
MAX_BROADCAST = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"

_LOG_FACTORIALS = [math.lgamma(k + 1) for k in range(32)]


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """key, copy (together they name a row, equal rows apart), doc_id, source, size in words."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(text_col).alias("size"), row_key(id_col, text_col, source_col).alias("key"),
    )
    copies = Window.partitionBy("key").orderBy("doc_id", "source", "size")
    return rows.withColumn("copy", F.row_number().over(copies))


def row_key(id_col: str, text_col: str, source_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col), F.col(source_col).cast("string"))


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most_passes: float = MOST_PASSES) -> DataFrame:
    """source, source_size, target: the budget shared by weight, where no source gets above its limit.

    Sources by code point, null last, take the weights in turn. A source is at its limit if the level at which
    the others would share what is left gives it more; the level is found by one ordered pass over the sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    array = F.array(*[F.lit(float(w)) for w in weights])
    w = totals.withColumn("weight", F.element_at(array, (turn % len(weights) + 1).cast("int")))
    w = w.withColumn("limit", F.col("source_size") * most_passes).withColumn("level", F.col("limit") / F.col("weight"))
    every = Window.orderBy("level", F.asc_nulls_last("source"))
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    after = every.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_ = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("left", F.sum("source_size").over(all_) * budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    w = w.withColumn("share", F.col("left") / F.sum("weight").over(after))
    w = w.withColumn("settled", F.first(F.when(F.col("share") <= F.col("level"), F.col("share")), ignorenulls=True).over(all_))
    target = F.least("limit", F.coalesce(F.col("settled"), F.lit(float("inf"))) * F.col("weight"))
    return w.select("source", "source_size", target.alias("target"))


def _log_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
    table = F.array(*[F.lit(v) for v in _LOG_FACTORIALS])
    return F.when(n < len(_LOG_FACTORIALS), F.get(table, n.cast("int"))).otherwise(series)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def _let(value: Column, use) -> Column:
    """use(value) with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def hypergeometric(population: Column, marked: Column, draws: Column, uniform: Column) -> Column:
    """How many of `draws` out of `population` are marked, from one uniform number in [0, 1).

    Probabilities are summed from the most likely count outwards, one count on either side at a time, until
    they pass the uniform number; the walk is as long as 16 standard deviations or the whole range.
    """
    plain = population - marked

    def ranged(r: Column) -> Column:
        likely = F.floor((draws + 1.0) * (marked + 1.0) / (population + 2.0)).cast("long")
        spread = F.sqrt(draws * 1.0 * marked * plain / F.greatest(population * population, F.lit(1)))
        bounds = F.struct(
            r["low"].alias("low"), r["high"].alias("high"), F.least(r["high"], F.greatest(r["low"], likely)).alias("mode"),
            F.least(r["high"] - r["low"], F.ceil(spread * 16).cast("long") + 32).cast("long").alias("steps"),
        )
        return _let(bounds, walk)

    def walk(r: Column) -> Column:
        mode = r["mode"]
        peak = F.exp(_log_choose(marked, mode) + _log_choose(plain, draws - mode) - _log_choose(population, draws))

        def step(state: Column, _: Column) -> Column:
            up, down = state["up"], state["down"]
            more = F.when(up < r["high"], state["p_up"] * (marked - up) * (draws - up) / ((up + 1.0) * (plain - draws + up + 1.0)))
            less = F.when(down > r["low"], state["p_down"] * down * (plain - draws + down) / ((marked - down + 1.0) * (draws - down + 1.0)))
            sides = F.struct(F.coalesce(more, F.lit(0.0)).alias("more"), F.coalesce(less, F.lit(0.0)).alias("less"))

            def moved(side: Column) -> Column:
                found = state["sum"] > uniform
                taken = F.when(found, state["x"]).when(state["sum"] + side["more"] > uniform, up + 1)
                taken = taken.when(state["sum"] + side["more"] + side["less"] > uniform, down - 1).otherwise(state["x"])
                return F.struct(
                    taken.alias("x"), F.when(found, state["sum"]).otherwise(state["sum"] + side["more"] + side["less"]).alias("sum"),
                    F.least(up + 1, r["high"]).alias("up"), F.greatest(down - 1, r["low"]).alias("down"),
                    side["more"].alias("p_up"), side["less"].alias("p_down"),
                )

            return _let(sides, moved)

        first = lambda p: F.struct(
            mode.alias("x"), p.alias("sum"), mode.alias("up"), mode.alias("down"), p.alias("p_up"), p.alias("p_down")
        )
        return F.aggregate(F.sequence(F.lit(0).cast("long"), r["steps"]), _let(peak, first), step, lambda state: state["x"])

    return _let(F.struct(F.greatest(F.lit(0), draws - plain).alias("low"), F.least(marked, draws).alias("high")), ranged)


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """shard, source, n: the quotas (source, n) of all sources dealt to `shards` (a power of two) shards.

    A node of the tree holds one number for each source, so the tree grows with sources times shards only.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("The number of shards must be a power of two.")
    order = F.array_sort(F.collect_list(F.struct("turn", "source", "n")))
    turned = quotas.withColumn("turn", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    level = turned.agg(order.alias("held")).withColumn("node", F.lit(0).cast("long"))
    for depth in range(shards.bit_length() - 1):
        total = F.aggregate("held", F.lit(0).cast("long"), lambda t, s: t + s["n"])
        level = level.withColumn("total", total)
        uniform = lambda s: F.pmod(F.xxhash64(F.lit(seed), F.lit(depth), F.col("node"), s["turn"]), F.lit(1 << 52)) / float(1 << 52)  # noqa: B023, E731

        def go_left(state: Column, s: Column) -> Column:
            x = F.when(state["draws"] <= 0, F.lit(0).cast("long")).otherwise(
                hypergeometric(state["total"], s["n"], state["draws"], uniform(s))  # noqa: B023
            )
            return _let(
                x,
                lambda taken: F.struct(
                    (state["total"] - s["n"]).alias("total"), (state["draws"] - taken).alias("draws"),
                    F.concat(state["left"], F.array(F.struct(s["turn"].alias("turn"), s["source"].alias("source"), taken.alias("n")))).alias("left"),
                ),
            )

        empty = F.filter("held", lambda s: F.lit(False))
        start = F.struct(F.col("total"), F.floor(F.col("total") / 2).cast("long").alias("draws"), empty.alias("left"))
        level = level.withColumn("left", F.aggregate("held", start, go_left)["left"])
        right = F.zip_with("held", "left", lambda a, b: F.struct(a["turn"].alias("turn"), a["source"].alias("source"), (a["n"] - b["n"]).alias("n")))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("held")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("held")),
        )
        level = level.select(F.inline(halves))
    rows = level.select(F.col("node").alias("shard"), F.explode("held").alias("s"))
    return rows.select("shard", "s.source", "s.n")


def draw(
    sizes: DataFrame, goals: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """Blocks that the mix takes: key, copy, doc_id, source, block, start (its first word), words, pass_no, shard, place.

    `sizes` is a table as of document_sizes, `goals` one as of targets. A block is taken once in a pass, and
    passes are two at most. Within a shard, `place` is the random order of its blocks. Documents without words
    have no blocks. The draw depends on the rows alone, so a repeated run gives the same.
    """
    last = F.floor((F.col("size") - 1) / block_words).cast("long")
    cut = sizes.where("size > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    start = F.col("block") * block_words
    cut = cut.withColumn("start", start).withColumn("words", F.least(F.lit(block_words).cast("long"), F.col("size") - start))
    cut = cut.withColumn("h", F.xxhash64(F.lit(seed), "key", "copy", "block"))
    cut = cut.withColumn("bucket", F.shiftrightunsigned("h", 64 - (BUCKETS - 1).bit_length()))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "key", "copy", "block")
    ranked = cut.withColumn("words_in", F.sum("words").over(inside) - F.col("words")).withColumn("rank_in", F.row_number().over(inside) - 1)
    buckets = cut.groupBy("source", "bucket").agg(F.sum("words").alias("w"), F.count("*").alias("n"))
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(
        F.col("source").alias("of"), F.col("bucket").alias("in"),
        F.coalesce(F.sum("w").over(along), F.lit(0)).alias("words_ahead"), F.coalesce(F.sum("n").over(along), F.lit(0)).alias("rank_ahead"),
    )
    placed = ranked.join(buckets, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in")))
    placed = placed.select(
        "key", "copy", "doc_id", "source", "block", "start", "words", "h",
        (F.col("words_in") + F.col("words_ahead")).alias("ahead"), (F.col("rank_in") + F.col("rank_ahead")).alias("rank"),
    )
    order = stored(placed, "mix-order")
    goals = stored(goals, "mix-goals")
    n_sources = goals.count()
    whole = F.floor(F.col("target") / F.col("source_size"))  # passes over the whole source
    goal = goals.where("source_size > 0").select(
        F.col("source").alias("of"), whole.alias("whole"), (F.round("target") - whole * F.col("source_size")).alias("rest")
    )
    small = n_sources * max(shards, 4) <= MAX_BROADCAST
    beside = F.broadcast if small else (lambda df: df)
    aimed = order.join(beside(goal), F.col("source").eqNullSafe(F.col("of")))
    passes = F.col("whole") + F.when(F.col("ahead") < F.col("rest"), 1).otherwise(0)
    aimed = aimed.withColumn("passes", passes.cast("long")).drop("of")
    quotas = aimed.groupBy("source").agg(F.sum("passes").alias("n"), F.count("*").alias("blocks"))
    dealt = split_quotas(quotas.select("source", "n"), shards, seed)
    ends = dealt.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("q"))
    ends = ends.select(
        F.col("source").alias("of"),
        F.aggregate(
            "q", F.array().cast("array<bigint>"),
            lambda a, s: F.concat(a, F.array(s["n"] + F.when(F.size(a) > 0, F.element_at(a, -1)).otherwise(F.lit(0).cast("long")))),
        ).alias("ends"),
    )
    # copies of a block in later passes come after all blocks of the passes before
    ends = ends.join(quotas.select(F.col("source").alias("of_"), "blocks"), F.col("of").eqNullSafe(F.col("of_"))).drop("of_")
    taken = aimed.where("passes > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).alias("pass_no"))
    taken = taken.join(beside(stored(ends, "mix-quotas")), F.col("source").eqNullSafe(F.col("of")))
    index = F.col("rank") + F.col("pass_no") * F.col("blocks")
    shard = F.size(F.filter("ends", lambda e: e <= index))
    # the last block of a source gives only the words that are left to its target
    words = F.when(F.col("pass_no") == F.col("whole"), F.least("words", (F.col("rest") - F.col("ahead")).cast("long"))).otherwise(F.col("words"))
    return taken.select(
        "key", "copy", "doc_id", "source", "block", "start", words.alias("words"), "pass_no", shard.alias("shard"),
        F.xxhash64(F.lit(seed + 1), "h", "pass_no").alias("place"),
    )


def taken_words(sizes: DataFrame, goals: DataFrame, draws: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of `sizes`."""
    sums = draws.groupBy("key", "copy").agg(F.sum("words").alias("taken"))
    joined = sizes.join(sums, ["key", "copy"], "left")
    goals = goals.select(F.col("source").alias("of"), "source_size", "target")
    small = goals.count() <= MAX_BROADCAST
    joined = joined.join(F.broadcast(goals) if small else goals, F.col("source").eqNullSafe(F.col("of")))
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, **columns: str) -> DataFrame:
    """Every row of `docs` with what the mix takes of it: doc_id, size, source_size, target (double), taken.

    Null texts have size 0, null sources are a source of their own, rows with equal ids are separate documents;
    other columns are ignored, an empty table gives no rows.
    """
    sizes = stored(document_sizes(docs, **columns), "mix-sizes")
    goals = targets(sizes)
    return taken_words(sizes, goals, draw(sizes, goals))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of `docs` that the mix takes, whole and as often as it takes them; each document is one block."""
    sizes = stored(document_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    goals = targets(sizes)
    key, copy, taken = (unused(x, docs.columns) for x in ("key", "copy", "taken"))
    draws = draw(sizes, goals, WHOLE).groupBy("key").agg(F.collect_list("copy").alias(taken)).withColumnRenamed("key", key)
    copies = Window.partitionBy(key).orderBy(F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.length(text_col))
    numbered = docs.withColumn(key, row_key(id_col, text_col, source_col)).withColumn(copy, F.row_number().over(copies))
    # Numbered and joined by the same key, so that texts are shuffled once; a list has the draws of equal rows only.
    joined = numbered.join(draws.hint("merge"), key)
    own = F.filter(taken, lambda c: c == F.col(copy))
    return joined.withColumn(copy, F.explode(own)).select(*docs.columns)
