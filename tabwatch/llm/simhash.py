"""Near-duplicates by SimHash, with pivot distance tables in place of all comparisons.

Fingerprints meet as candidates under keys that lose nothing: fingerprints within `max_bits` of each other are equal in
one of max_bits + 1 parts of their bits, and what is left of them again in one of as many parts, so each such pair of
parts is a key.

Under a key, fingerprints have a table of their Hamming distances to fixed reference fingerprints. Two of them can only
be close if no coordinate differs by more than the radius, so they are sorted by the first coordinate and compared in a
sliding range, coordinate by coordinate; survivors are verified bit by bit. What is linked already is not compared
again, and a key gives a spanning forest of its links, not its pairs. Stars joined from the forests give the components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.llm.arrow import blocks, flat, record, unused
from tabwatch.llm.hashing import mix
from tabwatch.session import stored

SEED = 42
SHINGLE, MAX_BITS = 3, 3
LANES = 4  # most 64-bit lanes of a fingerprint
#: Reference fingerprints.
PIVOTS = np.random.default_rng(4).integers(0, 1 << 64, (16, LANES), np.uint64)
#: Fingerprints of a key that one task compares with each other; keys with more are cut into tiles of two such parts.
TILE = 4096
_HASHED = 65_536  # shingles whose bits are counted at a time
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, shingle: int = SHINGLE, lanes: int = 1) -> bytes:
    """64 bits a lane, each 1 if it is in over half of the shingle hashes; all 0 without words.

    The first lane takes the hashes as they are, the others mix them.
    """
    words = text.lower().split()
    if not words:
        return bytes(8 * lanes)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(shingle, len(words))
    spans = list(zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True))
    digest, ones = xxhash.xxh64_digest, np.zeros((lanes, 64), np.int64)
    for at in range(0, len(spans), _HASHED):
        raw = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans[at : at + _HASHED]]), np.uint8)
        for lane in range(lanes):
            bits = raw if not lane else mix(raw.view(">u8").astype(np.uint64) + np.uint64(lane)).view(np.uint8)
            ones[lane] += np.unpackbits(bits).reshape(-1, 64).sum(axis=0, dtype=np.uint32)
    return np.packbits(ones.ravel() * 2 > len(spans)).tobytes()


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, lanes: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, row (a hash of the text) and the lanes w0, w1, ... (as longs) of every whole text; null has no words."""
    names = [f"w{k}" for k in range(lanes)]

    def run(batches):
        for batch in batches:
            for block in blocks(batch, "text"):
                data, offsets = flat(block.column("text"))
                data = data.tobytes()
                found = [fingerprint(data[a:b], shingle, lanes) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                table = np.frombuffer(b"".join(found), ">i8").astype(np.int64).reshape(-1, lanes)
                columns = [block.column("doc_id"), block.column("row"), *[pa.array(table[:, k]) for k in range(lanes)]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", *names])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "doc_id long, row long" + "".join(f", {name} long" for name in names))


def _parts(positions: list[int], n: int) -> list[list[int]]:
    size, more = divmod(len(positions), n)
    cuts = [k * size + min(k, more) for k in range(n + 1)]
    return [positions[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _mask(positions: list[int]) -> int:
    value = sum(1 << p for p in positions)
    return value - (1 << 64) if value >> 63 else value


def _keys(fp: Column, max_bits: int) -> Column:
    """One key for each way to choose a part and then a part of the rest: which way, and the bits in both."""
    keys, everything = [], list(range(64))
    for part in _parts(everything, max_bits + 1):
        rest = [p for p in everything if p not in part]
        for second in _parts(rest, max_bits + 1):
            keys.append(F.struct(F.lit(len(keys)).alias("way"), fp.bitwiseAND(F.lit(_mask(part + second))).alias("bits")))
    return F.array(*keys)


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes is linked with."""
    parent = np.arange(n)
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        apart = low != high
        if not apart.any():
            return parent
        np.minimum.at(parent, high[apart], low[apart])
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above


def forest(fp: np.ndarray, group: np.ndarray, side: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) by index for fingerprints (rows of lanes) linked within their group.

    Rows with a side other than 0 are compared with rows of other sides only.
    """
    table = np.bitwise_count(fp[:, None, :] ^ PIVOTS[None, :, : fp.shape[1]]).sum(axis=2, dtype=np.int16)
    order = np.lexsort((table[:, 0], group))
    fp, group, side, table = fp[order], group[order], side[order], table[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    of = np.cumsum(np.append(False, group[1:] != group[:-1]))
    parent, here, shift = np.arange(len(fp)), np.arange(len(fp)), 0
    while len(here):
        shift += 1
        here = here[here + shift < len(fp)]
        there = here + shift
        near = (of[here] == of[there]) & (table[there, 0] - table[here, 0] <= max_bits)
        here = here[near]  # ranges only end: what is too far now stays so at a larger shift
        left = here[(parent[here] != parent[here + shift]) & ((side[here] != side[here + shift]) | (side[here] == 0))]
        for pivot in range(1, len(PIVOTS)):
            left = left[np.abs(table[left, pivot] - table[left + shift, pivot]) <= max_bits]
        left = left[np.bitwise_count(fp[left] ^ fp[left + shift]).sum(axis=1) <= max_bits]
        if len(left):
            parent = components(len(fp), np.append(np.arange(len(fp)), left), np.append(parent, left + shift))
            whole = np.minimum.reduceat(parent, starts) == np.maximum.reduceat(parent, starts)
            here = here[~whole[of[here]]]
    child = np.flatnonzero(parent != np.arange(len(fp)))
    return order[child], order[parent[child]]


def _links(max_bits: int):
    """Rows come sorted by way, bits and tile; groups of a batch are compared at once, the last one waits for the next."""

    def settle(columns: list[np.ndarray]):
        way, bits, tile_a, tile_b, part, node, *lanes = columns
        fresh = np.append(True, (way[1:] != way[:-1]) | (bits[1:] != bits[:-1]) | (tile_a[1:] != tile_a[:-1]) | (tile_b[1:] != tile_b[:-1]))
        group = np.cumsum(fresh)
        many = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(many):
            return
        side = np.where(tile_a == tile_b, 0, part + 1)[many]
        fp = np.stack([w[many].view(np.uint64) for w in lanes], axis=1)
        a, b = forest(fp, group[many], side, max_bits)
        yield record(_LINK, a=node[many][a], b=node[many][b])

    def run(batches):
        held = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            n = len(columns[0])
            last = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])) if n else []
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from settle([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
        if held is not None and len(held[0]):
            yield from settle(held)

    return run


def links(keyed: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links (a, b) between fingerprints within max_bits that share a key; keyed: node, lanes, way, bits."""
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lanes = [c for c in keyed.columns if c.startswith("w") and c != "way"]
    crowded = keyed.groupBy("way", "bits").count().where(F.col("count") > TILE)
    sized = keyed.join(crowded, ["way", "bits"], "left")
    tiles = F.coalesce(F.ceil(F.col("count") / TILE), F.lit(1)).cast("int")
    sized = sized.withColumn("tiles", tiles).withColumn("part", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    sized = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tile = [F.least("part", "other").alias("tile_a"), F.greatest("part", "other").alias("tile_b")]
    tiled = sized.select("way", "bits", *tile, "part", "node", *lanes)
    dealt = tiled.repartition(n, "way", "bits", "tile_a", "tile_b").sortWithinPartitions("way", "bits", "tile_a", "tile_b")
    return dealt.mapInArrow(_links(max_bits), "a long, b long")


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) that is not the smallest of its component.

    Alternates large and small stars until nothing changes; each round is written to the shared folder, so the
    lineage stays short. A node's least neighbour is found by a grouped minimum and joined back, and the join
    may be split where a node has very many neighbours.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("of")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "of")
        small = large.join(least, F.col("a") == F.col("of")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("of", "m")).where("a <> b").distinct()
        current = stored(small, "stars")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _named(prints: DataFrame, classes: DataFrame, edges: DataFrame) -> DataFrame:
    """`prints` with component_id, the smallest doc_id among the classes (node, first, lanes) linked with a row's."""
    roots = stars(edges)
    rooted = classes.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    rooted = rooted.select("node", "first", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("node", "root").join(smallest, "root").select(F.col("node").alias("of"), "root", "component_id")
    return prints.join(named, F.col("node") == F.col("of")).drop("of")


def linked(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (a hash of the text), w0 (the fingerprint), root (the same in a component), component_id of every row."""
    prints = fingerprints(docs, shingle, 1, id_col, text_col).withColumn("node", F.col("w0"))
    prints = stored(prints, "fingerprints")
    classes = stored(prints.groupBy("node", "w0").agg(F.min("doc_id").alias("first")), "classes")
    keyed = classes.select("node", "w0", F.inline(_keys(F.col("w0"), max_bits)))
    return _named(prints, classes, links(keyed, max_bits))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the smallest doc_id reachable over fingerprints within max_bits.

    Letters A-Z are lower-cased and words are runs without ASCII white space; a text with fewer words than a
    shingle is one shingle, one without words (or null) has the fingerprint zero and is linked like any other.
    Repeated rows give repeated results, null ids never name a component; other columns are ignored.
    """
    named = linked(docs, shingle, max_bits, id_col, text_col)
    return named.select("doc_id", F.lpad(F.lower(F.hex("w0")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component of `near_duplicates` the row with the least id stays.

    A row without an id stays only where none of its component has one. Of rows with the same id and text one stays.
    """
    named = linked(docs, id_col=id_col, text_col=text_col, **options)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    kept = named.groupBy("root").agg(least.alias("least")).select("least.doc_id", "least.row")
    names = [unused(name, docs.columns) for name in ("row", "kept_id", "copy")]
    row, kept_id, copy = (F.col(name) for name in names)
    keyed = docs.withColumn(names[0], F.xxhash64(text_col))
    kept = kept.select(F.col("doc_id").alias(names[1]), F.col("row").alias("kept_row"))
    chosen = keyed.join(kept, (row == F.col("kept_row")) & F.col(id_col).cast("long").eqNullSafe(kept_id), "left_semi")
    numbered = chosen.withColumn(names[2], F.row_number().over(Window.partitionBy(row, id_col).orderBy(row)))
    return numbered.where(copy == 1).select(*docs.columns)
