"""Conversation prefix trie over minimal-perfect-hash node tables.

A turn is known by 128 bits of its role and text. The digest of a prefix is the running sum of the 128-bit hashes of
(depth, turn) on its path, so long conversations are digested in pieces, by many tasks. A shard is a bounded run of
path rows. It lists its distinct digests, gives each a slot by a minimal perfect hash whose slots hold the digests they
stand for, and scatters counts into flat arrays; one row for each distinct node leaves a shard, and shards are summed.

A node with one member is on a chain without branches and needs no more than its own row. What nodes with more members
add to all above them (leaves, saved bytes) is scattered into shards of the paths of their smallest members and
accumulated through the array of parent slots, deepest level first; the sums of shards are added by node again. Each
node counts in one path only, so the sums are exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.hashing import mix
from tabwatch.llm.running import ints, running
from tabwatch.session import stored

#: Path rows of a shard, and bytes of ids that are handed on at once for one node.
SHARD_ROWS, CHUNK_BYTES = 1 << 18, 1 << 18
#: The regrouping of the registered query: conversations take the opening of every fifth, of fewer than nine turns.
EVERY, MOST = 5, 9
_COUNTED = "d1 long, d2 long, p1 long, p2 long, depth long, bytes long, n long, ends long, conv_id long"
_SUMMED = "d1 long, d2 long, leaves long, saved long"


class SlotTable:
    """A minimal perfect hash of distinct 128-bit keys: slots 0 to n - 1, each holding its key.

    On each level keys that hash to a place of their own stay there; the others go on to the next level. The slot is
    the number of taken places before.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.levels, at = [], np.arange(len(first))
        self.keys = np.empty((2, len(first)), np.uint64)
        taken = 0
        while len(at):
            size = 2 * len(at) + 1
            place = self._place(first[at], second[at], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            slots = taken + np.cumsum(alone) - 1
            fits = alone[place]
            where = slots[place[fits]]
            self.keys[0, where], self.keys[1, where] = first[at[fits]], second[at[fits]]
            self.levels.append((alone, slots))
            taken += int(fits.sum())
            at = at[~fits]

    @staticmethod
    def _place(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(first ^ mix(second + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 for keys that the table does not hold."""
        out, at = np.full(len(first), -1, np.int64), np.arange(len(first))
        for level, (alone, slots) in enumerate(self.levels):
            place = self._place(first[at], second[at], level, len(alone))
            hit = alone[place]
            out[at[hit]] = slots[place[hit]]
            at = at[~hit]
        found = np.flatnonzero(out >= 0)
        wrong = (self.keys[0, out[found]] != first[found]) | (self.keys[1, out[found]] != second[found])
        out[found[wrong]] = -1
        return out


def _table(first: np.ndarray, second: np.ndarray) -> tuple[SlotTable, np.ndarray]:
    """A table of the distinct keys, and the slot of each row."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(order)]
    table = SlotTable(a[new], b[new])
    slots = table.find(first, second)
    if (slots < 0).any():
        raise AssertionError("a slot does not hold the digest that it was given to")
    return table, slots


def _scattered(values: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
    """One value for each slot; rows of a slot must agree."""
    out = np.empty(n, np.int64)
    out[slots] = values
    if (out[slots] != values).any():
        raise RuntimeError("two prefixes share a 128-bit digest")
    return out


def _batch(names: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64, copy=False)) for c in columns], names=[c.split()[0] for c in names.split(", ")])


def _count(batches):
    """Distinct nodes of each run of path rows with their members, ends and smallest member."""
    for batch in batches:
        for start in range(0, batch.num_rows, SHARD_ROWS):
            rows = {c: ints(batch.column(c)[start : start + SHARD_ROWS]) for c in batch.schema.names}
            table, slots = _table(rows["d1"].view(np.uint64), rows["d2"].view(np.uint64))
            n = table.keys.shape[1]
            same = [_scattered(rows[c], slots, n) for c in ("p1", "p2", "depth", "bytes")]
            least = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(least, slots, rows["conv_id"])
            ends = np.bincount(slots[rows["depth"] == rows["total"]], minlength=n)
            yield _batch(_COUNTED, [*table.keys.view(np.int64), *same, np.bincount(slots, minlength=n), ends, least])


def _whole_paths(batches, most: int = SHARD_ROWS):
    """Runs of whole conversations of about `most` rows; a longer one is a run of its own."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: ints(batch.column(c)) for c in batch.schema.names}
        cuts = np.flatnonzero(rows["depth"] == 0)
        while n + len(rows["depth"]) > most and len(cuts):
            near = cuts[cuts + n <= most]
            cut = int(near[-1]) if len(near) and (n or near[-1]) else int(cuts[0] if n or len(cuts) == 1 else cuts[1])
            if cut == 0 and not n:
                break
            held.append({c: v[:cut] for c, v in rows.items()})
            yield {c: np.concatenate([h[c] for h in held]) for c in rows}
            held, n = [], 0
            rows = {c: v[cut:] for c, v in rows.items()}
            cuts = cuts[cuts >= cut] - cut
        held.append(rows)
        n += len(rows["depth"])
    if held:
        yield {c: np.concatenate([h[c] for h in held]) for c in held[0]}


def _climb(batches):
    """What the nodes of each shard add to themselves and to all nodes above them."""
    for rows in _whole_paths(batches):
        table, slots = _table(rows["d1"].view(np.uint64), rows["d2"].view(np.uint64))
        n = table.keys.shape[1]
        depth = _scattered(rows["depth"], slots, n)
        first, second = (_scattered(rows[c], slots, n).view(np.uint64) for c in ("p1", "p2"))
        parent = table.find(first, second)
        leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(leaves, slots, rows["leaves"])
        np.add.at(saved, slots, rows["saved"])
        order = np.argsort(-depth, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(depth[order]) != 0)), n)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            level = order[a:b]
            if depth[level[0]] > 0:
                np.add.at(leaves, parent[level], leaves[level])
                np.add.at(saved, parent[level], saved[level])
        yield _batch(_SUMMED, [*table.keys.view(np.int64), leaves, saved])


def _runs(batch: pa.RecordBatch):
    """Consecutive rows of one node: (digest, first row, row after the last)."""
    d1, d2 = ints(batch.column("d1")), ints(batch.column("d2"))
    cuts = np.append(np.flatnonzero(np.append(True, (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))), len(d1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield (int(d1[a]), int(d2[a])), a, b


_CHUNK = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_SHA = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("sha", pa.string())])


def _chunks(batches):
    """Ids in order as joined texts of bounded length, each of one node."""
    for batch in batches:
        ids = [str(c) for c in batch.column("conv_id").to_pylist()]
        first = ints(batch.column("conv_id"))
        step = CHUNK_BYTES // 20
        out = [(*key, int(first[i]), ",".join(ids[i : min(i + step, b)])) for key, a, b in _runs(batch) for i in range(a, b, step)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _CHUNK, strict=True)], schema=_CHUNK)


def _hashed(batches):
    """SHA-256 of the joined ids of each node, over chunks as they come."""
    key, sha, out = None, None, []
    for batch in batches:
        texts = batch.column("ids")
        for found, a, b in _runs(batch) if batch.num_rows else ():
            if found != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = found, hashlib.sha256()
                joint = b""
            for i in range(a, b):
                sha.update(joint + texts[i].as_py().encode())
                joint = b","
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SHA, strict=True)], schema=_SHA)
            out = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, sha.hexdigest()), _SHA, strict=True)], schema=_SHA)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1, by turn with null first, ties by role and text), x1, x2 (the turn's 128 bits), bytes.

    Null roles and texts are empty; rows without conv_id belong to no conversation; other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"),
    )
    hashed = [F.xxhash64(F.lit(seed), "role", "text").alias(f"x{seed}") for seed in (1, 2)]
    turns = turns.select("conv_id", "turn", "role", "text", *hashed, F.octet_length("text").cast("long").alias("bytes"))
    return running(turns, "conv_id", ["turn", "role", "text"], ["x1", "x2", "bytes"], [])


def regrouped(turns: DataFrame) -> DataFrame:
    """The turns of rebuilt conversations: the first h of conversation c - c % 5, then c's own after its first h, for
    h = crc32(c) % 9. Columns conv_id, depth (0: the textless start), total (turns of the conversation), x1, x2, bytes.
    """
    head = F.struct("place", "x1", "x2", "bytes")
    heads = (
        turns.where((F.col("conv_id") % EVERY == 0) & (F.col("place") < MOST))
        .groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(head)).alias("heads"))  # at most 8 turns
    )
    h = F.crc32(F.col("conv_id").cast("string")) % MOST
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n")).withColumn("h", h)
    convs = convs.join(heads, F.col("conv_id") - F.col("conv_id") % EVERY == F.col("base"), "left")
    lent = F.least("h", F.coalesce(F.size("heads"), F.lit(0)))
    convs = convs.withColumn("lent", F.greatest(lent, F.lit(0)).cast("int"))  # the size of null is -1 without ANSI
    convs = convs.withColumn("total", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    taken = convs.select("conv_id", "total", F.explode(F.expr("slice(heads, 1, lent)")).alias("t"))
    taken = taken.select("conv_id", F.col("t.place").alias("depth"), "total", "t.x1", "t.x2", "t.bytes")
    own = turns.join(convs.select("conv_id", "h", "lent", "total"), "conv_id").where("place > h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("lent")).alias("depth"), "total", "x1", "x2", "bytes")
    zero = F.lit(0).cast("long")
    starts = convs.select("conv_id", zero.alias("depth"), "total", zero.alias("x1"), zero.alias("x2"), zero.alias("bytes"))
    return starts.unionByName(taken).unionByName(own)


def _paths(turns: DataFrame) -> DataFrame:
    """Path rows with the digests of their node (d1, d2) and its parent (p1, p2; of the root: itself)."""
    def part(seed: int, a: str, b: str) -> Column:
        return F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), "depth", a, b))

    turns = turns.withColumns({"y1": part(1, "x1", "x2"), "y2": part(2, "x2", "x1")})
    summed = running(turns, "conv_id", ["depth"], ["depth", "total", "bytes", "y1", "y2"], ["y1", "y2"])

    def parents(batches):
        for batch in batches:
            rows = {c: ints(batch.column(c)) for c in batch.schema.names}
            yield _batch(ddl, [rows["conv_id"], rows["depth"], rows["total"], rows["bytes"], rows["run_y1"], rows["run_y2"],
                               rows["run_y1"] - rows["y1"], rows["run_y2"] - rows["y2"]])

    ddl = "conv_id long, depth long, total long, bytes long, d1 long, d2 long, p1 long, p2 long"
    return summed.mapInArrow(parents, ddl)


def trie(turns: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of conversations, given as rows of `regrouped`.

    node, parent (32 hex digits), conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (summed over the subtree: (n_convs - 1) times the bytes of the last text) and ends_sha256 (of the
    comma-joined ids of the conversations that end there, in order). The root's parent is null. No rows, no nodes.
    The path of a shared node is a bounded part of a shard, unless a single conversation is longer than a shard.
    """
    paths = _paths(turns)
    same = [F.min(c).alias(c) for c in ("p1", "p2", "depth", "bytes")]
    differ = F.greatest(*(F.max(c) != F.min(c) for c in ("p1", "p2", "depth", "bytes")))
    counted = paths.mapInArrow(_count, _COUNTED).groupBy("d1", "d2").agg(
        *same, F.sum("n").alias("n"), F.sum("ends").alias("ends"), F.min("conv_id").alias("conv_id"), differ.alias("differ"),
    )
    collision = F.raise_error(F.lit("two prefixes share a 128-bit digest")).cast("long")
    nodes = stored(counted.withColumn("n", F.when(F.col("differ"), collision).otherwise(F.col("n"))).drop("differ"), "nodes")

    single, below = F.col("n") == 1, F.col("depth") > 0
    none = F.lit(None).cast("long")
    leaf = (F.col("n") == F.col("ends")).cast("long")
    shared = nodes.where(~single)
    values = (
        shared.select("d1", "d2", "conv_id", "depth", leaf.alias("leaves"), ((F.col("n") - 1) * F.col("bytes")).alias("saved"))
        .unionByName(nodes.where(single & below).select(
            F.col("p1").alias("d1"), F.col("p2").alias("d2"), none.alias("conv_id"), none.alias("depth"),
            F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")))
        .groupBy("d1", "d2").agg(*(F.max(c).alias(c) for c in ("conv_id", "depth")), *(F.sum(c).alias(c) for c in ("leaves", "saved")))
        .where("conv_id is not null")  # a chain below a node with one member adds nothing
        .select("conv_id", "depth", "leaves", "saved")
    )
    reach = shared.groupBy("conv_id").agg(F.max("depth").alias("deepest"))
    climbing = (
        paths.select("conv_id", "depth", "d1", "d2", "p1", "p2").join(reach, "conv_id").where("depth <= deepest")
        .join(values, ["conv_id", "depth"], "left").fillna(0, ["leaves", "saved"])
        .select("conv_id", "depth", "d1", "d2", "p1", "p2", "leaves", "saved")
        .repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    )
    sums = climbing.mapInArrow(_climb, _SUMMED)

    ends = paths.where("depth = total").select("d1", "d2", "conv_id")
    chunks = ends.repartitionByRange("d1", "d2", "conv_id").sortWithinPartitions("d1", "d2", "conv_id")
    chunks = chunks.mapInArrow(_chunks, "d1 long, d2 long, first long, ids string")
    shas = chunks.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first").mapInArrow(_hashed, "d1 long, d2 long, sha string")

    children = nodes.where(below).groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count("*").alias("n_children"))
    facts = nodes
    for more in (children, sums, shas):
        facts = facts.unionByName(more, allowMissingColumns=True)
    whole = facts.groupBy("d1", "d2").agg(
        *(F.max(c).alias(c) for c in ("p1", "p2", "depth", "n", "conv_id", "n_children", "sha")), *(F.sum(c).alias(c) for c in ("leaves", "saved")),
    )
    over = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    whole = whole.join(over, ["p1", "p2"], "left")

    def name(a: str, b: str) -> Column:
        return F.lower(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in (a, b))))

    return whole.select(
        name("d1", "d2").alias("node"), F.when(below, name("p1", "p2")).alias("parent"), "conv_id", "depth",
        F.when(below, F.col("parent_conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


SQL = """
WITH RECURSIVE turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), bits AS (  -- CRC-32, a bit in each step
    SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS bit, CAST(4294967295 AS BIGINT) AS c FROM turns GROUP BY conv_id
    UNION ALL
    SELECT conv_id, s, bit + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END
    FROM (SELECT *, CASE WHEN bit % 8 = 0 THEN xor(c, CAST(ascii(substr(s, bit // 8 + 1, 1)) AS BIGINT)) ELSE c END AS x
          FROM bits WHERE bit < 8 * length(s))
), lent AS (
    SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % 9 AS h FROM bits WHERE bit = 8 * length(s)
), rebuilt AS (
    SELECT l.conv_id, 0 AS part, t.place, t.role, t.text
    FROM lent l JOIN turns t ON t.conv_id = l.conv_id - l.conv_id % 5 AND t.place <= l.h
    UNION ALL
    SELECT l.conv_id, 1, t.place, t.role, t.text FROM lent l JOIN turns t ON t.conv_id = l.conv_id AND t.place > l.h
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth,
           count(*) OVER (PARTITION BY conv_id) AS total
    FROM rebuilt
), paths AS (
    SELECT conv_id, depth, total, strlen(text) AS bytes,
           string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
    FROM numbered
    UNION ALL
    SELECT l.conv_id, 0, coalesce(max(n.total), 0), 0, '' FROM lent l LEFT JOIN numbered n USING (conv_id) GROUP BY l.conv_id
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = total), '')) AS ends_sha256,
           count(*) = count(*) FILTER (depth = total) AS leaf
    FROM paths GROUP BY path, depth
), sums AS (
    SELECT left(path, 128 * up) AS path, sum(saved) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves,
           count(*) FILTER (up = depth - 1) AS n_children
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM nodes) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 128 * (n.depth - 1))
"""
