"""Line deduplication by winnowing.

The lines of a text that hold a word are hashed. Of every RUN lines in a row the one with the least hash is selected
(the last such one), so two texts that share RUN lines in a row share a selected line in the same place: it is a
guaranteed fingerprint. Occurrences of a fingerprint are dealt to one place, with the runs around it that selected it;
each occurrence is matched with the first one, both ways, as far as those runs go, and the runs of neighbouring
fingerprints carry a match on. A run that has occurred before, in a smaller document or further up, is deleted.

Of the occurrences in a batch only the first is dealt; later ones are deleted at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabwatch.llm.arrow import PARCEL, PARCEL_DDL, blocks, flat, joined, parcels, record, unpacked, unused
from tabwatch.llm.hashing import Substrings, line_spans, mix, word_spans
from tabwatch.session import stored

RUN = 2
N_LINES, N_REMOVED = "n_lines_", "n_removed_"
RUNS, DELETED = 0, 1
_RUNS = "u8 i8 u8 u4"  # hash of the run, doc, row, its first line
_DELETED = "u8 u4"  # row, first line


def _lines(column: pa.Array):
    data, offsets = flat(column)
    starts, ends, owner = line_spans(data, offsets, word_spans(data, offsets)[0])
    return data, offsets, starts, ends, owner


def winnow(lines: np.ndarray, owner: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of lines of one text: its first line, the line it selects, and its hash."""
    first = np.flatnonzero(owner[run - 1 :] == owner[: len(owner) - run + 1]) if len(owner) >= run else np.empty(0, np.int64)
    selected, whole = first.copy(), np.zeros(len(first), np.uint64)
    for k in range(run):
        selected = np.where(lines[first + k] <= lines[selected], first + k, selected)
        whole = mix(whole * np.uint64(3) + lines[first + k])
    return first, selected, whole


def _first_seen(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Runs by hash and place, and whether an occurrence in an earlier place is known."""
    order = np.lexsort((columns[2], columns[3], columns[1], columns[0]))
    columns = [c[order] for c in columns]
    fresh = np.append(True, columns[0][1:] != columns[0][:-1])[: len(order)]
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    later = (columns[1] != columns[1][first]) | (columns[3] != columns[3][first])
    return columns, later


def _delete(n: int, columns: list[np.ndarray]):
    return parcels(DELETED, (columns[2] % np.uint64(n)).astype(np.int32), [columns[2], columns[3]])


def _select(n: int, run: int):
    def fingerprints(batches):
        for batch in batches:
            found = []
            for block in blocks(batch, "text"):
                data, offsets, starts, ends, owner = _lines(block.column("text"))
                lines = Substrings(data).of(starts, ends)
                first, selected, whole = winnow(lines, owner, run)
                doc = block.column("rank").to_numpy(zero_copy_only=False)
                row = block.column("row").to_numpy(zero_copy_only=False).view(np.uint64)
                before = np.searchsorted(owner, np.arange(len(offsets) - 1))
                of = owner[first]
                found.append([whole, doc[of], row[of], (first - before[of]).astype(np.uint32), lines[selected]])
            columns, later = _first_seen(joined(found, _RUNS + " u8"))
            yield from _delete(n, [c[later] for c in columns])
            kept = [c[~later] for c in columns]
            yield from parcels(RUNS, (kept[4] % np.uint64(n)).astype(np.int32), kept[:4])

    return fingerprints


def _match(n: int):
    def run(batches):
        found = []
        for batch in batches:
            for kind, bucket, records in zip(*(batch.column(c).to_pylist() for c in ("kind", "bucket", "records")), strict=True):
                if kind == RUNS:
                    found.append(unpacked(records, _RUNS))
                else:
                    yield record(PARCEL, kind=[kind], bucket=[bucket], records=[records], data=[b""])
        columns, later = _first_seen(joined(found, _RUNS))
        yield from _delete(n, [c[later] for c in columns])

    return run


_BY_ROW = pa.schema([("row_", pa.int64()), ("gone_", pa.binary())])


def _gather(batches):
    """Deleted runs of each row, one row for each."""
    found = [unpacked(r, _DELETED) for batch in batches for r in batch.column("records").to_pylist()]
    row, line = joined(found, _DELETED)
    order = np.lexsort((line, row))
    row, line = row[order], line[order]
    cuts = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)]), len(row))
    rows = row[cuts[:-1]].view(np.int64) if len(row) else np.empty(0, np.int64)
    yield record(_BY_ROW, row_=rows, gone_=[line[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), text_col)


def deleted_runs(docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_ (as of row_key) and gone_: the first lines (32-bit numbers, blank lines left out) of its deleted runs."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(rank.alias("rank"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    dealt = rows.mapInArrow(_select(n, run), PARCEL_DDL).repartitionById(n, F.col("bucket"))
    matched = dealt.mapInArrow(_match(n), PARCEL_DDL).repartitionById(n, F.col("bucket"))
    return stored(matched.mapInArrow(_gather, "row_ long, gone_ binary"), "lines")


def _without(text: bytes, starts: np.ndarray, ends: np.ndarray, drop: np.ndarray) -> bytes:
    """The text without some of its lines; each goes with the feed after it, the last one with the feed before."""
    keep, at = [], 0
    for line in drop.tolist():
        keep.append(text[at : starts[line]])
        at = min(int(ends[line]) + 1, len(text))
    keep.append(text[at:])
    left = b"".join(keep)
    return left[:-1] if int(ends[drop[-1]]) == len(text) and left.endswith(b"\n") else left


def _apply(schema: pa.Schema, text_col: str, run: int, gone_col: str):
    def delete(batches):
        for batch in batches:
            for block in blocks(batch, text_col):
                gone, texts = block.column(gone_col), block.column(text_col).to_pylist()
                data, offsets, starts, ends, owner = _lines(block.column(text_col))
                lines = np.bincount(owner, minlength=block.num_rows)
                ahead, removed = np.append(0, np.cumsum(lines)), np.zeros(block.num_rows, np.int64)
                for k in np.flatnonzero(np.asarray(gone.is_valid())).tolist():
                    drop = np.unique((np.frombuffer(gone[k].as_py(), np.uint32)[:, None] + np.arange(run)).ravel())
                    removed[k] = len(drop)
                    own = slice(ahead[k], ahead[k + 1])
                    text = data[offsets[k] : offsets[k + 1]].tobytes()
                    texts[k] = _without(text, starts[own] - offsets[k], ends[own] - offsets[k], drop).decode("utf-8")
                made = [pa.array(texts, schema.field(text_col).type) if name == text_col else block.column(name) for name in schema.names[:-2]]
                yield pa.RecordBatch.from_arrays([*made, pa.array(lines, pa.int64()), pa.array(removed)], schema=schema)

    return delete


def dedup_lines(docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` with the repeated runs deleted from the text, and n_lines_, n_removed_ (lines with a word).

    A line goes if it is in `run` lines in a row (blank ones left out) that also begin at an earlier place: in a
    document with a smaller id, or further up in the same one; this is judged on the input. Null texts stay null, a
    text may become empty. Rows with an equal id count as one document; a null id comes first.
    """
    row, gone, n_lines, n_removed = (unused(x, docs.columns) for x in ("row_", "gone_", N_LINES, N_REMOVED))
    runs = deleted_runs(docs, run, id_col, text_col).toDF(row, gone)
    # One plan for all sizes: a small table of runs is not broadcast either.
    marked = docs.join(runs.hint("merge"), row_key(id_col, text_col) == F.col(row), "left").drop(row)
    arrow = to_arrow_schema(docs.schema).append(pa.field(n_lines, pa.int64())).append(pa.field(n_removed, pa.int64()))
    ddl = T.StructType([*docs.schema.fields, T.StructField(n_lines, T.LongType()), T.StructField(n_removed, T.LongType())])
    return marked.mapInArrow(_apply(arrow, text_col, run, gone), ddl)


def digest(deduped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed and the hash of what is left of each text (null as empty)."""
    kept = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    return deduped.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(N_LINES).alias("n_lines"), F.col(N_REMOVED).alias("n_removed"),
        kept.alias("kept_sha256"),
    )


#: The same rows in plain SQL, for RUN = 2.
SQL = r"""
WITH lines AS (
    SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
real AS (
    SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
runs AS (SELECT a.doc_id, a.p, a.line AS l1, b.line AS l2 FROM real a JOIN real b ON a.doc_id = b.doc_id AND b.p = a.p + 1),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY l1, l2 ORDER BY doc_id, p) AS k FROM runs) WHERE k > 1),
gone AS (SELECT doc_id, p FROM later UNION SELECT doc_id, p + 1 FROM later),
kept AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
    FROM lines l LEFT JOIN real r ON r.doc_id = l.doc_id AND r.i = l.i
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.p = r.p) GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_lines, coalesce(g.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM real GROUP BY doc_id) n USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN kept k USING (doc_id)
"""
