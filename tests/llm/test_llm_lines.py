import hashlib

import numpy as np
from llm_fixtures import WORD, documents, empty, frame

from tabwatch.llm import lines


def expected(rows, run=2):
    """rows: (doc_id, text) -> (doc_id, lines with a word, removed, what is left) by the definition."""
    real = [[(i, x) for i, x in enumerate((t or "").split("\n")) if WORD.search(x)] for _, t in rows]
    first = {}
    for (doc, _), own in zip(rows, real, strict=True):
        for p in range(len(own) - run + 1):
            key = tuple(x for _, x in own[p : p + run])
            first[key] = min(first.get(key, (doc, p)), (doc, p))
    out = []
    for (doc, text), own in zip(rows, real, strict=True):
        gone = set()
        for p in range(len(own) - run + 1):
            if first[tuple(x for _, x in own[p : p + run])] < (doc, p):
                gone |= {own[p + k][0] for k in range(run)}
        kept = "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in gone)
        out.append((doc, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def run_on(spark, docs, run=2):
    least = -(1 << 63)
    rows = [(d[0] if d[0] is not None else least, d[1]) for d in docs]
    got = lines.digest(lines.dedup_lines(frame(spark, docs), run)).collect()
    found = sorted((r["doc_id"] if r["doc_id"] is not None else least, *tuple(r)[1:]) for r in got)
    assert found == sorted(expected(rows, run))
    return found


def test_against_definition(spark):
    extra = ["a\nb\nc\nd", "x\na\nb\n\ny", "a\nb\na\nb\na\nb", "b\nc\nd\n", "\n\nq\n", "a \nb", "a\nb", "n\n \nm", "n\nm"]
    docs = documents() + [(5000 - k, t, "en", "a", 0, *["x"] * 9) for k, t in enumerate(extra)]
    assert any(r[2] for r in run_on(spark, docs, 2))
    run_on(spark, docs, 3)


def test_columns_and_empty(spark):
    docs = frame(spark)
    out = lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines_", "n_removed_"]
    assert out.where("text is null").count() == docs.where("text is null").count()
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_runs_share_a_selected_line():
    """The guarantee: equal runs select the line in the same place, the last one of equal hashes."""
    rng = np.random.default_rng(1)
    values = rng.integers(0, 4, 400).astype(np.uint64)
    for run in (2, 3, 5):
        first, selected, whole = lines.winnow(values, np.zeros(400, np.int64), run)
        places = {}
        for f, s, h in zip(first, selected, whole, strict=True):
            window = tuple(values[f : f + run].tolist())
            assert s - f == max(k for k in range(run) if window[k] == min(window))
            assert places.setdefault(window, (s - f, h)) == (s - f, h)
