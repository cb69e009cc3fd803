"""Runs registered queries on Spark and their SQL on DuckDB and compares all rows.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6f}") + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql: str) -> tuple[bool, str]:
    cols, rows = normalised(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    ocols, orows = normalised([d[0] for d in cur.description], cur.fetchall())
    if cols != ocols:
        return False, f"columns {cols} != {ocols}"
    if len(rows) != len(orows):
        return False, f"{len(rows)} rows != {len(orows)}; spark {rows[:2]} sql {orows[:2]}"
    for a, b in zip(rows, orows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return False, f"spark {a} != sql {b}"
    return True, f"{len(rows)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from tabwatch.session import build_session

    spark = build_session(
        "oracle-check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                ok, note = compare(df, con, oracles[name])
            else:
                ok, note = True, f"{df.count()} rows, no SQL"
        except Exception as exc:  # report and go on
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
