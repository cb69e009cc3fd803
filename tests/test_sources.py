import datetime
import json

import pytest
from pyspark.sql import functions as F

from tabwatch.functions.coerce import null_na_tokens
from tabwatch.plans.ingest import RejectedUpload, ingest_csv
from tabwatch.schema import ID, TARGET, ColumnSpec, DatasetContract, MonitorConfig, categories, numbers
from tabwatch.session import new_workspace
from tabwatch.sources import csv, files, logs, tables


@pytest.fixture()
def folder(tmp_path):
    return tmp_path


def now():
    return F.lit(datetime.datetime(2024, 1, 1))


def test_header_na_tokens_quotes_and_overflow(spark, folder):
    path = folder / "a.csv"
    path.write_text('id,name,v\n1,"x, ""y""",NA\n2,none, \n3,short\n4,a,b,extra\n5,"","null"\n6,a,b,\n7,"a,b",c\n8,"never closed,x\n')
    rows, rejects = csv.split_malformed(csv.read_raw_csv(spark, str(path)))
    assert rows.columns == ["id", "name", "v"]
    assert {tuple(r) for r in rows.collect()} == {("1", 'x, "y"', None), ("2", "none", " "), ("3", "short", None), ("5", None, None), ("7", "a,b", "c")}
    assert [(r["id"], r[csv.OVERFLOW]) for r in rejects.collect()] == [("4", "extra"), ("6", csv.EMPTY_FIELD), ("8", csv.BROKEN)]


def test_multi_line_values(spark, folder):
    path = folder / "m.csv"
    path.write_text('id,name\n1,"two\nlines"\n')
    assert csv.read_raw_csv(spark, str(path)).head()["name"] == "two\nlines"


def test_csv_round_trip_keeps_blanks(spark, folder):
    df = spark.createDataFrame([("1", "  x "), ("2", " "), ("3", None), ("4", 'q"u,o')], "id string, v string")
    csv.write_raw_csv(df, str(folder / "out"))
    back = csv.read_raw_csv(spark, str(folder / "out")).drop(csv.OVERFLOW)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in null_na_tokens(df).collect()}


def test_admission_and_fingerprints(spark, folder):
    (folder / "ok.csv").write_bytes(b"id\n1\n")
    (folder / "UP.CSV").write_bytes(b"id\n")
    (folder / "big.csv").write_bytes(b"x" * (1024 * 1024 + 1))
    (folder / "empty.csv").write_bytes(b"")
    (folder / "notes.txt").write_bytes(b"hello")
    config = MonitorConfig(max_upload_mb=1)
    reasons = {r["path"].rsplit("/", 1)[1]: r["reject_reason"] for r in files.admission(files.list_files(spark, str(folder)), config).collect()}
    assert reasons["ok.csv"] is None and reasons["UP.CSV"] is None
    assert reasons["big.csv"] == "File size 1.0MB exceeds the 1MB limit."
    assert "empty.csv" not in reasons  # zero bytes: not listed
    listed = spark.createDataFrame([("in/e.csv", 0)], "path string, length bigint")
    assert files.admission(listed).head()["reject_reason"] == "Uploaded file is empty."
    assert reasons["notes.txt"] == "Unsupported file type '.txt'. Only CSV files are accepted."
    hashes = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in files.fingerprints(spark, str(folder)).collect()}
    import hashlib

    assert hashes["ok.csv"] == hashlib.sha256(b"id\n1\n").hexdigest()
    assert hashes["big.csv"] == hashlib.sha256(b"x" * (1024 * 1024 + 1)).hexdigest()  # refused, but hashed


def test_content_hash_covers_all_files(spark, folder):
    (folder / "up").mkdir()
    for name, text in (("a.csv", "1"), ("b.csv", "2")):
        (folder / "up" / name).write_text(text)

    def digest():
        return files.content_hash(files.fingerprints(spark, str(folder / "up")), str(folder / "up")).head()[0]

    seen = [digest()]
    for name in ("a.csv", "b.csv"):
        (folder / "up" / name).write_text("changed " + name)
        seen.append(digest())
    assert len(set(seen)) == 3
    single = files.fingerprints(spark, str(folder / "up" / "a.csv"))
    assert files.content_hash(single, str(folder / "up" / "a.csv")).head()[0] == single.head()["sha256"]


def test_integrity_precedence(spark):
    catalog = spark.createDataFrame(
        [("ok", True, "p", "h"), ("inv", False, "gone", "h"), ("miss", True, "gone", "h"), ("stale", True, "p", "other")],
        "id string, is_valid boolean, storage_path string, content_hash string",
    )
    hashes = spark.createDataFrame([("p", "h")], "storage_path string, sha256 string")
    wanted = spark.createDataFrame([(i,) for i in ("ok", "inv", "miss", "stale", "nope")], "dataset_id string")
    assert {r["dataset_id"]: r["status"] for r in files.integrity(wanted, catalog, hashes).collect()} == {
        "ok": "ok", "inv": "invalid", "miss": "missing_file", "stale": "hash_mismatch", "nope": "not_found",
    }


def test_verified_runs(spark, folder):
    (folder / "r1" / "model").mkdir(parents=True)
    (folder / "r1" / "model" / "part").write_text("x")
    (folder / "r2").mkdir()
    runs = files.verified_runs(files.list_files(spark, str(folder)), F.regexp_extract("path", r"/([^/]+)/model/", 1))
    assert [r[0] for r in runs.collect()] == ["r1"]


def test_landing_replaces_only_its_dataset(spark, folder):
    path = str(folder / "landing")
    df = spark.createDataFrame([("1",), ("2",)], "v string")
    tables.land_rows(df, "a", path)
    tables.land_rows(df, "b", path)
    tables.land_rows(df.limit(1), "b", path)
    assert {r["dataset_id"]: r["count"] for r in spark.read.parquet(path).groupBy("dataset_id").count().collect()} == {"a": 2, "b": 1}


def test_prediction_log_prunes_days(spark):
    path = new_workspace(spark, "test-log")
    rows = spark.range(100).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") < 70, "hot").otherwise("cold").alias("model_version_id"),
        (F.lit(datetime.datetime(2024, 1, 1)) + F.expr("make_dt_interval(cast(id % 3 as int))")).alias("created_at"),
    )
    tables.append_predictions(rows, path)
    tables.append_predictions(rows, path)
    log = spark.read.parquet(path)
    day = log.where("dt = '2024-01-02' AND model_version_id = 'hot'")
    assert log.count() == 200 and day.count() == 2 * len([i for i in range(70) if i % 3 == 1])
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()


def test_ingest(spark, folder, contract):
    good = folder / "good.csv"
    good.write_text("id,depth,flow,soil,target\n" + "".join(f"C{i},{30 + i},{i}.5,p{i % 2},{'Yes' if i % 3 else 'No'}\n" for i in range(60)))
    place = {"landing": str(folder / "landing"), "catalog": str(folder / "datasets"), "as_of": now()}
    row = ingest_csv(spark, str(good), contract, dataset_id="d1", filename="good.csv", **place).head()
    assert row["is_valid"] and row["n_rows"] == 60 and row["n_columns"] == 5 and len(row["content_hash"]) == 64
    assert json.loads(row["quality_report"])["class_balance"] == {"No": 20, "Yes": 40}
    bad = folder / "bad.csv"
    bad.write_text("id,depth,soil,target\n1,2,p,Yes\n")
    row = ingest_csv(spark, str(bad), contract, dataset_id="d2", filename="bad.csv", **place).head()
    assert not row["is_valid"]
    # Landed all the same, and the catalog has both.
    assert spark.read.parquet(place["landing"]).where("dataset_id = 'd2'").count() == 1
    assert spark.read.parquet(place["catalog"]).count() == 2
    for name, body, message in (("x.txt", "id\n1\n", "Unsupported"), ("e.csv", "", "empty"), ("m.csv", "id,age\n1,2,3\n", "Could not parse")):
        (folder / name).write_text(body)
        with pytest.raises(RejectedUpload, match=message):
            ingest_csv(spark, str(folder / name), contract, dataset_id="d3", filename=name, **place)


def test_access_log(spark, folder):
    (folder / "log.json").write_text(
        '{"timestamp": "t", "message": "request_completed", "method": "GET", "path": "/a", "status_code": 200, "latency_ms": 1500.0}\n'
        '{"message": "request_failed", "method": "GET", "path": "/a"}\n'
    )
    rows = logs.read_access_log(spark, str(folder / "log.json")).collect()
    assert len(rows) == 1 and rows[0]["latency_s"] == 1.5


def test_typed_struct():
    contract = DatasetContract("c", (ColumnSpec("id", ID), *numbers("a"), *categories("b"), ColumnSpec("y", TARGET)), ("Yes", "No"))
    assert [f.dataType.simpleString() for f in contract.typed_struct().fields] == ["double", "string"]
    assert contract.required == ("id", "a", "b", "y")
