import datetime
import hashlib

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabwatch.operators import drift
from tabwatch.queries.feature_queries import SPEC
from tabwatch.schema import ID, TARGET, ColumnSpec, DatasetContract, MonitorConfig, categories, numbers
from tabwatch.session import new_workspace
from tabwatch.streaming import counts, ingest, limiter, scoring, sink
from tabwatch.streaming import drift as stream_drift

T0 = datetime.datetime(2024, 1, 1)
MINUTE = 60_000_000


def blocked(attempts, config=MonitorConfig(), start=None, failures=0):
    micros = np.array([int(t * MINUTE) for t, _ in attempts], dtype="int64")
    flags, start, failures = limiter.decide(micros, np.array([ok for _, ok in attempts]), start, failures, config)
    return flags.tolist(), start, failures


def test_fifth_failure_blocks_even_the_right_password():
    attempts = [(0.1 * i, False) for i in range(5)] + [(0.6, False), (0.7, True), (4.9, True), (5.0, True)]
    assert blocked(attempts)[0] == [False] * 5 + [True] * 3 + [False]


def test_success_clears():
    flags, start, failures = blocked([(0, False), (1, False), (2, True)])
    assert flags == [False] * 3 and start is None and failures == 0


def test_window_is_anchored_at_the_first_failure():
    attempts = [(0, False), (4, False), (4.5, False), (4.8, False), (5.1, False), (5.2, False), (5.3, False), (5.4, False), (5.5, False), (5.6, False)]
    # The window of minute 0 ends at minute 5; the next one starts at 5.1 and fills at 5.5.
    assert blocked(attempts)[0] == [False] * 9 + [True]


def test_state_carries_over_between_batches():
    rng = np.random.default_rng(4)
    attempts = sorted((float(t), bool(ok)) for t, ok in zip(rng.uniform(0, 60, 300), rng.random(300) < 0.1))
    whole = blocked(attempts)[0]
    start, failures, pieces = None, 0, []
    for i in range(0, 300, 37):
        flags, start, failures = blocked(attempts[i:i + 37], start=start, failures=failures)
        pieces += flags
    assert pieces == whole and any(whole) and not all(whole)


def attempts_frame(spark, rows):
    return spark.createDataFrame(rows, "attempt_id long, ts timestamp, key string, success boolean")


def test_limiter_stream_equals_replay_across_files(spark):
    root = new_workspace(spark, "test-limiter")
    rng = np.random.default_rng(9)
    rows = [(i, T0 + datetime.timedelta(seconds=20 * i), f"k{rng.integers(0, 3)}", bool(rng.random() < 0.1)) for i in range(600)]
    for part in range(3):
        attempts_frame(spark, rows[part * 200:(part + 1) * 200]).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = limiter.limit_attempts(sink.file_stream(spark, f"{root}/in", "*.parquet", max_files=1), watermark="1 minute")
        sink.write_batches(stream, f"{root}/out", f"{root}/checkpoint", mode="append").awaitTermination()
    got = {r["attempt_id"]: r["blocked"] for r in spark.read.parquet(f"{root}/out").collect()}
    for key in ("k0", "k1", "k2"):
        mine = [r for r in rows if r[2] == key]
        expected, _, _ = blocked([((r[1] - T0).total_seconds() / 60, r[3]) for r in mine])
        assert [got[r[0]] for r in mine] == expected
    assert any(got.values())


def event_rows(spark, start, n):
    return spark.range(start, start + n).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("v"), F.col("id") % 2).alias("model_version_id"),
        (F.lit(T0) + F.expr("make_dt_interval(0, 0, cast(id as int))")).alias("created_at"),
        (F.col("id") % 50).cast("double").alias("tenure"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("plan"),
    )


def test_counts_equal_batch_after_several_runs(spark):
    root = new_workspace(spark, "test-counts")
    for part in range(3):
        event_rows(spark, part * 100, 100).write.mode("append").parquet(f"{root}/in")
        stream = counts.windowed_counts(sink.file_stream(spark, f"{root}/in", "*.parquet"), ["model_version_id"])
        sink.write_batches(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    state = sink.newest_state(spark, f"{root}/out", ["window_start", "model_version_id"])
    batch = event_rows(spark, 0, 300).groupBy(F.date_trunc("hour", "created_at").alias("window_start"), "model_version_id").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, batch.collect()))


def test_closed_windows_are_written_once_and_open_ones_are_state(spark):
    """After every run the result is the batch result, and no window was ever written twice."""
    root = new_workspace(spark, "test-current")
    for part in range(4):
        event_rows(spark, part * 150, 150).write.mode("append").parquet(f"{root}/in")
        stream = counts.windowed_histogram(sink.file_stream(spark, f"{root}/in", "*.parquet", max_files=4), ["model_version_id"], F.col("tenure"), watermark="2 hours")
        sink.write_batches(stream, f"{root}/out", f"{root}/checkpoint", mode="append").awaitTermination()
        closed = spark.read.parquet(f"{root}/out")
        assert closed.select("window_start", "model_version_id").distinct().count() == closed.count()
        now = sink.current_windows(spark, f"{root}/out", f"{root}/checkpoint", ["model_version_id"])
        batch = counts._flat(
            event_rows(spark, 0, 150 * (part + 1)).groupBy(F.window("created_at", "1 hour").alias("window"), "model_version_id")
            .agg(*counts.histogram_aggregates(F.col("tenure"))), ["model_version_id"],
        )
        assert sorted(map(tuple, now.collect())) == sorted(map(tuple, batch.select(*now.columns).collect()))
    assert closed.count() < now.count()


def test_rows_later_than_the_watermark_are_dropped(spark):
    root = new_workspace(spark, "test-late")
    for start, shift in ((0, 0), (5000, 0), (0, 0)):
        event_rows(spark, start, 10).write.mode("append").parquet(f"{root}/in")
        stream = counts.windowed_counts(sink.file_stream(spark, f"{root}/in", "*.parquet"), [], watermark="1 hour")
        sink.write_batches(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    state = {r["window_start"]: r["n"] for r in sink.newest_state(spark, f"{root}/out", ["window_start"]).collect()}
    assert state[T0] == 10


def test_histogram_stream(spark):
    root = new_workspace(spark, "test-histogram")
    event_rows(spark, 0, 120).write.parquet(f"{root}/in")
    stream = counts.windowed_histogram(sink.file_stream(spark, f"{root}/in", "*.parquet"), ["model_version_id"], F.col("tenure"))
    sink.write_batches(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    rows = sink.newest_state(spark, f"{root}/out", ["window_start", "model_version_id"]).collect()
    assert sum(r["latency_count"] for r in rows) == 120 and all(r["le_0_5"] <= r["le_10"] <= r["le_inf"] == r["latency_count"] for r in rows)


def test_drift_stream_equals_batch_and_survives_replay(spark):
    contract = DatasetContract("c", (ColumnSpec("id", ID), *numbers("tenure"), *categories("plan"), ColumnSpec("y", TARGET)), ("Yes", "No"))
    root = new_workspace(spark, "test-drift")
    for part in range(2):
        event_rows(spark, part * 200, 200).write.mode("append").parquet(f"{root}/in")
        stream = sink.file_stream(spark, f"{root}/in", "*.parquet", max_files=2)
        stream_drift.count_stream(stream, contract, f"{root}/counts", f"{root}/checkpoint").awaitTermination()
    # A replayed micro-batch writes the same folder again.
    first = spark.read.parquet(f"{root}/counts/batch_id=0")
    kept = first.collect()
    spark.createDataFrame(kept, first.schema).write.mode("overwrite").parquet(f"{root}/counts/batch_id=0")
    versions = spark.createDataFrame([("v0", "l", "d", None), ("v1", "l", "d", None)], "model_version_id string, version_label string, dataset_id string, training_job_id string")
    training = spark.range(300).select(F.lit("d").alias("dataset_id"), (F.col("id") % 40).cast("double").alias("tenure"), F.lit("a").alias("plan"))
    streamed = stream_drift.report(spark, f"{root}/counts", versions, training, contract)
    _, batch = drift.drift_report(versions, training, event_rows(spark, 0, 400), contract, as_of=F.lit(T0))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.select(*streamed.columns).collect()))
    assert streamed.count() == 4
    # A window that begins inside an hour: that hour's rows come from the log.
    since, config = F.lit(T0 + datetime.timedelta(minutes=90)), MonitorConfig(min_samples=20)
    log = event_rows(spark, 0, 400)
    window = stream_drift.report(spark, f"{root}/counts", versions, training, contract, since=since, predictions=log, config=config)
    _, exact = drift.drift_report(versions, training, log.where(F.col("created_at") >= since), contract, as_of=F.lit(T0), config=config)
    assert sorted(map(tuple, window.collect())) == sorted(map(tuple, exact.select(*window.columns).collect()))


def test_folded_counts_give_any_window(spark):
    """Hours fold into days and months, in several steps; windows that start inside any unit equal the log's."""
    contract = DatasetContract("c", (ColumnSpec("id", ID), *numbers("tenure"), *categories("plan"), ColumnSpec("y", TARGET)), ("Yes", "No"))
    root = new_workspace(spark, "test-fold")
    end = T0 + datetime.timedelta(days=100)

    def late(lo, n):  # an event every 5 hours
        return event_rows(spark, lo, n).withColumn("created_at", (F.lit(T0) + F.make_dt_interval(F.lit(0), F.col("id").cast("int") * 5)).cast("timestamp"))

    for part in range(3):
        late(part * 160, 160).write.mode("append").parquet(f"{root}/in")
        stream = sink.file_stream(spark, f"{root}/in", "*.parquet", max_files=100)
        stream_drift.count_stream(stream, contract, f"{root}/counts", f"{root}/checkpoint").awaitTermination()
        hours = spark.read.parquet(f"{root}/counts").select("start").distinct().count()
        folds = stream_drift.fold(spark, f"{root}/counts", as_of=T0 + datetime.timedelta(days=33 * (part + 1)), keep_days=35, settled=part == 2, remove=True)
        assert folds == stream_drift.fold(spark, f"{root}/counts", as_of=T0 + datetime.timedelta(days=33 * (part + 1)), keep_days=35, settled=part == 2)
    starts = stream_drift.unit_counts(spark, f"{root}/counts", stream_drift._folds(spark, f"{root}/counts")).select("start").distinct().count()
    assert starts < 90 < hours + 320
    versions = spark.createDataFrame([("v0", "l", "d", None), ("v1", "l", "d", None)], "model_version_id string, version_label string, dataset_id string, training_job_id string")
    training = spark.range(300).select(F.lit("d").alias("dataset_id"), (F.col("id") % 40).cast("double").alias("tenure"), F.lit("a").alias("plan"))
    config, log = MonitorConfig(min_samples=2), late(0, 480)
    for since in (None, T0 + datetime.timedelta(days=3, minutes=7), T0 + datetime.timedelta(days=70, hours=5, minutes=1), end - datetime.timedelta(minutes=601)):
        seen = None if since is None else F.lit(since)
        got = stream_drift.report(spark, f"{root}/counts", versions, training, contract, since=seen, predictions=log, config=config)
        _, exact = drift.drift_report(versions, training, log if since is None else log.where(F.col("created_at") >= since), contract, as_of=F.lit(T0), config=config)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exact.select(*got.columns).collect()))


def test_ingest_stream_checks_each_content_once(spark, contract):
    root = new_workspace(spark, "test-ingest")
    import pathlib

    inbox = pathlib.Path(root.removeprefix("file:")) / "in"
    inbox.mkdir(parents=True)
    body = "id,depth,flow,soil,target\n" + "".join(f"C{i},{30 + i},{i}.5,p,{'Yes' if i % 2 else 'No'}\n" for i in range(60))

    def run():
        ingest.ingest_stream(spark, str(inbox), contract, f"{root}/catalog", f"{root}/checkpoint").awaitTermination()

    (inbox / "a.csv").write_text(body)
    (inbox / "note.txt").write_text("hello")
    run()
    (inbox / "copy.csv").write_text(body)
    (inbox / "bad.csv").write_text(body.replace(",Yes", ",Maybe"))
    run()
    rows = {r["path"].rsplit("/", 1)[1]: r for r in spark.read.parquet(f"{root}/catalog").collect()}
    assert set(rows) == {"a.csv", "note.txt", "bad.csv"}
    assert rows["a.csv"]["is_valid"] and rows["a.csv"]["n_rows"] == 60
    assert rows["a.csv"]["sha256"] == hashlib.sha256(body.encode()).hexdigest()
    assert rows["note.txt"]["reject_reason"].startswith("Unsupported") and rows["note.txt"]["is_valid"] is None
    assert rows["bad.csv"]["is_valid"] is False and rows["bad.csv"]["n_errors"] == 1


def test_ingest_stream_reads_each_files_own_header(spark, contract):
    import pathlib

    root = new_workspace(spark, "test-headers")
    inbox = pathlib.Path(root.removeprefix("file:")) / "in"
    inbox.mkdir(parents=True)
    cells = [[f"W{i}", str(30 + i), f"{i}.5", '"clay, wet\nor ""dry"""', "Yes" if i % 2 else "No"] for i in range(60)]
    names = ["id", "depth", "flow", "soil", "target"]

    def write(file, columns, rows=60, header=None, extra=""):
        lines = [",".join(header or columns) + extra] + [",".join(r[names.index(c)] for c in columns) + extra for r in cells[:rows]]
        (inbox / file).write_text("\n".join(lines) + "\n")

    write("good.csv", names)
    write("turned.csv", names[::-1])
    write("foreign.csv", names, header=["a", "b", "c", "d", "e"])
    write("missing.csv", [n for n in names if n != "flow"])
    write("more.csv", names, header=[*names, "spare"])
    write("nothing.csv", names, rows=0)
    (inbox / "broken.csv").write_text((inbox / "good.csv").read_text() + 'W99,1,2,"never closed,No\n')
    ingest.ingest_stream(spark, str(inbox), contract, f"{root}/catalog", f"{root}/checkpoint", pattern="*.csv").awaitTermination()
    rows = {r["path"].rsplit("/", 1)[1]: (r["n_rows"], r["is_valid"], r["checks"]) for r in spark.read.parquet(f"{root}/catalog").collect()}
    assert rows["good.csv"] == rows["turned.csv"] == (60, True, "")
    assert rows["foreign.csv"] == (60, False, "required_columns,unexpected_columns")
    assert rows["missing.csv"] == (60, False, "required_columns")
    assert rows["more.csv"] == (60, True, "unexpected_columns")
    assert rows["nothing.csv"] == (0, False, "non_empty")
    assert rows["broken.csv"] == (60, False, "malformed_records")


def test_watermark_option_is_required_type(spark):
    with pytest.raises(Exception):
        limiter.limit_attempts(attempts_frame(spark, []), watermark="not a duration")


class _Even:
    """Stands for a model: the positive class at a chance of one half."""

    def transform(self, rows):
        return rows.withColumns({"prediction": F.lit(1.0), "probability": array_to_vector(F.array(F.lit(0.5), F.lit(0.5)))})


def test_scored_micro_batches_parse_a_text_once(spark, monkeypatch):
    """Both outputs of a micro-batch: every record once, and no check repeats the parsing of a text."""
    root, plans = new_workspace(spark, "score-test"), []
    rows = [("a", " 1", "2.5", "3", "f", "s"), ("b", "1.5", "2.5", "3", "f", "s"), ("c", "1", None, "x", "f", None), ("d", "4", "0", None, "f", "s"), ("e", "2d", "-1", "", "f", "s")]
    schema = "row_key string, quantity string, unit string, total string, flag string, status string"
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/in")

    def seen(*a, real=scoring.score, **b):
        out = real(*a, **b)
        plans.extend(d._jdf.queryExecution().optimizedPlan().toString() for d in out)
        return out

    monkeypatch.setattr(scoring, "score", seen)
    scoring.score_stream(
        spark.readStream.schema(schema).parquet(f"{root}/in"), _Even(), SPEC, f"{root}/out", f"{root}/checkpoint", model_version_id="v",
        record_key=["row_key"], integers=["quantity"],
    ).awaitTermination()
    refused = {r["row_key"]: r["violations"] for r in spark.read.parquet(f"{root}/out/rejected").collect()}
    assert refused == {
        "b": ["quantity: not an integer"], "c": ["status: required", "total: not a number", "unit: required"],
        "e": ["quantity: not a number", "total: not a number", "unit: negative"],
    }
    log = spark.read.parquet(f"{root}/out/predictions").select("input_features.*", "prediction").collect()
    assert sorted((r["quantity"], r["total"], r["prediction"]) for r in log if r["total"]) == [(1.0, 3.0, "Yes")] and len(log) == 2
    filters = [line for plan in plans for line in plan.splitlines() if "Filter" in line and "required" in line]
    assert len(filters) == len(plans) >= 2 and all("trim(" not in line for line in filters)
