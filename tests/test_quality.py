import json

import pytest
from pyspark.sql import functions as F

from tabwatch.operators import quality


def rows(n=60):
    return [
        {"id": f"W{i}", "depth": str(30 + i % 20), "flow": str(100.0 + i), "soil": "clay" if i % 2 else "sand",
         "target": "Yes" if i % 3 == 0 else "No"}
        for i in range(n)
    ]


def frame(spark, data, columns=("id", "depth", "flow", "soil", "target")):
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in data], schema)


def report(spark, contract, data, columns=("id", "depth", "flow", "soil", "target")):
    return quality.report(frame(spark, data, columns), contract).head().asDict(recursive=True)


def finding(rep, check):
    found = [i for i in rep["issues"] if i["check"] == check]
    assert found, f"no {check} in {[i['check'] for i in rep['issues']]}"
    return found[0]


def changed(**cells):
    data = rows()
    for key, value in cells.items():
        column, _, at = key.partition("_")
        data[int(at or 0)][column] = value
    return data


def test_clean(spark, contract):
    rep = report(spark, contract, rows())
    assert rep["is_valid"] and rep["issues"] == [] and rep["n_rows"] == 60 and rep["n_columns"] == 5
    assert rep["class_balance"] == {"No": 40, "Yes": 20} and rep["duplicate_row_count"] == 0
    assert rep["column_null_counts"] == {"depth": 0, "flow": 0, "soil": 0}


def test_empty(spark, contract):
    rep = report(spark, contract, [])
    assert finding(rep, "non_empty")["severity"] == "error" and not rep["is_valid"]
    assert finding(rep, "target_labels")["severity"] == "error"


def test_missing_column_skips_value_checks(spark, contract):
    data = rows()
    data[1] = {**data[0], "id": data[1]["id"]}
    rep = report(spark, contract, data, ("id", "flow", "soil", "target"))
    assert finding(rep, "required_columns")["details"]["missing_columns"] == "depth"
    assert rep["class_balance"] is None and rep["column_null_counts"] == {} and rep["duplicate_row_count"] == 1
    assert len(rep["issues"]) == 1 and not rep["is_valid"]


def test_extra_column_is_a_warning(spark, contract):
    rep = report(spark, contract, rows(), ("id", "depth", "flow", "soil", "target", "extra_col"))
    assert finding(rep, "unexpected_columns")["severity"] == "warning" and rep["is_valid"]


def test_too_few_rows(spark, contract):
    found = finding(report(spark, contract, rows(10)), "minimum_row_count")
    assert found["message"] == "Dataset has 10 rows; at least 50 are required for training."


def test_duplicate_ids(spark, contract):
    data = rows()
    data[1]["id"] = data[0]["id"]
    assert finding(report(spark, contract, data), "duplicate_ids")["details"]["duplicate_id_count"] == "1"


def test_null_ids_equal_each_other(spark, contract):
    data = rows()
    for i in (3, 4, 5):
        data[i]["id"] = None
    assert finding(report(spark, contract, data), "duplicate_ids")["details"]["duplicate_id_count"] == "2"


def test_duplicate_content(spark, contract):
    data = rows()
    data[1] = {**data[0], "id": data[1]["id"]}
    rep = report(spark, contract, data)
    assert finding(rep, "duplicate_rows")["severity"] == "warning" and rep["duplicate_row_count"] == 1 and rep["is_valid"]


def test_null_and_empty_text_are_different_content(spark, contract):
    a, b = rows()[0], rows()[0]
    rep = report(spark, contract, [*rows(), {**a, "id": "x", "soil": None}, {**b, "id": "y", "soil": ""}])
    assert rep["duplicate_row_count"] == 0


@pytest.mark.parametrize(("n_null", "severity"), [(31, "error"), (30, "warning")])
def test_missing_fraction_is_an_error_only_above_half(spark, contract, n_null, severity):
    data = rows()
    for r in data[:n_null]:
        r["soil"] = None
    assert finding(report(spark, contract, data), "missing_values")["severity"] == severity


def test_coercible_missing_only_warns(spark, contract):
    data = rows()
    for r in data:
        r["flow"] = " "
    rep = report(spark, contract, data)
    found = finding(rep, "missing_values")
    assert found["severity"] == "warning" and found["message"].endswith("will be imputed during preprocessing.")


@pytest.mark.parametrize(("column", "value", "severity"), [("depth", "not_a_number", "error"), ("flow", "N/A", "warning")])
def test_text_in_numeric(spark, contract, column, value, severity):
    found = finding(report(spark, contract, changed(**{column: value})), "dtype_numeric")
    assert found["severity"] == severity and found["details"] == {"column": column, "invalid_count": "1"}


def test_unexpected_label_wins_over_too_few_classes(spark, contract):
    data = [{**r, "target": "Maybe"} for r in rows()]
    found = [i for i in report(spark, contract, data)["issues"] if i["check"] == "target_labels"]
    assert len(found) == 1 and found[0]["details"] == {"unexpected_labels": "Maybe"}


def test_one_class(spark, contract):
    found = finding(report(spark, contract, [{**r, "target": "Yes"} for r in rows()]), "target_labels")
    assert found["message"] == "Target column 'target' must have at least 2 distinct classes; found 1."


def test_missing_target_is_null_only(spark, contract):
    assert finding(report(spark, contract, changed(target=None)), "missing_target")["severity"] == "error"
    rep = report(spark, contract, changed(target=" "))
    assert [i["check"] for i in rep["issues"]] == ["target_labels"]


def test_order_of_findings(spark, contract):
    data = rows(10)
    data[1]["id"] = data[0]["id"]
    data[2].update(depth="x", soil=None, target="?")
    data[3].update(flow="", target=None)
    rep = report(spark, contract, data)
    assert [i["check"] for i in rep["issues"]] == [
        "minimum_row_count", "duplicate_ids", "missing_values", "missing_values", "missing_target", "dtype_numeric", "target_labels",
    ]


def test_report_json_round_trip(spark, contract):
    doc = json.loads(quality.report_json(frame(spark, changed(depth="x")), contract).head()[0])
    assert doc["n_rows"] == 60 and not doc["is_valid"] and doc["issues"][0]["check"] == "dtype_numeric"


def test_profile_of_many_datasets_in_one_job(spark, contract):
    good = frame(spark, rows()).withColumn("path", F.lit("good"))
    bad = frame(spark, [{**r, "target": "Yes"} for r in rows()]).withColumn("path", F.lit("bad"))
    both = good.unionByName(bad)
    found = quality.issues(both, contract, by=["path"]).select("path", "check").collect()
    assert [tuple(r) for r in found] == [("bad", "target_labels")]


def test_duplicate_flags_keep_the_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, k string")
    out = quality.duplicate_flags(df, ["k"], ["id"]).orderBy("id").collect()
    assert [r["is_duplicate"] for r in out] == [False, True, False, True, False]


def test_row_violations(spark, contract):
    df = frame(spark, [{"depth": "1.5", "soil": "p"}, {"depth": "-1", "flow": "x", "soil": None}, {"depth": "3", "soil": "p", "flow": "2"}])
    checked = quality.row_violations(df, contract, integers=["depth"], optional=["flow"])
    out = [r["violations"] for r in checked.collect()]
    assert out == [["depth: not an integer"], ["depth: negative", "flow: not a number", "soil: required"], []]
    accepted, rejected = quality.split_by_violations(checked)
    assert (accepted.count(), rejected.count()) == (1, 2)


def test_row_violations_parse_a_text_once(spark, contract):
    """A filter on the violations must not repeat the parsing for each check that needs the value."""
    df = frame(spark, [{"depth": "  2 ", "soil": "p", "flow": " "}, {"depth": "1f", "soil": "p"}, {"depth": None, "soil": "p", "flow": "-0x1"}, {"depth": "-inf", "soil": "p"}])
    checked = quality.row_violations(df, contract, integers=["depth"], optional=["flow"])
    assert checked.columns == [*df.columns, "violations"]
    accepted, rejected = quality.split_by_violations(checked)
    for part in (accepted, rejected):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("trim(") == len(contract.numeric_columns)
    assert {r["depth"]: r["violations"] for r in rejected.collect()} == {
        None: ["depth: required", "flow: not a number"], "  2 ": ["flow: not a number"], "-inf": ["depth: negative"], "1f": ["depth: not a number"],
    }
