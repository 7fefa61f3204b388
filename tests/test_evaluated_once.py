"""Expensive expressions and rows that an operator reads several times."""
from pyspark.sql import functions as F

from revlake.operators import hierarchy, profile, versioning


def test_stems_of_cases_are_evaluated_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    @F.udf("string")
    def stem(name):
        with open(log, "a") as file:
            file.write("x")
        return name

    rows = [("1", "a"), ("2", "a"), ("3", "a_2"), ("0", "b")]
    cases = spark.createDataFrame(rows, "serial string, name string").select("serial", F.lit("f").alias("folder"), stem("name").alias("stem"))
    got = {r["serial"]: r["path"] for r in versioning.assign_case_paths(cases).collect()}
    assert got == {"1": "f/a.md", "2": "f/a_2.md", "3": "f/a_2_3.md", "0": "f/b.md"}
    with open(log) as file:
        assert len(file.read()) == len(rows)


def test_case_keys_are_evaluated_in_one_pass_of_the_profile(spark):
    cases = spark.createDataFrame(
        [("1", "대법원", "400201", "20200101", "2001다1", "민사")],
        "serial string, court string, court_code string, date string, case_no string, case_type string")
    plan = profile.case_quality_profile(cases)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 2  # the keys and the rows of the result


def test_rows_meet_paths_of_organizations_once_at_the_end(spark):
    parents = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "child string, parent string")
    rows = [(1, "a", "c"), (2, "b", "c"), (3, "b", "new"), (4, "b", ""), (5, None, "c"), (6, "x", None), (7, "", "")]
    placed = hierarchy.organization_paths(spark.createDataFrame(rows, "id int, top string, agency string"), parents)
    got = {r["id"]: (r["path"], r["path_status"]) for r in placed.collect()}
    assert got == {
        1: (["a", "b", "c"], "ok"), 2: (["a", "b"] + ["c"], "ok"), 3: (["a", "b", "new"], "ok"), 4: (["a", "b"], "ok"),
        5: ([], "ok"), 6: (["y", "x"], "cycle"), 7: ([], "ok")}
    plan = placed._jdf.queryExecution().sparkPlan().toString()
    assert len([line for line in plan.splitlines() if "FileScan" in line and "path#" in line.split("]")[0]]) == 1


def test_days_and_rows_of_a_change_log_are_evaluated_once(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "calls")

    @F.udf("string")
    def day(text):
        with open(log, "a") as file:
            file.write("x")
        return "" if text == "none" else text

    monkeypatch.setattr(versioning, "format_date_checked", day)
    rows = [("1", "a", "2020-01-02", "p1", "제정"), ("2", "a", "none", "p0", "제정"), ("3", "b", "2020-01-01", "q", "폐지")]
    frame = spark.createDataFrame(rows, "serial string, identity string, issue_date string, path string, amendment string")
    frame = frame.select("*", F.col("serial").alias("rev_id"), F.lit("Y").alias("current_flag"))
    got = {(r["rev_id"], r["action"], r["removed_path"], r["date"]) for r in versioning.revision_change_log(frame).collect()}
    assert got == {("2", "write", None, "2000-01-01"), ("1", "move", "p0", "2020-01-02"), ("3", "none", None, "2020-01-01")}
    with open(log) as file:
        assert len(file.read()) == len(rows)
