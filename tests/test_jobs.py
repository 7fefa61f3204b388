import pytest
from pyspark.sql import functions as F

from revlake.functions.organizations import NATIONAL
from revlake.operators import incremental, profile
from revlake.plans import jobs, samples
from revlake.plans.fixtures import Inputs, TODAY
from revlake.streaming import revisions as streams

FOLDER = "/root/testdata/sf0.001"


def test_import_laws_accounts_for_every_revision(spark):
    t = Inputs(spark, FOLDER)
    out = jobs.import_laws(samples.law_xml(t), t.view("history"), t.view("allowlist"), TODAY)
    docs, failures = out["documents"], out["failures"]
    assert docs.count() + failures.count() == t.view("revisions").count()
    assert docs.select("rev_id").distinct().count() == docs.count()


def test_import_rules_and_ordinances(spark):
    t = Inputs(spark, FOLDER)
    rules = jobs.import_rules(samples.rule_xml(t), NATIONAL)
    assert rules["documents"].select("path").distinct().count() > 1
    assert rules["log"].filter("action = 'write'").count() > 0
    ordinances = jobs.import_ordinances(samples.ordinance_xml(t))
    total = ordinances["documents"].count() + ordinances["quarantined"].count()
    assert total == t.view("revisions").count()


def test_duplicate_ids_fail_the_index(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "c", "z")], "rev_id int, path string, title string")
    with pytest.raises(Exception, match="duplicate rev_id 1 across a and b"):
        jobs.build_index(docs, ["title"]).collect()
    assert jobs.build_index(docs.filter("path <> 'b'"), ["title"]).count() == 2
    assert profile.duplicate_keys(docs).count() == 1


def test_stream_keeps_newest_whatever_the_arrival_order(spark, tmp_path):
    schema = "lineage_id string, rev_id int, title string, kind string, prom_date string, prom_num string"
    rows = [("A", 1, "t", "법률", "20200101", "1"), ("B", 2, "t", "법률", "20200101", "1"), ("A", 3, "t", "법률", "20190101", "1"), ("B", 4, "t", "법률", "20210101", "1")]
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for i, part in enumerate((rows[:2], rows[2:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streams.stream_revisions(stream, target, mark).awaitTermination()
    got = {r["lineage_id"]: r["rev_id"] for r in streams.read_current(spark, target).collect()}
    assert got == {"A": 1, "B": 4}
    streams.compact(spark, target, str(tmp_path / "compact"))
    assert streams.read_current(spark, str(tmp_path / "compact")).count() == 2


def test_late_history_does_not_replace_newer(spark):
    schema = "lineage_id string, rev_id int, title string, kind string, prom_date string, prom_num string"
    now = spark.createDataFrame([("A", 5, "t", "k", "20200101", "1")], schema)
    late = spark.createDataFrame([("A", 1, "t", "k", "20100101", "1"), ("B", 2, "t", "k", "20100101", "1")], schema)
    assert {r["lineage_id"]: r["rev_id"] for r in incremental.guarded_upsert(now, late).collect()} == {"A": 5, "B": 2}
    assert incremental.lookback("2020-01-20", "2020-01-31", 14).start == "20200117"
    assert incremental.lookback("2019-12-01", "2020-01-31", 14).start == "20191201"
    with pytest.raises(ValueError):
        incremental.id_window_probe(now, "rev_id", -1, 0)
    assert incremental.id_window_probe(now, "rev_id", 10, 2).count() == 7
    assert incremental.id_window_probe(now, "rev_id", 0, 0).count() == 0


def test_plans_have_no_cartesian_product_and_prune(spark):
    t = Inputs(spark, FOLDER)
    from revlake.operators import versioning

    plan = versioning.assign_law_paths(t.view("revisions")).select("rev_id", "path")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "o_totalprice" not in plan.split("== Optimized Logical Plan ==")[1].split("FileScan")[1].split("ReadSchema")[-1]


def test_blank_lineages_stay_apart_and_late_failures_count(spark, tmp_path):
    import datetime as dt

    schema = "lineage_id string, rev_id int, title string, kind string, prom_date string, prom_num string"
    rows = spark.createDataFrame([("", i, "t", "k", "20200101", "1") for i in range(5)] + [("A", 9, "t", "k", "20200101", "1")], schema)
    assert incremental.guarded_upsert(rows.limit(0), rows).count() == 6
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    rows.coalesce(1).write.parquet(source)
    streams.stream_revisions(spark.readStream.schema(schema).parquet(source), target, mark).awaitTermination()
    assert streams.read_current(spark, target).count() == 6

    source, target, mark = (str(tmp_path / x) for x in ("failures", "counts", "mark2"))
    late = [dt.datetime(2024, 1, 10) - dt.timedelta(hours=48 * i) for i in range(4)]
    for i, at in enumerate(late):
        spark.createDataFrame([("e", at)] * (i + 1), "reason string, failed_at timestamp").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("reason string, failed_at timestamp").parquet(source)
        streams.stream_failure_counts(stream, target, mark).awaitTermination()
    assert {r["day"]: r["n"] for r in streams.read_failure_counts(spark, target).collect()} == {f"{at:%Y-%m-%d}": i + 1 for i, at in enumerate(late)}


def test_increment_plan_is_small(spark):
    from revlake.plans import catalog

    catalog.load_all()
    plan = catalog.QUERIES["incremental_apply"](spark, FOLDER)._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan and plan.count("FileScan") + plan.count("Scan ") < 10
    plan = catalog.QUERIES["failure_delta_gate"](spark, FOLDER)._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan


def test_index_import_preflight_and_cleanup(spark, tmp_path):
    path = tmp_path / "index.csv"
    path.write_text('총1건\n순번,법령MST,' + ",".join("abcdefghijk") + '\n1,11,x,부처,L1,가나 시행령,20200101,1,20200102,c,대통령령,f,분야\n', encoding="utf-8")
    row = jobs.import_index(spark, str(path)).first()
    assert row["path"] == "kr/가나/시행령.md" and "법령분야: 분야" in row["content"] and "법령구분코드: c" in row["content"]
    assert jobs.import_index(spark, str(path), dry_run=True).columns == ["rev_id", "path"]
    t = Inputs(spark, FOLDER)
    out = jobs.preflight_names(t.view("cases"))
    assert out["report"].count() == 1 and out["samples"].count() <= 10 and out["profile"].count() > 0
    kept, gone = jobs.cleanup_no_result(samples.case_xml(t))
    assert kept.count() + gone.count() <= t.view("cases").count() and gone.count() > 0
    jobs.dump_oracle(t.view("cases"), str(tmp_path / "oracle"))
    assert spark.read.json(str(tmp_path / "oracle")).count() == t.view("cases").count()


def test_case_update_probes_ids_around_the_newest(spark):
    t = Inputs(spark, FOLDER)
    raw = samples.case_xml(t)
    newest = t.view("cases").agg(F.max("event_id")).first()[0]
    committed = t.view("cases").filter(f"event_id <= {newest - 20}").select("serial")
    none = spark.createDataFrame([(str(newest - 5),)], "serial string")
    out = jobs.update_cases(committed, raw, none, overlap=10, horizon=25)
    probed = {str(i) for i in range(newest - 19, newest + 6)} - {str(newest - 5)}
    got = {r["serial"] for r in out["documents"].collect()}
    gone = {r["serial"] for r in out["missing"].collect()}
    assert got <= probed and gone == {str(i) for i in range(newest + 1, newest + 6)} and sum(r["n"] for r in out["classes"].collect()) == len(probed - gone)


def test_imports_resume_and_take_orphans_only(spark):
    t = Inputs(spark, FOLDER)
    raw = samples.rule_xml(t).withColumn("serial", F.col("rev_id").cast("string"))
    every = raw.count()
    done, failed = raw.filter("rev_id % 3 = 0").select("serial"), raw.filter("rev_id % 3 = 1").select("serial")
    job = lambda rows: jobs.import_rules(rows.drop("serial"), NATIONAL)
    out = jobs.import_corpus(raw, job, done=[done, failed])["documents"]
    assert 0 < out.count() == raw.filter("rev_id % 3 = 2").count() < every
    few = jobs.import_corpus(raw, job, done=[done], orphans=failed, limit=7)["documents"]
    assert few.count() == 7 and few.filter("rev_id % 3 <> 1").count() == 0
    cases = samples.case_xml(t)
    assert jobs.import_corpus(cases, lambda rows: jobs.import_cases(rows.select("xml")), ids=cases.select("serial").limit(5))["documents"].count() <= 5


def test_image_jobs(spark):
    schema = "path string, id string, status string, sha256 string, converted_text string, line int"
    rows = [("kr/a/x.md", "1", "downloaded", "d1", None, 1), ("kr/b/x.md", "2", "downloaded", "d2", "t\tu", 2), ("kr/a/y.md", "3", "extracted", None, None, 3)]
    manifest = spark.createDataFrame(rows, schema)
    assert {r["value"]: r["n"] for r in jobs.image_stats(manifest).collect()} == {"": 3, "downloaded": 2, "extracted": 1}
    assert [r["line"] for r in jobs.image_report(manifest, "downloaded", "kr/b/*").collect()] == ["kr/b/x.md\t2\tdownloaded\td2\tt u"]
    approved = jobs.approve_images(manifest, glob="kr/a/*")
    assert {r["id"]: r["status"] for r in approved.collect()} == {"1": "approved", "2": "downloaded", "3": "extracted"}
    with pytest.raises(ValueError):
        jobs.approve_images(manifest)
    cached = spark.createDataFrame([("1", "k1", "d1"), ("2", "k2", "d2")], "id string, key string, sha256 string")
    remote = spark.createDataFrame([("k1", "other")], "key string, sha256 string")
    plan = lambda **kw: {r["key"]: r["status"] for r in jobs.plan_image_upload(cached, remote, approved, **kw)["plan"].collect()}
    assert plan() == {"k1": "skipped", "k2": "would-upload"} and plan(only_approved=True, compare_digest=True) == {"k1": "would-upload"}


def test_counters_come_from_the_writing_pass(spark):
    """Counters of an increment are observed while it is written: they are there without another job."""
    schema = "rev_id int, title string, prom_date string, amendment string"
    listing = spark.createDataFrame([(1, "a", "20200101", "x"), (2, "a", "20200102", "x"), (3, "b", "20200103", "x")], schema)
    details = spark.createDataFrame([(1, "L", "a", "k", "20200101", "1", "x", "valid"), (2, "L", "a", "k", "20200102", "1", "x", "malformed")],
                                    "rev_id int, lineage_id string, title string, kind string, prom_date string, prom_num string, amendment string, detail_status string")
    current = details.select("lineage_id", "rev_id", "title", "kind", "prom_date", "prom_num").limit(0)
    out = incremental.incremental_apply(listing, listing.limit(0), details, listing.select("rev_id").limit(0), current, None, "20200110", 30)
    assert out["counters"].first().asDict() == {"found": 3, "committed": 1, "no_result": 1, "errors": 1}
    assert "Scan" not in out["counters"]._jdf.queryExecution().optimizedPlan().toString()


def test_import_parses_responses_once(spark):
    t = Inputs(spark, FOLDER)
    out = jobs.import_laws(samples.law_xml(t), t.view("history"), t.view("allowlist"), TODAY)
    for frame in out.values():
        assert "from_xml" not in frame._jdf.queryExecution().optimizedPlan().toString()
