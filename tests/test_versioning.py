"""Parallel versioning against plain sequential loops on small, skewed fixtures."""
import random
import re

import pytest
from pyspark.sql import functions as F

from revlake import session
from revlake.operators import ordering, profile, refs, versioning
from revlake.plans import catalog


def greedy_rules(rows):
    owner, out = {}, {}
    for r in sorted(rows, key=lambda r: r["serial"]):
        base = f"{r['dir']}/{r['name']}"
        first = r["issue"] or r["serial"]
        candidates = [base, f"{base}_{first}", f"{base}_{r['serial']}", f"{base}_{r['issue']}_{r['serial']}"]
        step = 2
        while True:
            path = candidates.pop(0) if candidates else f"{base}_{r['serial']}_{step}"
            if not path.endswith(f"_{step}") or candidates:
                pass
            if owner.get(path, r["identity"]) == r["identity"]:
                owner[path] = r["identity"]
                out[r["serial"]] = path + "/본문.md"
                break
            if not candidates and path == f"{base}_{r['serial']}_{step}":
                step += 1
    return out


def test_rule_paths_equal_the_sequential_claims(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        # One directory holds most revisions; names collide with other revisions' suffixes.
        rows.append({
            "serial": str(i), "identity": f"i{rng.randint(0, 60)}", "dir": "hot" if rng.random() < 0.7 else f"d{rng.randint(0, 9)}",
            "name": rng.choice(["n", "n_1", "n_2", f"n_{rng.randint(0, 400)}", "m"]), "issue": rng.choice(["", "1", "2", "3"])})
    df = spark.createDataFrame(rows)
    got = {r["serial"]: r["path"] for r in versioning.assign_rule_paths(df).collect()}
    assert got == greedy_rules(rows)


def test_ordinance_paths_use_number_and_identity(spark):
    """Four-way clashes; suffixes with separators stay inside the directory."""
    rng = random.Random(4)
    rows = [{"serial": str(i), "identity": f"C{rng.randint(0, 40)}", "dir": "d", "name": rng.choice(["n", "m"]), "issue": rng.choice(["", "1/2", "3"])} for i in range(200)]
    owner, want = {}, {}
    part = lambda v: {"": "_", "1/2": "1 2"}.get(v, v)
    for r in sorted(rows, key=lambda r: r["serial"]):
        base, number, ident = f"d/{r['name']}", part(r["issue"]), r["identity"]
        tails = ["", f"_{number}", f"_{ident}", f"_{number}_{ident}", *(f"_{ident}_{i}" for i in range(2, 99))]
        path = next(base + t for t in tails if owner.get(base + t, ident) == ident)
        owner[path] = ident
        want[r["serial"]] = path + "/본문.md"
    got = {r["serial"]: r["path"] for r in versioning.assign_rule_paths(spark.createDataFrame(rows), "ordinance").collect()}
    assert got == want
    slashed = spark.createDataFrame([("1", "a", "d", "n", ""), ("2", "b", "d", "n", "1/2")], "serial string, identity string, dir string, name string, issue string")
    assert all(r["path"].count("/") == 2 for r in versioning.assign_rule_paths(slashed).collect())


def test_rule_paths_meet_across_directories_and_rounds_sort_no_rows(spark, monkeypatch):
    """A name may hold a separator; groups of a path are aggregated by hash."""
    seen = []
    for name in ("checkpointed", "materialized"):
        step = getattr(session, name)
        monkeypatch.setattr(versioning, name, lambda df, step=step: seen.append(df) or step(df), raising=False)
    rows = [("1", "A", "org", "a/b_1", ""), ("2", "B", "org/a", "b", "1"), ("3", "C", "org/a", "b", "1"), ("3", "C", "org/a", "b", "1"),
            ("4", None, "org", "c", None), ("5", "D", "org", "c", None), (None, "E", "org", "c", "2")]
    frame = spark.createDataFrame(rows, "serial string, identity string, dir string, name string, issue string")
    got = [(r["serial"], r["path"].removesuffix("/본문.md")) for r in versioning.assign_rule_paths(frame).collect()]
    assert sorted(got, key=str) == [
        ("1", "org/a/b_1"), ("2", "org/a/b"), ("3", "org/a/b_3"), ("3", "org/a/b_3"), ("4", "org/c"), ("5", "org/c_5"), (None, "org/c_2")]
    assert seen and not any("SortAggregate" in df._jdf.queryExecution().executedPlan().toString() for df in seen)


def test_case_paths_equal_the_sequential_claims(spark):
    rng = random.Random(5)
    rows = [{"serial": str(i), "folder": "f", "stem": rng.choice(["a", "b", f"a_{rng.randint(0, 300)}", f"a_{rng.randint(0, 300)}_{rng.randint(0, 300)}"])} for i in range(300)]
    taken, want = {}, {}
    for r in sorted(rows, key=lambda r: r["serial"]):
        path = f"f/{r['stem']}.md"
        if taken.get(path, r["serial"]) != r["serial"]:
            path = f"f/{r['stem']}_{r['serial']}.md"
        taken[path] = r["serial"]
        want[r["serial"]] = path
    got = {r["serial"]: r["path"] for r in versioning.assign_case_paths(spark.createDataFrame(rows)).collect()}
    assert got == want


def test_change_log_equals_the_fold(spark):
    rng = random.Random(9)
    rows = []
    for i in range(500):
        rows.append({
            "rev_id": i, "serial": str(i), "identity": "hot" if rng.random() < 0.5 else f"i{rng.randint(0, 40)}",
            "issue_date": f"20{rng.randint(0, 20):02d}0101", "path": f"p{rng.randint(0, 5)}",
            "amendment": rng.choice(["폐지", "일부개정", "제정"]), "current_flag": rng.choice(["Y", "N"])})
    published = [{"identity": "hot", "path": "old"}, {"identity": "i3", "path": "p1"}]
    live, want = {p["identity"]: p["path"] for p in published}, set()
    ordered = sorted(rows, key=lambda r: (r["issue_date"], int(r["serial"]), r["path"]))
    last = {r["identity"]: r for r in ordered}
    for r in ordered:
        before = live.get(r["identity"])
        if r["amendment"] == "폐지":
            want.add((r["rev_id"], "delete" if before else "none", None, before))
            live.pop(r["identity"], None)
            continue
        moved = before is not None and before != r["path"]
        want.add((r["rev_id"], "move" if moved else "write", r["path"], before if moved else None))
        live[r["identity"]] = r["path"]
        if last[r["identity"]] is r and r["current_flag"] == "N":
            want.add((r["rev_id"], "delete_after_write", None, r["path"]))
    log = versioning.revision_change_log(spark.createDataFrame(rows), spark.createDataFrame(published))
    assert {(r["rev_id"], r["action"], r["path"], r["removed_path"]) for r in log.collect()} == want


def test_positions_and_previous_survive_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pos = ordering.with_position(df, [F.col("k"), F.col("v")]).collect()
        prev = ordering.with_previous(df, ["k"], [F.col("v")], F.col("v"), "p", last="end").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [(r["k"], r["v"]) for r in sorted(pos, key=lambda r: r["pos"])] == sorted(rows)
    assert sorted(r["pos"] for r in pos) == list(range(1, 2001))
    want, last = {}, {}
    for k, v in sorted(rows):
        want[(k, v)] = last.get(k)
        last[k] = v
    assert {(r["k"], r["v"]): r["p"] for r in prev} == want
    assert {(r["k"], r["v"]) for r in prev if r["end"]} == set(last.items()) and len(prev) == len(rows)


@pytest.mark.parametrize("name", ["sort_serials", "revision_change_log", "history_vs_commits"])
def test_sorts_compare_columns_and_no_expressions(spark, monkeypatch, name):
    seen = []
    step = ordering.checkpointed
    monkeypatch.setattr(ordering, "checkpointed", lambda df: seen.append(df) or step(df))
    catalog.load_all()
    catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    (keys,) = re.findall(r"(?m)^[^\n\w]*Sort \[(.*)\], false", plan)
    assert all(re.fullmatch(r"\w+#\d+L? (ASC|DESC) NULLS (FIRST|LAST)", key) for key in keys.split(", ")), keys


def test_shards_are_few_files_and_pages_are_written_by_many_tasks(spark, tmp_path):
    rows = [(i % 500 * 2, "d", i, "extracted", "", f"law {i % 3}") for i in range(20_000)]
    frame = spark.createDataFrame(rows, "id long, doc string, line int, status string, sha256 string, law string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        refs.write_shards(refs.export_shards(frame, shards=2, size=10), str(tmp_path))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        pages = refs.export_shards(frame, shards=2, size=10)
        refs.write_shards(pages, str(tmp_path / "adaptive"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert 1 < len(list(tmp_path.glob("detail/shard=0/*.json"))) <= 8
    assert len(list(tmp_path.glob("adaptive/list/page=*"))) == 50
    assert len({f.name.split("-")[1] for f in tmp_path.glob("adaptive/list/page=*/*.json")}) > 4
    assert spark.read.schema("id long, pos long, page int").json(str(tmp_path / "adaptive/list")).count() == 500
    assert spark.read.schema("id long, shard int").json(str(tmp_path / "detail")).count() == 20_000


def test_shards_are_dealt_once_and_compressed(spark, tmp_path):
    rows = [(i % 50, "d" + str(i % 7), i, "error" if i % 9 == 4 else f"s{i % 4}", str(i), f"law {i % 3}") for i in range(2_000)]
    frame = spark.createDataFrame(rows, "id long, doc string, line int, status string, sha256 string, law string")
    tables = refs.export_shards(frame, statuses=("s0", "s1", "s2", "s3"), shards=3, size=10)
    assert tables["detail"]._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    plain = profile.collect_references(frame.filter("status <> 'error'")).withColumn("shard", (F.col("id") % 3).cast("int"))
    assert tables["detail"].columns == plain.columns
    assert sorted(map(tuple, tables["detail"].collect())) == sorted(map(tuple, plain.collect()))
    refs.write_shards(tables, str(tmp_path), compression="gzip")
    assert 1 <= len(list(tmp_path.glob("detail/shard=0/*.json.gz"))) <= 8 and not list(tmp_path.glob("detail/shard=0/*.json"))
    back = spark.read.schema(plain.schema).json(str(tmp_path / "detail"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, plain.collect()))
    assert tables["summary"].first()["total"] == 50


def test_law_paths_sticky_and_latest(spark):
    rows = [
        (1, "A", "갑법", "법률", "20000101", "1"), (2, "B", "갑법", "법률", "20010101", "1"), (3, "A", "을법", "법률", "20020101", "1"),
        (4, "C", "갑법", "법률", "20030101", "1"), (5, "", "병법", "법률", "20030101", "2"), (6, "", "병법", "법률", "20040101", "2")]
    df = spark.createDataFrame(rows, "rev_id int, lineage_id string, title string, kind string, prom_date string, prom_num string")
    latest = {r["rev_id"]: (r["path"], r["shared_path"]) for r in versioning.assign_law_paths(df).collect()}
    assert latest[1] == latest[3] == ("kr/을법/법률.md", False)
    assert latest[2] == ("kr/갑법/법률.md", False) and latest[4] == ("kr/갑법/법률(법률).md", False)
    assert latest[5] == latest[6] == ("kr/병법/법률.md", False)
    sticky = {r["rev_id"]: (r["path"], r["shared_path"]) for r in versioning.assign_law_paths_streaming(df).collect()}
    assert sticky[1] == sticky[3] == ("kr/갑법/법률.md", False)
    assert sticky[2] == sticky[4] == ("kr/갑법/법률(법률).md", True)
