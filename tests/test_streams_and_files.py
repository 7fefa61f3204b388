"""Leveled stream tables, the growing log, file sinks, inventories of large files, and XML at any depth."""
import collections
import datetime as dt
import hashlib
import os
import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from revlake.operators import incremental
from revlake.plans import catalog, queries_increments
from revlake.sources import documents, file_sink, log_stream, records, xml_details, xml_elements
from revlake.streaming import leveled
from revlake.streaming import revisions as streams

REVISION = "lineage_id string, rev_id int, title string, kind string, prom_date string, prom_num string"


# -- leveled tables ------------------------------------------------------------------------------------------------

def test_live_folders_cover_all_batches_in_logarithmic_number():
    for fan_in in (2, 3, 8):
        before = []
        for n in range(1, 700):
            now = leveled.live(n, fan_in)
            assert [a for a, _ in now] == [0, *(b for _, b in now[:-1])] and now[-1][1] == n
            # The new folder merges whole folders of the batch before, or is the batch alone.
            assert set(now[:-1]) <= set(before) and {p for p in before if p[0] >= now[-1][0]} == set(before) - set(now[:-1])
            before = now
    assert all(len(leveled.live(n)) <= 7 * 7 for n in (10**6, 8**6 - 1, 123_457))


def test_leveled_table_equals_the_upsert_and_survives_replays(spark, tmp_path):
    rng, target, total = random.Random(4), str(tmp_path / "t"), []
    combine = streams._newest("lineage_id")
    for batch in range(21):
        rows = [(rng.choice(["A", "B", "C", ""]), batch * 10 + i, "t", "법률", f"20{rng.randint(10, 20)}0101", "1") for i in range(3)]
        total += rows
        for _ in range(2 if batch % 4 == 3 else 1):  # a batch that is applied twice
            leveled.append(target, batch, spark.createDataFrame(rows, REVISION).coalesce(1), combine, fan_in=2)
    n, folders = leveled.manifest(spark, target)
    assert n == 21 and folders == ["0-16", "16-20", "20-21"]
    there = set(os.listdir(tmp_path / "t" / "data"))
    assert set(folders) <= there and len(there) <= len(folders) + len(leveled.live(20, 2))
    got = {tuple(r) for r in streams.read_current(spark, target).collect()}
    rows = spark.createDataFrame(total, REVISION)
    assert got == {tuple(r) for r in incremental.guarded_upsert(rows.limit(0), rows).collect()}
    streams.compact(spark, target, str(tmp_path / "c"))
    leveled.append(str(tmp_path / "c"), 0, spark.createDataFrame([("A", 999, "t", "법률", "20300101", "1")], REVISION), combine)
    after = {tuple(r) for r in streams.read_current(spark, str(tmp_path / "c")).collect()}
    assert len(after) == len(got) and ("A", 999, "t", "법률", "20300101", "1") in after and after - got == {("A", 999, "t", "법률", "20300101", "1")}


def test_late_failures_leave_the_state_but_count(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema, want = "reason string, failed_at timestamp", collections.Counter()
    days = [dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 20, 12), dt.datetime(2024, 1, 19, 23), dt.datetime(2024, 1, 5, 1), dt.datetime(2024, 1, 10, 13)]
    for at in days:
        for reason in ("e", None):
            spark.createDataFrame([(reason, at)] * 2, schema).coalesce(1).write.mode("append").parquet(source)
            want[f"{at:%Y-%m-%d}", reason] += 2
        streams.stream_failure_counts(spark.readStream.schema(schema).parquet(source), target, mark, fan_in=2).awaitTermination()
    query = streams.stream_failure_counts(spark.readStream.schema(schema).parquet(source), target, mark, fan_in=2)
    query.awaitTermination()
    got = streams.read_failure_counts(spark, target).collect()
    assert {(r["day"], r["reason"]): r["n"] for r in got} == dict(want)
    late = {r["day"]: r["late"] for r in got if r["reason"] == "e"}
    assert late["2024-01-05"] == 2 and late["2024-01-20"] == 0 and late["2024-01-19"] == 0 and late["2024-01-10"] == 2


# -- growing log ---------------------------------------------------------------------------------------------------

def _log(n, rng):
    names = ["민법", "상법 시행령", "é law"]
    return [f"h{i}\x002020-01-{i % 28 + 1:02d}T00:00:00\x00법률: {rng.choice(names)} (제정)\n\n공포일자: 2020-01-02\n공포번호: {i}\n소관부처: 부\n법령MST: {i % (n // 2)}"
            for i in range(n)]


def test_log_appended_in_pieces_equals_one_read(spark, tmp_path):
    rng = random.Random(8)
    data = "\x1e\n".join(_log(60, rng)).encode() + b"\x1e"
    path, target, mark = tmp_path / "log.txt", str(tmp_path / "out"), str(tmp_path / "mark")
    cuts = sorted({0, len(data), *(rng.randrange(len(data)) for _ in range(5))})  # within records and within characters
    for a, b in zip(cuts, cuts[1:], strict=False):
        with open(path, "ab") as f:
            f.write(data[a:b])
        streams.stream_commit_log(spark, str(path), target, mark).awaitTermination()
    got = {tuple(r) for r in streams.read_streamed_log(spark, target).select("rev_id", "hash", "name", "prom_num").collect()}
    whole = records.read_commit_log(spark, str(path)).select("rev_id", "hash", "name", "prom_num")
    assert got == {tuple(r) for r in whole.collect()} and len(got) == 30
    assert {h for _, h, _, _ in got} == {f"h{i}" for i in range(30)}


def test_log_ranges_give_every_record_once(tmp_path):
    rng = random.Random(9)
    found = ["x" * rng.choice([0, 1, 3, 40]) + "é" * rng.randint(0, 2) for _ in range(200)]
    for separator in ("\x1e", "<>"):
        file = tmp_path / f"log{len(separator)}"
        file.write_bytes((separator.join(found) + separator + "unfinished").encode())
        for size in (1, 2, 7, 64, 10_000):
            reader = log_stream.LogReader(str(file), separator, size)
            parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
            rows = [r for p in parts for r in reader.read(p)]
            assert [r[2] for r in rows] == found and len({r[1] for r in rows}) == 200
    assert log_stream.LogReader(str(tmp_path / "none"), "\x1e", 5).latestOffset() == {"files": "{}"}


# -- file sinks and inventories ------------------------------------------------------------------------------------

def test_file_sink_is_atomic_and_retries(spark, tmp_path):
    target, flag = str(tmp_path / "out"), tmp_path / "failed"
    docs = [(f"a/{i}.md", f"가{i}" * 50) for i in range(40)]

    def fail_once(batches):
        for batch in batches:
            yield batch
        if not flag.exists():
            flag.write_text("x")
            raise RuntimeError("lost")

    rows = spark.createDataFrame(docs, "path string, content string").coalesce(1)
    # Without retries in local mode the first job fails as a whole: nothing of it is in place.
    with pytest.raises(Exception, match="lost"):
        file_sink.write_files(rows.mapInArrow(fail_once, rows.schema), target, "path", "content")
    assert not list((tmp_path / "out").rglob("*.md")) and not list((tmp_path / "out").rglob("*/[0-9]*"))
    file_sink.write_files(rows.mapInArrow(fail_once, rows.schema), target, "path", "content")
    assert {(str(p.relative_to(target)), p.read_text()) for p in (tmp_path / "out").rglob("*.md")} == set(docs)
    assert (tmp_path / "out" / file_sink.DONE).read_text().startswith('{"files": 40') and not (tmp_path / "out" / file_sink.STAGING / "x").exists()
    file_sink.write_files(spark.createDataFrame([("a/1.md", "new"), ("b/empty.md", None)], "path string, content string"), target, "path", "content")
    assert (tmp_path / "out/a/1.md").read_text() == "new" and (tmp_path / "out/b/empty.md").read_text() == "" and (tmp_path / "out/a/2.md").exists()


def test_file_sink_paths_are_checked_by_components(spark, tmp_path):
    assert file_sink.is_below("file:///shared/x", "/shared") and file_sink.is_below("/shared", "file:/shared/")
    assert not file_sink.is_below("/shared2/x", "/shared") and not file_sink.is_below("/shared/../x", "/shared")
    for bad in ("../x", "/etc/x", "a/../../x", "", ".staging/x", "_COMMITTED"):
        with pytest.raises(ValueError):
            file_sink.safe_relative(bad)
    assert file_sink.safe_relative("a/..b/c.md") == "a/..b/c.md"
    with pytest.raises(Exception, match="not a path below"):
        documents.export_files(spark.createDataFrame([("../x", "y")], "path string, content string"), str(tmp_path / "o"))


def test_batches_of_failures_do_not_grow_with_the_tasks_that_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries_increments, "scratch", lambda _, label: str(tmp_path / "run" / label))
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    catalog.load_all()
    rows = catalog.QUERIES["stream_failure_counts"](spark, str(tmp_path)).collect()
    assert sum(r["n"] for r in rows) == spark.read.parquet(str(tmp_path / "events.parquet")).filter("event_type = 'error'").count()
    assert len([f for f in (tmp_path / "run" / "mark" / "commits").iterdir() if f.name.isdigit()]) <= 7


def test_inventory_reads_large_files_in_chunks(spark, tmp_path):
    (tmp_path / "in" / "b c").mkdir(parents=True)
    (tmp_path / "in" / "b c" / "s%20.txt").write_bytes(b"small")
    (tmp_path / "in" / "a.txt").write_bytes(b"")
    size = 3 << 30
    with open(tmp_path / "in" / "huge.bin", "wb") as f:  # a sparse file beyond what a row can hold
        f.seek(size)
        f.write(b"end")
    digest, zeros = hashlib.sha256(), bytes(64 << 20)
    for _ in range(size >> 26):
        digest.update(zeros)
    digest.update(b"end")
    rows = documents.file_inventory(spark, str(tmp_path / "in"))
    got = {r["path"]: (r["bucket"], r["bytes"], r["sha256"]) for r in rows.collect()}
    assert got == {
        "huge.bin": ("huge.bin", size + 3, digest.hexdigest()),
        "b c/s%20.txt": ("b c", 5, hashlib.sha256(b"small").hexdigest())}
    chunked = documents.file_inventory(spark, str(tmp_path / "in" / "b c"), row_bytes=0)
    assert [tuple(r) for r in chunked.collect()] == [("s%20.txt", "s%20.txt", 5, hashlib.sha256(b"small").hexdigest())]


# -- XML at any depth ----------------------------------------------------------------------------------------------

def _plain(xml):
    """Articles by the standard library's tree."""
    def fields(node, names):
        return {n: node.findtext(tag, "") or "" for n, tag in names.items()}

    return [fields(jo, xml_details.ARTICLE) | {"paragraphs": [
        fields(h, xml_details.PARAGRAPH) | {"subparas": [
            fields(s, xml_details.SUBPARA) | {"items": [fields(m, xml_details.ITEM) for m in s.findall(".//목")]} for s in h.findall(".//호")]}
        for h in jo.findall(".//항")]} for jo in ET.fromstring(xml).findall(".//조문단위")]


def _random_law(rng):
    def node(depth):
        tag = rng.choice(["항", "호", "목", "w", "항", "호"])
        inner = "".join(rng.choice([
            lambda: f"<{tag}번호> {rng.randint(1, 9)}</{tag}번호>", lambda: f"<{tag}내용>a &lt; b<![CDATA[<항> & ]]>c</{tag}내용>",
            lambda: f"<{tag}내용>x<b>y</b>z</{tag}내용>", lambda: "<!-- <항> -->", lambda: f"<{tag}번호/>", lambda: "\n text "])() for _ in range(rng.randint(0, 3)))
        below = "".join(node(depth - 1) for _ in range(rng.randint(0, 3))) if depth else ""
        parts = [inner, below]
        rng.shuffle(parts)
        return f"<{tag} k='a > b' n=\"1/2\">{''.join(parts)}</{tag}>"

    articles = "".join(f"<조문단위 조문키=\"{i}\"><조문번호>{i}</조문번호>{''.join(node(4) for _ in range(3))}<조문내용><![CDATA[제{i}조]]></조문내용></조문단위>" for i in range(3))
    return f"<?xml version='1.0' encoding='UTF-8'?>\n<법령 k='v'><기본정보><법령ID>1</법령ID><법령명_한글>n</법령명_한글><법종구분>법률</법종구분></기본정보><조문>{articles}</조문></법령>\n"


def test_laws_of_any_depth_equal_the_tree(spark):
    rng = random.Random(11)
    deep = "<법령><조문단위>" + "<항><항번호>1</항번호>" * 50 + "<호><호내용>h</호내용></호>" + "</항>" * 50 + "</조문단위></법령>"
    texts = [deep, *(_random_law(rng) for _ in range(60))]
    out = xml_details.parse_law_detail(spark.createDataFrame(list(enumerate(texts)), "id int, xml string"))
    got = {r["id"]: r for r in out.collect()}
    for i, text in enumerate(texts):
        assert [a.asDict(recursive=True) for a in got[i]["articles"]] == _plain(text)
        assert got[i]["detail_status"] == ("valid" if i else "lacking")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "from_xml" not in plan and plan.count("ArrowEvalPython") == 1  # one scan of a document


@pytest.mark.parametrize("xml, ok", [
    ("<a/>", True), ("<a></a>", True), (" \n<a>x</a>\n ", True), ("<?xml version='1.0'?><!-- c --><a><?p x?></a><!-- d -->", True), ("<a><![CDATA[</a>]]></a>", True),
    ("<a b='>'/>", True), ("", False), ("x", False), ("<a>", False), ("</a>", False), ("<a></b>", False), ("<a><b></a></b>", False), ("<a/><b/>", False), ("<a/>x", False),
    ("x<a/>", False), ("<a>&nope;</a>", False), ("<a>x & y</a>", False), ("<a b=1/>", False), ("<a b='1' b='2'/>", False), ("<a>< b</a>", False), ("<a><![CDATA[x</a>", False),
])
def test_well_formed_or_not(spark, xml, ok):
    rows = spark.createDataFrame([(xml,)], "xml string").select(xml_elements.elements(F.col("xml"), ["a", "b"]).alias("r"))
    assert rows.first()["r"]["ok"] is ok
    if ok:
        assert rows.first()["r"]["e"][0]["name"] == "a"
    else:
        with pytest.raises(ET.ParseError):
            ET.fromstring(xml)
