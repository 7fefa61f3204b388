import gzip
import hashlib
import json

from pyspark.sql import functions as F

from revlake.functions.organizations import NATIONAL
from revlake.operators import refs, reconcile, render
from revlake.sources import documents, records, table_functions, xml_details


def test_descendants_errors_and_cdata(spark):
    xml = ("<법령><기본정보><법령ID>1</법령ID><법령명_한글>민법</법령명_한글><x><법종구분>법률</법종구분></x></기본정보><조문><조문단위><조문번호>1</조문번호>"
           "<조문내용><![CDATA[제1조 <개정 2020> & ]]></조문내용><w><항><항내용>p &amp; q</항내용><호><호내용>h</호내용></호></항></w></조문단위></조문><부칙/></법령>")
    rows = [("ok", xml), ("cut", xml[:-3]), ("unclosed", xml.replace("</조문>", "")), ("error", "<r><result>실패</result></r>"), ("lack", "<법령/>"), ("none", None)]
    out = {r["id"]: r for r in xml_details.parse_law_detail(spark.createDataFrame(rows, "id string, xml string")).collect()}
    assert {k: v["detail_status"] for k, v in out.items()} == {
        "ok": "valid", "cut": "malformed", "unclosed": "malformed", "error": "api_error", "lack": "lacking", "none": "missing"}
    article = out["ok"]["articles"][0]
    assert article["text"] == "제1조 <개정 2020> & " and article["paragraphs"][0]["text"] == "p & q"
    assert article["paragraphs"][0]["subparas"][0]["text"] == "h" and out["ok"]["metadata"]["kind"] == "법률"
    assert out["cut"]["articles"] == []


def test_rule_fallback_tags_and_bylaws(spark):
    xml = ("<r><ID>7</ID><행정규칙명_한글>이름</행정규칙명_한글><소관부처명>노동부</소관부처명><상위부처명>고용노동부</상위부처명>"
           "<별표><별표파일링크>/a</별표파일링크></별표><별표><별표단위><별표PDF파일링크>b</별표PDF파일링크></별표단위></별표><본문> 가 </본문></r>")
    row = xml_details.parse_admrule_detail(spark.createDataFrame([(xml,)], "xml string"), NATIONAL).first()
    assert (row["serial"], row["name"], row["top"], row["agency"], row["body_text"]) == ("7", "이름", "고용노동부", "고용노동부", "가")
    assert row["raw_ministry"] == "노동부"
    assert [(a["num"], a["file_link"], a["pdf_link"]) for a in row["attachments"]] == [
        ("별표 1", "https://www.law.go.kr/a", ""), ("별표 2", "", "https://www.law.go.kr/b")]


def test_inferred_search_columns(spark):
    xml = "<s><totalCnt>2</totalCnt><page>1</page><ordin id='1'><a>1</a><b><![CDATA[x <y>]]></b><a>2</a><c/></ordin></s>"
    row = xml_details.parse_search_page(spark.createDataFrame([(xml,)], "xml string"), "ordin").first()
    assert row["item"] == {"a": "2", "b": "x <y>", "c": ""} and row["total"] == 2


def test_fixed_search_fields_are_those_of_the_parser(spark):
    """Direct children only, text around CDATA, items with attributes and failed, cut or missing pages."""
    item = "<법령명한글>가 <![CDATA[나 & <다>]]> &lt;라</법령명한글><w><법령ID>9</법령ID></w><공포번호/><공포번호>2</공포번호>"
    page = f"<s><x><totalCnt> 2 </totalCnt></x><page>z</page><law id='1'>{item}</law><w><law><법령ID>7</법령ID></law></w><!-- <law/> --></s>"
    rows = [("ok", page), ("failed", page.replace("</s>", "<result>실패</result></s>")), ("cut", page[:-2]), ("none", None)]
    found = xml_details.parse_search_page(spark.createDataFrame(rows, "id string, xml string"), "law")
    got = sorted(found.collect(), key=lambda r: r["row_pos"])
    assert [(r["id"], r["total"], r["page"], r["row_pos"]) for r in got] == [("ok", 2, 1, 0), ("ok", 2, 1, 1)]
    assert got[0]["item"] == dict.fromkeys(xml_details.SEARCH_FIELDS["law"], "") | {"법령명한글": "가 나 & <다> <라"}
    assert got[1]["item"] == dict.fromkeys(xml_details.SEARCH_FIELDS["law"], "") | {"법령ID": "7"}


def test_history_files(spark, tmp_path):
    entry = {"법령일련번호": " 5 ", "법령명한글": "민법", "제개정구분명": "제정"}
    for name, text in (("ok", json.dumps([entry, "x"], ensure_ascii=False)), ("empty", "[]"), ("bad", "[{"), ("object", '{"a": 1}')):
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    entries, status = records.read_history_json(spark, str(tmp_path))
    got = {r["file"].rsplit("/", 1)[1]: (r["status"], r["bad_entries"]) for r in status.collect()}
    assert got == {"ok.json": ("ok", 1), "empty.json": ("empty", 0), "bad.json": ("malformed", 0), "object.json": ("malformed", 0)}
    assert [(r["rev_id"], r["title"]) for r in entries.collect()] == [("5", "민법")]


def test_index_log_and_id_files(spark, tmp_path):
    header = "순번,법령MST,소관부처코드,소관부처명,법령ID,법령명,공포일자,공포번호,시행일자,법령구분코드,법령구분명,법령분야코드,법령분야명"
    (tmp_path / "i.csv").write_text(f"총1건\n{header}\n1, 9 ,c,\"부, 청\",L,민법,19580222,1,19600101,A,법률,F,민사\n1,2\n", encoding="utf-8")
    row = records.read_index_csv(spark, str(tmp_path / "i.csv")).first()
    assert (row["rev_id"], row["dept"], row["title"], row["area"]) == ("9", "부, 청", "민법", "민사")
    log = "h1\x002020-01-02T00:00:00\x00법률: 민법 (제정)\n\n공포일자: 2020-01-02\n공포번호: \n소관부처: 부\n법령MST: 9\x1e\nh2\x002019-01-01T0\x00x\n\n법령MST: 9\n법령MST: 10\x1e"
    (tmp_path / "log.txt").write_text(log, encoding="utf-8")
    got = {r["rev_id"]: r for r in records.read_commit_log(spark, str(tmp_path / "log.txt")).collect()}
    assert (got["9"]["hash"], got["9"]["name"], got["9"]["amendment"]) == ("h1", "민법", "제정")
    assert got["9"]["prom_num"] == "소관부처: 부" and got["10"]["hash"] == "h2"
    (tmp_path / "ids.txt").write_text(" 1 \n\n# 2\n1\n3\n", encoding="utf-8")
    assert sorted(r["id"] for r in records.read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == ["1", "3"]


def test_inventory_and_export(spark, tmp_path):
    docs = spark.createDataFrame([("a/x.md", "가"), ("b/y.md", "나다")], "path string, content string")
    documents.export_files(docs, str(tmp_path / "out"))
    got = {r["path"]: (r["bucket"], r["bytes"], r["sha256"]) for r in documents.file_inventory(spark, str(tmp_path / "out")).collect()}
    assert got["a/x.md"] == ("a", 3, hashlib.sha256("가".encode()).hexdigest()) and set(got) == {"a/x.md", "b/y.md"}


def test_table_function_needs_no_shuffle(spark):
    table_functions.register(spark)
    item, deep = {"num": "m", "branch": "", "text": "t"}, "array<struct<num:string,branch:string,text:string"
    schema = f"id int, note string, articles {deep},paragraphs:{deep},subparas:{deep},items:{deep}>>>>>>>>"
    sub = lambda n: item | {"items": [item] * n}
    para = lambda *n: item | {"subparas": [sub(x) for x in n]}
    rows = [(1, "a", [item | {"paragraphs": [para(2, 0), para()]}, item | {"paragraphs": [para(1)]}]), (2, None, None), (3, "c", []), (4, "d", [item | {"paragraphs": []}])]
    parsed = spark.createDataFrame(rows, schema)
    got = spark.sql("SELECT * FROM explode_articles(TABLE({parsed}))", parsed=parsed)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = sorted(tuple(r) for r in xml_details.explode_articles(parsed, "id").collect())
    assert sorted(tuple(r) for r in got.drop("note").collect()) == want and len(want) == 12
    dealt = spark.sql("SELECT * FROM explode_articles(TABLE({parsed}) PARTITION BY id)", parsed=parsed)
    assert sorted(tuple(r) for r in dealt.drop("note").collect()) == want
    assert {(r["id"], r["note"]) for r in got.collect()} == {(1, "a"), (4, "d")}


def test_lines_of_articles_and_rules_and_rules_have_no_arrays_of_lines(spark):
    item = "array<struct<num:string,branch:string,text:string"
    schema = f"articles {item},kind:string,title:string,paragraphs:{item},subparas:{item},items:{item}>>>>>>>>"
    none, sub = ("", "", "", []), lambda text: ("1..", "2", text, [("가.", "", "가. x")])
    paras = [none, ("", "", "", [("", "", "", [])]), ("①", "", "① p·q", [sub("1. a  b"), sub("")])]
    rows = [([("3", "2", "제3조의2(t) [a](b)", "", "t", paras), ("", "", "제1장 총칙", "전문", "", []), ("", "", "", "전문", "", []), ("4", "", "", "", "", [])],)]
    df = spark.createDataFrame(rows, schema).select(render.render_articles("articles").alias("md"))
    assert df.first()["md"] == (
        "##### 제3조의2 (t)\n\n\\[a](b)\n\n\n**①** pㆍq\n\n  1의2\\. a b\n    가\\. x\n    가\\. x\n\n## 제1장 총칙\n\n##### 제4조\n")
    body = spark.createDataFrame([("제1장 a\n제2조(b) ① c\n① d\n\n\n제3조 삭제\n제 e\n1. f",)], "t string").select(render.structured_body(F.lit("n"), F.col("t")).alias("md"))
    assert body.first()["md"] == "# n\n\n## 제1장 a\n\n##### 제2조 (b)\n\n**①** c\n\n**①** d\n\n##### 제3조\n\n삭제\n\n제 e\n  1\\. f"
    assert "flatten" not in body._jdf.queryExecution().optimizedPlan().toString()


def test_inventory_is_listed_by_tasks(spark, tmp_path):
    names = ["a/b/c/deep.txt", "a:b/x y.txt", "top.txt", "a/_k=v/in.txt", "_metadata.txt", ".hidden", "_skipped", "a/.d/x.txt", "_s/x.txt", "half._COPYING_"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name, encoding="utf-8")
    (tmp_path / "a" / "empty").touch()
    (tmp_path / "a" / "lost").symlink_to(tmp_path / "nowhere")
    for path in (str(tmp_path), f"file://{tmp_path}/"):
        inventory = documents.file_inventory(spark, path)
        assert "BinaryFile" not in inventory._jdf.queryExecution().optimizedPlan().toString()
        assert not inventory.inputFiles()  # no list of files on the driver
        assert {tuple(r) for r in inventory.collect()} == {
            (n, n.split("/")[0], len(n), hashlib.sha256(n.encode()).hexdigest()) for n in names[:5]}


def test_inventory_of_empty_files_and_of_bytes_as_they_are(spark, tmp_path):
    (tmp_path / "a" / "_s").mkdir(parents=True)
    contents = {"a/empty": b"", "top": b"", "a/x.gz": gzip.compress(b"x"), "a/y.txt": b"y"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "a" / "_s" / "empty").touch()
    (tmp_path / ".empty").touch()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    for path in (str(tmp_path), "viewfs://store/in"):
        got = sorted(tuple(r) for r in documents.file_inventory(spark, path, empty=True).collect())
        assert got == sorted((n, n.split("/")[0], len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items())


def test_foreign_headers(spark):
    df = spark.createDataFrame([("a: {b: 1}\nc: 2020-01-02",), ("- x",), ("a: [",)], "h string")
    got = [r[0] for r in df.select(documents.foreign_header_json("h")).collect()]
    assert json.loads(got[0]) == {"a": {"b": 1}, "c": "2020-01-02"} and got[1:] == [None, None]


def test_image_tags_and_replacement(spark):
    text = ("공포일자: 2024-01-01\n<img src='https://www.law.go.kr/LSW/flDownload.do?flSeq=12' alt=''></img><img id=\"7\">\n"
            "<img id='8' src=\"http://www.law.go.kr/flDownload.do?flSeq=8\"> <img id=\"7\"><img id=\"7\">")
    docs = spark.createDataFrame([("d", text)], "doc string, content string")
    found = refs.extract_tag_refs(docs, "doc", "content", "2024-01-31").collect()
    assert sorted((r["line"], r["id"], r["format"], r["priority"]) for r in found) == [
        (2, "12", "src", 30), (2, "7", "id-only", 30), (3, "7", "id-only", 30), (3, "7", "id-only", 30), (3, "8", "src", 30)]
    todo = [("d", 3, '<img id="7">', "first", "approved", 1), ("d", 3, '<img id="7">', "second", "approved", 2),
            ("d", 3, '<img id="7">', "third", "approved", 3), ("d", 1, "공포", "x", "extracted", 4)]
    manifest = spark.createDataFrame(todo, "doc string, line int, tag string, converted_text string, status string, ref_pos int")
    merged, after = refs.replace_refs(docs, manifest)
    assert merged.first()["content"].split("\n")[2].endswith(" firstsecond")
    assert {r["ref_pos"]: r["status"] for r in after.collect()} == {1: "replaced", 2: "replaced", 3: "approved", 4: "extracted"}
    assert refs.tags_not_found(after).first()["not_found"] == 1


def test_gate_edges(spark):
    current = spark.createDataFrame([("1", "api_error", "2024-01-30 00:00:00"), ("2", "api_error", "2024-01-29 23:59:59"), ("3", "api_error", None), ("4", "empty_body", "2024-01-30 12:00:00")],
                                    "key string, reason string, failed_at string").withColumn("failed_at", F.col("failed_at").cast("timestamp"))
    base = spark.createDataFrame([("4", "api_error")], "key string, reason string")
    got = {r["key"]: r["class"] for r in reconcile.failure_delta(current, base, "2024-01-31 00:00:00").collect()}
    assert got == {"1": "transient", "2": "semantic", "3": "semantic", "4": "semantic"}


def test_long_texts_and_lists_do_not_exhaust_the_stack(spark):
    long = "가나 &amp; 다 " * 20_000
    page = f"<s><totalCnt>1</totalCnt><page>1</page><law><법령명한글>{long}</법령명한글><법령ID><![CDATA[{'x' * 100_000}]]></법령ID></law></s>"
    item = xml_details.parse_search_page(spark.createDataFrame([(page,)], "xml string"), "law").first()["item"]
    assert item["법령명한글"] == "가나 & 다 " * 20_000 and len(item["법령ID"]) == 100_000
    header = "---\n이름: a\n목록:\n" + "".join(f"- e{i}\n" for i in range(10_000)) + "끝: b\n---\nbody\n"
    row = documents.read_frontmatter_docs(spark.createDataFrame([(header,)], "text string"), "text").first()
    assert row["lists"]["목록"] == [f"e{i}" for i in range(10_000)] and row["scalars"] == {"이름": "a", "끝": "b"}
    line = ",".join(["1", "9", "", '"' + "가, 나\n" * 20_000 + '"', "L", "t", "20200101", "1", "20200102", "c", "k", "f", "a"])
    got = records.parse_index_lines(spark.createDataFrame([(line,)], "line string"), "line").first()
    assert got["dept"] == ("가, 나\n" * 20_000).strip() and got["rev_id"] == "9"


def test_paragraphs_inside_paragraphs(spark):
    def xml(levels):
        inner = ""
        for i in range(levels, 0, -1):
            inner = f"<항><항내용>p{i}</항내용>{inner}<호><호내용>h{i}</호내용></호></항>"
        return f"<법령><법령ID>1</법령ID><법령명_한글>a</법령명_한글><법종구분>b</법종구분><조문단위>{inner}</조문단위></법령>"

    rows = spark.createDataFrame([(i, xml(i)) for i in (1, 2, 3, 30)], "n int, xml string")
    out = {r["n"]: r for r in xml_details.parse_law_detail(rows).collect()}
    for n in (1, 2, 3, 30):
        found = out[n]["articles"][0]["paragraphs"]
        assert [p["text"] for p in found] == [f"p{i}" for i in range(1, n + 1)]
        assert [len(p["subparas"]) for p in found] == list(range(n, 0, -1))
        assert out[n]["detail_status"] == "valid"


def test_index_file_with_line_breaks_in_fields(spark, tmp_path):
    rows = ["총2건", "순번,법령MST," + ",".join("abcdefghijk"), '1,11,x,"부처\n둘, ""셋""",L1,이름,20200101,1,20200102,c,k,f,분야', "2,12,x,d,L2,n,20200101,2,20200102,c,k,f,a", "3,짧다"]
    path = tmp_path / "index.csv"
    path.write_text("\n".join(rows), encoding="utf-8")
    got = {r["rev_id"]: r for r in records.read_index_csv(spark, str(path)).collect()}
    assert set(got) == {"11", "12"} and got["11"]["dept"] == '부처\n둘, "셋"' and got["11"]["area"] == "분야"


def test_index_file_is_split_and_keeps_empty_last_fields(spark, tmp_path):
    """Small splits cut records and quoted fields; rows whose last field is empty stay."""
    cells = lambda i, dept, last: ",".join([str(i), str(i), "x", dept, "L", "n", "20200101", "1", "20200102", "c", "k", "f", last])
    depts = {i: f"부처{i}" if i % 3 else "\n".join([f'줄, "{i}"'] + ["가, 나"] * (i % 40)) for i in range(300)}
    rows = ["총300건", "순번,법령MST," + ",".join("abcdefghijk")]
    rows += [cells(i, d if i % 3 else '"' + d.replace('"', '""') + '"', ("", '""', 'a"b', "분야")[i % 4]) for i, d in depts.items()]
    path = tmp_path / "index.csv"
    path.write_text("\n".join([*rows, "3,짧다"]) + "\n", encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701")
    try:
        assert spark.read.text(str(path), lineSep="\n").rdd.getNumPartitions() > 10
        got = {r["rev_id"]: (r["dept"], r["area"]) for r in records.read_index_csv(spark, str(path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert {k: d for k, (d, _) in got.items()} == {str(i): d for i, d in depts.items()}
    assert all(area == ("", "", 'a"b', "분야")[int(i) % 4] for i, (_, area) in got.items())


def test_an_unbalanced_quote_spoils_its_own_line_only(spark, tmp_path):
    row = lambda i, title: f"{i},{i},c,dept,L{i},{title},20200101,1,20200101,k,kind,f,area"
    lines = [row(0, "plain"), row(1, '"two\nlines"'), row(2, '"stray'), *(row(i, "plain") for i in range(3, 60))]
    (tmp_path / "i.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    got = {r["rev_id"]: (r["title"], r["status"]) for r in _bounded(spark, str(tmp_path / "i.csv"), 10).collect()}
    assert got["0"] == ("plain", "ok") and got["1"] == ("two\nlines", "ok") and "2" not in got
    assert all(got[str(i)] == ("plain", "unbalanced") for i in range(3, 60))
    assert len(_bounded(spark, str(tmp_path / "i.csv"), 10_000).collect()) == 2  # unbounded, the quote takes all that follows


def _bounded(spark, path, most):
    return records.parse_index_lines(records.read_index_records(spark, path, most), "line", ["status"])


def test_explode_articles_from_sql_carries_columns(spark):
    from revlake.sources import table_functions

    xml = "<r><법령ID>1</법령ID><조문단위><조문번호>1</조문번호><항><항번호>a</항번호><호><호번호>b</호번호><목><목번호>c</목번호></목></호></항></조문단위></r>"
    parsed = xml_details.parse_law_detail(spark.createDataFrame([(7, "k", xml), (None, "x", xml), (9, None, "<r/>")], "rev_id int, extra string, xml string"))
    table_functions.register(spark)
    got = spark.sql("SELECT * FROM explode_articles(TABLE({t}) PARTITION BY rev_id)", t=parsed.drop("addenda"))
    assert got.columns[:4] == ["rev_id", "extra", "detail_status", "level"]
    want = xml_details.explode_articles(parsed, "rev_id")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() == 8
    assert {r["extra"] for r in got.collect()} == {"k", "x"}
    import pytest

    with pytest.raises(Exception, match="column articles"):
        spark.sql("SELECT * FROM explode_articles(TABLE(SELECT 1 AS a))")


def test_ancestor_chains_of_any_length_and_cycles(spark):
    from revlake.operators import hierarchy

    links = [(f"n{i}", f"n{i + 1}") for i in range(200)] + [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("s", "s"), ("lone", ""), ("null", None), ("x", "n7"), (None, "n1"), ("two", "n3"), ("two", "n2")]
    parent = {}
    for c, p in sorted((c, p) for c, p in links if c and p):
        parent.setdefault(c, p)
    want = {}
    for name in {c for c, _ in links if c} | {p for _, p in links if p}:
        path, status = [name], "ok"
        while path[0] in parent:
            if parent[path[0]] in path:
                status = "cycle"
                break
            path.insert(0, parent[path[0]])
        want[name] = (path, status)
    got = hierarchy.ancestor_chains(spark.createDataFrame(links, "child string, parent string")).collect()
    assert {r["name"]: (r["path"], r["status"]) for r in got} == want and len(got) == len(want)


def test_records_agree_with_the_element_scan(spark):
    """Records come from a tree of another parser than the elements; what is well-formed and the texts are the same."""
    from revlake.sources.xml_elements import Nodes, elements, records as found

    rows = ["<a><b>1<x/>2</b><w><n><b>3</b><n><b/><m><b>4</b></m></n></n></w></a>", "<p:a><b>1</b></p:a>", "<a xmlns='u'><b>1</b></a>",
            "<!DOCTYPE a SYSTEM 'x'><a><b>&u;1</b></a>", "<a>&u;</a>", "<a><b>1</b>", "", None, "\n<?xml version='1.0'?><b>t<!-- c -->u</b>",
            "<n>" * 3000 + "<m><b>5</b></m>" + "</n>" * 3000]
    df = spark.createDataFrame([(x,) for x in rows], "xml string")
    nodes = {"ns": Nodes("n", {"b": "b"}, {"ms": Nodes("m", {"b": "b"})})}
    got = [r["r"] for r in df.select(found(F.col("xml"), {"first": "b"}, nodes).alias("r")).collect()]
    scan = [r["r"] for r in df.select(elements(F.col("xml"), ["b", "n"]).alias("r")).collect()]
    assert [r["ok"] for r in got] == [r and r["ok"] for r in scan]
    first = [next((e["text"] for e in (r["e"] if r else []) if e["name"] == "b"), "") for r in scan]
    assert [r["first"] for r in got] == first and first[:4] == ["1", "1", "1", "1"]
    assert [[n["b"], [m["b"] for m in n["ms"]]] for n in got[0]["ns"]] == [["3", ["4"]], ["", ["4"]]]
    assert len(got[-1]["ns"]) == 3000 and all(n["ms"][0]["b"] == "5" for n in got[-1]["ns"])
