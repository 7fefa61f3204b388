import random
import unicodedata

from pyspark.sql import functions as F

from revlake.functions import dates, links, names, text
from revlake.functions.organizations import NATIONAL
from revlake.operators import profile, render


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(value):
    return F.lit(value)


def test_text(spark):
    assert one(spark, text.normalize_dots(lit("가·나・다･라ㆍ"))) == "가ㆍ나ㆍ다ㆍ라ㆍ"
    assert one(spark, text.name_key(lit(" 가 · 나　"))) == "가ㆍ나"
    assert one(spark, text.parse_departments(lit("a, ,b ,"))) == ["a", "b"]
    assert one(spark, text.escape_relative_links(lit("[별표 3](일반직) ![a](b) \\[c](d) [u](https://x) [t](#a)"))) == (
        "\\[별표 3](일반직) ![a](b) \\[c](d) [u](https://x) [t](#a)")
    assert one(spark, text.html_to_text(lit("a<br/>b<BR>c&nbsp;&lt;x&gt; &amp;lt; &#44032;&#xAC01; &copy &notit;<i>t</i>"))) == (
        "a\nb\nc <x> &lt; 가각 © ¬it;t")
    assert one(spark, text.html_to_text(lit(" a<br>b"), " ")) == "a b"
    cut = "<title>x &lt; y &amp</title>{z} &#65 &#65; &notit; &copy"
    assert one(spark, text.html_to_text(lit(cut), unterminated=False)) == "x < y &amp{z} &#65 A &notit; &copy"
    assert one(spark, text.html_to_text(lit(cut))) == "x < y &{z} A A ¬it; ©"
    assert one(spark, text.dedent_body(lit("x\n    y\n      z\n\n"))) == "x\ny\n  z\n"
    assert one(spark, text.dedent_body(lit("x\ny\n"))) == "x\ny\n"
    assert one(spark, text.lines_of(lit("a\r\nb c\n"))) == ["a", "b", "c"]


def test_dates(spark):
    assert one(spark, dates.format_date_lenient(lit("2024139"))) == "2024139"
    assert one(spark, dates.format_date_nullable(lit("00010101"))) is None
    assert one(spark, dates.format_date_checked(lit("2024.02.30"))) == "2024.02.30"
    assert one(spark, dates.format_date_checked(lit(" 2024-02-29 "))) == "2024-02-29"
    assert tuple(one(spark, dates.clamp_issue_date(lit("19650301")))) == ("1970-01-01", "19650301", True)
    # Bound steps: one strip a date instead of one for each place that uses it.
    assert str(dates.clamp_issue_date(F.col("d"))).count("\\A[") <= 2
    assert tuple(one(spark, dates.clamp_issue_date(lit("20240231")))) == ("1970-01-01", "20240231", True)
    assert tuple(one(spark, dates.clamp_issue_date(lit("미정")))) == ("미정", "미정", False)
    assert one(spark, dates.parse_dot_date(lit("1958. 2.22"))) == "19580222"
    assert one(spark, dates.parse_dot_date(lit("1958.2.22."))) == "1958222"
    assert one(spark, dates.dangi_to_gregorian(lit("42890525"))) == "19560525"
    assert one(spark, dates.commit_date(lit("19500101"))) == "1970-01-01"
    assert one(spark, dates.commit_date(lit(""))) == "2000-01-01"


def test_names(spark):
    assert tuple(one(spark, names.law_group_and_file(lit("민법 시행령"), lit("대통령령")))) == ("민법", "시행령")
    assert tuple(one(spark, names.law_group_and_file(lit("검사 인사규정"), lit("대통령령")))) == ("검사인사규정", "대통령령")
    assert one(spark, names.sanitize_case_number(lit("(창원)2000나10828, 10835(병합)"))) == "2000나10828_10835_병합"
    assert one(spark, names.case_type(lit("형사, 세무"))) == "형사·세무"
    assert tuple(one(spark, names.article_number(lit("001002"), lit(""), lit("y"), lit("C0011")))) == ("10", "2", "조문", "의회규칙")
    assert tuple(one(spark, names.split_jurisdiction(lit("강원도 춘천시")))) == ("강원특별자치도", "춘천시")
    assert tuple(one(spark, names.split_jurisdiction(lit("제주도교육청")))) == ("제주특별자치도", "_교육청")
    assert one(spark, names.safe_path_part(lit("con.txt"))) == "_con.txt"
    assert one(spark, names.safe_path_part(lit(" ./: "))) == "_"
    org = names.resolve_agency(lit("노동부"), lit("고용노동부"), lit(""), lit(""), NATIONAL)
    assert tuple(one(spark, org)) == ("고용노동부", "고용노동부")
    assert one(spark, names.org_path(lit("행정안전부"), lit("경찰청"), NATIONAL)) == ["행정안전부", "경찰청"]
    assert one(spark, names.org_path(lit("위성전파감시센터"), lit(""), NATIONAL)) == ["과학기술정보통신부", "중앙전파관리소", "위성전파감시센터"]


def test_links_and_sizes(spark):
    assert one(spark, links.absolute_url(lit("/a"))) == "https://www.law.go.kr/a"
    assert not one(spark, links.is_allowed_url(lit("https://law.go.kr.evil.example/")))
    assert one(spark, links.is_allowed_url(lit("https://u@www.law.go.kr:443/x")))
    assert one(spark, profile.bytes_text(lit(1023))) == "1023 B"
    assert one(spark, profile.bytes_text(lit(1536))) == "1.50 KB"


def random_text(rng, n):
    pool = "ab .(),_/가각힣한é한漢🙂　"
    return "".join(rng.choice(pool) for _ in range(n))


def test_byte_limits_on_random_text(spark):
    rng = random.Random(7)
    rows = [(random_text(rng, rng.randint(0, 120)), rng.randint(0, 60)) for _ in range(400)]
    df = spark.createDataFrame(rows, "s string, n int")
    got = df.select("s", "n", text.utf8_prefix("s", F.col("n")).alias("p")).collect()
    for r in got:
        assert r["p"] == r["s"].encode()[: r["n"]].decode("utf-8", "ignore")


def test_stem_properties(spark):
    rng = random.Random(11)
    rows = [(str(i), random_text(rng, rng.randint(0, 90)), rng.choice(["", " ", "서울고법", "대법원"]), rng.choice([None, "2001-02-03"])) for i in range(300)]
    df = spark.createDataFrame(rows, "serial string, no string, court string, day string")
    stems = df.select("*", names.compose_stem("court", "day", "no", "serial").alias("stem")).collect()
    for r in stems:
        assert len(r["stem"].encode()) <= 180
        assert unicodedata.is_normalized("NFC", r["stem"])
        court, day, slot = r["stem"].split("_", 2)
        assert court in ("미상법원", "서울고등법원", "대법원") and day in ("0000-00-00", "2001-02-03") and slot


def test_structured_body(spark):
    body = "\n\n제1장 총칙\n제1조(목적) ① 이 규칙은\n\n\n제2조 삭제\n1. 가\n가. 나\n② 다\n본문\n\n"
    assert one(spark, render.structured_body(lit("이름"), lit(body))) == (
        "# 이름\n\n## 제1장 총칙\n\n##### 제1조 (목적)\n\n**①** 이 규칙은\n\n##### 제2조\n\n삭제\n\n  1\\. 가\n    가\\. 나\n\n**②** 다\n\n본문")
    assert one(spark, render.structured_body(lit(""), lit("\n\n가나\n\n\n다"))) == "가나\n\n다"
