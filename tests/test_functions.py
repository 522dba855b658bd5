import datetime

import pytest

from pyspark.sql import functions as F
from slotwise.functions import scalars as S
from slotwise.operators import validate


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("name, want", [("BP P.L.C.", "BP"), ("BARCLAYS PLC /NEW/", "BARCLAYS"), ("ASTRAZENECA (UK) LIMITED", "ASTRAZENECA"), ("THE BRITISH PETROLEUM COMPANY P.L.C.", "BRITISH PETROLEUM COMPANY")])
def test_uk_names(spark, name, want):
    assert one(spark, name, S.uk_name) == want


@pytest.mark.parametrize("f, value, want", [
    (S.crn, "102498", "00102498"), (S.crn, "sc095000", "SC095000"), (S.crn, None, ""), (S.squeezed, "DBS Group Holdings Ltd.", "dbsgroupholdingsltd"), (S.stock_codes, "00700<br/>80700", ["00700", "80700"]), (S.size_bytes, "3MB", 3145728),
    (S.size_bytes, "12", None), (S.country, "united kingdom", "GBR"), (S.country, "FRA", "FRA"), (S.escaped_cell, "=1+1", "'=1+1"), (S.climbs, "a/../b", True), (S.climbs, "a..b/c", False), (S.safe_name, "a/b: c", "a_b__c"), (S.without_words, "The Foo Group plc", "FOO"),
    (S.nfkc, "ﬁ", "fi"), (S.nfkd_ascii, "é", "e"), (S.html_unescape, "a &amp; b", "a & b"), (S.is_public_host, "10.0.0.1", False), (S.is_public_host, "example.com", True), (S.visible_text, "<p>a<script>x</script> <b>b</b>", "a b"),
    (S.period_end, "made up to 31 December 2024", datetime.date(2024, 12, 31)), (S.period_end, "made up to 5 April 2023", datetime.date(2023, 4, 5)), (S.period_end, "2022-06-30", datetime.date(2022, 6, 30)), (S.period_end, "soon", None),
    (S.any_datetime, "30/04/2025 16:05", datetime.datetime(2025, 4, 30, 16, 5)), (S.last_segment, "https://a.b/c/d.pdf?x=1", "d.pdf"),
])
def test_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


def test_canonical_code(spark):
    assert one(spark, ["80700", "00700"], lambda c: S.canonical_code(c, F.array(F.lit("00700"), F.lit("80700"))), "array<string>") == "00700"
    assert one(spark, ["80700"], lambda c: S.canonical_code(c, F.array(F.lit("80700"))), "array<string>") == "80700"


def test_paths_come_back(spark):
    row = ("2138001YYBULX5SZ2H24", "GBR", "XLON", "BARC", "GB0031348658", 2023)
    df = spark.createDataFrame([row], "lei string, land string, mic string, own string, isin string, fy int")
    path = S.canonical_path(F.col("lei"), F.col("land"), F.col("mic"), F.col("own"), F.col("isin"), F.col("fy"), F.lit("AR"), F.lit("EN"))
    got = df.select(path.alias("p")).select("p", *S.path_parts(F.col("p"))).first()
    assert got[0] == "GBR/XLON/2138001YYBULX5SZ2H24_GB0031348658_BARC/FY2023/2138001YYBULX5SZ2H24_GBR_XLON_BARC_GB0031348658_FY2023_AR_EN.pdf"
    assert tuple(got[1:]) == ("GBR", "XLON", row[0], row[4], "BARC", 2023)


@pytest.mark.parametrize("url, ok", [("https://a.example/x.pdf", True), ("http://a.example/x.pdf", False), ("https://localhost/x", False), ("https://127.0.0.1/x", False), ("https://192.168.1.9/x", False), ("https://u:p@a.example/x", False), ("ftp://a.example", False), ("https:///x", False), ("", False), (None, False)])
def test_safe_urls(spark, url, ok):
    assert one(spark, url, validate.safe_url) is ok


@pytest.mark.parametrize("base, href, want", [("https://a.b/c/d.html", "e.pdf", "https://a.b/c/e.pdf"), ("https://a.b/c/", "/x", "https://a.b/x"), ("https://a.b/c", "https://o.p/q", "https://o.p/q"), ("https://a.b/c?d=1#e", "//z.y/x", "https://z.y/x"), ("https://a.b/a/b/c.html", "../d.pdf", "https://a.b/a/d.pdf"), ("https://a.b/a/b/c.html?x=1", "?y=1", "https://a.b/a/b/c.html?y=1"), ("https://a.b/c?d=1#e", "#f", "https://a.b/c?d=1#f"), ("https://a.b", "x/../../y/./z/..", "https://a.b/y/"), ("https://a.b/c/", "/p/../../q?r=../s", "https://a.b/q?r=../s"), ("https://a.b/c/d", "", "https://a.b/c/d")])
def test_absolute(spark, base, href, want):
    assert one(spark, href, lambda c: S.absolute(F.lit(base), c)) == want
