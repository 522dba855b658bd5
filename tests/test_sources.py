import json
import zipfile

import pytest

from pyspark.sql import functions as F
from slotwise.sources import readers, writers

GOOD = "GBR,XLON,2138001YYBULX5SZ2H24,GB0031348658,BARC,FY2024,AR,EN,https://a.example/a.pdf,,true"


def test_manifest(spark, tmp_path):
    path = tmp_path / "m.csv"
    bad = GOOD.replace("GBR", "UK", 1)
    path.write_text("﻿" + ",".join(readers.MANIFEST_FIELDS) + "\n" + "\n".join([GOOD, bad, GOOD, GOOD.replace("FY2024", "2024"), GOOD.replace("https://a", "http://a"), GOOD.replace("BARC", "a/b")]) + "\n")
    valid, rejected = readers.manifest(spark, str(path))
    assert [r["line"] for r in valid.collect()] == [2]
    got = {r["line"]: r["reason"] for r in rejected.collect()}
    assert got[3] == "country must be USA or GBR" and got[4].startswith("duplicate canonical target") and set(got) == {3, 4, 5, 6, 7}


def test_strict_header(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a,b\n1,2\n")
    with pytest.raises(readers.SchemaError):
        readers.strict_csv(spark, str(tmp_path / "m.csv"), ["a", "c"])


def test_universe(spark, tmp_path):
    head, row = ",".join(readers.UNIVERSE_FIELDS), "GBR,Acme,XLON,L,I,T,,"
    (tmp_path / "u.csv").write_text(f"{head}\n{row}\n")
    assert readers.universe(spark, str(tmp_path / "u.csv")).first()["company_key"] == "GBR|XLON|L|I|T"
    (tmp_path / "d.csv").write_text(f"{head}\n{row}\n{row}\n")
    (tmp_path / "e.csv").write_text(f"{head}\n")
    for name in "de":
        with pytest.raises(readers.SchemaError):
            readers.universe(spark, str(tmp_path / f"{name}.csv"))


def test_header_aliases(spark):
    df = spark.createDataFrame([("", "b"), ("a", "")], "`Company Name` string, ISSUER_NAME string")
    assert [r[0] for r in readers.by_aliases(df, {"name": ["company-name", "issuer name"], "none": ["x"]}).collect()] == ["b", "a"]


def test_records_of_all_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n")
    (tmp_path / "b.json").write_text(json.dumps({"results": [{"k": 2, "v": {"n": 1}}]}))
    (tmp_path / "c.jsonl").write_text('{"k": "3"}\n\n{"k": "4"}\n')
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("in/e.csv", "k\n5\n")
        z.writestr("../f.csv", "k\n6\n")
    assert sorted(r["row"]["k"] for r in readers.records(spark, str(tmp_path)).collect()) == ["1", "2", "3", "4", "5"]
    assert [r["member"] for r in readers.zip_members(spark, str(tmp_path / "d.zip"), r"\.csv$").collect()] == ["in/e.csv"]


def test_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Symbol</t></si><si><t>Company Name</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="inlineStr"><is><t>note</t></is></c></row><row><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row><row><c r="A3" t="inlineStr"><is><t>ABC</t></is></c><c r="C3" t="inlineStr"><is><t>Acme</t></is></c></row></sheetData></worksheet>')
    assert [r["row"] for r in readers.workbook(spark, str(tmp_path / "w.xlsx"), ["symbol", "company name"]).collect()] == [{"Symbol": "ABC", "Company Name": "Acme"}]


def test_columnar_and_headed_json(spark):
    df = spark.sql("""SELECT 7 AS cik, from_json('{"form":["10-K","8-K"],"date":["2024"]}', 'form array<string>, date array<string>') AS recent""")
    assert [tuple(r) for r in readers.columnar(df, "recent", ["form", "date"]).collect()] == [(7, 0, "10-K", "2024"), (7, 1, "8-K", "")]
    rows = spark.sql("SELECT array(array('urlkey', 'timestamp'), array('u', 't1'), array('v', 't2')) AS a")
    out = rows.select("a", F.explode(F.slice("a", 2, 9)).alias("r")).select(*readers.headed_rows(F.col("a"), {"timestamp": 1, "original": 0}))
    assert [tuple(r) for r in out.collect()] == [("t1", "u"), ("t2", "v")]


def test_pages(spark):
    html = '<a href="/a.pdf">One</a> <a href="https://o.example/b.pdf">Two</a><a href="/a.pdf">Again</a><table><tr><td>1 May<td>AR <b>2024</b></tr></table>ISIN: NZ123 Type: Share'
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = readers.links(df, "page_id", "html", F.lit("https://x.example/p"), hosts=["x.example"]).collect()
    assert [(r["url"], r["text"]) for r in got] == [("https://x.example/a.pdf", "One")]
    assert readers.table_rows(df, "page_id", "html").first()["cells"] == ["1 May", "AR 2024"]
    assert spark.range(1).select(*readers.labelled(F.lit("ISIN: NZ123 Type: Share"), ["ISIN", "Type"])).first()[0] == "NZ123"
    assert spark.range(1).select(readers.sitemap(F.lit("<url><loc> https://a/x-2023-ar-00/ </loc></url>"))).first()[0] == ["https://a/x-2023-ar-00/"]
    assert tuple(spark.range(1).select(*readers.year_and_type(F.lit("https://a/x-2023-ar-00/"))).first()) == (2023, "AR")
    assert spark.range(1).select(readers.company_count(F.lit("Main Board 2,300 GEM 320 Total 2,620"))).first()[0] == 2620


def test_directives(spark):
    df = spark.createDataFrame([("Harvest the next 50 companies from New Zealand for 2019-2023",), ("all listed Canadian companies",)], "t string")
    assert [tuple(r) for r in df.select(*readers.directive(F.col("t"))).collect()] == [("NewZealand", 50, 2019, 2023), ("Canada", 999_999, None, None)]
    assert list(readers.years("2017:2019")) == [2017, 2018, 2019]
    with pytest.raises(ValueError):
        readers.years("2025:2017")


def test_listing_and_optional_tables(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.pdf").write_bytes(b"12345")
    assert [r["length"] for r in readers.listing(spark, str(tmp_path), "*.pdf").collect()] == [5]
    assert readers.table_or_empty(spark, "no_such_table", "a int").count() == 0


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("=x", 1, "direct"), ("y", 2, "review")], "a string, b int, t string")
    writers.fixed_csv(df, str(tmp_path / "o"), ["b", "a"])
    back = spark.read.option("header", True).csv(str(tmp_path / "o"))
    assert back.columns == ["b", "a"] and sorted(r["a"] for r in back.collect()) == ["'=x", "y"]
    assert {k: v.count() for k, v in writers.split(df, F.col("t")).items()} == {"direct": 1, "bulk": 0, "review": 1}
    assert set(writers.audits({"all": df}, str(tmp_path / "v"))) == {"all"}
    for _ in range(2):
        writers.append_metrics(df.limit(1), str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2
    writers.manifest_files(df, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "c/json")).count() == 2


def test_orphans_and_one_file(spark, tmp_path):
    for i in range(40):
        (tmp_path / "o" / str(i % 7) / "deep").mkdir(parents=True, exist_ok=True)
        (tmp_path / "o" / str(i % 7) / "deep" / f"{i}.pdf{'' if i % 3 else '.part'}").write_bytes(b"%PDF-")
    (tmp_path / "o" / "top.part").write_bytes(b"")
    assert writers.remove_orphans(spark, f"file://{tmp_path}/o", older_ms=3_600_000) == 0
    assert writers.remove_orphans(spark, f"file://{tmp_path}/o") == 15
    left = writers.listed(spark, f"file://{tmp_path}/o").collect()
    assert sorted(int(r["path"].split("/")[-1][:-4]) for r in left) == [i for i in range(40) if i % 3] and {r["length"] for r in left} == {5}
    spark.range(5000).repartition(3).orderBy("id").selectExpr("cast(id AS string) AS value").write.text(f"{tmp_path}/p")
    writers.one_file(spark, f"file://{tmp_path}/p", f"file://{tmp_path}/w/x.csv", b"head\n")
    assert (tmp_path / "w" / "x.csv").read_text() == "head\n" + "".join(f"{i}\n" for i in range(5000))
