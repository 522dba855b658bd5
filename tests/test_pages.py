"""Page readers on hostile pages, and writes of one pass."""

import datetime

import pytest

from pyspark.sql import functions as F
from slotwise.sources import readers, writers


def page(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "id int, html string")


def test_links_count_repeats(spark):
    html = '<a href="/a">One</a><A class=x HREF = \'/b\'>Two <b>x</b></A><a href="/a">Again</a><a name="n">no</a><a href="https://off.example/c">C</a>'
    got = readers.links(page(spark, html, None, ""), "id", "html", F.lit("https://x.example/p"), hosts=["x.example"]).collect()
    assert sorted((r["url"], r["text"], r["n"]) for r in got) == [("https://x.example/a", "One", 2), ("https://x.example/b", "Two x", 1)]


def test_filings(spark):
    pdf = '<a href="/company/0012/filing-history/MzA/document?format=pdf&amp;download=0">PDF</a>'
    html = f"""<table><tr><th>Date</th></tr>
    <tr><td>12
      Mar 2024</td><td>AA</td><td>Accounts <b>made</b> up&amp;to</td><td>{pdf} (12 pages)</td></tr>
    <TR class='x'><TD>1 Jan 2023</TD></TR>
    <tr><td>31 Feb 2023</td><td>CS01</td><td>x</td><td>{pdf}</td></tr>
    <tr><td>3 Abc 2022</td><td><a href="/x/filing-history/ABCDEFGHIJKLMNOPQ">y</a></td></tr>
    <tr><td>4 Apr 2022</td><td>B</td><td></td><td>{pdf.replace('MzA', 'Zz')} (1 PAGE)</td></tr></table>"""
    got = {r["transaction_id"]: (r["row"], *tuple(r)[3:]) for r in readers.filing_rows(page(spark, html, None, "<tr><td>"), "id", "html").collect()}
    href = "/company/0012/filing-history/{}/document?format=pdf&download=0"
    assert got == {
        "MzA": (1, datetime.date(2024, 3, 12), "AA", "Accounts made up&to", 12, href.format("MzA")),
        "ABCDEFGHIJKLMNOPQ": (4, None, "", "3 Abc 2022 y", 0, ""),
        "Zz": (5, datetime.date(2022, 4, 4), "B", "", 1, href.format("Zz")),
    }


def test_codes_of_a_market(spark):
    table = "<table><tr><th>Code<th>Name</tr><tr><td>abc<td>First &amp; Co</tr><tr><td>ABC</td><td>Again</td></tr><tr><td>A-B</td><td>no</td></tr><tr><td>X</td><td>short</td></tr><tr><td>ZZZ</td></tr></table><a href='/companies/OTHER'>Other</a>"
    anchors = '<tr><td>CODE</td><td>Name</td></tr><a href="/companies/AIR">Air <i>NZ</i></a><a href="https://x/companies/AIR">Later</a><a href="/companies/FPH"></a><a href="/companies/aia">low</a><a href="/companies/MEL?x">q</a>'
    got = sorted(map(tuple, readers.listed_codes(page(spark, table, anchors, None), "id", "html").collect()))
    assert got == [(0, "ABC", "First &amp; Co"), (1, "AIR", "Air NZ")]


def test_reports_of_an_archive(spark):
    def item(title, *hrefs, kind="download"):
        return f"<li><div class='heading'>{title}</div>" + "".join(f'<span class="btn_archived {kind}"><a href="{h}">d</a></span>' for h in hrefs) + "</li>"

    html = "<li><span class=heading>Annual Report 2001</span></li><ul class='x archived_report_content_block'>" + "".join([
        item("2020 <b>Annual Report</b>", "/Click/1"), item("Annual Report 2020", "/b.PDF?x=1"), item("Annual report 2020", "/Click/3"), item("Form 10-K 2020", "/c.pdf"),
        item("Annual Report 2021", "/page.html", "/Click/4"), item("Annual Report 2021", "/Click/5"), item("Annual Report 120223", "/d.pdf"), item("Interim 2022", "/e.pdf"),
        item("Report and Accounts 2019", "http://www.x.example/f.pdf"), item("Annual Report 2018", "/g.pdf", kind="other"), item("Annual Report 2017", "../h.pdf", kind="view_annual_report"),
    ]) + "</ul>"
    base = F.lit("https://www.x.example/Company/acme")
    got = [r["reports"] for r in readers.report_years(page(spark, html, None, "<ul></ul>"), "id", "html", base).collect()]
    assert got == [{2017: "https://www.x.example/h.pdf", 2020: "https://www.x.example/c.pdf", 2021: "https://www.x.example/Click/4"}]


def test_parts_are_written_by_one_pass(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        for batch in rows:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(90).selectExpr("id", "concat('=', id) AS t").repartition(3).mapInArrow(counted, "id long, t string")
    tag = F.when(F.col("id") % 3 == 0, "direct").otherwise("review")
    paths, rows = writers.split_once(df, tag, ["direct", "bulk", "review"], str(tmp_path / "s"))
    assert reads.value == 90 and rows == {"direct": 30, "bulk": 0, "review": 60}
    back = {n: spark.read.option("header", True).csv(p) for n, p in paths.items()}
    assert {n: (df.columns, df.count()) for n, df in back.items()} == {"direct": (["id", "t"], 30), "bulk": (["id", "t"], 0), "review": (["id", "t"], 60)}
    assert back["direct"].where("id = 3").first()["t"] == "'=3"
    with pytest.raises(ValueError):
        writers.split_once(spark.range(3).select("id"), F.when(F.col("id") > 0, "a"), ["a", "b"], str(tmp_path / "x"))
