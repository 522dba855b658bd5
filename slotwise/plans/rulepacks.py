"""Classifiers and fiscal-year cascades over filing titles.

Titles are made from filings: one of TEMPLATES by the filing's key, with a year. The same SQL text
of a pack runs in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slotwise.functions import fiscal, text
from slotwise.functions.rules import DUCKDB, SPARK, Dialect, apply
from slotwise.plans.base import Family, read

family = Family()
TEMPLATES = (
    "Annual Report {y}", "{y} Integrated Annual Report", "FY{y} Annual Report and Financial Statements", "Annual Report FY{s}", "Annual Report {y}/{t}", "Audited Accounts {p}-{y}",
    "Audited Annual Financial Statements for the year ended 31 December {y}", "Sustainability Report {y}", "ESG Report", "Notice of Annual General Meeting {y}", "Release and dispatch of {y} Annual Report",
    "Appendix 4E and Annual Report", "Half Year Report {y}", "Interim accounts made up to 30 June {y}", "Group of companies' accounts made up to 31 December {y}", "Full accounts made up to 5 April {y}",
    "Dormant accounts", "Micro-entity accounts", "Total exemption small accounts", "Amended full accounts", "Corporate governance report", "Climate transition action plan", "Modern slavery statement {y}",
    "Business & Sustainability Report", "{y} Environmental Update", "Investor presentation Q1", "Rapport annuel {y}", "General Disclosure Document", "Annual return {y}", "Report to shareholders {y}",
    "Annual Report revised under Regulation 34, financial year {p}-{s}", "SEC FORM 17-A annual report for the fiscal year ended | Dec 31, {y}", "Audited financial statements", "Supplementary schedule", "quarterly results 17-Q",
    "AR{y} sustainability supplement summary", "年報 {y}", "Corporate social responsibility report", "Financial Report", "Full-year financial report {y}", "circular to shareholders",
)


def titles_sql(d: Dialect) -> str:
    """id, title, url, pages, published, period, kind of each filing, as select-list SQL."""
    string = "string" if d.raw else "varchar"
    year = "(2016 + o_orderkey % 9)"
    own = "CASE o_orderkey % {n} {whens} END".format(n=len(TEMPLATES), whens=" ".join(f"WHEN {i} THEN {text.text(t)}" for i, t in enumerate(TEMPLATES)))
    for mark, value in (("{y}", year), ("{p}", f"({year} - 1)"), ("{s}", f"({year} % 100)"), ("{t}", f"(({year} + 1) % 100)")):
        own = f"replace({own}, '{mark}', cast({value} AS {string}))"
    return f"""o_orderkey AS id, {own} AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'https://x.example/docs/a_en.pdf' ELSE 'https://x.example/a.html' END AS url,
      cast(o_orderkey % 60 AS int) AS pages, cast(o_orderdate AS date) AS published,
      CASE WHEN o_orderkey % 7 = 0 THEN concat(cast({year} AS {string}), '-12-31') WHEN o_orderkey % 7 = 1 THEN concat('31/12/', cast({year} AS {string})) WHEN o_orderkey % 7 = 2 THEN concat('31 December ', cast({year} AS {string})) ELSE '' END AS period,
      CASE WHEN o_orderkey % 5 = 0 THEN 'AA' WHEN o_orderkey % 50 = 1 THEN 'AA01' WHEN o_orderkey % 50 = 2 THEN 'ANNREP' ELSE 'SR' END AS kind"""


def add(name: str, pack: Callable[[Dialect], dict[str, str]], sql: str | None = None) -> None:
    """A query of a pack over the titles; its SQL is the pack's in the other dialect, unless it is given by hand."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        titles = read(spark, sf, "orders").selectExpr(*_split(titles_sql(SPARK)))
        return apply(titles, "id", pack(SPARK))

    run.__name__ = name
    columns = ", ".join(f"{sql} AS {c}" for c, sql in pack(DUCKDB).items())
    family.add(name, run, sql or f"WITH titles AS (SELECT {titles_sql(DUCKDB)} FROM orders) SELECT id, {columns} FROM titles")


def _split(sql: str) -> list[str]:
    """A select list's parts: at commas outside brackets and quotes."""
    out, depth, quoted, now = [], 0, False, ""
    for c in sql:
        quoted ^= c == "'"
        depth += (not quoted) * ((c == "(") - (c == ")"))
        if c == "," and not depth and not quoted:
            out.append(now)
            now = ""
        else:
            now += c
    return [*out, now]


def _named(names: str, values: tuple[str, ...] | str) -> dict[str, str]:
    return dict(zip(names.split(), values if isinstance(values, tuple) else (values,), strict=True))


def _year(c: tuple[str, str, str]) -> dict[str, str]:
    return _named("fiscal_year confidence method", c)


add("classify_sustainability", lambda d: _named("class code", text.sustainability(d, "title", "kind")))
add("classify_accounts", lambda d: _named("status reason", text.accounts(d, "kind", "title", "period", "(pages > 1)", "pages", "(id % 97 = 0)")))
add("classify_australia", lambda d: _named("annual_score sr_type sr_score class", text.australia(d, "title", "pages")))
add("classify_africa", lambda d: _named("label score", text.africa(d, "title", "url", "pages")))
add("classify_middle_east", lambda d: _named("class confidence", text.middle_east(d, "title", "url", "kind")))
add("detect_arabic_share", lambda d: {"language": text.middle_east_language(d, "title", "''"), "confidence": text.middle_east_confidence(d, "title", "''")})
add("detect_french", lambda d: {"language": text.canada_language(d, "title", "url", "kind")})
add("classify_canada", lambda d: {"score": text.canada(d, "title", "url")})
add("classify_india", lambda d: {"score": text.india(d, "title"), "annual": f"(({text.india(d, 'title')}) >= 90)"})
add("classify_bangladesh", lambda d: {"score": text.bangladesh(d, "title")})
add("classify_new_zealand", lambda d: {"score": text.new_zealand(d, "title", "kind")})
add("score_hong_kong", lambda d: {"score": f"round({text.hong_kong(d, 'title', 'title', 'kind', 'kind', '2020', '(pages * 1000)')}, 6)"})
add("score_singapore", lambda d: {"score": text.singapore(d, "title", "2020", "kind")})
add("classify_philippines", lambda d: {"class": text.philippines(d, "title")})
# written by hand: what each title of TEMPLATES, by its place, and each address is
add("report_type_by_name", lambda d: {"report_type": text.report_type(d, "title")}, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 41 = 1 THEN 'IR' WHEN o_orderkey % 41 IN (7, 8, 21, 23, 35) THEN 'SR' ELSE 'AR' END AS report_type FROM orders")
add("source_format_by_suffix", lambda d: {"format": text.source_format(d, "url")}, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'pdf' ELSE 'html' END AS format FROM orders")
add("fy_cascade_africa", lambda d: _year(fiscal.africa(d, "title", "period", "published")))
add("fy_cascade_middle_east", lambda d: _year(fiscal.middle_east(d, "title", "period", "published")))
add("fy_cascade_sri_lanka", lambda d: _year(fiscal.sri_lanka(d, "title")))
add("fy_cascade_australia", lambda d: _year(fiscal.australia(d, "title", "published")))
add("fy_cascade_hong_kong", lambda d: _year(fiscal.hong_kong(d, "title", "published")))
add("fy_cascade_canada", lambda d: _year(fiscal.canada(d, "title", "period", "published")))
add("fy_cascade_india", lambda d: _year(fiscal.india(d, "title")))
add("fy_cascade_bangladesh", lambda d: _year(fiscal.bangladesh(d, "title", "cast(year(published) AS int)")))
add("fy_cascade_new_zealand", lambda d: _year(fiscal.new_zealand(d, "title", "cast(year(published) AS int)")))
add("fy_form_17a", lambda d: _year(fiscal.form_17a(d, "title")))
add("fy_unique_year", lambda d: {"fiscal_year": fiscal.unique_year(d, "title")}, """
SELECT o_orderkey AS id, (CASE WHEN o_orderkey % 41 IN (0, 1, 4, 6, 7, 9, 10, 12, 13, 14, 15, 22, 24, 26, 28, 29, 31, 36, 39) THEN 2016 + o_orderkey % 9 WHEN o_orderkey % 41 = 30 THEN 2015 + o_orderkey % 9 END)::INTEGER AS fiscal_year FROM orders""")
add("fy_last_or_first", lambda d: {"fiscal_year": fiscal.last_or_first_year(d, "title", "period")})
add("score_singapore_pick", lambda d: {"score": text.singapore_pick(d, "title", "(pages * 40000)", "kind")})
add("annual_title", lambda d: {"annual": text.annual_title(d, "title")})
add("sitemap_reports", lambda d: _named("fiscal_year report_type", text.sitemap_report(d, "concat('https://x.example/', replace(title, ' ', '-'), '.pdf')")))
add("part_marks", lambda d: {"part": text.part_mark(d, "concat(title, ' part ', substring(kind, 1, 1), '_p3 vol 2')")})
add("fy_two_stages", lambda d: _named("fiscal_year confidence", fiscal.two_stages(d, "title", "title")))


#: Titles with some Arabic, and a file name with or without a mark of English.
_ARABIC = """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN repeat('تقرير ', cast(o_orderkey % 7 AS int)) || 'Board' WHEN 1 THEN 'Annual REPORT ' || repeat('س', cast(o_orderkey % 11 AS int)) WHEN 2 THEN '  ' ELSE 'Notice of the board' END AS title,
 CASE WHEN o_orderkey % 5 = 0 THEN 'x_EN.pdf' WHEN o_orderkey % 5 = 1 THEN 'English.pdf' WHEN o_orderkey % 5 = 2 THEN 'company.pdf' ELSE '' END AS name FROM orders"""


def detect_arabic_names(spark: SparkSession, sf: str) -> DataFrame:
    """Language and confidence of titles and file names; the SQL counts letters in its own way."""
    titles = spark.sql(_ARABIC.replace("FROM orders", "FROM {orders}"), orders=read(spark, sf, "orders"))
    return apply(titles, "id", {"language": text.middle_east_language(SPARK, "title", "name"), "confidence": text.middle_east_confidence(SPARK, "title", "name")})


family.add("detect_arabic_names", detect_arabic_names, f"""
WITH t AS ({_ARABIC}), u AS (SELECT id, lower(title || ' ' || name) AS x, len(list_filter(string_split(title, ''), lambda c: unicode(c) BETWEEN 1536 AND 1791)) / greatest(1, length(trim(title))) AS share FROM t),
v AS (SELECT id, share, x LIKE '%ar en%' OR x LIKE '%en\\_%' ESCAPE '\\' OR x LIKE '%\\_en%' ESCAPE '\\' OR x LIKE '%english%' AS mark, len(list_filter(['annual', 'report', 'financial', 'statements', 'company', 'board', 'auditor'], lambda w: instr(x, w) > 0)) AS words FROM u)
SELECT id, CASE WHEN mark THEN 'EN' WHEN share > 0.4 THEN 'AR' WHEN share > 0.1 THEN 'BILINGUAL' ELSE 'EN' END AS language, (CASE WHEN mark THEN 0.98 WHEN share > 0.4 THEN 0.95 WHEN share > 0.1 THEN 0.85 WHEN words >= 2 THEN 0.9 ELSE 0.7 END)::DOUBLE AS confidence FROM v""")
