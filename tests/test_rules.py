"""Golden rows of the rule packs."""

import datetime

import pytest

from slotwise.functions import fiscal, text
from slotwise.functions.rules import SPARK


def run(spark, values, expressions):
    df = spark.createDataFrame([tuple(v for v, _ in values.values())], ", ".join(f"{k} {t}" for k, (_, t) in values.items()))
    return tuple(df.selectExpr(*expressions).first())


def titled(spark, title, pack, **more):
    values = {"title": (title, "string"), **more}
    out = pack(values)
    return run(spark, values, out if isinstance(out, tuple) else (out,))


def date(s):
    return (datetime.date.fromisoformat(s) if s else None, "date")


@pytest.mark.parametrize("title, kind, want", [
    ("Microsoft 2019 CSR Annual Report", "CSR", ("STANDALONE_SR", "SR")),
    ("Business & Sustainability Report", "Integrated", ("INTEGRATED_REPORT", "IR")),
    ("2024 Environmental Update", "Sustainability", ("TOPIC_UPDATE", "CLIMATE")),
    ("People and communities", "", ("TOPIC_UPDATE", "OTHER")),
    ("Annual", "", ("MANUAL_REVIEW", "OTHER")),
])
def test_sustainability(spark, title, kind, want):
    assert titled(spark, title, lambda _: text.sustainability(SPARK, "title", "kind"), kind=(kind, "string")) == want


@pytest.mark.parametrize("form, description, pages, want", [
    ("AA", "Group of companies' accounts made up to 31 December 2024", 280, ("AR", "")),
    ("AA", "Accounts for a dormant company", 3, ("EXCLUDED", "dormant_accounts")),
    ("AA", "Micro-entity accounts", 3, ("EXCLUDED", "micro_entity_accounts")),
    ("AA", "Total exemption small company accounts", 5, ("EXCLUDED", "total_exemption_small_accounts")),
    ("AA01", "Change of accounting reference date", 1, ("EXCLUDED", "non_accounts_form:AA01")),
    ("AAMD", "Amended group accounts", 100, ("REVIEW", "amended_accounts_requires_review")),
    ("AA", "Full accounts", 4, ("REVIEW", "short_page_count:4")),
    ("XX", "Something", 40, ("REVIEW", "unconfirmed_accounts_subtype:Something")),
])
def test_accounts(spark, form, description, pages, want):
    got = titled(spark, description, lambda _: text.accounts(SPARK, "form", "title", "'2024-12-31'", "true", "pages", "false"), form=(form, "string"), pages=(pages, "int"))
    assert got == want


def test_accounts_without_pdf_or_period(spark):
    assert titled(spark, "Full accounts", lambda _: text.accounts(SPARK, "'AA'", "title", "'2024-12-31'", "false", "9", "false")) == ("EXCLUDED", "pdf_unavailable")
    assert titled(spark, "Full accounts", lambda _: text.accounts(SPARK, "'AA'", "title", "''", "false", "9", "false")) == ("REVIEW", "missing_period_end_date")


def test_australia_scores(spark):
    def pack(_):
        return text.australia(SPARK, "title", "pages")

    assert titled(spark, "FY25 Annual Report and Financial Statements", pack, pages=(137, "int"))[0] > 90
    assert titled(spark, "Release and dispatch of 2025 Annual Report", pack, pages=(2, "int"))[0] < 0
    assert titled(spark, "Modern slavery statement", pack, pages=(2, "int")) == (-100, "SR", 55, "SR")


@pytest.mark.parametrize("title, label", [("Integrated Annual Report 2023", "AR"), ("Sustainability Report 2022", "SR"), ("Half-year results", "OTHER"), ("Notice of Annual General Meeting", "OTHER"), ("Annual accounts", "OTHER"), ("Annual financials", "AR")])
def test_africa_labels(spark, title, label):
    assert titled(spark, title, lambda _: text.africa(SPARK, "title", "''", "pages"), pages=(None, "int"))[0] == label


@pytest.mark.parametrize("title, kind", [("Annual Report 2023", "AR_FULL"), ("Audited Financial Statements", "ANNUAL_FS_COMPONENT"), ("Corporate Governance Report", "GOVERNANCE_COMPONENT"), ("ESG Report", "ESG_COMPONENT"), ("AGM Notice", "REJECT"), ("Q3 results", "REJECT"), ("ar en 2020", "AR_FULL")])
def test_middle_east_classes(spark, title, kind):
    assert titled(spark, title, lambda _: text.middle_east(SPARK, "title", "''", "''"))[0] == kind


def test_languages(spark):
    assert titled(spark, "التقرير السنوي", lambda _: text.middle_east_language(SPARK, "title", "''")) == ("AR",)
    assert titled(spark, "Annual report التقرير", lambda _: text.middle_east_language(SPARK, "title", "''")) == ("BILINGUAL",)
    assert titled(spark, "Rapport annuel 2024", lambda _: text.canada_language(SPARK, "title", "''", "''")) == ("FR",)
    assert titled(spark, "Rapport annuel 2024", lambda _: text.canada_language(SPARK, "title", "''", "'en'")) == ("EN",)


@pytest.mark.parametrize("label, want", [("Sustainability Report", "SR"), ("SEC Form 17-Q", "OTHER"), ("SEC Form 17-A", "AR_FULL"), ("Audited Financial Statements", "AR_COMPONENT"), ("Cover", "REVIEW"), (None, "REVIEW")])
def test_philippines(spark, label, want):
    assert run(spark, {"title": (label, "string")}, (text.philippines(SPARK, "title"),)) == (want,)


AFRICA = [("Annual Report FY2024", "", 2024), ("Integrated Report FY23", "", 2023), ("Annual Report 2023/24", "", 2024), ("Audited Accounts 2022-2023", "", 2023), ("Accounts for the year ended 31 December 2022", "", 2022), ("x", "2023-12-31", 2023), ("Annual Report 2021", "", 2021), ("2020 Integrated Annual Report", "", 2020), ("Report", "", None)]


@pytest.mark.parametrize("title, period, year", AFRICA)
def test_africa_years(spark, title, period, year):
    got = titled(spark, title, lambda _: fiscal.africa(SPARK, "title", "period", "published"), period=(period, "string"), published=date(None))
    assert got[0] == year and (not period or got[1] == 1.0)


@pytest.mark.parametrize("title, period, want", [
    ("", "2023-12-31", (2023, 0.99, "EXPLICIT_PERIOD_END_ISO")), ("", "31/12/2024", (2024, 0.99, "EXPLICIT_PERIOD_END_DMY")), ("", "31 December 2022", (2022, 0.99, "EXPLICIT_PERIOD_END_TEXT")),
    ("Annual Report 2022-23", "", (2023, 0.92, "YEAR_RANGE_SHORT")), ("Arab Bank Annual Report 2021", "", (2021, 0.85, "TITLE_STANDALONE_YEAR")), ("General Disclosure Document", "", (None, 0.0, "unresolved")),
])
def test_middle_east_years(spark, title, period, want):
    assert titled(spark, title, lambda _: fiscal.middle_east(SPARK, "title", "period", "published"), period=(period, "string"), published=date(None)) == want


@pytest.mark.parametrize("title, day, want", [("FY25 Annual Report", "2025-09-01", (2025, "title_fy2")), ("Annual Report", "2026-03-01", (2025, "publication_heuristic_prev")), ("Annual Report", "2025-09-01", (2025, "publication_heuristic_same")), ("Annual Report for year ended 31 December 2024 - lodged 2025", "2025-03-01", (2024, "title_year_ended"))])
def test_australia_years(spark, title, day, want):
    got = titled(spark, title, lambda _: fiscal.australia(SPARK, "title", "day"), day=date(day))
    assert (got[0], got[2]) == want


def test_hong_kong_years(spark):
    def year(title, day):
        return titled(spark, title, lambda _: fiscal.hong_kong(SPARK, "title", "day"), day=date(day))

    assert year("ANNUAL REPORT 2024", "2025-04-30") == (2024, 1.0, "title")
    assert year("ANNUAL REPORT", "2025-04-30") == (2024, 0.5, "publication_heuristic")
    assert year("2023 2024", "2025-04-30")[0] == 2024


@pytest.mark.parametrize("title, year", [("Annual Report 2024-25", 2025), ("FY2023", 2023), ("year ended March 31, 2022", 2022), ("Report", None)])
def test_india_years(spark, title, year):
    assert titled(spark, title, lambda _: fiscal.india(SPARK, "title"))[0] == year


@pytest.mark.parametrize("pack, title, year", [("bangladesh", "Annual Report 2024-25", 2025), ("bangladesh", "2023-2024", 2024), ("bangladesh", "FY22 Annual Report", 2022), ("new_zealand", "FY25 Annual Report", 2025), ("new_zealand", "for the year ended 31 March 2024", 2024), ("new_zealand", "Annual Report - 2019", 2019)])
def test_explicit_years(spark, pack, title, year):
    assert titled(spark, title, lambda _: getattr(fiscal, pack)(SPARK, "title", "cast(null AS int)"))[0] == year


def test_other_years(spark):
    canada = titled(spark, "Report", lambda _: fiscal.canada(SPARK, "title", "period", "day"), period=("2024-12-31", "string"), day=date("2025-03-01"))
    assert canada[0] == 2024
    assert titled(spark, "Annual Report 2023", lambda _: fiscal.canada(SPARK, "title", "''", "day"), day=date(None))[::2] == (2023, "title")
    assert [titled(spark, t, lambda _: fiscal.sri_lanka(SPARK, "title"))[0] for t in ("2024", "2024/2025", "2023-24", "none")] == [2024, 2025, 2024, None]
    assert titled(spark, "For the fiscal year ended Dec 31, 2017", lambda _: fiscal.form_17a(SPARK, "title"))[0] == 2017
    assert [titled(spark, t, lambda _: fiscal.unique_year(SPARK, "title"))[0] for t in ("a 2020 b 2020", "2020 2021")] == [2020, None]


def test_ranges_carry_the_century_in_india(spark):
    from slotwise.functions import fiscal, rules

    year, _, _ = fiscal.india(rules.SPARK, "t")
    df = spark.createDataFrame([("Annual Report 2099-00",), ("2023-24",), ("2023-25",), ("2023-2023",)], "t string")
    assert [r[0] for r in df.selectExpr(year).collect()] == [2100, 2024, None, 2023]


def test_shared_matches_change_nothing(spark):
    """A pack gives the same with its matches taken out of its columns."""
    from slotwise.functions import rules, text

    df = spark.createDataFrame([(i, t, "https://x.example/a.pdf", i % 60) for i, t in enumerate(["Annual Report 2024", "ESG Report", None, "Integrated annual report", "Notice of AGM (it's) 2023"])], "id int, title string, url string, pages int")
    label, score = text.africa(rules.SPARK, "title", "url", "pages")
    got = rules.apply(df, "id", {"label": label, "score": score}).orderBy("id").collect()
    assert got == df.selectExpr("id", f"{label} AS label", f"{score} AS score").orderBy("id").collect()
    texts, matches, outer = rules.shared({"label": label, "score": score})
    assert matches and all(sum(m in x for x in outer.values()) for m in matches)
