"""Title, document and attachment classifiers. Each function gives SQL expressions over column names."""

from __future__ import annotations

from slotwise.functions.rules import Dialect, case, every, found, has, text, total

# ---- fixed values: words and patterns that decide the classes
TOPIC = r"environmental update|portfolio update|people.{0,8}communities|climate update|progress update"
INTEGRATED = r"integrated|business\s*(?:&|and)\s*(?:sustainability|esg)|annual report (?:and|&) accounts"
STANDALONE = r"sustainab|\besg\b|corporate (?:social )?responsibility|\bcsr\b|impact (?:report|summary)"
ACCOUNTS_EXCLUDED = (
    (r"\bdormant\b|accounts-with-accounts-type-dormant", "dormant_accounts"),
    (r"\bmicro[- ]?entity\b|accounts-with-accounts-type-micro-entity", "micro_entity_accounts"),
    (r"\babbreviated\b|accounts-with-accounts-type-abbreviated", "abbreviated_accounts"),
    (r"\babridged\b", "abridged_accounts"),
    (r"\bfilleted\b|accounts-with-accounts-type-filleted", "filleted_accounts"),
    (r"\btotal exemption\b|accounts-with-accounts-type-total-exemption-small", "total_exemption_small_accounts"),
    (r"\bsmall company\b|accounts-with-accounts-type-small", "small_company_accounts"),
    (r"\bunaudited\b|accounts-with-accounts-type-unaudited", "unaudited_accounts"),
    (r"\binterim accounts\b", "interim_accounts"),
    (r"\binitial accounts\b", "initial_accounts"),
    (r"\bchange of accounting reference date\b", "accounting_ref_date_change"),
)
ACCOUNTS_ELIGIBLE = (r"\bgroup of companies['’]?\s*accounts\b", r"\bfull accounts\b", r"accounts-with-accounts-type-group", r"accounts-with-accounts-type-full")
ACCOUNTS_FORMS_EXCLUDED = ("AA01", "AA02", "ARD")
AU_EXCLUDED = ("half year", "half-year", "interim", "quarterly", "appendix 4d", "appendix 4g", "corporate governance", "sustainability", "esg", "notice of annual general meeting", "notice of agm", "agm", "release and dispatch", "dispatch of", "supplementary information", "presentation", "results release", "results announcement")
AU_NOT_RESCUED = ("sustainability", "supplementary", "notice of", "release and dispatch", "agm")
AU_STRONG = ("annual report and financial statements", "annual report and financial statement", "annual report to shareholders", "annual report for year ended", "appendix 4e and annual report", "annual report and accounts")
AU_SR_EXCLUDED = ("half year", "half-year", "interim", "quarterly", "appendix 4d", "notice of annual general meeting", "notice of agm", "agm", "release and dispatch", "dispatch of", "supplementary information", "presentation", "investor presentation", "results release", "results announcement", "proxy form", "dividend", "distribution", "briefing")
AF_AR = (r"\bannual\s+report\s+(?:and|&)\s+financial\s+statements\b", r"\bintegrated\s+annual\s+report\b", r"\bannual\s+integrated\s+report\b", r"\bannual\s+report\s+(?:and|&)\s+accounts\b", r"\bannual\s+report\s+to\s+shareholders\b", r"\bannual\s+report\b", r"\bintegrated\s+report\b", r"\baudited\s+annual\s+financial\s+statements\b", r"\bannual\s+financial\s+statements\b")
AF_SR = (r"\bsustainability\s+report\b", r"\besg\s+report\b", r"\bcorporate\s+social\s+responsibility\s+report\b", r"\bcsr\s+report\b", r"\bclimate\s+(?:change\s+)?report\b", r"\bsustainability\s+review\b", r"\bsustainability\s+(?:and|&)\s+governance\s+report\b", r"\benvironmental(?:,|\s+and)?\s+social(?:,|\s+and)?\s+governance\b")
AF_EXCLUDED = (r"\bhalf[- ]?year(?:ly)?\b", r"\binterim\b", r"\bquarter(?:ly)?\b", r"\bq[1-4]\b", r"\bannual\s+general\s+meeting\b", r"\bagm\b", r"\bnotice\s+of\s+meeting\b", r"\bproxy\s+form\b", r"\bproxy\s+statement\b", r"\bcircular\b", r"\babridged\s+results\b", r"\bpress\s+release\b", r"\bdividend\s+announcement\b", r"\bpresentation\b", r"\bfactsheet\b", r"\bcorporate\s+governance\s+report\b", r"\bunaudited\b")
AF_NOT_RESCUED = (r"\bhalf[- ]?year\b", r"\binterim\b", r"\bquarter\b", r"\bagm\b", r"\bproxy\b")
ME_INTERIM = (r"\b(?:half[-\s]?year|semi[-\s]?annual|hy\b|h1\b|h2\b)", r"\b(?:first|second|third|fourth)\s+quarter", r"\b(?:1st|2nd|3rd|4th)\s+quarter", r"\b(?:q1|q2|q3|q4)\b", r"\binterim\b", r"\bquarterly\b")
ME_NOTICE = (r"\bagm\b", r"\begm\b", r"\bnotice\s+of\s+(?:annual\s+general\s+)?meeting\b", r"\bproxy\s+form\b", r"\bcircular\b", r"\bdividend\s+announcement\b", r"\bpress\s+release\b", r"\bpresentation\b", r"\bfactsheet\b")
ME_GOVERNANCE = (r"\bcorporate\s+governance\s+report\b", r"\bgovernance\s+report\b", r"\bboard\s+of\s+directors\s+report\b")
ME_ESG = (r"\bsustainability\s+report\b", r"\besg\s+report\b", r"\bcsr\s+report\b", r"\bclimate\s+report\b")
ME_FULL = (r"\bannual\s+report\s+and\s+(?:audited\s+)?financial\s+statements\b", r"\bintegrated\s+(?:annual\s+)?report\b", r"\bannual\s+report\b", r"\bannual\s+integrated\s+report\b", r"\bar\s+en\b", r"\bannual\s+financial\s+report\b")
ME_STATEMENTS = (r"\baudited\s+financial\s+statements\b", r"\bannual\s+financial\s+statements\b", r"\bfinancial\s+statements\s+for\s+the\s+year\s+ended\b", r"\bindependent\s+auditor'?s\s+report\s+and\s+financial\s+statements\b", r"\bfinancial\s+statements\b", r"\bfinancial\s+report\b")
CA_EXCLUDED = (r"annual return", r"annual information form", r"management information circular", r"proxy", r"notice of meeting", r"agm", r"sustainab", r"esg", r"climate", r"quarter", r"interim", r"financial statements only", r"md&a", r"management discussion", r"presentation", r"news release")
IN_EXCLUDED = ("annual return", "secretarial compliance", "secretarial audit", "business responsibility", "brsr", "sustainability report", "esg report", "corporate governance report", "newspaper", "scrutinizer", "voting result", "postal ballot", "notice of agm", "agm notice", "investor presentation", "transcript", "earnings call", "shareholding pattern", "financial results")
BD_EXCLUDED = ("interim", "half year", "half-year", "quarter", "q1", "q2", "q3", "quarterly", "annual meeting", "agm", "egm", "notice of meeting", "proxy", "presentation", "sustainability report", "esg report", "brsr", "corporate governance", "annual return", "director report", "dividend", "price sensitive", "audit committee report")
BD_POSITIVE = ("annual report", "annual report and financial statements", "annual financial report", "annual report & financial statements", "audited annual report")
NZ_EXCLUDED = ("interim", "half year", "half-year", "quarter", "annual meeting", "agm", "notice of meeting", "presentation", "investor presentation", "sustainability report", "climate statement", "climate report", "esg report", "corporate governance statement", "annual return", "distribution notice", "results announcement")
NZ_POSITIVE = ("annual report", "annual financial report", "annual report and financial statements", "statutory annual report")
SG_REJECT_SR = ("appendix", "circular", "proxy", "agm", "notice", "letter", "requestform", "informationstatement")
SG_REJECT_AR = ("sustainability", "esg", "appendix", "circular", "proxy", "agm", "notice", "letter", "requestform", "informationstatement")
PH_SR = ("sustainability", "esg", "csr", "social responsibility", "climate", "environment")
PH_OTHER = ("quarter", "17-q", "governance", "information statement", "agm", "proxy", "notice", "minutes")
PH_FULL = ("17-a", "annual report", "annual_report", "annual-report")
PH_COMPONENT = ("financial statement", "audited financial", "supplementary schedule", "auditor", "afs")
HK_PENALISED = ("supplement", "notification", "request form")
HK_CJK = ("年報", "年度報告", "年度报告")
SG_REJECT_TERMS = ("clarification", "corrigendum", "analysis", "shareholding", "notice", "proxy", "letter", "requestform", "request form", "market research", "addendum", "errata", "press release", "highlights", "presentation", "factsheet", "circular", "agm", "appendix", "statement", "summary")
UK_TITLE_EXCLUDED = ("half", "interim", "quarter", "proxy", "notice", "agm", "result of", "award", "statement", "availability", "convening")
UK_TITLE_WANTED = ("annual", "accounts", "financial report", "report and accounts")
SITEMAP_REPORT = r"(?:annual|integrated|sustainability|esg|csr|climate|tcfd|databook).*(?:201[7-9]|202[0-5]).*\.pdf"
SITEMAP_SR = ("sustain", "esg", "csr", "climate", "tcfd", "databook")


def squeezed(d: Dialect, t: str) -> str:
    """t in lower case, white space collapsed and trimmed."""
    return f"trim(regexp_replace(lower({t}), {d.re(chr(92) + 's+')}, ' '{_all(d)}))"


def _all(d: Dialect) -> str:
    return "" if d.raw else ", 'g'"


def sustainability(d: Dialect, title: str, kind: str) -> tuple[str, str]:
    """Class and sub-code from title and kind: topic, then integrated, then standalone, else review."""
    t = f"concat_ws(' ', {title}, {kind})"
    topic, integrated, alone = (found(d, t, p) for p in (TOPIC, INTEGRATED, STANDALONE))
    code = case([(has(f"lower({t})", ("environment", "climate")), "'CLIMATE'")], "'OTHER'")
    return case([(topic, "'TOPIC_UPDATE'"), (integrated, "'INTEGRATED_REPORT'"), (alone, "'STANDALONE_SR'")], "'MANUAL_REVIEW'"), case([(topic, f"({code})"), (integrated, "'IR'"), (alone, "'SR'")], "'OTHER'")


def accounts(d: Dialect, form: str, description: str, period_end: str, has_pdf: str, pages: str, amended: str) -> tuple[str, str]:
    """AR, REVIEW or EXCLUDED and the reason for an accounts filing; the first rule that holds decides."""
    ft, desc = f"upper(trim(coalesce({form}, '')))", f"trim(coalesce({description}, ''))"
    rules = [(f"{ft} IN ({', '.join(map(text, ACCOUNTS_FORMS_EXCLUDED))})", "EXCLUDED", f"concat('non_accounts_form:', {ft})")]
    rules += [(found(d, desc, p), "EXCLUDED", text(reason)) for p, reason in ACCOUNTS_EXCLUDED]
    rules += [
        (f"coalesce({period_end}, '') = ''", "REVIEW", "'missing_period_end_date'"),
        (f"NOT coalesce({has_pdf}, false)", "EXCLUDED", "'pdf_unavailable'"),
        (f"(coalesce({amended}, false) OR contains(lower({desc}), 'amend') OR {ft} = 'AAMD')", "REVIEW", "'amended_accounts_requires_review'"),
        (f"NOT ({found(d, desc, ACCOUNTS_ELIGIBLE)} OR {ft} = 'AA')", "REVIEW", f"concat('unconfirmed_accounts_subtype:', substring({desc}, 1, 80))"),
        (f"({pages} > 0 AND {pages} < 8)", "REVIEW", f"concat('short_page_count:', cast({pages} AS {'string' if d.raw else 'varchar'}))"),
    ]
    return case([(c, text(s)) for c, s, _ in rules], "'AR'"), case([(c, r) for c, _, r in rules], "''")


def _pages(pages: str, tiers: list[tuple[str, float]]) -> str:
    return case([(f"{pages} {c}", str(w)) for c, w in tiers], "0")


def australia(d: Dialect, title: str, pages: str) -> tuple[str, str, str, str]:
    """Annual score, sustainability type and score, and the class that follows from them."""
    t = squeezed(d, title)
    gone = f"({has(t, AU_EXCLUDED)} AND (NOT contains({t}, 'annual report') OR {has(t, AU_NOT_RESCUED)}))"
    base = case([(gone, "-100"), (has(t, AU_STRONG), "100"), (has(t, ["annual report"]), "85"), (has(t, ["annual financial report"]), "80"), (has(t, ["full year financial report", "full-year financial report"]), "55"), (found(d, t, r"\bfinancial report\b"), "35")], "-100")
    extra = f"{total([(f'{has(t, ['appendix 4e'])} AND {has(t, ['annual report'])}', 10)])} + {_pages(pages, [('>= 40', 12), ('>= 20', 5), ('<= 5', -35)])}"
    annual = f"(CASE WHEN ({base}) = -100 THEN -100 ELSE ({base}) + {extra} END)"
    no_sr = f"({has(t, AU_SR_EXCLUDED)} OR contains({t}, 'annual general meeting'))"
    tiers = [
        (no_sr, None, -100),
        (has(t, ["sustainability report", "sustainability review"]), "SR", 90),
        (has(t, ["sustainability and social impact", "corporate sustainability"]), "SR", 90),
        (has(t, ["esg report", "environment, social and governance", "environmental, social and governance"]), "ESG", 90),
        (has(t, ["climate transition action plan", "climate report", "climate change report"]), "CLIMATE", 85),
        (has(t, ["modern slavery statement", "modern slavery report"]), "SR", 85),
        (has(t, ["corporate responsibility report"]), "SR", 80),
        (f"({has(t, ['sustainability'])} AND {has(t, ['report'])})", "SR", 75),
    ]
    kind = case([(c, text(k) if k else "NULL") for c, k, _ in tiers])
    sr = f"(CASE WHEN ({kind}) IS NULL THEN -100 ELSE {case([(c, str(w)) for c, _, w in tiers], '-100')} + {_pages(pages, [('>= 20', 10), ('<= 3', -30)])} END)"
    return annual, f"({kind})", sr, case([(f"{annual} > 0", "'AR'"), (f"{sr} > 0", f"({kind})")])


def africa(d: Dialect, title: str, url: str, pages: str) -> tuple[str, str]:
    """C4: label (AR, SR, OTHER) and score; negatives with a rescue, then sustainability, then tiers, clamped."""
    t = f"lower(trim(concat_ws(' ', {title}, {url})))"
    rescued = f"({has(t, ['integrated annual report', 'annual report and financial statements'])} AND NOT {found(d, t, AF_NOT_RESCUED)})"
    out = f"({found(d, t, AF_EXCLUDED)} AND NOT {rescued})"
    sr = f"({found(d, t, AF_SR)} AND NOT {has(t, ['integrated annual report', 'annual integrated report'])})"
    tier = case([(found(d, t, AF_AR), "90"), (f"({found(d, t, chr(92) + 'bannual' + chr(92) + 'b')} AND {found(d, t, chr(92) + 'bfinancials?' + chr(92) + 'b')})", "65"), (found(d, t, r"\bannual\b"), "45")], "0")
    sr_score = f"(90 + {_pages(pages, [('>= 20', 10), ('<= 5', -35)])})"
    ar_score = f"(({tier}) + {_pages(pages, [('>= 40', 10), ('>= 20', 5), ('<= 5', -35)])})"
    label = case([(out, "'OTHER'"), (sr, "'SR'"), (f"({tier}) = 0", "'OTHER'"), (f"{ar_score} >= 50", "'AR'")], "'OTHER'")
    return label, case([(out, "-100"), (sr, f"least(100, greatest(0, {sr_score}))"), (f"({tier}) = 0", "0")], f"least(100, greatest(0, {ar_score}))")


def middle_east(d: Dialect, title: str, url: str, tag: str) -> tuple[str, str]:
    """One of five document classes and its confidence."""
    t = f"lower(concat_ws(' ', {title}, {url}, {tag}))"
    report = found(d, t, r"annual\s+report")
    rules = [
        (f"({found(d, t, ME_INTERIM)} OR {found(d, t, ME_NOTICE)})", "REJECT", 0.95),
        (f"({found(d, t, ME_GOVERNANCE)} AND NOT {report})", "GOVERNANCE_COMPONENT", 0.9),
        (f"({found(d, t, ME_ESG)} AND NOT {report})", "ESG_COMPONENT", 0.9),
        (found(d, t, ME_FULL), "AR_FULL", 0.95),
        (found(d, t, ME_STATEMENTS), "ANNUAL_FS_COMPONENT", 0.9),
        (f"({has(t, ['annual'])} AND {has(t, ['report'])})", "AR_FULL", 0.8),
    ]
    return case([(c, text(k)) for c, k, _ in rules], "'REJECT'"), f"cast({case([(c, str(w)) for c, _, w in rules], '0.5')} AS double)"


# fixed values: marks of English names, words of English reports
ME_ENGLISH, ME_REPORT_WORDS = ("ar en", "en_", "_en", "english"), ("annual", "report", "financial", "statements", "company", "board", "auditor")


def _arabic_share(d: Dialect, t: str) -> str:
    return f"({d.call('size', every(d, t, '[؀-ۿ]', 0, ''))} / greatest(1, length(trim({t}))))"


def middle_east_language(d: Dialect, t: str, name: str) -> str:
    """EN, AR or BILINGUAL by marks in the name and the share of Arabic letters."""
    share = _arabic_share(d, t)
    return case([(has(f"lower(concat_ws(' ', {t}, {name}))", ME_ENGLISH), "'EN'"), (f"{share} > 0.4", "'AR'"), (f"{share} > 0.1", "'BILINGUAL'")], "'EN'")


def middle_east_confidence(d: Dialect, t: str, name: str) -> str:
    """How sure the language is: by a mark, by the letters, by two report words at least, or by default."""
    all_, share = f"lower(concat_ws(' ', {t}, {name}))", _arabic_share(d, t)
    return f"cast({case([(has(all_, ME_ENGLISH), '0.98'), (f'{share} > 0.4', '0.95'), (f'{share} > 0.1', '0.85'), (total([(has(all_, [w]), 1) for w in ME_REPORT_WORDS]) + ' >= 2', '0.9')], '0.7')} AS double)"


def canada_language(d: Dialect, title: str, url: str, declared: str) -> str:
    """EN or FR; a declared language overrides."""
    known = f"upper(trim(coalesce({declared}, '')))"
    return case([(f"{known} IN ('EN', 'ENG', 'ENGLISH')", "'EN'"), (f"{known} IN ('FR', 'FRE', 'FRA', 'FRENCH', 'FRANCAIS', 'FRANÇAIS')", "'FR'"), (found(d, f"lower(concat_ws(' ', {title}, {url}))", r"rapport annuel|français|francais|_fr\b|-fr\b"), "'FR'")], "'EN'")


def canada(d: Dialect, title: str, url: str) -> str:
    """Additive title score; 30 is enough."""
    t = f"lower(concat_ws(' ', {title}, {url}))"
    score = total([(found(d, t, r"\bannual report\b"), 80), (found(d, t, r"\breport to shareholders\b"), 55), (found(d, t, r"\bintegrated annual report\b"), 60), (found(d, t, r"\bannual\b"), 15), (f"lower({url}) LIKE '%.pdf'", 10)])
    return case([(found(d, t, CA_EXCLUDED), "-100")], score)


def india(d: Dialect, title: str) -> str:
    """Additive title score; 90 is enough."""
    t = squeezed(d, title)
    score = total([(has(t, ["annual report"]), 100), (has(t, ["integrated annual report", "integrated report"]), 105), (has(t, ["reg. 34", "regulation 34"]), 25), (has(t, ["financial year", "year ended"]), 10), (has(t, ["revised"]), -10)])
    return case([(has(t, IN_EXCLUDED), "-100")], score)


def bangladesh(d: Dialect, title: str) -> str:
    """Title score; 5 is enough."""
    t = f"lower({title})"
    score = total([(has(t, BD_POSITIVE), 6), (found(d, t, r"annual\s*report[_\-\s]*(?:20)?[0-9]{2}"), 2), (f"({has(t, ['audited financial statements'])} AND {has(t, ['annual'])})", 2), (f"({has(t, ['annual report'])} AND {has(t, ['revised', 'amended', 'updated'])})", 0.5)], 0.0)
    return f"cast({case([(has(t, ['annual return']), '-5.0'), (f'({has(t, BD_EXCLUDED)} AND NOT {has(t, ["annual report"])})', '-2.0')], score)} AS double)"


def new_zealand(d: Dialect, title: str, kind: str) -> str:
    """Title score with a bonus for the announcement type; 5 is enough."""
    t = f"lower({title})"
    score = total([(f"upper({kind}) = 'ANNREP'", 5), (has(t, NZ_POSITIVE), 5), (has(t, ["audited financial statements"]), 1), (f"({has(t, ['annual shareholder review'])} AND NOT {has(t, ['annual report'])})", -2), (has(t, ["updated", "amended"]), 0.5)], 0.0)
    return f"cast({case([(f'({has(t, NZ_EXCLUDED)} AND NOT {has(t, ["annual report"])})', '-1.0')], score)} AS double)"


def hong_kong(d: Dialect, title: str, long_text: str, file_type: str, info: str, year: str, size: str) -> str:
    """C11: candidate score; size in bytes counts up to 12 by its logarithm."""
    t, more = f"lower({title})", f"lower({long_text})"
    score = total([(has(more, ["annual report"]), 100), (has(t, ["annual report"]), 40), (has(t, HK_CJK), 40), (f"contains({t}, cast({year} AS {'string' if d.raw else 'varchar'}))", 25), (f"upper({file_type}) = 'PDF'", 20), (has(t, HK_PENALISED), -60), (has(t, ["summary"]), -20), (has(f"lower({info})", ["multi"]), -25)], 0.0)
    return f"({score} + CASE WHEN {size} > 0 THEN least(12.0, log10({size} + 1)) ELSE 0 END)"


def singapore(d: Dialect, name: str, year: str, kind: str) -> str:
    """Attachment score for the report type asked for."""
    low = f"lower({name})"
    n = f"regexp_replace({low}, {d.re('[^a-z0-9]+')}, ''{_all(d)})"
    year_in = f"contains({name}, cast({year} AS {'string' if d.raw else 'varchar'}))"
    sr = case([(has(n, ["sustainabilityreport"]), "130"), (has(n, ["sustainability", "sustainable"]), "100"), (has(n, ["esg", "csr"]), "90"), (has(n, ["climate", "tcfd", "gri"]), "70")], "0")
    sr = f"({sr}) + {total([(year_in, 20), (f'({has(n, ["annualreport"])} AND NOT {has(n, ["sustain"])})', -100), (has(n, SG_REJECT_SR), -150)])}"
    ar = case([(has(n, ["annualreport"]), "120"), (found(d, low, r"(?:^|[^a-z])ar\s*20[0-9]{2}"), "90"), (f"({has(n, ['annual'])} AND {has(n, ['report'])})", "80")], "0")
    ar = f"({ar}) + {total([(year_in, 20), (has(n, ['financialstatements', 'financialreport']), 15), (has(n, ['integratedreport']), 20), (has(n, SG_REJECT_AR), -150)])}"
    return f"CASE WHEN upper(trim({kind})) = 'SR' THEN {sr} ELSE {ar} END"


def philippines(d: Dialect, label: str) -> str:
    """C14: attachment class."""
    t = f"lower(trim(coalesce({label}, '')))"
    return case([(has(t, PH_SR), "'SR'"), (has(t, PH_OTHER), "'OTHER'"), (has(t, PH_FULL), "'AR_FULL'"), (has(t, PH_COMPONENT), "'AR_COMPONENT'")], "'REVIEW'")


def report_type(d: Dialect, name: str) -> str:
    """IR, SR or AR by a file name or title."""
    t = f"lower({name})"
    return case([(has(t, ["integrated"]), "'IR'"), (has(t, ["sustain", "sr", "esg", "climate"]), "'SR'")], "'AR'")


def source_format(d: Dialect, url: str) -> str:
    """Format by the address's ending."""
    u = f"lower({url})"
    return case([(f"{u} LIKE '%.pdf'", "'pdf'"), (f"({u} LIKE '%.htm' OR {u} LIKE '%.html')", "'html'"), (f"{u} LIKE '%.zip'", "'zip'")], "'other'")


def singapore_pick(d: Dialect, name: str, size: str, kind: str) -> str:
    """Score for choosing among attachments: language, rejected terms (each counts), title, resolution, size."""
    t = f"lower({name})"
    whole = "bigint"
    chinese = f"({found(d, t, r'[-_ ]c(?:hi|hinese|[.]pdf|_|' + chr(92) + 'b)')} OR {t} LIKE 'c_%' AND substring({t}, 2, 1) = '_' OR {has(t, ['cisdn', 'mandarin', 'chinese'])})"
    english = f"({found(d, t, r'[-_ ]e(?:ng|nglish|[.]pdf|_|' + chr(92) + 'b)')} OR {t} LIKE 'e_%' AND substring({t}, 2, 1) = '_' OR {has(t, ['eisdn', 'english'])})"
    ar, sr = f"({kind} = 'AR')", f"({kind} = 'SR')"
    title = has(t, ["annual report", "annual_report", "annualreport"])
    weights = [(chinese, -2000), (english, 300), *[(has(t, [x]), -500) for x in SG_REJECT_TERMS], (f"({ar} AND {title})", 250), (f"({ar} AND NOT {title} AND {has(t, ['ar20', 'ar 20'])})", 180), (f"({sr} AND {has(t, ['sustainability', 'sustainable'])})", 250), (f"({sr} AND {has(t, ['esg', 'csr'])})", 180), (has(t, ["low res", "lowres"]), -50), (has(t, ["high res", "hires", "hi-res"]), 50)]
    return f"({total(weights)} + cast(least(150, floor(coalesce({size}, 0) / 102400)) AS {whole}))"


def annual_title(d: Dialect, title: str) -> str:
    """Whether a title is an annual report's."""
    t = f"lower({title})"
    return f"(NOT {has(t, UK_TITLE_EXCLUDED)} AND {has(t, UK_TITLE_WANTED)})"


def sitemap_report(d: Dialect, url: str) -> tuple[str, str]:
    """C17: year and type of an address that looks like a report's, else NULL."""
    t = f"lower({url})"
    ok = found(d, t, SITEMAP_REPORT)
    year = f"cast(nullif(regexp_extract({t}, {d.re('(201[7-9]|202[0-5])')}, 1), '') AS int)"
    return f"CASE WHEN {ok} THEN {year} END", f"CASE WHEN {ok} THEN {case([(has(t, ['integrated']), chr(39) + 'IR' + chr(39)), (has(t, SITEMAP_SR), chr(39) + 'SR' + chr(39))], chr(39) + 'AR' + chr(39))} END"


def part_mark(d: Dialect, name: str) -> str:
    """C20: the part that a file name says it is (part 2, _p2, volume 2), else NULL."""
    marks = [f"nullif(regexp_extract(lower({name}), {d.re('(' + p + ')')}, 1), '')" for p in (r"part\s*[1-9]", r"_p[1-9]\b", r"vol(?:ume)?\s*[1-9]")]
    return f"coalesce({', '.join(marks)})"
