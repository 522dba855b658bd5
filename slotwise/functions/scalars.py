"""Scalar functions: names, identifiers, paths, sizes, dates, addresses. All are Column expressions
inside code generation, but for the few that Spark has no built-in for, which are Arrow UDFs."""

from __future__ import annotations

import difflib
import html
import ipaddress
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

# ---- fixed values
UK_LEGAL = r"\b(PUBLIC LIMITED COMPANY|P\.?L\.?C\.?|LIMITED|LTD\.?|GROUP|HOLDINGS?|THE|AND|&|UK|U\.K\.)\b"
STOP_WORDS = ("PLC", "PUBLIC", "LIMITED", "LTD", "GROUP", "HOLDINGS", "CORP", "CORPORATION", "THE")
MISSING = ("", "NA", "N/A", "NONE", "UNKNOWN", "NULL")
COUNTRIES = {"US": "USA", "USA": "USA", "UNITED STATES": "USA", "UNITED STATES OF AMERICA": "USA", "UK": "GBR", "GB": "GBR", "GBR": "GBR", "UNITED KINGDOM": "GBR", "GREAT BRITAIN": "GBR"}
FORMULA_MARKS = ("=", "+", "-", "@", "\t", "\r")
LEI, ISIN, ISIN_CHECKED, MIC = r"^[A-Z0-9]{20}$", r"^[A-Z]{2}[A-Z0-9]{10}$", r"^[A-Z]{2}[A-Z0-9]{9}[0-9]$", r"^[A-Z0-9]{4}$"
FISCAL_YEAR, TICKER = r"^FY(?:19|20|21)[0-9]{2}$", r"^[A-Z0-9.-]{1,16}$"
REPORT_TYPES = ("AR", "SR", "ESG", "IR", "CLIMATE", "TCFD", "CDP", "STR", "BRR", "ASSUR", "GHG", "10K", "20F", "ASR", "MODS", "GGR", "OTHER")
PATH_FIELDS = ("filePath", "path", "file", "url", "link", "downloadUrl", "attachment", "fileName", "pdfPath")
#: What a name, a security type or an industry says of listings that are no companies.
NOT_COMPANIES = (r"\bETF\b", r"EXCHANGE[- ]TRADED", r"\bETP\b", r"\bCDR\b", r"CANADIAN DEPOSITARY RECEIPT", r"CLOSED[- ]END FUND", r"INVESTMENT FUND", r"MUTUAL FUND", r"\bSPAC\b", r"CAPITAL POOL COMPANY")
MAIN_BOARD, VENTURE, NEXT = "XTSE", "XTSX", "XTNX"
FORMS = {"10-K": "10K", "20-F": "20F"}
PERMANENT_ERRORS, PERMANENT_MARK = ("encrypted PDF requires a password", "response is not a PDF"), "exceeds max_mib"
MISSING_BOTH, MISSING_ISIN, MISSING_LEI = "Missing both LEI and ISIN", "Missing valid ISIN", "Missing valid LEI"
CRN = r"^(?:[0-9]{8}|(?:SC|NI|OC|SO|NC|RO|RC|IC|SI|NP|NO|LP|SL|NL|CE|CS|PC|RS|SR|IP|SP|ES)[0-9]{6})$"


def nonempty(c: Column) -> Column:
    """c, or NULL where it is blank."""
    return F.when(F.trim(c) != "", c)


def coalesce_nonempty(*cols: Column) -> Column:
    return F.coalesce(*map(nonempty, cols))


def is_missing(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit("")))).isin(*MISSING)


# ---------------------------------------------------------------- names


def uk_name(c: Column) -> Column:
    """Upper case, without /NEW/, brackets, legal forms and signs."""
    x = F.regexp_replace(F.upper(c), r"/NEW/?$", "")
    x = F.regexp_replace(F.regexp_replace(x, r"\(.*?\)", " "), UK_LEGAL, " ")
    return F.trim(F.regexp_replace(x, r"[^A-Z0-9]+", " "))


def without_words(c: Column, words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Upper-case tokens that aren't stop words, joined by a blank."""
    parts = F.split(F.trim(F.regexp_replace(F.upper(c), r"[^A-Z0-9_]+", " ")), " ")
    return F.array_join(F.filter(parts, lambda t: ~t.isin(*words)), " ")


def squeezed(c: Column) -> Column:
    """Letters and digits only, in lower case."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _text_udf(f):
    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    return run


nfkc = _text_udf(lambda s: unicodedata.normalize("NFKC", s))
nfkd_ascii = _text_udf(lambda s: "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))
html_unescape = _text_udf(html.unescape)


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; equal pairs of a batch are compared once."""
    pairs = list(zip(a, b, strict=True))
    ratio = {(x, y): None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in set(pairs)}
    return pd.Series([ratio[p] for p in pairs], dtype="float64")


@F.pandas_udf(BooleanType())
def is_public_host(host: pd.Series) -> pd.Series:
    """Neither localhost nor an address that isn't global."""

    def ok(h):
        if h is None or h == "" or h.lower() == "localhost" or h.lower().endswith(".localhost"):
            return False
        try:
            return ipaddress.ip_address(h.strip("[]")).is_global
        except ValueError:
            return True

    return host.map(ok)


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def token_overlap(a: Column, b: Column) -> Column:
    """Shared tokens over the smaller number of tokens, to three places, halves to the even digit."""
    return F.bround(F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.least(F.size(a), F.size(b))), 3)


# ---------------------------------------------------------------- identifiers


def crn(c: Column) -> Column:
    """A registration number in upper case; numbers are padded to eight digits."""
    x = F.replace(F.upper(F.trim(c)), F.lit(" "), F.lit(""))
    return F.when(x.rlike("^[0-9]{1,7}$"), F.lpad(x, 8, "0")).otherwise(F.coalesce(x, F.lit("")))


def stock_codes(c: Column) -> Column:
    """The codes between <br> tags, padded to five digits, each once, in order."""
    parts = F.split(F.regexp_replace(c, r"<br\s*/?>", "|"), r"\|")
    digits = F.filter(F.transform(parts, lambda p: F.regexp_replace(p, "[^0-9]", "")), lambda p: p != "")
    return F.array_distinct(F.transform(digits, lambda p: F.right(F.when(F.length(p) < 5, F.lpad(p, 5, "0")).otherwise(p), F.lit(5))))


def canonical_code(codes: Column, active: Column) -> Column:
    """The first active code below 80000, else the first active one."""
    live = F.filter(codes, lambda c: F.array_contains(active, c))
    return F.coalesce(F.try_element_at(F.filter(live, lambda c: c.cast("int") < 80000), F.lit(1)), F.try_element_at(live, F.lit(1)))


def country(c: Column) -> Column:
    """ISO code of an alias; other values as they are."""
    table = F.create_map(*[F.lit(x) for kv in COUNTRIES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.upper(F.trim(c))), F.upper(F.trim(c)))


def stable_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24)


# ---------------------------------------------------------------- sizes, dates, text values


def size_bytes(c: Column) -> Column:
    """3.2MB -> 3355443; NULL without a unit."""
    x = F.replace(F.upper(c), F.lit(" "), F.lit(""))
    n, unit = F.regexp_extract(x, r"([0-9]+(?:\.[0-9]+)?)(KB|MB|GB|B)", 1), F.regexp_extract(x, r"([0-9]+(?:\.[0-9]+)?)(KB|MB|GB|B)", 2)
    factor = F.when(unit == "KB", 1024.0).when(unit == "MB", 1048576.0).when(unit == "GB", 1073741824.0).otherwise(1.0)
    return F.when(unit != "", F.floor(n.try_cast("double") * factor).cast("long"))


def period_end(c: Column) -> Column:
    """The date in "made up to 31 December 2024", "31 Dec 2024" or "2024-12-31"."""
    named = F.regexp_extract(c, r"(?i)made up to\s+([0-9]{1,2}\s+[A-Za-z]+\s+20[0-9]{2}|20[0-9]{2}-[0-9]{2}-[0-9]{2})", 1)
    x = F.trim(F.when(named != "", named).otherwise(c))
    return F.coalesce(*[F.try_to_date(x, f) for f in ("d MMMM yyyy", "d MMM yyyy", "yyyy-MM-dd")])


def any_datetime(c: Column) -> Column:
    x = collapsed(c)
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in ("dd/MM/yyyy HH:mm", "yyyy/MM/dd HH:mm", "dd/MM/yyyy", "yyyy-MM-dd")])


def from_millis(c: Column) -> Column:
    return F.timestamp_millis(c)


def month_ends(day: Column, n: int = 3) -> Column:
    """The last n closed month ends before a day."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.last_day(F.add_months(day, -k)))


def retry_after(c: Column, now: Column) -> Column:
    """Seconds to wait from a header that holds seconds or a date, within 0 to 300; 0 for anything else."""
    date = F.try_to_timestamp(F.regexp_replace(c, r"^[A-Za-z]{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    seconds = F.coalesce(c.try_cast("double"), (F.unix_timestamp(date) - F.unix_timestamp(now)).cast("double"), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(300.0), seconds))


# ---------------------------------------------------------------- paths and addresses


def safe_name(c: Column, most: int = 80) -> Column:
    """A file name without reserved signs, blanks as underscores, at most so long."""
    x = F.regexp_replace(F.trim(F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', "_")), r"^[ ._]+|[ ._]+$", "")
    x = F.regexp_replace(x, r"\s+", "_")
    return F.substring(F.when(x == "", "UNKNOWN").otherwise(x), 1, most)


def canonical_path(lei: Column, land: Column, mic: Column, ticker: Column, isin: Column, year: Column, kind: Column, language: Column) -> Column:
    """country/MIC/LEI_ISIN_ticker/FY/name.pdf of a complete identity, else NULL."""
    whole = lei.rlike(LEI) & isin.rlike(ISIN) & mic.rlike(MIC) & ticker.rlike(TICKER) & year.isNotNull()
    fy = F.concat(F.lit("FY"), year.cast("string"))
    name = F.concat(F.concat_ws("_", lei, land, mic, ticker, isin, fy, kind, language), F.lit(".pdf"))
    return F.when(whole, F.concat_ws("/", land, mic, F.concat_ws("_", lei, isin, ticker), fy, name))


def staging_path(root: Column, land: Column, ticker: Column, year: Column, name: Column) -> Column:
    """root/unresolved_identity/country/ticker_FYyear/name of a document whose identity isn't complete."""
    folder = F.concat(F.coalesce(nonempty(F.upper(ticker)), F.lit("UNKNOWN")), F.lit("_FY"), F.coalesce(year.cast("string"), F.lit("0000")))
    return F.concat_ws("/", root, F.lit("unresolved_identity"), land, folder, safe_name(name))


def path_parts(path: Column) -> list[Column]:
    """country, mic, lei, isin, ticker, fiscal_year of a canonical path."""
    parts = F.split(path, "/")
    company = F.split(F.try_element_at(parts, F.lit(3)), "_")

    def at(x: Column, n: int) -> Column:
        return F.try_element_at(x, F.lit(n))

    return [at(parts, 1).alias("country"), at(parts, 2).alias("mic"), at(company, 1).alias("lei"), at(company, 2).alias("isin"), at(company, 3).alias("ticker"), F.replace(at(parts, 4), F.lit("FY"), F.lit("")).try_cast("int").alias("fiscal_year")]


def climbs(member: Column) -> Column:
    """Whether an archive member's name leaves its folder."""
    return member.rlike(r"^[/\\]") | F.exists(F.split(member, r"[/\\]"), lambda p: p == "..")


def archive_url(cik: Column, accession: Column, document: Column) -> Column:
    """The address of a filing's document, NULL for a malformed accession number."""
    return F.when(accession.rlike("^[0-9]{10}-[0-9]{2}-[0-9]{6}$"), F.concat_ws("/", F.lit("https://www.sec.gov/Archives/edgar/data"), cik.try_cast("long").cast("string"), F.replace(accession, F.lit("-"), F.lit("")), document))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)


def stem_title(url: Column) -> Column:
    """A title from an address's last segment."""
    return F.initcap(F.translate(F.regexp_replace(last_segment(url), r"\.[A-Za-z0-9]+$", ""), "-_", "  "))


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash without its . and .. segments."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array(F.lit("")), step)
    folder = F.element_at(parts, -1).isin(".", "..") | (F.size(kept) == 1)
    return F.concat(F.array_join(kept, "/"), F.when(folder, "/").otherwise(""))


def absolute(base: Column, href: Column) -> Column:
    """href against base: whole, host-relative, path-relative with its dots resolved, or only a query or a fragment."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    path = F.substring(page, F.length(root) + 1, F.length(page))
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    own, rest = F.regexp_replace(href, r"[?#].*$", ""), F.regexp_extract(href, r"([?#].*)$", 1)
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), href))
        .when(href == "", F.regexp_replace(base, "#.*$", ""))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(root, _without_dots(F.when(href.startswith("/"), own).otherwise(F.concat(folder, own))), rest))
    )


def escaped_cell(c: Column) -> Column:
    """A spreadsheet cell that is not taken for a formula."""
    return F.when(F.substring(c, 1, 1).isin(*FORMULA_MARKS), F.concat(F.lit("'"), c)).otherwise(c)


def visible_text(page: Column) -> Column:
    """The text of simple HTML: scripts, styles and tags out, white space collapsed."""
    x = F.regexp_replace(page, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    return collapsed(F.regexp_replace(x, r"(?s)<[^>]*>", " "))


def well_formed(content: Column) -> Column:
    """Whether a file's ends are those of its kind: a PDF's end mark, a ZIP's directory, a page's root tag; NULL for other kinds."""
    kind = magic(content)
    tail = F.hex(F.substring(content, F.greatest(F.lit(1), F.octet_length(content) - 1023), F.lit(1024)))
    head = F.lower(F.substring(content, 1, 1024).cast("string"))
    return F.when(kind == "pdf", tail.contains("2525454F46")).when(kind == "zip", tail.contains("504B0506")).when(kind == "html", head.rlike("<(!doctype|html|head|body)"))


def magic(content: Column) -> Column:
    """pdf, html, zip or other by the first bytes."""
    head = F.lower(F.hex(F.substring(content, 1, 5)))
    return F.when(head.startswith("255044462d"), "pdf").when(head.startswith("504b0304"), "zip").when(head.startswith("3c"), "html").otherwise("other")


def first_pdf(row: Column) -> Column:
    """The first field of a record (a map) that looks like a document's path: the usual names, then any."""
    named = [F.when(F.contains(F.lower(v), F.lit(".pdf")) | F.contains(v, F.lit("/")), F.trim(v)) for v in (F.try_element_at(row, F.lit(k)) for k in PATH_FIELDS)]
    other = F.filter(F.map_values(row), lambda v: F.contains(F.lower(v), F.lit(".pdf")) | F.contains(F.lower(v), F.lit("upload_")))
    return F.coalesce(*named, F.trim(F.try_element_at(other, F.lit(1))), F.lit(""))


def pages_and_size(c: Column) -> tuple[Column, Column]:
    """The "12 pages 3.2MB" at a text's end."""
    return F.regexp_extract(c, r"(?i)([0-9]+)\s+pages?\b", 1).try_cast("int"), size_bytes(F.regexp_extract(c, r"(?i)([0-9.]+\s*(?:KB|MB|GB|B))\s*$", 1))


def slugs(land: Column, ticker: Column) -> Column:
    """The names that a site may have for a listing, best first."""
    dashed = F.translate(F.lower(ticker), "._", "--")
    plain = F.regexp_replace(F.lower(ticker), "[._-]", "")
    return F.array_distinct(F.transform(F.array(dashed, plain, F.substring(plain, 1, 6), F.substring(plain, 1, 5), F.substring(plain, 1, 4)), lambda x: F.concat_ws("-", land, x)))


# ---------------------------------------------------------------- listings and failures


def exchange_mic(exchange: Column, symbol: Column) -> Column:
    """The market of an exchange's name and a symbol: NEX by name or .H, venture by name, main board by name, else by .V."""
    x, own = F.replace(F.upper(F.coalesce(exchange, F.lit(""))), F.lit(" "), F.lit("")), F.upper(F.coalesce(symbol, F.lit("")))
    venture, main = x.contains("VENTURE") | x.isin("TSXV", "XTSX", "V"), x.isin("TSX", "XTSE", "T") | x.contains("TORONTO")
    return F.when(own.endswith(".H") | x.contains("NEX"), NEXT).when(venture, VENTURE).when(main, MAIN_BOARD).when(own.contains(".V"), VENTURE).otherwise(MAIN_BOARD)


def eligible_issuer(mic: Column, *texts: Column, with_next: bool = False) -> Column:
    """Whether a listing is a company's: no fund, receipt or shell by what its texts say, and on no NEX board."""
    said = F.concat_ws(" ", *texts).rlike("(?i)" + "|".join(NOT_COMPANIES))
    return ~said & (F.lit(with_next) | F.coalesce(mic != NEXT, F.lit(True)))


def form_type(form: Column) -> Column:
    """The report type of a filing's form; any other form is an annual report."""
    return F.coalesce(*[F.when(form == k, v) for k, v in FORMS.items()], F.lit("AR"))


def retryable(error: Column) -> Column:
    """Whether a failure isn't permanent."""
    return ~F.coalesce(error.isin(*PERMANENT_ERRORS) | error.contains(PERMANENT_MARK), F.lit(False))


def identity_missing(isin: Column, lei: Column) -> Column:
    """Which identifiers lack their length, NULL if none does."""
    no_isin, no_lei = F.coalesce(F.length(isin) != 12, F.lit(True)), F.coalesce(F.length(lei) != 20, F.lit(True))
    return F.when(no_isin & no_lei, MISSING_BOTH).when(no_isin, MISSING_ISIN).when(no_lei, MISSING_LEI)


def half_even(c: Column, places: int) -> Column:
    """Rounded, halves to the even digit."""
    return F.bround(c, places)
