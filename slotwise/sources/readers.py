"""Reading what lands in files: strict and tolerant CSV, JSON shapes, archives, workbooks, pages, listings."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions import scalars as S
from slotwise.operators import validate
from slotwise.sources import archives, csv_records

MANIFEST_FIELDS = ("country", "exchange", "lei", "isin", "ticker", "fiscal_year", "report_type", "language", "pdf_url", "source_page", "verified")
UNIVERSE_FIELDS = ("country", "company_name", "exchange", "lei", "isin", "ticker", "cik", "aliases")


class SchemaError(ValueError):
    """The columns aren't the ones that the source must have."""


def strict_csv(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """CSV files with exactly these columns, in any order, and each row's line (quoted line breaks count as one)."""
    try:
        names, df = csv_records.rows(spark, path)
    except ValueError as wrong:
        raise SchemaError(str(wrong)) from wrong
    if sorted(names) != sorted(fields):
        raise SchemaError(f"CSV columns must be exactly: {', '.join(fields)}")
    return df.select(*fields, "line")


def manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with line and reason); of rows with one canonical target the later ones are rejected."""
    rows = strict_csv(spark, path, MANIFEST_FIELDS).withColumn("reason", validate.reason(validate.report_rules()))
    target = S.canonical_path(F.col("lei"), F.col("country"), F.col("exchange"), F.col("ticker"), F.col("isin"), F.replace("fiscal_year", F.lit("FY"), F.lit("")).try_cast("int"), F.col("report_type"), F.col("language"))
    rows = rows.withColumn("target", F.when(F.col("reason").isNull(), target))
    first = F.min("line").over(W.partitionBy("target"))
    again = F.col("target").isNotNull() & (F.col("line") > first)
    rows = rows.withColumn("reason", F.when(again, F.concat(F.lit("duplicate canonical target also listed at line "), first.cast("string"))).otherwise(F.col("reason")))
    return rows.where("reason IS NULL").drop("reason"), rows.where("reason IS NOT NULL")


def universe(spark: SparkSession, path: str) -> DataFrame:
    """The roster; a repeated listing identity or an empty file is an error."""
    rows = strict_csv(spark, path, UNIVERSE_FIELDS)
    key = F.concat_ws("|", "country", "exchange", "lei", "isin", "ticker")
    found = rows.groupBy(key.alias("company_key")).count()
    n, most = found.agg(F.sum("count"), F.max("count")).first()
    if not n:
        raise SchemaError("the universe is empty")
    if most > 1:
        raise SchemaError(f"duplicate listing identity: {found.where('count > 1').first()[0]}")
    return rows.withColumn("company_key", key)


def by_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column for each target: the first alias, compared without case and signs, that isn't blank."""
    own = {}
    for c in df.columns:
        own.setdefault(re.sub(r"[^a-z0-9]", "", c.lower()), c)
    out = []
    for target, names in aliases.items():
        there = [F.col(f"`{own[n]}`").cast("string") for n in (re.sub(r"[^a-z0-9]", "", x.lower()) for x in names) if n in own]
        out.append((F.coalesce(*[S.nonempty(F.trim(c)) for c in there], F.lit("")) if there else F.lit("")).alias(target))
    return df.select(*out)


def records(spark: SparkSession, path: str, roots: Sequence[str] = ("data", "results", "documents")) -> DataFrame:
    """path and row (a map of strings) of CSV, JSON, JSON lines or ZIPs of those, streamed by file and member."""
    return archives.members(spark, path, roots=list(roots)).select("path", "row")


def archive_rows(spark: SparkSession, path: str, pattern: str, batch: int = archives.BATCH) -> DataFrame:
    """path, member, pos, row of the CSV and JSON members of archives whose names match, streamed in batches."""
    return archives.members(spark, path, pattern=pattern, batch=batch)


def zip_members(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, member, content of the archive members whose names match, unsafe names left out; for small members."""
    return archives.members(spark, path, kind="content", pattern=pattern)


def workbook(spark: SparkSession, path: str, header_words: Sequence[str], within: int = 30) -> DataFrame:
    """sheet and row (a map of strings) of all sheets of XLSX files, each streamed; a sheet's header is the first of
    its first rows that has all the words."""
    found = archives.members(spark, path, kind="sheets", pattern=archives.SHEET, words=list(header_words), within=within)
    return found.select(F.col("member").alias("sheet"), "row")


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path and length of files, without their content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length")


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def or_seed(primary: DataFrame, seed: DataFrame) -> DataFrame:
    """The primary rows, or the seed if there are none."""
    none = primary.agg((F.count("*") == 0).alias("_none"))  # one row
    return primary.unionByName(seed.crossJoin(F.broadcast(none)).where("_none").drop("_none"))


# ---------------------------------------------------------------- JSON shapes


def columnar(df: DataFrame, struct: str, fields: Sequence[str]) -> DataFrame:
    """A struct of parallel arrays as rows; arrays that are too short give empty strings."""
    zipped = F.arrays_zip(*[F.coalesce(F.col(f"{struct}.{f}"), F.array().cast("array<string>")).alias(f) for f in fields])
    rest = [c for c in df.columns if c != struct.split(".")[0]]
    return df.select(*rest, F.posexplode(zipped).alias("pos", "r")).select(*rest, "pos", *[F.coalesce(F.col(f"r.{f}"), F.lit("")).alias(f) for f in fields])


def headed_rows(column: Column, names: Mapping[str, int]) -> list[Column]:
    """From an array of arrays whose first row is the header: for each name a column of an exploded `r` (array),
    found by the header or by the default position."""
    head = F.element_at(column, 1)
    return [F.try_element_at(F.col("r"), F.when(F.array_position(head, n) > 0, F.array_position(head, n)).otherwise(F.lit(d + 1)).cast("int")).alias(n) for n, d in names.items()]


def drifting(row: Column, *names: str) -> Column:
    """The first of some keys of a map that isn't blank."""
    return F.coalesce(*[S.nonempty(F.try_element_at(row, F.lit(n))) for n in names], F.lit(""))


def wrapped_value(c: Column) -> Column:
    """x from {"value": x} or x."""
    return F.coalesce(F.get_json_object(c, "$.value"), c)


# ---------------------------------------------------------------- pages


def links(pages: DataFrame, key: str, html: str, base: Column, hosts: Sequence[str] | None = None) -> DataFrame:
    """key, pos, url, text, n of a page's anchors; off-host ones dropped, the first of equal addresses kept, n of them."""
    anchor = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    found = pages.select(key, base.alias("_base"), F.posexplode(F.arrays_zip(F.regexp_extract_all(html, F.lit(anchor), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(anchor), F.lit(2)).alias("text"))).alias("pos", "a"))
    out = found.select(key, "pos", S.absolute(F.col("_base"), F.col("a.href")).alias("url"), S.visible_text(F.col("a.text")).alias("text"))
    if hosts:
        out = out.where(F.regexp_extract("url", r"^https?://([^/?#:]+)", 1).isin(*hosts))
    first = out.groupBy(key, "url").agg(F.min(F.struct("pos", "text")).alias("_f"), F.count("*").alias("n"))
    return first.select(key, "_f.pos", "url", "_f.text", "n")


# fixed values: what a register's filing rows, a market's lists and a report archive's pages look like
FILING = r'(?i)href="(/company/[^/]+/filing-history/([^/"]+)/document\?format=pdf[^"]*)"'
FILING_ONLY = r"/filing-history/([A-Za-z0-9_-]{15,})"
FILING_PAGES, FILING_DATE = r"(?i)\(([0-9]+)\s+pages?\)", r"([0-9]{1,2}\s+[A-Za-z]{3}\s+20[0-9]{2})"
COMPANY_PATH, REPORT_YEAR, REPORT_TITLE = r"/companies/([A-Z0-9]+)$", r"(?<![0-9])(20[0-9]{2})(?![0-9])", r"(?i)annual report|form 10[- ]?k|report and accounts"
ARCHIVE, HEADING, DOWNLOAD = "archived_report_content_block", "heading", ("download", "view_annual_report")


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _plain(x: Column) -> Column:
    """The text between tags, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), r"\s+", " "))


def _unescaped(texts: Column) -> Column:
    """An array of texts with its character references replaced, in one call for a row."""
    return F.split(S.html_unescape(F.array_join(texts, "\x01")), "\x01")


def filing_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row, transaction_id, filing_date, form_type, description, pages, href of the filings in a register's tables:
    rows with a document's address or else a filing's; of equal filings of a page the first. No date is NULL, no pages 0."""
    rows = pages.select(key, F.posexplode(_all(F.col(html), r"(?is)<tr[^>]*>.*?</tr>", 0)).alias("row", "_tr"))
    tr = F.col("_tr")
    rows = rows.withColumn("transaction_id", F.coalesce(S.nonempty(F.regexp_extract(tr, FILING, 2)), F.regexp_extract(tr, FILING_ONLY, 1))).where("transaction_id <> ''")
    rows = rows.groupBy(key, "transaction_id").agg(F.min(F.struct("row", "_tr")).alias("_f")).select(key, "transaction_id", "_f.*")
    rows = rows.withColumn("_c", _unescaped(F.transform(_all(tr, r"(?s)<td[^>]*>(.*?)</td>"), _plain)))
    three = F.size("_c") >= 3
    date = F.try_to_timestamp(F.regexp_replace(F.regexp_extract(F.get("_c", F.lit(0)), FILING_DATE, 1), r"\s+", " "), F.lit("d MMM yyyy")).cast("date")
    return rows.select(
        key, "row", "transaction_id", date.alias("filing_date"), F.when(three, F.get("_c", F.lit(1))).otherwise("").alias("form_type"),
        F.when(three, F.get("_c", F.lit(2))).otherwise(F.array_join("_c", " ")).alias("description"),
        F.coalesce(F.regexp_extract(tr, FILING_PAGES, 1).try_cast("int"), F.lit(0)).alias("pages"), F.replace(F.regexp_extract(tr, FILING, 1), F.lit("&amp;"), F.lit("&")).alias("href"),
    )


def listed_codes(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, code, name from the rows of a market's table whose first cell is a code; of a page without any, from its
    anchors to companies. The first name of a code counts."""
    cells = F.transform(_all(F.col("_tr"), r"(?is)<t[dh]\b[^>]*>(.*?)(?=<t[dh]\b|</t[dh]\s*>|$)"), _plain)
    tables = pages.select(key, F.posexplode(_all(F.col(html), r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr\s*>|</table\s*>)")).alias("pos", "_tr")).withColumn("_c", cells).where("size(_c) >= 2")
    coded = tables.select(key, F.lit(0).alias("way"), "pos", F.upper(F.get("_c", F.lit(0))).alias("code"), F.get("_c", F.lit(1)).alias("name")).where(F.col("code").rlike("^[A-Z0-9]{2,8}$") & (F.col("code") != "CODE"))
    pairs = F.arrays_zip(_all(F.col(html), r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>").alias("h"), _all(F.col(html), r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>", 2).alias("t"))
    anchors = pages.select(key, F.posexplode(pairs).alias("pos", "a")).select(key, F.lit(1).alias("way"), "pos", F.regexp_extract("a.h", COMPANY_PATH, 1).alias("code"), _plain(F.col("a.t")).alias("name")).where("code <> '' AND name <> ''")
    first = coded.union(anchors).groupBy(key, "code").agg(F.min(F.struct("way", "pos", "name")).alias("_f"))
    # anchors only count where the page's table has no code
    with_way = first.withColumn("_way", F.min("_f.way").over(W.partitionBy(key)))
    return with_way.where(F.col("_f.way") == F.col("_way")).select(key, "code", "_f.name")


def report_years(pages: DataFrame, key: str, html: str, base: Column) -> DataFrame:
    """key, reports: {year: url} of the annual reports in a page's archive list. Of each item its first address that is
    a PDF's or a redirect's counts; of a year's the last PDF's, else the first."""

    def has_class(*names: str) -> str:
        return "".join(rf"(?=[^\"']*(?<![\w-]){n}(?![\w-]))" for n in names)

    block = F.regexp_extract(html, rf"(?is)class=[\"']{has_class(ARCHIVE)}(.*)", 1)
    items = pages.select(key, base.alias("_base"), F.posexplode(_all(block, r"(?is)<li\b[^>]*>.*?</li>", 0)).alias("pos", "_li"))
    title = _plain(F.regexp_extract("_li", rf"(?is)<(\w+)\b[^>]*?\bclass=[\"']{has_class(HEADING)}[^\"']*[\"'][^>]*>(.*?)</\1\s*>", 2))
    either = "|".join(rf"(?:{has_class('btn_archived', d)})" for d in DOWNLOAD)
    hrefs = _all(F.col("_li"), rf"(?is)class=[\"'](?:{either})[^\"']*[\"'][^>]*>\s*<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"']")
    href = F.get(F.filter(hrefs, lambda x: F.lower(F.substring_index(x, "?", 1)).endswith(".pdf") | x.contains("/Click/")), F.lit(0))
    found = items.select(key, "pos", F.regexp_extract(title, REPORT_YEAR, 1).try_cast("int").alias("year"), title.alias("_title"), S.absolute(F.col("_base"), href).alias("url"))
    found = found.where(F.col("year").isNotNull() & F.col("_title").rlike(REPORT_TITLE) & F.col("url").startswith("https://"))
    pdf = F.lower(F.regexp_replace("url", "[?#].*$", "")).endswith(".pdf")
    each = found.groupBy(key, "year").agg(F.max_by(F.when(pdf, F.col("url")), F.when(pdf, F.col("pos"))).alias("_pdf"), F.min_by("url", "pos").alias("_first"))
    entry = F.struct("year", F.coalesce("_pdf", "_first").alias("url"))
    return each.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("reports"))  # one entry a year


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row, cells: the visible text of each table row's cells."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr\s*>|</table\s*>)"), F.lit(1))).alias("row", "_tr"))
    cells = F.regexp_extract_all("_tr", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=<t[dh]\b|</t[dh]\s*>|$)"), F.lit(1))
    return rows.select(key, "row", F.transform(cells, S.visible_text).alias("cells"))


def labelled(text: Column, labels: Sequence[str]) -> list[Column]:
    """The value after each "Label:" in a page's text."""
    return [F.nullif(F.trim(F.regexp_extract(text, rf"(?i)\b{re.escape(x)}\s*:\s*([^|;\n]+?)(?=\s+[A-Z][A-Za-z ]{{2,20}}:|[|;\n]|$)", 1)), F.lit("")).alias(x) for x in labels]


def sitemap(xml: Column) -> Column:
    """The addresses in a sitemap."""
    return F.regexp_extract_all(xml, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))


def year_and_type(url: Column) -> tuple[Column, Column]:
    """Year and type code from a path like /x-2023-ar-00/."""
    return F.regexp_extract(url, r"-(20[0-9]{2})-([a-z]{2})-[0-9]{2}/?", 1).try_cast("int"), F.upper(F.nullif(F.regexp_extract(url, r"-(20[0-9]{2})-([a-z]{2})-[0-9]{2}/?", 2), F.lit("")))


def company_count(text: Column) -> Column:
    """main + gem = total, or NULL."""

    def n(label: str) -> Column:
        return F.replace(F.regexp_extract(text, rf"(?i){label}[^0-9]{{0,40}}([0-9][0-9,]*)", 1), F.lit(","), F.lit("")).try_cast("int")

    main, gem, total = n("main board"), n("gem"), n("total")
    return F.when(main + gem == total, total)


# ---------------------------------------------------------------- directives

# fixed values: markets in the order in which their words are looked for, markets that are refused, and report types' words
MARKETS = {
    "Australia": ("australia", "asx", "aussie"),
    "Bangladesh": ("bangladesh", "dhaka", "dse"),
    "Canada": ("canada", "tsx", "tsxv", "canadian"),
    "HongKong": ("hong kong", "hongkong", "hkex", "sehk"),
    "India": ("india", "bse", "nse", "indian"),
    "NewZealand": ("new zealand", "newzealand", "nzx", "kiwi"),
    "Singapore": ("singapore", "sgx"),
    "SriLanka": ("sri lanka", "srilanka", "cse", "colombo"),
    "Africa": ("africa", "african", "jse", "south africa", "ngx", "nigeria", "kenya", "nse kenya", "ghana", "gse", "botswana", "bse", "zambia", "luse", "tanzania", "dse tanzania", "zimbabwe", "mauritius", "namibia", "uganda", "malawi", "rwanda", "eswatini", "seychelles", "sierra leone"),
    "MiddleEast": ("middle east", "middleeast", "oman", "msx", "jordan", "ase", "uae", "dubai", "dfm", "abu dhabi", "abudhabi", "adx", "saudi", "tadawul", "qatar", "qse", "bahrain", "kuwait", "boursa kuwait"),
    "Philippines": ("philippines", "philippine", "pse", "xphs", "manila", "filipino", "edge"),
}
REFUSED = ("palestine", "israel", "pex", "xpsx", "tase")
SUSTAINABLE_WORDS = r"\b(?:sustainab\w*|esg|csr|climate|environmental|integrated|sr|ir|brsr|databook)\b"
ANNUAL_WORDS = r"\b(?:annual|10-k|20-f|statutory|financial\w*|ar)\b"


def years(argument: str) -> range:
    """2017:2025 as a range of years."""
    m = re.fullmatch(r"(\d{4})(?::(\d{4}))?", argument.strip())
    if not m or int(m[2] or m[1]) < int(m[1]):
        raise ValueError(f"years must look like 2017:2025, not {argument!r}")
    return range(int(m[1]), int(m[2] or m[1]) + 1)


def directive(column: Column) -> list[Column]:
    """market, count, first and last year of plain-English requests; a column of them is parsed in place. The market is
    NULL where none is named or a refused one is."""
    low = F.lower(column)
    market = F.when(~low.rlike("|".join(REFUSED)), F.coalesce(*[F.when(low.rlike("|".join(words)), name) for name, words in MARKETS.items()]))
    everything = low.contains("all") & low.rlike("compan|listed|issuer")
    count = F.when(everything, 999_999).otherwise(F.coalesce(F.regexp_extract(low, r"\b([0-9]{1,3}|[3-9][0-9]{3}|1[0-8][0-9]{2})\b(?!\s*[-:])", 1).try_cast("int"), F.lit(100)))
    found = F.transform(F.regexp_extract_all(low, F.lit(r"\b((?:19|20)[0-9]{2})\b"), F.lit(1)), lambda x: x.cast("int"))
    return [market.alias("market"), count.alias("count"), F.array_min(found).alias("first_year"), F.array_max(found).alias("last_year")]


def directive_scope(column: Column) -> list[Column]:
    """offset (-1: after what is done already) and report_types (annual unless only sustainability is asked for)."""
    low = F.lower(column)
    sustainable, annual = low.rlike(SUSTAINABLE_WORDS), low.rlike(ANNUAL_WORDS)
    kinds = F.array_compact(F.array(F.when(annual | ~sustainable, "AR"), F.when(sustainable, "SR")))
    return [F.when(low.contains("next"), -1).otherwise(0).alias("offset"), F.array_join(kinds, ",").alias("report_types")]
