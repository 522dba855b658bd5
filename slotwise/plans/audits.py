"""Audits of texts and files, identifier dumps, ranges, run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions import scalars as S
from slotwise.functions.structure import structure
from slotwise.operators import audit
from slotwise.plans.base import Family, read
from slotwise.sources import writers

family = Family()

PAGED = r"list_filter([trim(x) FOR x IN string_split(coalesce(text, ''), chr(10))], lambda x: x <> '')"
PLAIN = r"trim(regexp_replace(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), '\b(the|inc|incorporated|corp|corporation|company|co|plc|ltd|limited)\b', '', 'g'))"


def _pages(text):
    """The lines of a text that aren't blank, without spaces of any kind (Zs) at their ends."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(F.transform(lines, lambda x: F.regexp_replace(x, r"^\p{Zs}+|\p{Zs}+$", "")), lambda x: x != "")


@family(f"""
WITH p AS (SELECT doc_id, {PAGED} AS pages, 10 + doc_id % 30 AS yr FROM documents), t AS (SELECT *, {PLAIN.format("array_to_string(CASE WHEN len(pages) <= 10 THEN pages ELSE list_concat(pages[1:5], pages[len(pages) - 4:len(pages)]) END, ' ')")} AS body FROM p),
r AS (SELECT doc_id, CASE WHEN body = '' THEN 'no extractable text in sampled pages' END AS a, CASE WHEN NOT contains(body, yr::VARCHAR) THEN 'fiscal year not found in sampled pages' END AS b,
 CASE WHEN CASE WHEN doc_id % 2 = 0 THEN (contains(body, 'that')::INT + contains(body, 'tion')::INT + contains(body, 'heit')::INT) < 2 ELSE NOT contains(body, 'ment') END THEN 'company name not found in sampled pages' END AS c FROM t)
SELECT doc_id, concat_ws('; ', a, b, c) AS reason, CASE WHEN a IS NULL AND b IS NULL AND c IS NULL THEN 'PASS' ELSE 'REVIEW' END AS status FROM r""")
def content_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What the sampled pages (here: lines) of a document lack of its year and its company's name."""
    d = read(spark, sf, "documents")
    name = F.when(F.col("doc_id") % 2 == 0, "The That-Tion HEIT Co. Ltd.").otherwise("Ment & Co.")
    reason = audit.content_reasons(_pages(F.col("text")), 10 + F.col("doc_id") % 30, name)
    return d.select("doc_id", reason.alias("reason")).withColumn("status", F.when(F.col("reason") == "", "PASS").otherwise("REVIEW"))


@family("""
WITH d AS (SELECT doc_id, lower(coalesce(text, '')) || CASE doc_id % 3 WHEN 0 THEN ' annual report 2024' WHEN 1 THEN ' report to shareholders' ELSE '' END AS t, n_chars AS bytes, doc_id % 9 AS pages FROM documents)
SELECT doc_id, CASE WHEN bytes < 500 OR pages < 2 THEN 'FAIL' ELSE 'PASS' END AS state, CASE WHEN bytes >= 500 AND pages >= 2 AND regexp_matches(t, 'annual report|report to shareholders|annual financial report') AND contains(t, '2024') THEN 'PASS' ELSE 'WARN' END AS semantic,
 CASE WHEN bytes < 500 THEN 'below_min_bytes:' || bytes WHEN pages < 2 THEN 'below_min_pages:' || pages WHEN NOT (regexp_matches(t, 'annual report|report to shareholders|annual financial report') AND contains(t, '2024')) THEN 'semantic_signal_incomplete' ELSE '' END AS note FROM d""")
def semantic_check(spark: SparkSession, sf: str) -> DataFrame:
    """Size, pages, and whether a text says what it should."""
    k = F.col("doc_id") % 3
    text = F.concat(F.coalesce("text", F.lit("")), F.when(k == 0, " Annual Report 2024").when(k == 1, " Report to Shareholders").otherwise(""))
    return read(spark, sf, "documents").select("doc_id", *audit.semantic(text, F.lit(2024), F.col("n_chars"), F.col("doc_id") % 9, 500, 2))


@family("""
WITH f AS (SELECT c_custkey, c_custkey % 4 AS kind FROM customer), k AS (SELECT 'T' || c_custkey AS ticker FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 > 0)
SELECT c_custkey, ticker, CAST(CASE kind WHEN 0 THEN 2010 + c_custkey % 15 ELSE 2000 + c_custkey % 9 END AS INT) AS fiscal_year, CASE kind WHEN 0 THEN 'SR' ELSE 'AR' END AS report_type
FROM f JOIN k ON ticker = 'T' || c_custkey WHERE kind < 2""")
def staged_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Staged files that can be promoted: ticker, year and type by name, else by folder, and both identifiers known."""
    k, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    by_name = F.concat(F.lit("in/x/T"), s, F.lit("_"), (2010 + k % 15).cast("string"), F.lit("_SR_final.pdf"))
    by_folder = F.concat(F.lit("in/t"), s, F.lit("_FY"), (2000 + k % 9).cast("string"), F.lit("/final.pdf"))
    path = F.when(k % 4 == 0, by_name).when(k % 4 == 1, by_folder).when(k % 4 == 2, F.concat(F.lit("in/T"), s, F.lit("/final.pdf"))).otherwise(F.concat(F.lit("in/T"), s, F.lit("_FYxx/a.pdf")))
    c = read(spark, sf, "customer")
    known = c.where("c_custkey % 3 = 0").select(F.concat(F.lit("T"), s).alias("ticker"), F.lpad(s, 20, "0").alias("lei"), F.when(k % 5 == 0, "").otherwise(F.lpad(s, 12, "0")).alias("isin"))
    return audit.sweep(c.select("c_custkey", path.alias("path")), "path", known).select("c_custkey", "ticker", "fiscal_year", "report_type")


@family("""
WITH d AS (SELECT o_orderkey, 'T' || (o_custkey % 50) AS ticker, CASE WHEN o_orderkey % 3 = 0 THEN lpad(o_orderkey::VARCHAR, 20, '0') END AS lei, CASE WHEN o_orderkey % 4 = 1 THEN 'GB' || lpad(o_orderkey::VARCHAR, 10, '0') END AS isin FROM orders)
SELECT ticker, arg_max(lei, o_orderkey) FILTER (WHERE lei IS NOT NULL) AS lei, arg_max(isin, o_orderkey) FILTER (WHERE isin IS NOT NULL) AS isin FROM d GROUP BY ticker HAVING count(lei) + count(isin) > 0""")
def identifier_dumps(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of tickers from two shapes of dumps, the last well-formed one of each."""
    k, s = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    lei, isin = F.when(k % 3 == 0, F.lpad(s, 20, "0")).otherwise("short"), F.when(k % 4 == 1, F.concat(F.lit("gb"), F.lpad(s, 10, "0"))).otherwise("")
    ticker = F.concat(F.lit(" t"), (F.col("o_custkey") % 50).cast("string"))
    plain, wrapped = F.struct(ticker.alias("ticker"), lei.alias("lei"), isin.alias("isin")), F.struct(*[F.struct(c.alias("value")).alias(n) for n, c in (("ticker", ticker), ("lei", lei), ("isin", isin))])
    o = read(spark, sf, "orders")
    dump = o.where("o_orderkey % 2 = 0").select(k, F.to_json(plain).alias("item")).union(o.where("o_orderkey % 2 <> 0").select(k, F.to_json(wrapped).alias("item")))
    return audit.identifiers(dump, "item", "o_orderkey")


_RANGES = """WITH RECURSIVE d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1), m AS (SELECT (max(n) * 3) // 4 AS most FROM d),
r AS (SELECT min(day) AS a, max(day) AS b FROM d UNION ALL
 SELECT CASE x WHEN 0 THEN a ELSE a + CAST(floor((b - a) / 2) AS INT) + 1 END, CASE x WHEN 0 THEN a + CAST(floor((b - a) / 2) AS INT) ELSE b END FROM r, m, (VALUES (0), (1)) AS v(x) WHERE a < b AND (SELECT sum(n) FROM d WHERE day BETWEEN a AND b) >= most),
s AS (SELECT a, b, CAST(coalesce((SELECT sum(n) FROM d WHERE day BETWEEN a AND b), 0) AS BIGINT) AS n FROM r),
g AS (SELECT a AS first, b AS last, n, CASE WHEN n < most THEN most ELSE 2 * most END::BIGINT AS "limit" FROM s, m WHERE n < most OR a = b)"""


def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    days = read(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    most = days.agg(F.max("n")).first()[0] * 3 // 4
    return audit.bisected(days, "day", "n", most, 4 * most)


@family(f"{_RANGES} SELECT * FROM g")
def bisected_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of days with fewer filings than a request may return; full days are asked again with a higher limit."""
    return _ranges(spark, sf)


@family(f"{_RANGES} SELECT o_orderkey, first FROM orders JOIN g ON CAST(o_orderdate AS DATE) BETWEEN first AND last")
def bisected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The filings that the ranges' answers have, each once although answers repeat some."""
    o = read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    answers = o.union(o.where("o_orderkey % 3 = 0"))
    return audit.asked_by_ranges(answers, "day", ["o_orderkey"], [F.asc("day")], _ranges(spark, sf)).select("o_orderkey", "first")


_RESULTS = "SELECT event_id, CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 11 = 0 THEN NULL ELSE 'DONE' END AS status, CASE WHEN event_type = 'error' THEN 'HTTP ' || (400 + user_id % 5) END AS error FROM events"


def _results(spark: SparkSession, sf: str) -> DataFrame:
    error = F.col("event_type") == "error"
    return read(spark, sf, "events").select("event_id", F.when(error, "FAILED").when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise("DONE").alias("status"), F.when(error, F.concat(F.lit("HTTP "), (400 + F.col("user_id") % 5).cast("string"))).alias("error"))


@family(f"SELECT count(*) AS total, count(*) FILTER (WHERE status = 'DONE') AS done, count(*) FILTER (WHERE status IS DISTINCT FROM 'DONE') AS failed, count(DISTINCT error) AS reasons FROM ({_RESULTS})")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return writers.run_summary(_results(spark, sf), "status", "error")[0]


@family(f"SELECT * FROM ({_RESULTS}) WHERE status IS DISTINCT FROM 'DONE'")
def run_failures(spark: SparkSession, sf: str) -> DataFrame:
    return writers.run_summary(_results(spark, sf), "status", "error")[1]


@family("""
SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 'ok' WHEN 1 THEN 'truncated' WHEN 2 THEN 'forged' WHEN 3 THEN 'forged' WHEN 4 THEN 'ok' WHEN 5 THEN 'truncated' WHEN 6 THEN 'forged' WHEN 7 THEN 'truncated' WHEN 8 THEN 'ok' END AS state FROM orders""")
def file_walk(spark: SparkSession, sf: str) -> DataFrame:
    """Whether what a PDF's cross-references and a ZIP's directory point at is there; ends that are cut or forged."""
    k, n = F.col("o_orderkey"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    head, thing = "%PDF-1.4\n", F.concat(F.lit("1 0 obj <</N "), n, F.lit(">> endobj\n"))
    # an object of 35 bytes at 9, so a table at 44; one points elsewhere, one is elsewhere
    table = F.concat(F.lit("xref\n0 2\n0000000000 65535 f \n"), F.when(k % 10 == 3, "0000000011").otherwise("0000000009"), F.lit(" 00000 n \ntrailer <</Size 2>>\nstartxref\n"), F.when(k % 10 == 2, "40").otherwise("44"), F.lit("\n%%EOF\n"))
    whole = F.concat(F.lit(head), thing, table)
    stream = F.concat(F.lit(head), thing, F.lit("2 0 obj <</Type /XRef>> endobj\nstartxref\n44\n%%EOF"))
    pdf = F.when(k % 10 == 1, F.substring(whole, F.lit(1), F.length(whole) - 8)).when(k % 10 == 4, stream).otherwise(whole).cast("binary")
    # an archive of one stored member: its record of 42 bytes, the directory's of 58 and the end
    name, little = F.lit("f").cast("binary"), "00000000000000000000"
    record = F.concat(F.unhex(F.lit("504B0304" + "0A00" + little[:12] + "0000" + "00000000" + "0B000000" + "0B000000" + "0100" + "0000")), name, F.substring(n, 2, 11).cast("binary"))
    entry = F.concat(F.unhex(F.concat(F.lit("504B0102" + "0A000A00" + little[:12] + "0000" + "00000000" + "0B000000" + "0B000000" + "0100" + "0000" + "0000" + "0000" + "0000" + "00000000"), F.when(k % 10 == 6, "05000000").otherwise("00000000"))), name)
    end = F.unhex(F.concat(F.lit("504B0506" + "00000000" + "01000100" + "2F000000" + "2A000000"), F.when(k % 10 == 7, "0900").otherwise("0000")))
    archive = F.concat(record, entry, F.when(k % 10 == 5, F.substring(end, 1, 15)).otherwise(end))
    content = F.when(k % 10 < 5, pdf).when(k % 10 < 9, archive).otherwise(F.lit("<html>").cast("binary"))
    return read(spark, sf, "orders").select("o_orderkey", structure(content).alias("state"))


@family("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'zip' WHEN 2 THEN 'html' ELSE 'other' END AS kind, CASE page_id % 4 WHEN 0 THEN page_id % 8 = 0 WHEN 1 THEN page_id % 8 = 1 WHEN 2 THEN page_id % 8 = 2 END AS whole FROM pages")
def file_structure(spark: SparkSession, sf: str) -> DataFrame:
    """A file's kind by its first bytes, and whether its end fits."""
    k, body = F.col("page_id") % 8, F.repeat(F.lit("x"), 3000)
    pdf = F.concat(F.lit("%PDF-1.7 "), body, F.when(k == 0, "%%EOF").otherwise(""))
    archive = F.concat(F.lit("PK\x03\x04"), body, F.when(k == 1, "PK\x05\x06").otherwise(""))
    content = F.when(k % 4 == 0, pdf).when(k % 4 == 1, archive).when(k % 4 == 2, F.concat(F.when(k == 2, "<!DOCTYPE html>").otherwise("<p>"), body)).otherwise(body)
    return read(spark, sf, "pages").select("page_id", content.cast("binary").alias("content")).select("page_id", S.magic(F.col("content")).alias("kind"), S.well_formed(F.col("content")).alias("whole"))
