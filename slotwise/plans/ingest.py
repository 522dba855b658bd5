"""Queries over raw pages and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions import scalars as S
from slotwise.sources import readers
from slotwise.plans.base import Family, read

family = Family()


@family("""
WITH a AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS root, unnest(regexp_extract_all(html, '(?is)<a [^>]*href="([^"]+)"[^>]*>', 1)) AS href FROM pages)
SELECT page_id, root || href AS url, count(*) AS n FROM a WHERE starts_with(href, '/') GROUP BY ALL""")
def html_links(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of a page's anchors, each once; how often each occurs."""
    return readers.links(read(spark, sf, "pages"), "page_id", "html", F.col("url")).select("page_id", "url", "n")


@family("""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a [^>]*href="([^"]+)"[^>]*>', 1)) AS href FROM pages)
SELECT page_id, 'https://docs.example' || href AS url, count(*) AS n FROM a WHERE starts_with(href, '/th') GROUP BY ALL""")
def links_of_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of allowed hosts only."""
    p = read(spark, sf, "pages").withColumn("html", F.replace("html", F.lit('href="/th'), F.lit('HREF = "https://docs.example/th')))
    return readers.links(p, "page_id", "html", F.col("url"), hosts=["docs.example", "www.docs.example"]).select("page_id", "url", "n")


_ITEMS = """a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li><a href="/([^"]*)">[^<]*</a></li>', 1)) AS word, unnest(range(0, len(regexp_extract_all(html, '(?s)<li><a href="/([^"]*)">[^<]*</a></li>', 0)))) AS pos FROM pages),
i AS (SELECT page_id, pos, regexp_replace(word, '[^A-Za-z]', '', 'g') AS word FROM a)"""


def _pages(spark: SparkSession, sf: str, item: str) -> DataFrame:
    """Pages whose list items became something else: $1 is an item's text."""
    p = read(spark, sf, "pages").withColumn("html", F.regexp_replace("html", r'(?s)<li><a href="/([^"]*)">[^<]*</a></li>', "<li>$1</li>"))
    letters = F.transform(F.split("html", "<li>"), lambda x: F.when(x.contains("</li>"), F.concat(F.regexp_replace(F.substring_index(x, "</li>", 1), "[^A-Za-z]", ""), F.lit("</li>"), F.regexp_replace(x, "(?s)^.*?</li>", ""))).otherwise(x))
    return p.withColumn("html", F.regexp_replace(F.array_join(letters, "<li>"), "(?s)<li>(.*?)</li>", item))


@family(f"""
WITH {_ITEMS}
SELECT page_id, 'TX' || word AS transaction_id, min(pos)::INTEGER AS row, CASE WHEN length(word) % 2 = 0 THEN make_date(2021, 3, length(word) % 20 + 1) END AS filing_date, 'AA' AS form_type, trim('Accounts & ' || word) AS description, length(word)::INTEGER AS pages,
 '/company/1/filing-history/TX' || word || '/document?format=pdf&download=0' AS href FROM i GROUP BY page_id, word""")
def filing_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A register's filings from the table rows that list items became, each once a page."""
    row = '<tr class="r"><td>#$1#</td><td> AA</td><td><b>Accounts</b> &amp;\n$1</td><td><a href="/company/1/filing-history/TX$1/document?format=pdf&amp;download=0">View PDF</a> (#$1# pages)</td></tr>'
    p = _pages(spark, sf, row)
    # days and numbers of pages from the lengths of words
    parts = F.transform(F.sequence(F.lit(0), F.lit(40)), lambda n: n)
    html = F.aggregate(parts, F.col("html"), lambda h, n: F.regexp_replace(F.regexp_replace(h, F.concat(F.lit("<td>#[A-Za-z]{"), n.cast("string"), F.lit("}#")), F.when(n % 2 == 0, F.concat(F.lit("<td>on "), (n % 20 + 1).cast("string"), F.lit("  Mar 2021"))).otherwise("<td>no day")), F.concat(F.lit(r"\(#[A-Za-z]{"), n.cast("string"), F.lit("}# ")), F.concat(F.lit("("), n.cast("string"), F.lit(" "))))
    return readers.filing_rows(p.withColumn("html", html), "page_id", "html")


@family(f"""
WITH {_ITEMS}, c AS (SELECT page_id, pos, upper(word) AS code, word AS name FROM i WHERE page_id % 3 > 0 AND length(word) BETWEEN 2 AND 8), n AS (SELECT page_id, pos, upper(word) AS code, 'To ' || word AS name FROM i WHERE word <> '')
SELECT page_id, code, arg_min(name, pos) AS name FROM c GROUP BY page_id, code UNION ALL SELECT page_id, code, arg_min(name, pos) FROM n WHERE page_id NOT IN (SELECT page_id FROM c) GROUP BY page_id, code""")
def listed_codes(spark: SparkSession, sf: str) -> DataFrame:
    """A market's codes and names, from its table or else from the anchors to its companies."""
    upper = F.transform(F.split("html", "@"), lambda x: F.when(x.rlike("^[A-Za-z]+#"), F.concat(F.upper(F.substring_index(x, "#", 1)), F.regexp_replace(x, "(?s)^[A-Za-z]+#", ""))).otherwise(x))
    with_rows = _pages(spark, sf, '<tr><th>$1<td><i>$1</i></tr><a class="x" href="/companies/@$1#">To <b>$1</b></a>').where("page_id % 3 > 0")
    anchors = _pages(spark, sf, '<tr><td>CODE</td><td>$1</td></tr><a href="/companies/@$1#">To <b>$1</b></a>').where("page_id % 3 = 0")
    return readers.listed_codes(with_rows.union(anchors).withColumn("html", F.array_join(upper, "")), "page_id", "html")


@family(f"""
WITH {_ITEMS}, w AS (SELECT page_id, pos, 2010 + length(word) % 8 AS year, word, length(word) % 3 AS way FROM i WHERE length(word) % 5 > 0),
u AS (SELECT page_id, pos, year, CASE way WHEN 0 THEN 'https://www.x.example/Click/' || word ELSE 'https://www.x.example/a/' || word || '.PDF?v=1' END AS url, way > 0 AS pdf FROM w)
SELECT page_id, year::INTEGER AS year, coalesce(arg_max(url, pos) FILTER (WHERE pdf), arg_min(url, pos)) AS url FROM u GROUP BY page_id, year""")
def report_years(spark: SparkSession, sf: str) -> DataFrame:
    """The reports of an archive list by year, PDFs before redirects."""
    item = '<li><span class="heading x">#$1#</span><span class="btn_archived other"><a href="/no.pdf">n</a></span><span class=\'btn_archived download\'><a class="y" href="/none.html">h</a></span><span class="view_annual_report btn_archived"> <a href="%$1%">d</a></span></li>'
    p = _pages(spark, sf, item)

    def told(h, n):
        title = F.when(n % 5 == 0, F.lit("Interim statement 2015")).otherwise(F.concat(F.lit("The Annual <b>Report</b> "), (2010 + n % 8).cast("string")))
        address = F.when(n % 3 == 0, F.lit("/Click/$1")).otherwise("/a/$1.PDF?v=1")
        return F.regexp_replace(F.regexp_replace(h, F.concat(F.lit("#[A-Za-z]{"), n.cast("string"), F.lit("}#")), title), F.concat(F.lit("%([A-Za-z]{"), n.cast("string"), F.lit("})%")), address)

    html = F.aggregate(F.sequence(F.lit(0), F.lit(40)), F.replace("html", F.lit("<nav>"), F.lit("<nav class='most archived_report_content_block'>")), told)
    found = readers.report_years(p.withColumn("html", html), "page_id", "html", F.lit("https://www.x.example/Company/x"))
    return found.select("page_id", F.explode("reports").alias("year", "url"))


@family("""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script\\s*>|<style.*?</style\\s*>|<noscript.*?</noscript\\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages""")
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select("page_id", S.visible_text(F.col("html")).alias("text"))


@family("SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?i)<html lang=\"([a-z]+)\"', 1) AS lang, len(regexp_extract_all(html, '(?i)<p[ >]'))::BIGINT AS paragraphs FROM pages")
def html_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Identity fields of a page."""
    return read(spark, sf, "pages").select("page_id", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract("html", r'(?i)<html lang="([a-z]+)"', 1).alias("lang"), F.size(F.regexp_extract_all("html", F.lit(r"(?i)<p[ >]"), F.lit(0))).cast("long").alias("paragraphs"))


@family("""
WITH t AS (SELECT page_id, '<table><tr><td>' || page_id || '</td><td><b>' || regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) || '</b></td></tr><tr><td>x</td></tr></table>' AS html, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)
SELECT page_id, 0 AS row, page_id || '|' || host AS cells FROM t UNION ALL SELECT page_id, 1, 'x' FROM t""")
def html_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)
    p = read(spark, sf, "pages").select("page_id", F.concat(F.lit("<table><tr><td>"), F.col("page_id").cast("string"), F.lit("</td><td><b>"), host, F.lit("</b></td></tr><tr><td>x</td></tr></table>")).alias("html"))
    return readers.table_rows(p, "page_id", "html").select("page_id", "row", F.array_join("cells", "|").alias("cells"))


@family("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN 2000 + o_orderkey % 25 END::INTEGER AS year, CASE WHEN o_orderkey % 7 > 0 THEN CASE o_orderkey % 3 WHEN 0 THEN 'AR' WHEN 1 THEN 'SR' ELSE 'IR' END END AS code FROM orders""")
def report_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Year and type code of reports out of their paths; paths of other shapes have none."""
    k = F.col("o_orderkey")
    code = F.element_at(F.array(F.lit("ar"), F.lit("sr"), F.lit("ir")), (k % 3 + 1).cast("int"))
    path = F.concat(F.lit("https://x.example/ken-abc-"), (2000 + k % 25).cast("string"), F.lit("-"), code, F.when(k % 7 == 0, "-x/").otherwise(F.concat(F.lit("-"), F.lpad((k % 9).cast("string"), 2, "0"), F.when(k % 2 == 0, "/").otherwise(""))))
    year, kind = readers.year_and_type(path)
    return read(spark, sf, "orders").select("o_orderkey", year.alias("year"), kind.alias("code"))


@family("SELECT page_id, CAST(nullif(regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/([0-9]+)', 2), '') AS BIGINT) AS number, upper(nullif(regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/([0-9]+)', 1), '')) AS code FROM pages")
def path_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and codes out of paths."""
    pattern = r"^[a-z]+://[^/]+/([a-z]{2})/([0-9]+)"
    return read(spark, sf, "pages").select("page_id", F.nullif(F.regexp_extract("url", pattern, 2), F.lit("")).cast("long").alias("number"), F.upper(F.nullif(F.regexp_extract("url", pattern, 1), F.lit(""))).alias("code"))


@family("SELECT o_custkey, pos, form, coalesce(day, '') AS day FROM (SELECT o_custkey, CAST(pos - 1 AS INT) AS pos, form, CASE WHEN pos <= len(days) THEN days[pos] END AS day FROM (SELECT o_custkey, unnest(range(1, len(forms) + 1)) AS pos, forms, days, forms[pos] AS form FROM (SELECT o_custkey, list(o_orderpriority ORDER BY o_orderkey) AS forms, list(o_orderstatus ORDER BY o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS days FROM orders GROUP BY o_custkey)))")
def columnar_json_explode(spark: SparkSession, sf: str) -> DataFrame:
    """A struct of parallel arrays of unequal length as rows."""
    o = read(spark, sf, "orders")

    def listed(c: str, keep=None):
        items = F.array_sort(F.collect_list(F.struct("o_orderkey", c) if keep is None else F.when(keep, F.struct("o_orderkey", c))))
        return F.transform(items, lambda x: x[c])

    s = o.groupBy("o_custkey").agg(F.struct(listed("o_orderpriority").alias("form"), listed("o_orderstatus", F.col("o_orderstatus") != "P").alias("day")).alias("recent"))
    return readers.columnar(s, "recent", ["form", "day"])


@family("SELECT event_id, event_type, coalesce(CAST(props->>'$.missing' AS VARCHAR), CAST(props->>'$.k' AS VARCHAR), '') AS k FROM events")
def drifting_json_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The first of several field names that a record has."""
    row = F.from_json("props", "map<string,string>")
    return read(spark, sf, "events").select("event_id", "event_type", readers.drifting(row, "missing", "k").alias("k"))


@family("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 100 + c_custkey % 7 END AS total FROM customer")
def checked_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts in a text that add up, else nothing."""
    k = F.col("c_custkey")
    total = (k % 100 + k % 7 + F.when(k % 3 == 0, 0).otherwise(1)).cast("string")
    text = F.concat(F.lit("Main Board: "), (k % 100).cast("string"), F.lit(" GEM: "), (k % 7).cast("string"), F.lit(" Total: "), total)
    return read(spark, sf, "customer").select("c_custkey", readers.company_count(text).cast("long").alias("total"))


@family("SELECT s_suppkey, 'seed' AS origin FROM supplier WHERE s_suppkey <= 10")
def seed_if_empty(spark: SparkSession, sf: str) -> DataFrame:
    """The seed stands in for an empty source."""
    s = read(spark, sf, "supplier")
    return readers.or_seed(s.where("s_suppkey < 0").select("s_suppkey", F.lit("live").alias("origin")), s.where("s_suppkey <= 10").select("s_suppkey", F.lit("seed").alias("origin")))


@family("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'India' WHEN 1 THEN 'Africa' WHEN 2 THEN 'MiddleEast' END AS market, CAST(c_custkey % 90 + 5 AS INT) AS count, CAST(2015 + c_custkey % 4 AS INT) AS first_year, CAST(2020 + c_custkey % 4 AS INT) AS last_year,
       CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 0 END AS "offset", CASE c_custkey % 3 WHEN 0 THEN 'AR' WHEN 1 THEN 'SR' ELSE 'AR,SR' END AS report_types FROM customer""")
def directives(spark: SparkSession, sf: str) -> DataFrame:
    """Requests in plain English as columns."""
    k = F.col("c_custkey")
    market = F.when(k % 4 == 0, " Indian").when(k % 4 == 1, " Kenya").when(k % 4 == 2, " Dubai").otherwise(" Israel")
    kinds = F.when(k % 3 == 0, " issuers for ").when(k % 3 == 1, " ESG issuers for ").otherwise(" annual and climate issuers for ")
    text = F.concat(F.when(k % 2 == 0, "Next ").otherwise("First "), (k % 90 + 5).cast("string"), market, kinds, (2015 + k % 4).cast("string"), F.lit(" to "), (2020 + k % 4).cast("string"))
    return read(spark, sf, "customer").select("c_custkey", *readers.directive(text), *readers.directive_scope(text))


@family("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '/docs/' || event_id WHEN event_id % 3 = 1 THEN 'A' || event_id || '.PDF' ELSE '' END AS path FROM events")
def first_pdf_field(spark: SparkSession, sf: str) -> DataFrame:
    """The field of a record that is a document's path."""
    k, s = F.col("event_id") % 3, F.col("event_id").cast("string")
    row = F.when(k == 0, F.create_map(F.lit("note"), F.lit("x"), F.lit("link"), F.concat(F.lit("/docs/"), s))).when(k == 1, F.create_map(F.lit("zz"), F.concat(F.lit("A"), s, F.lit(".PDF")), F.lit("link"), F.lit("none"))).otherwise(F.create_map(F.lit("link"), F.lit("none")))
    return read(spark, sf, "events").select("event_id", S.first_pdf(row).alias("path"))


@family("SELECT p_partkey, CAST(p_size AS INT) AS pages, CAST(floor((p_size + 0.25) * 1048576) AS BIGINT) AS bytes FROM part")
def pages_and_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The page count and size that a table row ends with."""
    n = F.col("p_size").cast("string")
    pages, size = S.pages_and_size(F.concat(F.col("p_name"), F.lit(" "), n, F.lit(" pages "), n, F.lit(".25MB")))
    return read(spark, sf, "part").select("p_partkey", pages.alias("pages"), size.alias("bytes"))


@family("""
WITH l AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'zz' || s_suppkey || '.x' ELSE 'none' || s_suppkey END AS ticker, 'name' || s_suppkey AS word FROM supplier),
p AS (SELECT 'ken-zz' || s_suppkey || 'x' AS slug FROM supplier WHERE s_suppkey % 2 = 0 UNION SELECT 'ken-name' || s_suppkey || 'plc' FROM supplier WHERE s_suppkey % 5 = 0),
d AS (SELECT s_suppkey, 'ken-' || replace(ticker, '.', '') AS slug FROM l WHERE 'ken-' || replace(ticker, '.', '') IN (SELECT slug FROM p))
SELECT * FROM d UNION ALL SELECT s_suppkey, min(slug) FROM l JOIN p ON starts_with(substr(slug, 5), word) OR starts_with(word, substr(slug, 5)) WHERE s_suppkey NOT IN (SELECT s_suppkey FROM d) GROUP BY s_suppkey""")
def slug_matches(spark: SparkSession, sf: str) -> DataFrame:
    """A site's page for a listing, by guessed names, then by the words of its name."""
    from slotwise.operators import resolve

    s, k = read(spark, sf, "supplier"), F.col("s_suppkey").cast("string")
    listings = s.select("s_suppkey", F.lit("ken").alias("land"), F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("zz"), k, F.lit(".x"))).otherwise(F.concat(F.lit("none"), k)).alias("ticker"), F.array(F.concat(F.lit("name"), k)).alias("words"))
    pages = s.where("s_suppkey % 2 = 0").select(F.concat(F.lit("ken-zz"), k, F.lit("x")).alias("slug")).union(s.where("s_suppkey % 5 = 0").select(F.concat(F.lit("ken-name"), k, F.lit("plc"))))
    return resolve.by_slug(listings, pages, "s_suppkey", "land", F.slice(S.slugs(F.col("land"), F.col("ticker")), 1, 2), F.col("words"))


@family("""
WITH e AS (SELECT user_id, list({t: epoch_us(ts), s: CASE WHEN event_id % 9 = 0 THEN 429 ELSE 200 END::BIGINT, l: 0::BIGINT} ORDER BY epoch_us(ts), event_id) AS es FROM events GROUP BY user_id)
SELECT user_id, CAST(list_reduce(list_prepend({t: es[1].t, s: 0::BIGINT, l: 4::BIGINT}, es), lambda a, e: CASE WHEN e.s = 429 THEN {t: e.t, s: 0::BIGINT, l: greatest(1, a.l // 2)} WHEN e.t - a.t >= 60000000 THEN {t: e.t, s: 0::BIGINT, l: least(16, a.l + 1)} ELSE a END).l AS INT) AS "limit" FROM e""")
def adaptive_limits(spark: SparkSession, sf: str) -> DataFrame:
    """A limit that halves and grows with the responses, replayed for each user."""
    from slotwise.operators import integrity

    e = read(spark, sf, "events").withColumn("status", F.when(F.col("event_id") % 9 == 0, 429).otherwise(200))
    return integrity.adaptive_limit(e, ["user_id"], "ts", "status", "event_id")
