"""Entity resolution and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions import scalars as S
from slotwise.operators import resolve, select
from slotwise.plans.base import Family, read

family = Family()
#: Candidates with keys of falling quality: symbol and market, code, segment name.
CANDIDATES = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'T' || o_custkey ELSE '' END AS ticker, CAST(o_custkey % 25 AS INT) AS market,
 CASE WHEN o_orderkey % 3 = 0 THEN 'I' || (o_custkey / 2)::BIGINT ELSE '' END AS isin, 'NAME ' || (o_custkey % 700) AS name FROM orders"""
ISSUERS = "SELECT c_custkey, 'T' || c_custkey AS ticker, c_nationkey AS market, 'I' || c_custkey AS isin, 'NAME ' || c_custkey AS name FROM customer"


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    half = F.round(c / 2).cast("long").cast("string")
    return read(spark, sf, "orders").select("o_orderkey", F.when(k % 4 == 0, F.concat(F.lit("T"), c.cast("string"))).otherwise("").alias("ticker"), (c % 25).cast("int").alias("market"), F.when(k % 3 == 0, F.concat(F.lit("I"), half)).otherwise("").alias("isin"), F.concat(F.lit("NAME "), (c % 700).cast("string")).alias("name"))


def issuers(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey").cast("string")
    return read(spark, sf, "customer").select("c_custkey", F.concat(F.lit("T"), c).alias("ticker"), F.col("c_nationkey").alias("market"), F.concat(F.lit("I"), c).alias("isin"), F.concat(F.lit("NAME "), c).alias("name"))


CANDIDATES = CANDIDATES.replace("(o_custkey / 2)::BIGINT", "CAST(round(o_custkey / 2.0) AS BIGINT)")


@family(f"""
WITH f AS ({CANDIDATES}), d AS ({ISSUERS}),
h AS (SELECT o_orderkey, c_custkey, 1 AS level FROM f JOIN d ON f.market = d.market AND f.ticker = d.ticker WHERE f.ticker <> ''
 UNION ALL SELECT o_orderkey, c_custkey, 2 FROM f JOIN d ON f.isin = d.isin WHERE f.isin <> '' UNION ALL SELECT o_orderkey, c_custkey, 3 FROM f JOIN d ON f.name = d.name),
e AS (SELECT o_orderkey, level, count(DISTINCT c_custkey) AS n, min(c_custkey) AS c FROM h GROUP BY ALL),
b AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY level) = 1)
SELECT f.o_orderkey, CASE WHEN n = 1 THEN c END AS c_custkey, CAST(level AS INT) AS level, coalesce(n, 0) AS n FROM f LEFT JOIN b USING (o_orderkey)""")
def cascade_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """(market, ticker), then code, then name; only exactly one match counts."""
    f, d = candidates(spark, sf).alias("f"), issuers(spark, sf).alias("d")
    keys = [[(F.col("market"), F.col("market")), (F.col("ticker"), F.col("ticker"))], [(F.col("isin"), F.col("isin"))], [(F.col("name"), F.col("name"))]]
    return resolve.cascade(f, d, "o_orderkey", "c_custkey", keys)


@family(f"""
WITH a AS (SELECT DISTINCT c_custkey, 'N' || (c_custkey % 500) AS alias FROM customer),
q AS (SELECT o_orderkey, 0 AS pos, CASE WHEN o_orderkey % 2 = 0 THEN 'N' || (o_custkey % 900) ELSE '' END AS alias FROM orders UNION ALL SELECT o_orderkey, 1, 'N' || (o_custkey % 1300) FROM orders),
h AS (SELECT o_orderkey, pos, count(DISTINCT c_custkey) AS n, min(c_custkey) AS c FROM q JOIN a USING (alias) GROUP BY ALL),
b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY pos) = 1)
SELECT o.o_orderkey, CASE WHEN n = 1 THEN c END AS c_custkey, CASE WHEN n IS NULL THEN 'unmapped' WHEN n > 1 THEN 'ambiguous' END AS reason FROM orders o LEFT JOIN b USING (o_orderkey)""")
def alias_index_join(spark: SparkSession, sf: str) -> DataFrame:
    """The first of two names that any alias matches; ambiguous ones have a reason."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    names = [F.when(k % 2 == 0, F.concat(F.lit("N"), (c % 900).cast("string"))).otherwise(""), F.concat(F.lit("N"), (c % 1300).cast("string"))]
    return resolve.aliases(read(spark, sf, "orders"), "o_orderkey", names, read(spark, sf, "customer"), "c_custkey", F.concat(F.lit("N"), (F.col("c_custkey") % 500).cast("string")))


@family("""
WITH u AS (SELECT c_nationkey AS nation, floor(c_acctbal / 25)::BIGINT AS band, min(c_custkey) AS c_custkey FROM customer GROUP BY ALL HAVING count(*) = 1)
SELECT o_orderkey, c_custkey FROM orders JOIN u ON o_orderkey % 25 = nation AND o_orderkey // 25 % 440 - 40 = band""")
def unique_match_join(spark: SparkSession, sf: str) -> DataFrame:
    """Only keys that belong to exactly one entity match."""
    key = [F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 25).alias("band")]
    u = read(spark, sf, "customer").groupBy(*key).agg(F.min("c_custkey").alias("c_custkey"), F.count("*").alias("n")).where("n = 1")
    k = F.col("o_orderkey")
    asked = read(spark, sf, "orders").select(k, (k % 25).alias("nation"), (F.floor(k / 25) % 440 - 40).alias("band"))
    return asked.join(u, ["nation", "band"]).select("o_orderkey", "c_custkey")


@family("""
WITH q AS (SELECT s_suppkey, lower(substr(p_name, 1, CAST(1 + s_suppkey % 8 AS INT))) AS wanted FROM supplier JOIN part ON p_partkey = s_suppkey), c AS (SELECT p_partkey, lower(p_name) AS name FROM part)
SELECT s_suppkey, p_partkey FROM q JOIN c ON contains(name, wanted)""")
def substring_theta_join(spark: SparkSession, sf: str) -> DataFrame:
    """Names that contain a query's, met by its rarest gram instead of a nested loop."""
    p = read(spark, sf, "part")
    q = read(spark, sf, "supplier").join(p, F.col("p_partkey") == F.col("s_suppkey")).select("s_suppkey", F.lower(F.expr("substring(p_name, 1, 1 + s_suppkey % 8)")).alias("wanted"))
    return resolve.contains_join(q, p.select("p_partkey", F.lower("p_name").alias("name")), "wanted", "name").select("s_suppkey", "p_partkey")


@family("""
WITH n AS (SELECT c_custkey, 0 AS pos, 'Q' || (c_custkey * 7 % 4000) AS name FROM customer UNION ALL SELECT c_custkey, 1, 'Q' || (c_custkey % 300) FROM customer),
k AS (SELECT 'Q' || s_suppkey AS name, s_suppkey FROM supplier), h AS (SELECT c_custkey, pos, count(*) AS hits, min(s_suppkey) AS s_suppkey FROM n JOIN k USING (name) GROUP BY ALL)
SELECT c_custkey, CAST(pos AS INT) AS pos, hits, s_suppkey FROM h QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY pos) = 1""")
def first_alias_with_hits(spark: SparkSession, sf: str) -> DataFrame:
    """The first of [name] + aliases that has hits wins, with all of them."""
    c = F.col("c_custkey")
    n = read(spark, sf, "customer").select("c_custkey", F.posexplode(F.array(F.concat(F.lit("Q"), (c * 7 % 4000).cast("string")), F.concat(F.lit("Q"), (c % 300).cast("string")))).alias("pos", "name"))
    k = read(spark, sf, "supplier").select(F.concat(F.lit("Q"), F.col("s_suppkey").cast("string")).alias("name"), "s_suppkey")
    h = n.join(k, "name").groupBy("c_custkey", "pos").agg(F.count("*").alias("hits"), F.min("s_suppkey").alias("s_suppkey"))
    return select.best(h, ["c_custkey"], [F.asc("pos")]).select("c_custkey", "pos", "hits", "s_suppkey")


@family("""
WITH a AS (SELECT p_partkey, p_brand, p_type, list_distinct(string_split(upper(p_name), ' ')) AS t FROM part)
SELECT a.p_partkey, b.p_partkey AS other, round_even(len(list_intersect(a.t, b.t)) / greatest(1, least(len(a.t), len(b.t))), 3) AS overlap FROM a JOIN a b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey""")
def token_overlap_match(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of a brand and type with the overlap of their names."""
    p = read(spark, sf, "part").select("p_partkey", "p_brand", "p_type", S.tokens(F.upper("p_name")).alias("t"))
    return resolve.overlap_pairs(p, "p_partkey", "t", ["p_brand", "p_type"]).select("p_partkey", "other", "overlap")


@family("""
WITH a AS (SELECT p_partkey, p_brand, list_distinct(string_split(p_name || ' ' || p_type, ' ')) AS t FROM part),
p AS (SELECT a.p_brand, a.p_partkey, b.p_partkey AS other, len(list_intersect(a.t, b.t)) AS n, least(len(a.t), len(b.t)) AS m FROM a JOIN a b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey)
SELECT p_brand, p_partkey, other, round_even(n / m, 3) AS overlap FROM p WHERE 10 * n >= 6 * m""")
def token_overlap_join(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a brand whose names and types share at least 0.6 of the smaller one's words, met at their rarest words."""
    p = read(spark, sf, "part").select("p_partkey", "p_brand", F.split(F.concat_ws(" ", "p_name", "p_type"), " ").alias("t"))
    return resolve.overlap_join(p, "p_partkey", "t", ["p_brand"], 0.6)


#: The ratio by its definition: the longest common part, the leftmost of equals, and the same left and right of it.
RATIO = """r AS (SELECT id, other, a, b, 0 AS got FROM pairs UNION ALL
 SELECT id, other, u.a, u.b, u.got FROM (SELECT id, other, a, b, best[1] AS n, -best[2] AS i, strpos(b, substr(a, -best[2], best[1])) AS j FROM
  (SELECT id, other, a, b, list_max(flatten(list_transform(range(1, length(a) + 1), lambda i: list_transform(list_filter(range(1, length(a) - i + 2), lambda l: contains(b, substr(a, i, l))), lambda l: [l, -i])))) AS best
   FROM r WHERE a <> '' AND b <> '') WHERE best IS NOT NULL) AS m, LATERAL (VALUES (substr(a, 1, (i - 1)::BIGINT), substr(b, 1, (j - 1)::BIGINT), n), (substr(a, (i + n)::BIGINT), substr(b, (j + n)::BIGINT), 0)) AS u(a, b, got)),
near AS (SELECT id, other, 2.0::DOUBLE * sum(r.got) / (length(any_value(pairs.a)) + length(any_value(pairs.b))) AS similarity FROM r JOIN pairs USING (id, other) GROUP BY id, other),
top AS (SELECT id, other, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, other)::INTEGER AS rank, similarity FROM near QUALIFY rank <= 4)"""
_NAMES = "WITH RECURSIVE pairs AS (SELECT x.p_partkey AS id, y.p_partkey AS other, lower(x.p_name) AS a, lower(y.p_name) AS b FROM part x JOIN part y ON x.p_brand = y.p_brand AND x.p_type = y.p_type AND x.p_partkey <> y.p_partkey),"


@family(f"{_NAMES} {RATIO} SELECT id AS p_partkey, other, rank, similarity FROM top WHERE similarity >= 0.55")
def fuzzy_name_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The four most similar part names of the same brand and type."""
    p = read(spark, sf, "part").withColumn("block", F.concat_ws("|", "p_brand", "p_type"))
    a = p.select("p_partkey", "block", F.lower("p_name").alias("a"))
    b = p.select(F.col("p_partkey").alias("other"), "block", F.lower("p_name").alias("b"))
    return resolve.fuzzy(a, b, "block", "a", "b", "p_partkey", "other").select("p_partkey", "other", "rank", "similarity")


ROSTER = """
a AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'K' || c_custkey END AS isin, 'NAME ' || c_custkey AS name, 'S' || c_custkey AS symbol, '' AS scrip, 'A' AS flag, 0 AS pos FROM customer WHERE c_custkey % 2 = 0),
b AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'K' || c_custkey END, 'NAME ' || c_custkey || CASE WHEN c_custkey % 5 = 0 OR c_custkey % 3 = 0 THEN '' ELSE ' LIMITED' END, '', 'B' || c_custkey, 'B', 1 FROM customer WHERE c_custkey % 7 < 5)"""


@family(f"""
WITH {ROSTER}, x AS (SELECT *, nullif(isin, '') AS k FROM (SELECT * FROM a UNION ALL SELECT * FROM b)), m AS (SELECT name AS nm, min(k) AS by_name FROM x WHERE k IS NOT NULL GROUP BY name),
y AS (SELECT x.*, coalesce(k, by_name, name) AS id FROM x LEFT JOIN m ON nm = name)
SELECT max(k) AS isin, arg_max(name, struct_pack(a := length(name), b := -pos)) AS name, max(nullif(symbol, '')) AS symbol, max(nullif(scrip, '')) AS scrip, array_to_string(list_sort(list_distinct(list(flag))), ',') AS flags FROM y GROUP BY id""")
def roster_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two exchanges' rosters as one: by code, else by name."""
    c = read(spark, sf, "customer")
    k = F.col("c_custkey")
    s = k.cast("string")
    a = c.where("c_custkey % 2 = 0").select(F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("K"), s)).alias("isin"), F.concat(F.lit("NAME "), s).alias("name"), F.concat(F.lit("S"), s).alias("symbol"), F.lit("").alias("scrip"), F.lit("A").alias("flag"))
    plain = (k % 5 == 0) | (k % 3 == 0)
    b = c.where("c_custkey % 7 < 5").select(F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("K"), s)).alias("isin"), F.concat(F.lit("NAME "), s, F.when(plain, "").otherwise(" LIMITED")).alias("name"), F.lit("").alias("symbol"), F.concat(F.lit("B"), s).alias("scrip"), F.lit("B").alias("flag"))
    return resolve.merge_rosters(a, b, "isin", F.col("name"))


@family("SELECT p.page_id, coalesce(m.new_url, p.url) AS url, CASE WHEN m.new_url IS NOT NULL THEN 'MAPPED' ELSE 'DISCOVERED' END AS status FROM pages p LEFT JOIN (SELECT DISTINCT url AS old_url, regexp_replace(url, '^http:', 'https:') AS new_url FROM pages WHERE starts_with(url, 'http:')) m ON m.old_url = p.url")
def url_rewrite_update_join(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses replaced through a mapping table."""
    pages = read(spark, sf, "pages").select("page_id", "url")
    mapping = pages.where(F.col("url").startswith("http:")).select("url", F.regexp_replace("url", "^http:", "https:").alias("new_url")).distinct()
    return pages.join(mapping, "url", "left").select("page_id", F.coalesce("new_url", "url").alias("url"), F.when(F.col("new_url").isNotNull(), "MAPPED").otherwise("DISCOVERED").alias("status"))


@family("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 11 = 0 THEN 'LEI' || c_custkey END, CASE WHEN c_custkey % 13 = 0 THEN 'ALT' || c_custkey END, c_mktsegment) AS lei FROM customer")
def identity_override(spark: SparkSession, sf: str) -> DataFrame:
    """Overrides by key, else by name and nation; blanks replace nothing."""
    c = read(spark, sf, "customer")
    s = F.col("c_custkey").cast("string")
    dim = c.select(s.alias("key"), "c_name", "c_nationkey", F.col("c_mktsegment").alias("lei"))
    by_key = c.where("c_custkey % 11 = 0").select(s.alias("key"), F.lit("").alias("c_name"), F.lit(-1).alias("c_nationkey"), F.concat(F.lit("LEI"), s).alias("lei"))
    by_name = c.where("c_custkey % 13 = 0").select(F.lit("").alias("key"), "c_name", "c_nationkey", F.concat(F.lit("ALT"), s).alias("lei"))
    blank = c.where("c_custkey % 17 = 0 AND c_custkey % 11 <> 0").select(s.alias("key"), F.lit("").alias("c_name"), F.lit(-1).alias("c_nationkey"), F.lit(" ").alias("lei"))
    out = resolve.overrides(dim, by_key.union(by_name).union(blank), "key", ["c_name", "c_nationkey"], ["lei"])
    return out.select(F.col("key").cast("long").alias("c_custkey"), "lei")


@family("""
SELECT isin, max(name) FILTER (WHERE mic = 'XNSE') AS primary_name, max(name) FILTER (WHERE mic = 'XBOM') AS secondary_name, CASE WHEN count(DISTINCT mic) = 2 THEN 'XNSE' ELSE min(mic) END AS mic
FROM (SELECT 'I' || (c_custkey % 1000) AS isin, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'XNSE' ELSE 'XBOM' END AS mic FROM customer) GROUP BY isin""")
def dual_listing_merge(spark: SparkSession, sf: str) -> DataFrame:
    """One row for a code listed on two exchanges; the first is primary."""
    k = F.col("c_custkey")
    x = read(spark, sf, "customer").select(F.concat(F.lit("I"), (k % 1000).cast("string")).alias("isin"), F.col("c_name").alias("name"), F.when(k % 2 == 0, "XNSE").otherwise("XBOM").alias("mic"))

    def name(mic: str):
        return F.max(F.when(F.col("mic") == mic, F.col("name")))

    return x.groupBy("isin").agg(name("XNSE").alias("primary_name"), name("XBOM").alias("secondary_name"), F.when(F.count_distinct("mic") == 2, "XNSE").otherwise(F.min("mic")).alias("mic"))


@family("""
WITH n AS (SELECT c_custkey, 'I' || (c_custkey % 900) AS isin, 'T' || (c_custkey % 800) AS ticker, 'N' || c_nationkey AS name FROM customer), k AS (SELECT 'I' || s_suppkey AS isin, 'T' || (s_suppkey * 3) AS ticker, 'N' || CASE WHEN s_nationkey < 4 THEN s_nationkey END AS name FROM supplier)
SELECT c_custkey FROM n WHERE isin NOT IN (SELECT isin FROM k) AND ticker NOT IN (SELECT ticker FROM k) AND name NOT IN (SELECT name FROM k WHERE name IS NOT NULL)""")
def three_way_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that are known neither by code nor by symbol nor by name."""

    def tag(p: str, c):
        return F.concat(F.lit(p), c.cast("string"))

    k, s = F.col("c_custkey"), F.col("s_suppkey")
    new = read(spark, sf, "customer").select("c_custkey", tag("I", k % 900).alias("isin"), tag("T", k % 800).alias("ticker"), tag("N", F.col("c_nationkey")).alias("name"))
    known = read(spark, sf, "supplier").select(tag("I", s).alias("isin"), tag("T", s * 3).alias("ticker"), tag("N", F.when(F.col("s_nationkey") < 4, F.col("s_nationkey"))).alias("name"))
    return resolve.unknown(new, known, ["isin", "ticker", "name"]).select("c_custkey")


@family("""
SELECT o_orderkey, coalesce(c_mktsegment, n_name, 'unknown') AS lei, CASE WHEN c_mktsegment IS NOT NULL THEN 'ticker' WHEN n_name IS NOT NULL THEN 'name' ELSE 'none' END AS by_key
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) ON c_custkey = o_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON n_nationkey = o_custkey % 25""")
def scalar_enrich_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """One lookup, and another where it misses."""
    a = read(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    b = read(spark, sf, "nation").where("n_nationkey < 20").select("n_nationkey", "n_name")
    o = read(spark, sf, "orders").join(a, "o_custkey", "left").join(F.broadcast(b), F.col("o_custkey") % 25 == F.col("n_nationkey"), "left")
    return o.select("o_orderkey", F.coalesce("c_mktsegment", "n_name", F.lit("unknown")).alias("lei"), F.when(F.col("c_mktsegment").isNotNull(), "ticker").when(F.col("n_name").isNotNull(), "name").otherwise("none").alias("by_key"))


@family("""
SELECT c_mktsegment, c_nationkey, arg_min(symbol, struct_pack(a := CASE WHEN ends_with(symbol, '.N0000') THEN 0 ELSE 1 END, b := symbol)) AS symbol
FROM (SELECT *, 'A' || c_custkey || CASE WHEN c_custkey % 4 = 0 THEN '.N0000' ELSE '.X0000' END AS symbol FROM customer) GROUP BY ALL""")
def preferred_symbol(spark: SparkSession, sf: str) -> DataFrame:
    """A voting share if an issuer has one, else the first symbol."""
    k = F.col("c_custkey")
    symbol = F.concat(F.lit("A"), k.cast("string"), F.when(k % 4 == 0, ".N0000").otherwise(".X0000"))
    x = read(spark, sf, "customer").withColumn("symbol", symbol)
    return x.groupBy("c_mktsegment", "c_nationkey").agg(F.min(F.struct((~F.col("symbol").endswith(".N0000")).cast("int").alias("a"), "symbol"))["symbol"].alias("symbol"))


@family("""
SELECT coalesce(c_custkey, s_suppkey) AS id, coalesce(s_name, p_name, c_name) AS name, CASE WHEN c_custkey IS NULL THEN 'profile' WHEN s_suppkey IS NULL THEN 'counter' ELSE 'both' END AS origin
FROM customer LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size < 20) ON p_partkey = c_custkey FULL JOIN (SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0) ON s_suppkey = c_custkey""")
def three_source_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Counters with metadata, and profiles that override names or stand alone."""
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    p = read(spark, sf, "part").where("p_size < 20").select(F.col("p_partkey").alias("id"), "p_name")
    s = read(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("id"), "s_name")
    out = c.join(p, "id", "left").join(s, "id", "full_outer")
    return out.select("id", F.coalesce("s_name", "p_name", "c_name").alias("name"), F.when(F.col("c_name").isNull(), "profile").when(F.col("s_name").isNull(), "counter").otherwise("both").alias("origin"))


@family("""
SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'UNAVAILABLE' WHEN 1 THEN 'UNAVAILABLE' WHEN 4 THEN 'VERIFIED' WHEN 5 THEN 'VERIFIED' WHEN 6 THEN 'VERIFIED' WHEN 7 THEN 'VERIFIED' ELSE 'REVIEW' END AS status,
 CASE c_custkey % 9 WHEN 0 THEN 'non_uk_isin_jurisdiction' WHEN 1 THEN 'non_uk_registration_number' WHEN 2 THEN 'no_companies_house_profile_found' WHEN 3 THEN 'listed_plc_matched_to_private_ltd_subsidiary' WHEN 4 THEN 'confirmed_by_gleif_crn_and_name'
 WHEN 5 THEN 'confirmed_by_authoritative_gleif_lei_crn' WHEN 6 THEN 'confirmed_by_exact_legal_name_and_plc_type' WHEN 7 THEN 'confirmed_by_exact_legal_name_and_plc_type' ELSE 'ambiguous_company_match_requires_review' END AS reason FROM customer""")
def company_match(spark: SparkSession, sf: str) -> DataFrame:
    """Listed companies against register profiles, one customer in nine for each of the rules and for none."""
    k = F.col("c_custkey")
    s, way = k.cast("string"), k % 9
    none = F.array().cast("array<string>")
    listed = read(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("Acme Widget"), s, F.when(way == 3, " PLC").otherwise(" Holdings (UK) /NEW/")).alias("company_name"), F.lit("").alias("legal_name"), none.alias("aliases"),
        F.when(way == 0, "US0000000000").otherwise("GB0000000000").alias("isin"), F.when(way == 1, "HRB 77").when(way.isin(4, 5), s).otherwise("").alias("register_no"),
        F.when(way != 2, F.lpad(s, 8, "0")).alias("profile_no"), F.when(way.isin(5, 8), F.concat(F.lit("Other Thing"), s)).when(way == 7, F.concat(F.lit("New Name"), s)).otherwise(F.concat(F.lit("ACME WIDGET"), s)).alias("profile_name"),
        F.when(way == 3, "private-limited").otherwise("plc").alias("profile_type"), F.when(way == 7, F.array(F.concat(F.lit("Acme Widget"), s, F.lit(" plc")))).otherwise(none).alias("previous_names"),
    )
    return resolve.company_match(listed).select("c_custkey", "status", "reason")


@family(f"""{_NAMES} {RATIO} SELECT id AS p_partkey, other, rank FROM top WHERE similarity >= 0.55 AND id % 3 = other % 3 QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank) = 1""")
def acceptable_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Each listing's first acceptable page among the four with the most similar names."""
    p = read(spark, sf, "part")
    ticker, block = F.concat(F.lit("T"), (F.col("p_partkey") % 3).cast("string")), F.concat_ws("|", "p_brand", "p_type").alias("block")
    a = p.select("p_partkey", block, F.lower("p_name").alias("a"), ticker.alias("ticker"))
    b = p.select(F.col("p_partkey").alias("other"), block, F.lower("p_name").alias("b"), ticker.alias("found"))
    return resolve.first_acceptable(a, b, "block", "a", "b", "p_partkey", "other", "ticker", "found").select("p_partkey", "other", "rank")

