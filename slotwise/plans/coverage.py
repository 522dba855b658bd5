"""Spines, gaps, coverage and the joins around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators import resolve, select, spine
from slotwise.plans.base import FIRST_YEAR, LAST_YEAR, Family, read

family = Family()
YEARS = f"(SELECT unnest(range({FIRST_YEAR}, {LAST_YEAR + 1})) AS year)"
FILINGS = "(SELECT *, CAST(year(o_orderdate) AS INT) AS yr FROM orders)"


def slots(spark: SparkSession, sf: str) -> DataFrame:
    return spine.spine(read(spark, sf, "customer"), "c_custkey", FIRST_YEAR, LAST_YEAR)


def filings(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    return o.withColumn("year", F.year("o_orderdate")).withColumnRenamed("o_custkey", "c_custkey")


@family(f"""
WITH picked AS (SELECT o_custkey, yr, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, yr ORDER BY o_orderdate, o_orderkey) AS rn FROM {FILINGS}) WHERE rn = 1)
SELECT n_name, y.year, count(*) AS expected, count(p.o_custkey) AS discovered, count(*) FILTER (WHERE p.o_orderstatus = 'F') AS verified,
       count(*) - count(p.o_custkey) AS missing, round_even(100.0 * count(*) FILTER (WHERE p.o_orderstatus = 'F') / count(*), 2) AS coverage_pct
FROM customer JOIN nation ON c_nationkey = n_nationkey CROSS JOIN {YEARS} y LEFT JOIN picked p ON p.o_custkey = c_custkey AND p.yr = y.year
GROUP BY n_name, y.year""")
def slot_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """The coverage report: expected, discovered, verified and missing slots of each nation and year."""
    picked = select.best(filings(spark, sf), ["c_custkey", "year"], [F.asc("o_orderdate"), F.asc("o_orderkey")])
    picked = picked.select("c_custkey", "year", "o_orderstatus", F.lit(1).alias("found"))
    issuers = read(spark, sf, "customer").join(F.broadcast(read(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # nations: a fixed 25 rows
    issuers = issuers.select("c_custkey", "n_name")
    state = slots(spark, sf).join(picked, ["c_custkey", "year"], "left").join(issuers, "c_custkey")
    out = state.groupBy("n_name", "year").agg(F.count("*").alias("expected"), F.count("found").alias("discovered"), F.count_if(F.col("o_orderstatus") == "F").alias("verified"))
    return out.withColumn("missing", F.col("expected") - F.col("discovered")).withColumn("coverage_pct", spine.rate(F.col("verified"), F.col("expected")))


@family(f"SELECT c_custkey, year FROM customer CROSS JOIN {YEARS} y WHERE EXISTS (SELECT 1 FROM {FILINGS} o WHERE o.o_custkey = c_custkey AND o.yr = y.year)")
def slots_discovered_semi(spark: SparkSession, sf: str) -> DataFrame:
    return spine.covered(slots(spark, sf), filings(spark, sf), ["c_custkey", "year"])


@family(f"SELECT c_custkey, year FROM customer CROSS JOIN {YEARS} y WHERE EXISTS (SELECT 1 FROM {FILINGS} o JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND o.o_custkey = c_custkey AND o.yr = y.year)")
def slots_verified_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    stored = read(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return spine.covered(slots(spark, sf), filings(spark, sf).join(stored, "o_orderkey", "left_semi"), ["c_custkey", "year"])


@family(f"SELECT c_custkey, year FROM customer CROSS JOIN {YEARS} y WHERE NOT EXISTS (SELECT 1 FROM {FILINGS} o WHERE o.o_custkey = c_custkey AND o.yr = y.year)")
def missing_slots_anti(spark: SparkSession, sf: str) -> DataFrame:
    return spine.missing(slots(spark, sf), filings(spark, sf), ["c_custkey", "year"])


@family(f"SELECT o_orderkey FROM {FILINGS} a WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM {FILINGS} b WHERE b.o_orderstatus = 'F' AND b.o_custkey = a.o_custkey AND b.yr = a.yr)")
def jobs_without_sibling_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to convert: those without a finished sibling in the same slot."""
    f = filings(spark, sf)
    return f.where("o_orderstatus = 'O'").join(f.where("o_orderstatus = 'F'").select("c_custkey", "year"), ["c_custkey", "year"], "left_anti").select("o_orderkey")


@family("SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey HAVING count(*) FILTER (WHERE l_quantity > 45) = 0")
def filings_without_attachment_anti(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    have = read(spark, sf, "orders").join(li.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return have.join(li.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


@family("SELECT c_custkey, c_acctbal FROM customer c WHERE EXISTS (SELECT 1 FROM customer k WHERE k.c_acctbal > 5000 AND k.c_mktsegment IN ('BUILDING', 'MACHINERY') AND k.c_custkey = c.c_custkey AND k.c_name = c.c_name AND k.c_nationkey = c.c_nationkey AND k.c_mktsegment = c.c_mktsegment AND k.c_acctbal = c.c_acctbal)")
def cohort_identity_semi(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose whole listing identity is in the cohort."""
    c = read(spark, sf, "customer")
    picked = c.where("c_acctbal > 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
    return c.join(picked, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"], "left_semi").select("c_custkey", "c_acctbal")


@family("SELECT o_orderkey, c_name, CASE WHEN c_custkey IS NULL THEN 'company not in universe' END AS reason FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey")
def lookup_join_with_review_reason(spark: SparkSession, sf: str) -> DataFrame:
    universe = read(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return resolve.lookup(read(spark, sf, "orders").select("o_orderkey", "o_custkey"), universe, ["o_custkey"], "company not in universe").drop("o_custkey")


@family("SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F'")
def facts_with_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer").join(F.broadcast(read(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return read(spark, sf, "orders").where("o_orderstatus = 'F'").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name")


LISTED = "CAST(1994 + c_custkey % 9 AS INT)"


@family(f"SELECT c_custkey, CAST(y AS INT) AS year FROM (SELECT c_custkey, unnest(range(greatest({FIRST_YEAR}, {LISTED}), {LAST_YEAR + 1})) AS y FROM customer)")
def listing_year_spine(spark: SparkSession, sf: str) -> DataFrame:
    """Slots from the listing year on."""
    return spine.spine(read(spark, sf, "customer"), "c_custkey", F.greatest(F.lit(FIRST_YEAR), F.expr(LISTED)), LAST_YEAR)


@family(f"SELECT s_suppkey, year, kind FROM supplier CROSS JOIN {YEARS} CROSS JOIN (SELECT unnest(['AR', 'SR']) AS kind)")
def typed_spine_cross(spark: SparkSession, sf: str) -> DataFrame:
    return spine.spine(read(spark, sf, "supplier"), "s_suppkey", FIRST_YEAR, LAST_YEAR, ["AR", "SR"])


@family(f"""
WITH done AS (SELECT o_custkey AS k, yr FROM {FILINGS} WHERE o_orderstatus = 'F' UNION SELECT o_custkey, yr FROM {FILINGS} WHERE o_totalprice > 200000)
SELECT 'verified' AS part, count(*) AS n FROM done
UNION ALL SELECT 'open', count(*) FROM (SELECT c_custkey, CAST(year AS INT) FROM customer CROSS JOIN {YEARS} EXCEPT SELECT k, yr FROM done)
UNION ALL SELECT 'both', count(*) FROM (SELECT o_custkey, yr FROM {FILINGS} WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey, yr FROM {FILINGS} WHERE o_totalprice > 200000)""")
def slot_set_union_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Union, difference and intersection of sets of slots."""
    f = filings(spark, sf)
    a, b = (f.where(x).select("c_custkey", "year") for x in ("o_orderstatus = 'F'", "o_totalprice > 200000"))
    done = a.union(b).distinct()
    parts = {"verified": done, "open": slots(spark, sf).join(done, ["c_custkey", "year"], "left_anti"), "both": a.intersect(b)}
    out = [d.agg(F.lit(name).alias("part"), F.count("*").alias("n")) for name, d in parts.items()]
    return out[0].union(out[1]).union(out[2])


@family(f"""
WITH a AS (SELECT DISTINCT o_custkey, yr FROM {FILINGS} WHERE o_orderpriority = '1-URGENT'),
b AS (SELECT DISTINCT o_custkey, yr FROM {FILINGS} WHERE o_orderpriority = '2-HIGH' AND (o_custkey, yr) NOT IN (SELECT o_custkey, yr FROM a)),
c AS (SELECT DISTINCT o_custkey, yr FROM {FILINGS} WHERE o_orderpriority = '5-LOW' AND (o_custkey, yr) NOT IN (SELECT o_custkey, yr FROM a) AND (o_custkey, yr) NOT IN (SELECT o_custkey, yr FROM b))
SELECT source, yr AS year, count(*) AS slots FROM (SELECT 'first' AS source, * FROM a UNION ALL SELECT 'second', * FROM b UNION ALL SELECT 'third', * FROM c) GROUP BY source, yr""")
def fallback_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Each source fills only the slots that the ones before left open."""
    f = filings(spark, sf)
    sources = [f.where(F.col("o_orderpriority") == p).select("c_custkey", "year").distinct().withColumn("source", F.lit(s)) for p, s in (("1-URGENT", "first"), ("2-HIGH", "second"), ("5-LOW", "third"))]
    return spine.cascade_sources(slots(spark, sf), sources, ["c_custkey", "year"]).groupBy("source", "year").agg(F.count("*").alias("slots"))


@family(f"""
SELECT c_custkey, yr AS year, o_orderkey FROM (SELECT c_custkey, yr, o_orderkey, row_number() OVER (PARTITION BY c_custkey, yr ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM customer JOIN {FILINGS} ON o_custkey = c_custkey) x
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM {FILINGS} v WHERE v.o_orderstatus = 'F' AND v.o_custkey = x.c_custkey AND v.yr = x.yr)""")
def export_unverified_slots(spark: SparkSession, sf: str) -> DataFrame:
    """The newest filing of each slot that isn't verified: exports never overwrite."""
    f = filings(spark, sf)
    done = f.where("o_orderstatus = 'F'").select("c_custkey", "year")
    return select.best(f, ["c_custkey", "year"], [F.desc("o_orderdate"), F.asc("o_orderkey")]).join(done, ["c_custkey", "year"], "left_anti").select("c_custkey", "year", "o_orderkey")


@family(f"SELECT c_custkey, year, count(o_orderkey) AS candidates FROM customer CROSS JOIN {YEARS} y LEFT JOIN {FILINGS} o ON o.o_custkey = c_custkey AND o.yr = y.year GROUP BY c_custkey, year")
def coverage_all_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The coverage variant that joins all candidates of a slot, not the selected one."""
    return slots(spark, sf).join(filings(spark, sf).select("c_custkey", "year", "o_orderkey"), ["c_custkey", "year"], "left").groupBy("c_custkey", "year").agg(F.count("o_orderkey").alias("candidates"))
