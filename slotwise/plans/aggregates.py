"""Counts, sums, shares, percentiles, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators import integrity, spine
from slotwise.plans.base import Family, read
from slotwise.plans.coverage import FILINGS, filings

family = Family()


@family("SELECT count(*) AS candidates, count(*) FILTER (WHERE o_orderstatus = 'F') AS verified, count(*) FILTER (WHERE o_orderstatus = 'P') AS amended, count(DISTINCT o_custkey) AS issuers FROM orders")
def global_counts(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("o_orderstatus")
    return read(spark, sf, "orders").agg(F.count("*").alias("candidates"), F.count_if(s == "F").alias("verified"), F.count_if(s == "P").alias("amended"), F.count_distinct("o_custkey").alias("issuers"))


@family("SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS large, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS quantity FROM lineitem GROUP BY l_returnflag")
def filtered_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") > 25).alias("large"), F.coalesce(F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))), F.lit(0.0)).alias("quantity"))


@family("SELECT l_returnflag, l_linestatus, sum(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END)::BIGINT AS full_reports, sum(CASE WHEN l_quantity <= 5 THEN 1 ELSE 0 END)::BIGINT AS short_reports, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS bytes FROM lineitem GROUP BY l_returnflag, l_linestatus")
def conditional_sums(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity")
    return read(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.when(q >= 40, 1).otherwise(0)).alias("full_reports"), F.sum(F.when(q <= 5, 1).otherwise(0)).alias("short_reports"), F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("bytes"))


@family("SELECT o_orderpriority, count(*) AS candidates, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS selected FROM orders GROUP BY o_orderpriority")
def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("candidates"), F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("selected"))


@family("SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY c_mktsegment, c_nationkey")
def group_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))


@family(f"SELECT count(*) AS duplicate_slots, coalesce(sum(n - 1), 0)::BIGINT AS surplus FROM (SELECT count(*) AS n FROM {FILINGS} WHERE o_orderstatus = 'F' GROUP BY o_custkey, yr HAVING count(*) > 1)")
def duplicate_slots_having(spark: SparkSession, sf: str) -> DataFrame:
    f = filings(spark, sf).where("o_orderstatus = 'F'").groupBy("c_custkey", "year").agg(F.count("*").alias("n")).where("n > 1")
    return f.agg(F.count("*").alias("duplicate_slots"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"))


@family(f"SELECT o_custkey AS c_custkey, yr AS year, string_agg(o_orderstatus, ' | ' ORDER BY o_orderstatus) AS states FROM {FILINGS} GROUP BY o_custkey, yr HAVING count(*) > 1")
def group_concat_multi(spark: SparkSession, sf: str) -> DataFrame:
    out = filings(spark, sf).groupBy("c_custkey", "year").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("o_orderstatus")), " | ").alias("states"))
    return out.where("n > 1").drop("n")


@family(f"SELECT yr AS year, count(DISTINCT o_custkey) AS issuers, count(DISTINCT o_orderpriority) AS sources FROM {FILINGS} GROUP BY yr")
def distinct_entities_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return filings(spark, sf).groupBy("year").agg(F.count_distinct("c_custkey").alias("issuers"), F.count_distinct("o_orderpriority").alias("sources"))


@family("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select("p_brand", "p_type").distinct()


@family("SELECT coalesce(c_mktsegment, 'TOTAL') AS segment, count(*) AS issuers, count(*) FILTER (WHERE c_acctbal > 0) AS eligible FROM customer GROUP BY ROLLUP (c_mktsegment)")
def universe_summary_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by group and a grand total."""
    out = read(spark, sf, "customer").rollup("c_mktsegment").agg(F.count("*").alias("issuers"), F.count_if(F.col("c_acctbal") > 0).alias("eligible"))
    return out.select(F.coalesce("c_mktsegment", F.lit("TOTAL")).alias("segment"), "issuers", "eligible")


@family("SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY event_type")
def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest-rank percentiles."""
    return read(spark, sf, "events").groupBy("event_type").agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY value)").alias(n) for p, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))])


@family("""
SELECT event_type, count(*) AS documents, round(count(*) / greatest(0.001, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6), 9) AS per_second,
       round(60 * count(*) / greatest(0.001, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6), 7) AS per_minute FROM events GROUP BY event_type""")
def throughput_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Rates over the elapsed time, which counts as a millisecond at least."""
    span = F.greatest(F.lit(0.001), F.unix_micros(F.max("ts").cast("timestamp")) / 1e6 - F.unix_micros(F.min("ts").cast("timestamp")) / 1e6)
    return read(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("documents"), F.round(F.count("*") / span, 9).alias("per_second"), F.round(60 * F.count("*") / span, 7).alias("per_minute"))


@family("""
WITH m AS (SELECT p_brand, p_size, median(p_retailprice) AS med FROM part GROUP BY p_brand, p_size HAVING bool_and(p_retailprice > 905)), w AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY med, p_size) = 1),
b AS (SELECT p_brand, min(p_retailprice) * 1.04 AS champion FROM part WHERE p_brand <> 'Brand#11' GROUP BY p_brand)
SELECT p_brand, p_size, med AS median, champion IS NULL OR med <= 0.95 * champion AS promoted FROM w LEFT JOIN b USING (p_brand)""")
def median_config_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The fastest valid configuration by median takes the champion's place if it is five per cent better."""
    p = read(spark, sf, "part").withColumn("ok", F.col("p_retailprice") > 905)
    before = p.where("p_brand <> 'Brand#11'").groupBy("p_brand").agg((F.min("p_retailprice") * 1.04).alias("champion"))
    return integrity.promotions(p, before, ["p_brand"], ["p_size"], "p_retailprice", "ok")


@family("""
WITH t AS (SELECT p_brand, 1 + p_size * p_partkey % 130 AS workers, 1 + p_partkey % 2 AS lanes, p_retailprice AS s, p_retailprice > 905 AS ok FROM part),
m AS (SELECT p_brand, workers, lanes, median(s) AS med FROM t GROUP BY ALL HAVING bool_and(ok)), w AS (SELECT p_brand, workers, lanes FROM m QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY med, workers, lanes) = 1),
n AS (SELECT p_brand, workers, lanes FROM w UNION SELECT p_brand, greatest(1, workers // 2), lanes FROM w UNION SELECT p_brand, least(128, workers * 2), lanes FROM w UNION SELECT p_brand, workers, least(2, lanes + 1) FROM w UNION SELECT p_brand, workers, greatest(1, lanes - 1) FROM w)
SELECT p_brand, workers::BIGINT AS workers, lanes::BIGINT AS lanes FROM n WHERE lanes <= workers""")
def next_configurations(spark: SparkSession, sf: str) -> DataFrame:
    """What to measure next around the fastest valid configuration."""
    t = read(spark, sf, "part").select("p_brand", (1 + F.col("p_size") * F.col("p_partkey") % 130).alias("workers"), (1 + F.col("p_partkey") % 2).alias("lanes"), F.col("p_retailprice").alias("s"), (F.col("p_retailprice") > 905).alias("ok"))
    return integrity.next_configurations(t, ["p_brand"], "workers", "lanes", "s", "ok")


@family(f"""
SELECT o_custkey AS c_custkey, yr AS year, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS ar_filings, count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS ar_downloads,
       count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS sr_filings, count(*) FILTER (WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F') AS sr_downloads FROM {FILINGS} GROUP BY o_custkey, yr""")
def wide_counts(spark: SparkSession, sf: str) -> DataFrame:
    """One conditional aggregation for what would be a correlated count for each column."""
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    return filings(spark, sf).groupBy("c_custkey", "year").agg(*[F.count_if(c).alias(n) for n, c in (("ar_filings", p == "1-URGENT"), ("ar_downloads", (p == "1-URGENT") & (s == "F")), ("sr_filings", p == "2-HIGH"), ("sr_downloads", (p == "2-HIGH") & (s == "F")))])


@family("SELECT event_type, count(*) AS n, CAST(rank() OVER (ORDER BY count(*) DESC) AS INT) AS place FROM events GROUP BY event_type")
def most_common(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window as W

    few = read(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))  # a row for each type
    return few.withColumn("place", F.rank().over(W.orderBy(F.desc("n"))))


@family("SELECT count(*) FILTER (WHERE l_returnflag IN ('A', 'R')) AS promoted, count(*) FILTER (WHERE l_returnflag = 'N') AS staged, count(*) FILTER (WHERE l_quantity > 0 AND l_linestatus = 'F') AS verified FROM lineitem")
def run_tallies(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("l_returnflag")
    return read(spark, sf, "lineitem").agg(F.count_if(r.isin("A", "R")).alias("promoted"), F.count_if(r == "N").alias("staged"), F.count_if((F.col("l_quantity") > 0) & (F.col("l_linestatus") == "F")).alias("verified"))


@family("""
WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 9000), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 0)
SELECT count(*) AS deduped, count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS dual_listed, count(*) FILTER (WHERE b.k IS NULL) AS only_a, count(*) FILTER (WHERE a.k IS NULL) AS only_b FROM a FULL JOIN b ON a.k = b.k""")
def dual_listing_stats(spark: SparkSession, sf: str) -> DataFrame:
    a = read(spark, sf, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).distinct().withColumn("a", F.lit(True))
    b = read(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("k")).distinct().withColumn("b", F.lit(True))
    x, y = F.col("a").isNotNull(), F.col("b").isNotNull()
    return a.join(b, "k", "full_outer").agg(F.count("*").alias("deduped"), F.count_if(x & y).alias("dual_listed"), F.count_if(~y).alias("only_a"), F.count_if(~x).alias("only_b"))


@family(f"SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, yr) AS candidates, concat_ws(';', CASE WHEN count(*) OVER (PARTITION BY o_custkey, yr) > 1 THEN 'multiple_candidates' END, CASE WHEN o_orderstatus = 'P' THEN 'heuristic_year' END) AS note FROM {FILINGS}")
def slot_notes(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window as W

    n = F.count("*").over(W.partitionBy("c_custkey", "year"))
    return filings(spark, sf).select("o_orderkey", n.alias("candidates"), F.concat_ws(";", F.when(n > 1, "multiple_candidates"), F.when(F.col("o_orderstatus") == "P", "heuristic_year")).alias("note"))


@family("SELECT split_part(path, '/', 4) AS language, split_part(path, '/', 3) AS host, count(*) AS files, count(DISTINCT split_part(path, '/', 5)) AS folders FROM (SELECT url AS path FROM pages) GROUP BY 1, 2")
def path_group_keys(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.split("url", "/")

    def part(i: int):
        return F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))

    return read(spark, sf, "pages").groupBy(part(4).alias("language"), part(3).alias("host")).agg(F.count("*").alias("files"), F.count_distinct(part(5)).alias("folders"))


@family("SELECT source, round(sum(n_chars) / pow(1024, 3), 12) AS gib, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY source")
def gigabytes(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").groupBy("source").agg(F.round(F.sum("n_chars") / F.pow(F.lit(1024), F.lit(3)), 12).alias("gib"), F.sum("n_chars").alias("bytes"))


@family("SELECT l_linestatus, round_even(100.0 * count(*) FILTER (WHERE l_returnflag = 'R') / count(*), 2) AS coverage_pct FROM lineitem GROUP BY l_linestatus")
def coverage_rate(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").groupBy("l_linestatus").agg(spine.rate(F.count_if(F.col("l_returnflag") == "R"), F.count("*")).alias("coverage_pct"))
