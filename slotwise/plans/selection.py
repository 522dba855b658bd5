"""Ranking and choosing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.operators import integrity, select
from slotwise.plans.base import Family, read
from slotwise.plans.coverage import FILINGS, filings

family = Family()
PRIORITY = "CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END"
SLOT = ["c_custkey", "year"]


def ranked_sql(order: str, extra: str = "") -> str:
    return f"SELECT o_custkey AS c_custkey, yr AS year, o_orderkey{extra} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, yr ORDER BY {order}) AS rn, count(*) OVER (PARTITION BY o_custkey, yr) AS n FROM {FILINGS}) WHERE rn = 1"


@family(ranked_sql("o_orderdate, o_orderkey"))
def first_per_slot(spark: SparkSession, sf: str) -> DataFrame:
    return select.best(filings(spark, sf), SLOT, [F.asc("o_orderdate"), F.asc("o_orderkey")]).select(*SLOT, "o_orderkey")


@family(f"SELECT count(*) FILTER (WHERE o_orderstatus <> 'F') AS non_pdf, count(*) FILTER (WHERE o_orderstatus = 'F') - count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN (o_custkey, yr) END) AS extras, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN (o_custkey, yr) END) AS slots FROM {FILINGS}")
def first_per_slot_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the choice of one filing a slot leaves out: other formats, counted before, and further filings."""
    f = filings(spark, sf)
    pdf = f.where("o_orderstatus = 'F'").groupBy(*SLOT).agg(F.count("*").alias("n"))
    other = f.agg(F.count_if(F.col("o_orderstatus") != "F").alias("non_pdf"))
    return pdf.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extras"), F.count("*").alias("slots")).crossJoin(F.broadcast(other)).select("non_pdf", "extras", "slots")  # one row each


@family(ranked_sql("o_orderdate DESC, o_orderkey"))
def latest_per_slot(spark: SparkSession, sf: str) -> DataFrame:
    return select.best(filings(spark, sf), SLOT, [F.desc("o_orderdate"), F.asc("o_orderkey")]).select(*SLOT, "o_orderkey")


@family(ranked_sql("o_totalprice DESC, o_orderkey % 60 DESC, o_orderdate DESC, o_orderkey", ", n AS candidates, CASE WHEN n > 1 THEN 'multiple_candidates' ELSE '' END AS note"))
def best_by_score_pages_date(spark: SparkSession, sf: str) -> DataFrame:
    """Score, then pages, then date; with the number of candidates and a note."""
    out = select.best(filings(spark, sf), SLOT, [F.desc("o_totalprice"), F.desc(F.col("o_orderkey") % 60), F.desc("o_orderdate"), F.asc("o_orderkey")], count="candidates")
    return out.select(*SLOT, "o_orderkey", "candidates", F.when(F.col("candidates") > 1, "multiple_candidates").otherwise("").alias("note"))


@family(ranked_sql(f"CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END, {PRIORITY}, o_totalprice DESC, o_orderkey"))
def best_preferred_language(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(1).asc(), F.expr(PRIORITY).asc(), F.desc("o_totalprice"), F.asc("o_orderkey")]
    return select.best(filings(spark, sf), SLOT, order).select(*SLOT, "o_orderkey")


@family(ranked_sql(f"{PRIORITY} DESC, o_totalprice DESC, o_orderdate DESC, o_orderkey"))
def best_by_source_priority(spark: SparkSession, sf: str) -> DataFrame:
    return select.best(filings(spark, sf), SLOT, [F.expr(PRIORITY).desc(), F.desc("o_totalprice"), F.desc("o_orderdate"), F.asc("o_orderkey")]).select(*SLOT, "o_orderkey")


@family(f"""
WITH p AS (SELECT * FROM (VALUES ('1-URGENT', 9), ('3-MEDIUM', 7)) t(source, priority)),
r AS (SELECT o.*, row_number() OVER (PARTITION BY o_custkey, yr ORDER BY coalesce(priority, 0) DESC, o_totalprice DESC, o_orderkey DESC) AS rn FROM {FILINGS} o LEFT JOIN p ON source = o_orderpriority),
d AS (SELECT DISTINCT o_custkey, yr FROM {FILINGS} WHERE o_orderstatus = 'F')
SELECT r.o_custkey AS c_custkey, r.yr AS year, o_orderkey, CASE WHEN d.yr IS NOT NULL THEN 'DONE' ELSE 'FOUND' END AS status FROM r LEFT JOIN d ON d.o_custkey = r.o_custkey AND d.yr = r.yr WHERE rn = 1""")
def best_sticky_done(spark: SparkSession, sf: str) -> DataFrame:
    """Priority by a dimension (missing: 0), then score, then the newest id; a slot that is done stays done."""
    dim = spark.createDataFrame([("1-URGENT", 9), ("3-MEDIUM", 7)], "o_orderpriority string, priority int")
    f = filings(spark, sf)
    done = f.where("o_orderstatus = 'F'").select(*SLOT).distinct().withColumn("done", F.lit(True))
    picked = select.best(f.join(F.broadcast(dim), "o_orderpriority", "left"), SLOT, [F.coalesce("priority", F.lit(0)).desc(), F.desc("o_totalprice"), F.desc("o_orderkey")])
    return picked.join(done, SLOT, "left").select(*SLOT, "o_orderkey", F.when(F.col("done"), "DONE").otherwise("FOUND").alias("status"))


SCORE = "CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE floor(o_totalprice / 1000) END AS BIGINT)"


@family(f"SELECT o_custkey AS c_custkey, yr AS year, o_orderkey, score FROM (SELECT *, {SCORE} AS score, row_number() OVER (PARTITION BY o_custkey, yr ORDER BY {SCORE} DESC, o_orderkey) AS rn FROM {FILINGS}) WHERE rn = 1 AND score <> 0")
def argmax_truthy_having(spark: SparkSession, sf: str) -> DataFrame:
    """The row of the greatest score; slots whose greatest score is 0 vanish."""
    f = filings(spark, sf).withColumn("score", F.expr(SCORE))
    return select.argmax_truthy(f, SLOT, F.col("score"), [F.asc("o_orderkey")]).select(*SLOT, "o_orderkey", "score")


POINTS = "CAST(l_quantity * 3 - 20 AS BIGINT)"


@family(f"SELECT l_orderkey, l_linenumber, score FROM (SELECT l_orderkey, l_linenumber, {POINTS} AS score, max({POINTS}) OVER (PARTITION BY l_orderkey) AS best, row_number() OVER (PARTITION BY l_orderkey ORDER BY {POINTS} DESC, l_linenumber) AS rn FROM lineitem) WHERE (rn = 1 AND score >= 0) OR (rn > 1 AND score >= 100 AND best - score <= 25)")
def near_tie_attachments(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").withColumn("score", F.expr(POINTS))
    return select.near_ties(li, ["l_orderkey"], "score", F.asc("l_linenumber")).where("selected").select("l_orderkey", "l_linenumber", "score")


@family("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_extendedprice DESC, l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def keyword_else_largest(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.when(F.col("l_returnflag") == "R", 0).otherwise(1).asc(), F.desc("l_extendedprice"), F.asc("l_linenumber")]
    return select.best(read(spark, sf, "lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_linenumber")


@family("""
WITH p AS (SELECT l_orderkey, l_linenumber, l_linestatus, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')),
n AS (SELECT l_orderkey FROM p GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) >= 2)
SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS INT) AS part_no FROM p WHERE l_orderkey IN (SELECT l_orderkey FROM n)""")
def multipart_numbering(spark: SparkSession, sf: str) -> DataFrame:
    part = F.when(F.col("l_returnflag").isin("A", "R"), F.col("l_returnflag"))
    return select.numbered_parts(read(spark, sf, "lineitem"), ["l_orderkey"], part, [F.asc("l_linenumber")]).select("l_orderkey", "l_linenumber", "part_no")


@family("SELECT l_orderkey, arg_max(l_linenumber, struct_pack(a := l_extendedprice, b := -l_linenumber)) AS l_linenumber, max(l_extendedprice) AS size FROM lineitem GROUP BY l_orderkey")
def largest_member(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(F.max_by("l_linenumber", F.struct(F.col("l_extendedprice"), -F.col("l_linenumber"))).alias("l_linenumber"), F.max("l_extendedprice").alias("size"))


@family(f"SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND count(*) FILTER (WHERE o_orderstatus = 'F') OVER (PARTITION BY o_custkey, yr) > 1 THEN 'REVIEW' ELSE o_orderstatus END AS status FROM {FILINGS}")
def demote_multiple(spark: SparkSession, sf: str) -> DataFrame:
    """Several accepted filings of one slot all go to review."""
    return select.demote_multiple(filings(spark, sf), SLOT, "o_orderstatus", "F", "REVIEW").select("o_orderkey", F.col("o_orderstatus").alias("status"))


@family("""
WITH x AS (SELECT l_partkey, l_suppkey, count(DISTINCT l_returnflag || l_linestatus) AS n_identities FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT l_orderkey, l_linenumber, CASE WHEN n_identities > 1 THEN 'review' ELSE 'ok' END AS outcome FROM lineitem JOIN x USING (l_partkey, l_suppkey)""")
def conflict_to_review(spark: SparkSession, sf: str) -> DataFrame:
    """Several documents for one path all go to review; equal duplicates don't."""
    out = select.conflicts(read(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"], ["l_returnflag", "l_linestatus"])
    return out.select("l_orderkey", "l_linenumber", F.when(F.col("n_identities") > 1, "review").otherwise("ok").alias("outcome"))


@family("SELECT page_id, host, CAST(row_number() OVER (PARTITION BY host ORDER BY page_id) AS INT) AS turn FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)")
def host_interleave(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"))
    return select.interleaved(pages, "host", [F.asc("page_id")])


@family("""
SELECT event_id, n AS in_window, CASE WHEN n >= 3 THEN (epoch_us(oldest) + 3000000000000 - epoch_us(ts)) / 1e6 ELSE 0.0 END AS wait FROM (SELECT event_id, ts, count(*) OVER w AS n, min(ts) OVER w AS oldest
 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3000000 SECONDS PRECEDING AND CURRENT ROW))""")
def rolling_budget_wait(spark: SparkSession, sf: str) -> DataFrame:
    """How many requests are in the window, and how long to wait until one leaves."""
    return integrity.rolling(read(spark, sf, "events"), ["user_id"], "ts", 3_000_000, 3, "event_id").select("event_id", "in_window", "wait")


@family("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 300 SECONDS PRECEDING AND CURRENT ROW) AS in_window FROM events")
def rolling_budget_300s(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.rolling(read(spark, sf, "events"), ["user_id"], "ts", 300, 3, "event_id").select("event_id", "in_window")


@family("WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders) SELECT o_orderkey FROM r WHERE pos IN (SELECT CAST(round_even(i * (n - 1) / 10.0, 0) AS BIGINT) FROM (SELECT unnest(range(0, 11)) AS i, (SELECT count(*) FROM orders) AS n))")
def quantile_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Eleven filings at even distances by size."""
    return select.evenly_spaced(read(spark, sf, "orders"), [F.asc("o_totalprice"), F.asc("o_orderkey")], 11).select("o_orderkey")


@family(f"""
WITH f AS (SELECT o_custkey, min(yr) AS first_year, list_distinct(list(yr)) AS years FROM {FILINGS} GROUP BY o_custkey)
SELECT o_custkey AS c_custkey, CAST(first_year AS INT) AS first_year, count(y) FILTER (WHERE NOT list_contains(years, y)) AS gaps FROM (SELECT *, unnest(range(first_year, 2002)) AS y FROM f) GROUP BY o_custkey, first_year""")
def gap_list_after_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    f = filings(spark, sf).groupBy("c_custkey").agg(F.min("year").alias("first_year"), F.collect_set("year").alias("years"))
    return f.select("c_custkey", "first_year", F.size(F.array_except(F.sequence(F.col("first_year"), F.lit(2001)), "years")).cast("long").alias("gaps"))


@family("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 ORDER BY upper(trim(c_name)), c_custkey OFFSET 20 LIMIT 50")
def exact_n_cohort(spark: SparkSession, sf: str) -> DataFrame:
    return select.cohort(read(spark, sf, "customer").where("c_acctbal > 0"), F.upper(F.trim("c_name")), 20, 50).select("c_custkey", "c_name")


@family(f"SELECT o_custkey AS c_custkey, o_orderkey, CAST(rn AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM {FILINGS}) WHERE rn <= 4")
def top_four_by_score(spark: SparkSession, sf: str) -> DataFrame:
    return select.best(filings(spark, sf), ["c_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], n=4, rank="rank").select("c_custkey", "o_orderkey", "rank")


@family("""
SELECT c_custkey, CAST(xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c_name, ''), lambda x: ascii(x)::BIGINT)),
 lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS INT) AS shard FROM customer""")
def shard_crc32(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select("c_custkey", select.shard_crc32(F.col("c_name"), 4).alias("shard"))


@family("SELECT c_custkey, CAST(('0x' || substr(sha256(c_name), 1, 16))::UBIGINT % 7 AS INT) AS shard FROM customer")
def shard_sha256(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select("c_custkey", select.shard_sha256(F.col("c_name"), 7).alias("shard"))


@family("SELECT c_custkey, CAST(('0x' || substr(sha1(c_name), 1, 16))::UBIGINT % 5 AS INT) AS shard FROM customer")
def shard_sha1(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select("c_custkey", select.shard_sha1(F.col("c_name"), 5).alias("shard"))


@family("SELECT o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 3) AS BIGINT) AS chunk FROM orders")
def chunked_batches(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select("o_orderkey", select.chunk_number([F.asc("o_orderkey")], ["o_custkey"], 3).cast("long").alias("chunk"))


@family(f"""
WITH b AS (SELECT o_custkey, yr, kind, o_orderkey FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 'IR' WHEN o_orderkey % 5 < 3 THEN 'AR' ELSE 'SR' END AS kind FROM {FILINGS}) QUALIFY row_number() OVER (PARTITION BY o_custkey, yr, kind ORDER BY o_totalprice DESC, o_orderkey) = 1),
s AS (SELECT DISTINCT o_custkey, yr, want FROM b CROSS JOIN (SELECT unnest(['AR', 'SR']) AS want))
SELECT s.o_custkey AS c_custkey, s.yr AS year, want AS kind, coalesce(x.o_orderkey, i.o_orderkey) AS o_orderkey, CASE WHEN x.o_orderkey IS NOT NULL THEN 'own' WHEN i.o_orderkey IS NOT NULL THEN 'integrated' ELSE 'none' END AS by_type
FROM s LEFT JOIN b x ON x.o_custkey = s.o_custkey AND x.yr = s.yr AND x.kind = want LEFT JOIN b i ON i.o_custkey = s.o_custkey AND i.yr = s.yr AND i.kind = 'IR'""")
def typed_slot_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The best of each type; an integrated report stands in for the type that a slot lacks."""
    f = filings(spark, sf).withColumn("kind", F.when(F.col("o_orderkey") % 5 == 0, "IR").when(F.col("o_orderkey") % 5 < 3, "AR").otherwise("SR"))
    b = select.best(f, [*SLOT, "kind"], [F.desc("o_totalprice"), F.asc("o_orderkey")]).select(*SLOT, "kind", "o_orderkey")
    s = b.select(*SLOT).distinct().withColumn("kind", F.explode(F.array(F.lit("AR"), F.lit("SR"))))
    ir = b.where("kind = 'IR'").select(*SLOT, F.col("o_orderkey").alias("_ir"))
    out = s.join(b, [*SLOT, "kind"], "left").join(ir, SLOT, "left")
    return out.select(*SLOT, "kind", F.coalesce("o_orderkey", "_ir").alias("o_orderkey"), F.when(F.col("o_orderkey").isNotNull(), "own").when(F.col("_ir").isNotNull(), "integrated").otherwise("none").alias("by_type"))


@family("""
WITH w AS (SELECT conv_id, turn, role, unnest(string_split(text, ' ')) AS word, unnest(range(0, len(string_split(text, ' ')))) AS pos FROM conversations)
SELECT conv_id, role, length(word)::INTEGER AS kind, turn, pos::INTEGER AS pos, word FROM w WHERE word <> '' QUALIFY row_number() OVER (PARTITION BY conv_id, role, length(word) ORDER BY turn, pos, word) = 1""")
def first_nested_item(spark: SparkSession, sf: str) -> DataFrame:
    """The first item of each kind in nested lists: by the outer order (turns), then by the list's own (words)."""
    flat = read(spark, sf, "conversations").select("conv_id", "role", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word")).where("word <> ''")
    return select.first_nested(flat, ["conv_id", "role", F.length("word").alias("kind")], ["turn", "pos", "word"])


@family("SELECT source, max(length(text)) AS longest, arg_max(doc_id, struct_pack(a := length(text), b := -doc_id)) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY source")
def longest_text_wins(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").where("text IS NOT NULL").select("source", "doc_id", F.length("text").alias("size"))
    return d.groupBy("source").agg(F.max("size").cast("long").alias("longest"), F.max_by("doc_id", F.struct(F.col("size"), -F.col("doc_id"))).alias("doc_id"))


@family(f"SELECT o_custkey AS c_custkey, yr AS year, CAST(sum(gap) AS BIGINT) AS changes FROM (SELECT o_custkey, yr, CASE WHEN o_orderstatus <> lag(o_orderstatus) OVER (PARTITION BY o_custkey, yr ORDER BY o_orderdate, o_orderkey) THEN 1 ELSE 0 END AS gap FROM {FILINGS}) GROUP BY o_custkey, yr")
def status_changes_in_slot(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy(*SLOT).orderBy("o_orderdate", "o_orderkey")
    f = filings(spark, sf).withColumn("gap", F.when(F.col("o_orderstatus") != F.lag("o_orderstatus").over(w), 1).otherwise(0))
    return f.groupBy(*SLOT).agg(F.sum("gap").alias("changes"))
