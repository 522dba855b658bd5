"""Upserts, snapshots and state changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.operators import integrity, merge
from slotwise.plans.base import Family, read

family = Family()
OLD = "SELECT c_custkey AS k, c_name AS name, c_mktsegment AS note, c_acctbal AS score FROM customer WHERE c_custkey % 3 <> 0"
NEW = "SELECT c_custkey AS k, 'new ' || c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'fresh' END AS note, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal + 1 END AS score FROM customer WHERE c_custkey % 2 = 0"


def old(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").where("c_custkey % 3 <> 0").selectExpr("c_custkey AS k", "c_name AS name", "c_mktsegment AS note", "c_acctbal AS score")


def new(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").where("c_custkey % 2 = 0").selectExpr("c_custkey AS k", "concat('new ', c_name) AS name", "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'fresh' END AS note", "CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal + 1 END AS score")


def merged_sql(name: str, note: str, score: str) -> str:
    return f"WITH o AS ({OLD}), n AS ({NEW}) SELECT coalesce(o.k, n.k) AS k, {name} AS name, {note} AS note, {score} AS score FROM o FULL JOIN n ON o.k = n.k"


def fresh(c: str) -> str:
    return f"CASE WHEN n.k IS NOT NULL THEN n.{c} ELSE o.{c} END"


@family(merged_sql(fresh("name"), fresh("note"), fresh("score")))
def upsert_full(spark: SparkSession, sf: str) -> DataFrame:
    return merge.upsert(old(spark, sf), new(spark, sf), ["k"])


@family(merged_sql(fresh("name"), "CASE WHEN o.k IS NOT NULL THEN o.note ELSE n.note END", fresh("score")))
def upsert_partial(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge(old(spark, sf), new(spark, sf), ["k"], {"name": "new", "note": "old", "score": "new"})


@family(merged_sql("coalesce(nullif(n.name, ''), o.name)", "coalesce(nullif(n.note, ''), nullif(o.note, ''))", "coalesce(n.score, o.score)"))
def merge_nonempty_wins(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge(old(spark, sf), new(spark, sf), ["k"], {"name": "nonempty", "note": "nonempty", "score": "coalesce"})


@family(merged_sql("coalesce(o.name, n.name)", "coalesce(o.note, n.note)", "coalesce(o.score, n.score)"))
def set_once(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge(old(spark, sf), new(spark, sf), ["k"], {"name": "set_once", "note": "set_once", "score": "set_once"})


@family(f"WITH o AS ({OLD}), n AS ({NEW}) SELECT * FROM o UNION ALL SELECT * FROM n WHERE k NOT IN (SELECT k FROM o)")
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    return merge.insert_ignore(old(spark, sf), new(spark, sf), ["k"], [F.asc("name")])


@family("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def last_write_of_batch(spark: SparkSession, sf: str) -> DataFrame:
    return merge.last_of_batch(read(spark, sf, "orders"), ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus")


@family(f"WITH o AS ({OLD}), n AS ({NEW}) SELECT coalesce(o.k, n.k) AS k, {fresh('name')} AS name, {fresh('note')} AS note, {fresh('score')} AS score, n.k IS NOT NULL AS active FROM o FULL JOIN n ON o.k = n.k")
def snapshot_refresh_scd(spark: SparkSession, sf: str) -> DataFrame:
    return merge.snapshot_refresh(old(spark, sf), new(spark, sf), ["k"])


@family("SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT))::BIGINT AS attempts, arg_max(l_returnflag, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey, d := l_extendedprice)) AS l_returnflag FROM lineitem GROUP BY l_orderkey")
def attempts_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").withColumns({"attempts": F.col("l_quantity").cast("long"), "seq": F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")})
    return merge.accumulate(li, ["l_orderkey"], "seq", "l_returnflag")


@family("SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O', 'P') THEN 'CANDIDATE_FOUND' ELSE o_orderstatus END AS status FROM orders")
def guarded_transition(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select("o_orderkey", merge.transition(F.col("o_orderstatus"), ["O", "P"], F.lit("CANDIDATE_FOUND")).alias("status"))


@family("SELECT o_orderkey, CASE WHEN d.l_orderkey IS NOT NULL THEN 'DONE' ELSE o_orderstatus END AS status FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 40) d ON d.l_orderkey = o_orderkey")
def status_propagation(spark: SparkSession, sf: str) -> DataFrame:
    """Finished downloads finish their slot."""
    d = read(spark, sf, "lineitem").where("l_returnflag = 'A' AND l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("d", F.lit(True))
    return read(spark, sf, "orders").join(d, "o_orderkey", "left").select("o_orderkey", F.when(F.col("d"), "DONE").otherwise(F.col("o_orderstatus")).alias("status"))


@family("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS status FROM orders")
def stale_reset(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select("o_orderkey", merge.reset_stale(F.col("o_orderstatus"), "P", "O").alias("status"))


@family("SELECT o_custkey, o_orderstatus, o_orderkey, 'AR' AS report_type FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1")
def schema_migration(spark: SparkSession, sf: str) -> DataFrame:
    """A new column with a default, and a new key."""
    o = read(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    return merge.migrate(o, {"report_type": F.lit("AR")}, ["o_custkey", "o_orderstatus"], [F.asc("o_orderkey")])


@family("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def retention_delete(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").where("ts >= TIMESTAMP '2024-01-15 00:00:00'").select("event_id")


@family("""
WITH s AS (SELECT doc_id, CASE WHEN doc_id % 10 <> 0 THEN 'p' || (doc_id - doc_id % 2) END AS path, sha256(coalesce(text, '')) AS digest FROM documents), e AS (SELECT 'p' || doc_id AS path, sha256(coalesce(text, '')) AS digest FROM documents WHERE doc_id % 3 = 1)
SELECT doc_id, CASE WHEN s.path IS NULL THEN 'STAGED_UNRESOLVED_IDENTITY' WHEN e.path IS NULL THEN 'PROMOTED' WHEN e.digest = s.digest THEN 'IDEMPOTENT_EXISTING' ELSE 'CONFLICT' END AS result FROM s LEFT JOIN e ON e.path = s.path""")
def promotion_decision(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of each staged document, a third of all being there already under their paths."""
    d = read(spark, sf, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    staged = d.withColumn("path", F.when(F.col("doc_id") % 10 != 0, F.concat(F.lit("p"), (F.col("doc_id") - F.col("doc_id") % 2).cast("string"))))
    existing = d.where("doc_id % 3 = 1").withColumn("path", F.concat(F.lit("p"), F.col("doc_id").cast("string")))
    return merge.promotion(staged, existing, "path", "digest").select("doc_id", "result")


@family("""
SELECT o_orderkey, CASE WHEN l.status = 'DONE' AND f.k IS NOT NULL THEN 'skip' WHEN l.status = 'DONE' THEN 'error' WHEN f.k IS NOT NULL THEN 'recover' ELSE 'pending' END AS action FROM orders
LEFT JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'DONE' ELSE 'FAILED' END AS status FROM orders WHERE o_orderkey % 2 = 0) l ON l.k = o_orderkey LEFT JOIN (SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 100000) f ON f.k = o_orderkey""")
def resume_decision(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    ledger = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "DONE").otherwise("FAILED").alias("status"))
    return merge.resume(o.select("o_orderkey"), ledger, o.where("o_totalprice > 100000").select("o_orderkey"), "o_orderkey")


ATTEMPTS = """SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS attempt,
 CASE l_returnflag WHEN 'R' THEN 'FAILED' ELSE 'DONE' END AS status, CASE WHEN l_linestatus = 'F' THEN 'not found' ELSE 'timeout' END AS error FROM lineitem"""


@family(f"SELECT l_orderkey, CAST(max(attempt) AS INT) AS attempts, arg_max(status, attempt) AS status, arg_max(error, attempt) AS error, arg_max(status, attempt) = 'FAILED' AND NOT coalesce(arg_max(error, attempt) IN ('not found', 'forbidden'), false) AS retry FROM ({ATTEMPTS}) GROUP BY l_orderkey")
def retry_final_status(spark: SparkSession, sf: str) -> DataFrame:
    """The state after the last pass; permanent errors aren't tried again."""
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    li = read(spark, sf, "lineitem").select("l_orderkey", F.row_number().over(w).alias("attempt"), F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("DONE").alias("status"), F.when(F.col("l_linestatus") == "F", "not found").otherwise("timeout").alias("error"))
    return integrity.retries(li, "l_orderkey", "attempt", ["not found", "forbidden"])


@family("""
WITH l AS (SELECT o_orderkey AS k, CAST(o_totalprice AS BIGINT) AS bytes, o_orderpriority AS sha FROM orders WHERE o_orderkey % 7 <> 0), f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE CAST(o_totalprice AS BIGINT) END AS length, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderpriority END AS digest FROM orders WHERE o_orderkey % 11 <> 0)
SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN f.k IS NULL THEN 'missing' END, CASE WHEN l.k IS NULL THEN 'orphan' END, CASE WHEN bytes <> length THEN 'size_mismatch' END, CASE WHEN sha <> digest THEN 'hash_mismatch' END], lambda x: x IS NOT NULL)) AS reason FROM l FULL JOIN f ON l.k = f.k) GROUP BY reason""")
def ledger_verify(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    ledger = o.where("o_orderkey % 7 <> 0").selectExpr("o_orderkey AS k", "CAST(round(o_totalprice) AS BIGINT) AS bytes", "o_orderpriority AS sha256")
    files = o.where("o_orderkey % 11 <> 0").selectExpr("o_orderkey AS k", "CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE CAST(round(o_totalprice) AS BIGINT) END AS length", "CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderpriority END AS digest")
    return integrity.verify(ledger, files, "k").groupBy("reason").agg(F.count("*").alias("n"))


@family("""
WITH l AS (SELECT o_orderkey AS k, CAST(o_totalprice AS BIGINT) AS bytes, o_orderpriority AS sha FROM orders WHERE o_orderkey % 7 <> 0), f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE CAST(o_totalprice AS BIGINT) END AS length, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderpriority END AS digest FROM orders WHERE o_orderkey % 11 <> 0)
SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN f.k IS NULL THEN 'missing' END, CASE WHEN l.k IS NULL THEN 'orphan' END, CASE WHEN bytes <> length THEN 'size_mismatch' END], lambda x: x IS NOT NULL)) AS reason FROM l FULL JOIN f ON l.k = f.k) GROUP BY reason""")
def ledger_verify_shallow(spark: SparkSession, sf: str) -> DataFrame:
    """Without a look at contents."""
    o = read(spark, sf, "orders")
    ledger = o.where("o_orderkey % 7 <> 0").selectExpr("o_orderkey AS k", "CAST(round(o_totalprice) AS BIGINT) AS bytes", "o_orderpriority AS sha256")
    files = o.where("o_orderkey % 11 <> 0").selectExpr("o_orderkey AS k", "CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE CAST(round(o_totalprice) AS BIGINT) END AS length", "CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderpriority END AS digest")
    return integrity.verify(ledger, files, "k", deep=False).groupBy("reason").agg(F.count("*").alias("n"))


@family("SELECT doc_id, min_id AS original FROM documents d JOIN (SELECT source, sha256(text) AS h, min(doc_id) AS min_id FROM documents WHERE text IS NOT NULL GROUP BY ALL HAVING count(*) > 1) g ON g.source = d.source AND g.h = sha256(d.text) WHERE doc_id <> min_id")
def content_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Copies within one parent, with the original."""
    d = read(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    return integrity.content_duplicates(d, ["source"], "digest", "doc_id").select("doc_id", "original")


@family("""
WITH a AS (SELECT doc_id, quality, toxic FROM labels WHERE doc_id % 10 <> 1), b AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS quality, toxic FROM labels WHERE doc_id % 10 <> 2)
SELECT count(*) FILTER (WHERE a.doc_id IS NULL) AS missing, count(*) FILTER (WHERE b.doc_id IS NULL) AS extra, count(*) FILTER (WHERE a.quality <> b.quality OR a.toxic <> b.toxic) AS different, count(*) FILTER (WHERE a.quality = b.quality AND a.toxic = b.toxic) AS equal FROM a FULL JOIN b USING (doc_id)""")
def golden_compare(spark: SparkSession, sf: str) -> DataFrame:
    lab = read(spark, sf, "labels").select("doc_id", "quality", "toxic")
    other = lab.where("doc_id % 10 <> 2").withColumn("quality", F.when(F.col("doc_id") % 7 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    return integrity.golden(lab.where("doc_id % 10 <> 1"), other, "doc_id", ["quality", "toxic"])


@family("SELECT o_orderkey, CASE WHEN l_orderkey IS NULL THEN 'missing' WHEN size = 0 THEN 'zero' WHEN size <> lines THEN 'mismatch' ELSE 'valid' END AS state FROM (SELECT o_orderkey, o_orderkey % 5 AS lines FROM orders) LEFT JOIN (SELECT l_orderkey, CAST(count(*) - 1 AS BIGINT) AS size FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey")
def size_check(spark: SparkSession, sf: str) -> DataFrame:
    files = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg((F.count("*") - 1).alias("length"))
    return integrity.size_check(read(spark, sf, "orders").selectExpr("o_orderkey", "o_orderkey % 5 AS bytes"), files, "o_orderkey").select("o_orderkey", "state")


@family("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F') d WHERE d.o_custkey = orders.o_custkey AND d.o_orderpriority = orders.o_orderpriority)")
def checkpoint_skip(spark: SparkSession, sf: str) -> DataFrame:
    """What is done for a key and source is skipped."""
    o = read(spark, sf, "orders")
    return o.join(o.where("o_orderstatus = 'F'").select("o_custkey", "o_orderpriority"), ["o_custkey", "o_orderpriority"], "left_anti").select("o_orderkey")
