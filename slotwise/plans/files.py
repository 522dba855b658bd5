"""Readers, writers and streams: rows of the driver's tables go out in the shared folder and come back."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators import select
from slotwise.plans.base import Family, read, scratch
from slotwise.sources import archives, readers, writers
from slotwise.streaming import streams

family = Family()


def _archived(rows: DataFrame, path: str) -> None:
    """Archives below path, written by tasks from rows (archive, member, seq, data): a member's data in the order of seq.

    An archive is written under a name of its own and then moved, so that a task may run again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = archives.filesystem(path)
        now, member, out, z, stream, at = None, None, None, None, None, ""

        def close() -> None:
            stream.close()
            z.close()
            out.close()
            fs.move(at, f"{folder}/{now}")

        for batch in batches:
            for archive, name, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if archive != now:
                    if z is not None:
                        close()
                    at = f"{folder}/.{archive}-{uuid.uuid4().hex}"
                    fs.create_dir(f"{folder}/{archive}".rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(at)
                    now, member, stream, z = archive, None, None, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                if name != member:
                    if stream is not None:
                        stream.close()
                    member, stream = name, z.open(name, "w")
                stream.write(data)
        if z is not None:
            close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([1], pa.int32())})

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(n, "archive").sortWithinPartitions("archive", "member", "seq").select("archive", "member", "data").mapInArrow(run, "n int").agg(F.sum("n")).collect()


@family("""
SELECT 'T' || s_suppkey AS ticker, CASE WHEN s_suppkey % 5 = 0 THEN 'country must be USA or GBR' WHEN s_suppkey % 3 = 0 THEN 'fiscal_year must look like FY2024' WHEN s_suppkey % 7 = 0 THEN 'pdf_url must be an absolute HTTPS URL' END AS reason FROM supplier""")
def manifest_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest file's rows, each with the first rule that it breaks."""
    k, s = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    values = {"country": F.when(k % 5 == 0, "FRA").otherwise("GBR"), "exchange": F.lit("XLON"), "lei": F.lpad(s, 20, "0"), "isin": F.concat(F.lit("GB"), F.lpad(s, 10, "0")), "ticker": F.concat(F.lit("T"), s), "fiscal_year": F.when(k % 3 == 0, "2024").otherwise("FY2024"), "report_type": F.lit("AR"), "language": F.lit("EN"), "pdf_url": F.concat(F.when(k % 7 == 0, "http").otherwise("https"), F.lit("://a.example/x,y.pdf")), "source_page": F.lit(""), "verified": F.lit("true")}
    path = scratch(spark, "manifest")
    read(spark, sf, "supplier").select(*[v.alias(n) for n, v in values.items()]).coalesce(1).write.option("header", True).option("escape", "\"").csv(path)
    valid, rejected = readers.manifest(spark, path)
    return valid.select("ticker", F.lit(None).cast("string").alias("reason")).union(rejected.select("ticker", "reason"))


@family("""
SELECT o_orderkey::VARCHAR AS key, CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority || chr(10) || 'a,"b"' || chr(13) || chr(10) WHEN 1 THEN o_orderstatus ELSE o_orderpriority END AS note,
 row_number() OVER (ORDER BY o_orderkey) + 1 AS line FROM orders""")
def quoted_csv_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The records of a CSV file with quoted line breaks, read by splits, with the lines that one task would give them."""
    k, path = F.col("o_orderkey"), scratch(spark, "quoted")
    note = F.when(k % 4 == 0, F.concat(F.lit('"'), "o_orderpriority", F.lit('\na,""b""\r\n"'))).when(k % 4 == 1, F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))).otherwise(F.col("o_orderpriority"))
    blank = F.when(k % 7 == 0, "\r\n").otherwise("\r")
    text = read(spark, sf, "orders").select(k, F.concat(k.cast("string"), F.lit(","), note, blank).alias("value"))
    text.orderBy("o_orderkey").select("value").write.text(f"{path}/parts")
    writers.one_file(spark, f"{path}/parts", f"{path}/whole/orders.csv", b'"key",note\r\n')
    path = f"{path}/whole"
    return readers.strict_csv(spark, path, ["note", "key"]).select("key", "note", F.col("line").cast("long").alias("line"))


@family("SELECT 'GBR|XLON|L' || s_suppkey || '|I' || s_suppkey || '|T' || s_suppkey AS company_key, s_name AS company_name FROM supplier")
def universe_roster(spark: SparkSession, sf: str) -> DataFrame:
    """A roster file with each listing once."""
    s = F.col("s_suppkey").cast("string")
    values = {"company_name": F.col("s_name"), "country": F.lit("GBR"), "exchange": F.lit("XLON"), "lei": F.concat(F.lit("L"), s), "isin": F.concat(F.lit("I"), s), "ticker": F.concat(F.lit("T"), s), "cik": F.lit(""), "aliases": F.lit("a;b")}
    path = scratch(spark, "universe")
    read(spark, sf, "supplier").select(*[v.alias(n) for n, v in values.items()]).coalesce(1).write.option("header", True).csv(path)
    return readers.universe(spark, path).select("company_key", "company_name")


@family("SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_mktsegment END AS name, '' AS phone FROM customer")
def header_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Targets from columns of any of several names, the first that isn't blank."""
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("Cust Key"), F.when(F.col("c_custkey") % 3 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("ISSUER_NAME"), F.col("c_name").alias("name"))
    return readers.by_aliases(c, {"id": ["id", "cust-key"], "name": ["issuer name", "NAME"], "phone": ["tel"]})


@family("SELECT o_orderkey, o_orderpriority AS name FROM orders")
def mixed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of CSV files, JSON lines, and archives of both and of JSON lists, by each name."""
    path, o = scratch(spark, "records"), read(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("name"))
    way = F.col("key") % 4
    o.where(way == 0).write.option("header", True).csv(f"{path}/csv")
    o.where(way == 1).select(F.to_json(F.struct("key", "name")).alias("value")).write.text(f"{path}/lines")
    lines = o.where(way > 1).withColumn("list", way == 2).select((F.col("key") % 5).alias("a"), "list", "key", F.to_json(F.struct("key", "name")).alias("value"))
    archive = F.concat(F.lit("b"), F.col("a").cast("string"), F.lit(".zip")).alias("archive")
    member = F.when(F.col("list"), "in/list.json").otherwise("in/lines.jsonl").alias("member")
    body = lines.select(archive, member, F.col("key").alias("seq"), F.when(F.col("list"), F.concat("value", F.lit(","))).otherwise(F.concat("value", F.lit("\n"))).alias("data"))
    ends = lines.where("list").select(archive, member).distinct().select("archive", "member", F.explode(F.array(F.struct(F.lit(-(1 << 62)).alias("seq"), F.lit('{"meta": {"n": [1]}, "results": [').alias("data")), F.struct(F.lit(1 << 62).alias("seq"), F.lit("null]}").alias("data")))).alias("e")).select("archive", "member", "e.*")
    unsafe = lines.select(archive, F.lit("../d.json").alias("member"), F.lit(0).alias("seq"), F.lit("[{}]").alias("data")).distinct()
    _archived(body.union(ends).union(unsafe).withColumn("data", F.col("data").cast("binary")), f"{path}/zip")
    # the names of Spark's text files have no suffix of JSON lines
    rest = spark.read.json(f"{path}/lines", schema="key long, name string").select(F.create_map(F.lit("key"), F.col("key").cast("string"), F.lit("name"), F.col("name")).alias("row"))
    return readers.records(spark, path).select("row").union(rest).select(F.col("row")["key"].cast("long").alias("o_orderkey"), F.col("row")["name"].alias("name"))


@family("SELECT c_custkey, c_name AS name FROM customer WHERE c_custkey % 10 > 0")
def zip_facts_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Members of archives picked by their names, and their JSON."""
    path, k = scratch(spark, "facts"), F.col("c_custkey")
    member = F.when(k % 10 > 0, F.concat(F.lit("CIK"), F.lpad(k.cast("string"), 10, "0"), F.lit(".json"))).otherwise(F.concat(F.lit("readme"), k.cast("string"), F.lit(".txt")))
    fact = F.to_json(F.struct(F.struct(F.col("c_name").alias("name")).alias("entity")))
    _archived(read(spark, sf, "customer").select(F.concat(F.lit("facts"), (k % 3).cast("string"), F.lit(".zip")).alias("archive"), member.alias("member"), k.alias("seq"), fact.cast("binary").alias("data")), path)
    found = readers.zip_members(spark, path, r"CIK[0-9]{10}\.json$").withColumn("text", F.col("content").cast("string"))
    return found.select(F.regexp_extract("member", "CIK([0-9]+)", 1).cast("long").alias("c_custkey"), F.get_json_object("text", "$.entity.name").alias("name"))


@family("""
SELECT l_suppkey % 7 AS archive, l_linenumber::INT AS member, l_orderkey, CASE WHEN l_orderkey % 10 = 0 THEN l_returnflag || chr(65533) || ', "' || chr(10) ELSE l_returnflag END AS mode
FROM lineitem WHERE l_linenumber % 2 = 1""")
def archive_csv_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the CSV members of archives that are picked by name, in batches while they are decompressed; bytes
    that are no UTF-8 are replaced."""
    path, k = scratch(spark, "archives"), F.col("l_orderkey")
    own = [F.concat(F.lit("fca"), (F.col("l_suppkey") % 7).cast("string"), F.lit(".zip")).alias("archive"), F.concat(F.lit("map/part-"), F.col("l_linenumber").cast("string"), F.lit(".csv")).alias("member")]
    # a byte that is no UTF-8, and signs that need quotes
    odd = F.concat(F.lit('"').cast("binary"), F.col("l_returnflag").cast("binary"), F.unhex(F.lit("FF")), F.lit(', ""\n"').cast("binary"))
    data = F.concat(k.cast("string").cast("binary"), F.lit(",").cast("binary"), F.when(k % 10 == 0, odd).otherwise(F.col("l_returnflag").cast("binary")), F.lit("\r\n").cast("binary"))
    rows = read(spark, sf, "lineitem").select(*own, F.monotonically_increasing_id().alias("seq"), data.alias("data"))
    heads = rows.select("archive", "member").distinct().select("archive", "member", F.lit(-1).cast("long").alias("seq"), F.lit("\ufefforder,mode\r\n").cast("binary").alias("data"))
    _archived(rows.union(heads), path)
    found = readers.archive_rows(spark, path, r"part-[13579]\.csv$")
    return found.select(F.regexp_extract("path", "fca([0-9])", 1).cast("long").alias("archive"), F.regexp_extract("member", "part-([0-9])", 1).cast("int").alias("member"), F.col("row")["order"].cast("long").alias("l_orderkey"), F.col("row")["mode"].alias("mode"))


@family("SELECT c_custkey::VARCHAR AS symbol, c_name AS company, 'xl/worksheets/sheet' || c_nationkey % 4 || '.xml' AS sheet FROM customer")
def workbook_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The sheets' rows below the header that has the wanted words, of workbooks that are read as a stream."""
    path, k = scratch(spark, "workbook"), F.col("c_custkey")
    own = [F.concat(F.lit("w"), (k % 3).cast("string"), F.lit(".xlsx")).alias("archive"), F.concat(F.lit("xl/worksheets/sheet"), (F.col("c_nationkey") % 4).cast("string"), F.lit(".xml")).alias("member")]

    def line(*values) -> Column:
        cells = [F.concat(F.lit(f'<c r="{"ABCD"[i]}1" t="inlineStr"><is><t>'), v, F.lit("</t></is></c>")) for i, v in enumerate(values)]
        return F.concat(F.lit("<row>"), *cells, F.lit("</row>"))

    rows = read(spark, sf, "customer").select(*own, k.alias("seq"), line(k.cast("string"), F.lit(""), F.col("c_name")).alias("data"))
    head = F.concat(F.lit('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'), line(F.lit("Listed companies")), line(F.lit("Symbol"), F.lit("Note"), F.lit("Company Name")))
    ends = rows.select("archive", "member").distinct().select("archive", "member", F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("seq"), head.alias("data")), F.struct(F.lit(1 << 62).alias("seq"), F.lit("</sheetData></worksheet>").alias("data")))).alias("e"))
    _archived(rows.union(ends.select("archive", "member", "e.*")).withColumn("data", F.col("data").cast("binary")), path)
    found = readers.workbook(spark, path, ["symbol", "company name"])
    return found.select(F.col("row")["Symbol"].alias("symbol"), F.col("row")["Company Name"].alias("company"), "sheet")


@family("SELECT r_regionkey::INT AS k, length(r_name) + 1 AS length FROM region")
def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a kind with their lengths, their content unread."""
    path = scratch(spark, "listing")
    read(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("value")).repartition(1).write.partitionBy("k").text(path)
    return readers.listing(spark, path, "*.txt").select(F.regexp_extract("path", "k=([0-9]+)", 1).cast("int").alias("k"), "length")


@family("SELECT n_nationkey, n_name FROM nation")
def missing_table_as_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A table that may be missing counts as empty."""
    return read(spark, sf, "nation").select("n_nationkey", "n_name").unionByName(readers.table_or_empty(spark, "no_such_table", "n_nationkey long, n_name string"))


@family("SELECT o_orderkey, o_orderstatus AS original, o_custkey::VARCHAR AS timestamp FROM orders")
def headed_json_rows(spark: SparkSession, sf: str) -> DataFrame:
    """An array of arrays whose first row names the columns, in any order."""
    a, b = F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    swap = F.col("o_orderkey") % 2 == 0
    head = F.when(swap, F.array(F.lit("timestamp"), F.lit("original"))).otherwise(F.array(F.lit("original"), F.lit("timestamp")))
    rows = read(spark, sf, "orders").select("o_orderkey", F.array(head, F.when(swap, F.array(a, b)).otherwise(F.array(b, a))).alias("a"))
    return rows.select("o_orderkey", "a", F.explode(F.slice("a", 2, 9)).alias("r")).select("o_orderkey", *readers.headed_rows(F.col("a"), {"original": 0, "timestamp": 1}))


@family("SELECT c_custkey, 'GB' || c_custkey AS ISIN, c_mktsegment AS Type FROM customer")
def labelled_values(spark: SparkSession, sf: str) -> DataFrame:
    """The values after a page's labels."""
    text = F.concat(F.lit("Profile | ISIN: GB"), F.col("c_custkey").cast("string"), F.lit("; Type: "), F.col("c_mktsegment"), F.lit(" | end"))
    return read(spark, sf, "customer").select("c_custkey", *readers.labelled(text, ["ISIN", "Type"]))


@family("SELECT n_nationkey, unnest(range(1995, 2002))::INT AS year FROM nation")
def years_of_an_argument(spark: SparkSession, sf: str) -> DataFrame:
    """A spine over the years that an argument names."""
    return read(spark, sf, "nation").select("n_nationkey", F.explode(F.array(*map(F.lit, readers.years("1995:2001")))).alias("year"))


@family("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN chr(39) || '=' ELSE '' END || s_name AS name FROM supplier")
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen columns as CSV, with cells that no program takes for formulas."""
    path = scratch(spark, "csv")
    writers.fixed_csv(read(spark, sf, "supplier").withColumn("name", F.concat(F.when(F.col("s_suppkey") % 2 == 0, "=").otherwise(""), F.col("s_name"))), path, ["s_suppkey", "name"])
    return spark.read.option("header", True).schema("s_suppkey long, name string").csv(path)


@family("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'direct' WHEN 'O' THEN 'bulk' ELSE 'review' END AS part FROM orders")
def split_by_tag(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in parts by a tag, written apart and read again."""
    s, names = F.col("o_orderstatus"), ["direct", "bulk", "review", "none"]
    tag = F.when(s == "F", "direct").when(s == "O", "bulk").otherwise("review")
    paths, _ = writers.split_once(read(spark, sf, "orders").select("o_orderkey", s), tag, names, scratch(spark, "split"))
    out = None
    for name, path in paths.items():
        one = spark.read.option("header", True).schema("o_orderkey long, o_orderstatus string").csv(path).select("o_orderkey", F.lit(name).alias("part"))
        out = one if out is None else out.union(one)
    return out


@family("SELECT 'event_type,n' AS line UNION ALL SELECT event_type || ',' || count(*) FROM events GROUP BY event_type UNION ALL SELECT event_type || ',' || count(*) FROM events GROUP BY event_type")
def metrics_with_one_header(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics appended twice: one header, all rows."""
    path, rows = scratch(spark, "metrics"), read(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    for _ in range(2):
        writers.append_csv(rows, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@family("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 ORDER BY upper(trim(c_name)), c_custkey LIMIT 50")
def frozen_cohort(spark: SparkSession, sf: str) -> DataFrame:
    """A cohort written as JSON lines and CSV, and read again."""
    path = scratch(spark, "cohort")
    cohort = select.cohort(read(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey", "c_name"), F.upper(F.trim("c_name")), 0, 50)
    writers.manifest_files(cohort, path)
    return spark.read.schema("c_custkey long, c_name string").json(f"{path}/json")


#: Folders that the files of orphans_removed are dealt to.
ORPHAN_FOLDERS = 997


@family("SELECT c_custkey || '.pdf' AS file, (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0) AS removed FROM customer WHERE c_custkey % 3 > 0")
def orphans_removed(spark: SparkSession, sf: str) -> DataFrame:
    """Of a file for each customer, what interrupted writers left is gone, the rest is there."""
    path = scratch(spark, "orphans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = archives.filesystem(path)
        made: set[int] = set()
        for batch in batches:
            for key in batch.column(0).to_pylist():
                at = key % ORPHAN_FOLDERS
                if at not in made:
                    fs.create_dir(f"{folder}/{at}", recursive=True)
                    made.add(at)
                with fs.open_output_stream(f"{folder}/{at}/{key}.pdf{'' if key % 3 else '.part'}") as f:
                    f.write(b"%PDF-")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read(spark, sf, "customer").select("c_custkey").repartition(n, F.col("c_custkey") % ORPHAN_FOLDERS).mapInArrow(run, "n long").agg(F.sum("n")).collect()
    gone = writers.remove_orphans(spark, path)
    return writers.listed(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.lit(gone).cast("long").alias("removed"))


def _streamed(spark: SparkSession, sf: str, path: str, files: int = 1) -> DataFrame:
    """Events as a stream of so many files, one for each micro-batch."""
    events = read(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    events.repartitionById(files, F.pmod("event_id", F.lit(files)).cast("int")).write.parquet(path)
    return spark.readStream.option("maxFilesPerTrigger", 1).schema("event_id long, ts timestamp, user_id long, event_type string").parquet(path)


@family("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of three micro-batches upserted into a table: each user's last event."""
    path = scratch(spark, "stream")
    streams.upserting_buckets(_streamed(spark, sf, f"{path}/in", 3), f"{path}/out", ["user_id"], "event_id", f"{path}/checkpoint").awaitTermination()
    return streams.upserted(spark, f"{path}/out").select("user_id", "event_type", "event_id")


@family("SELECT DISTINCT user_id FROM events")
def stream_queue(spark: SparkSession, sf: str) -> DataFrame:
    """A stream's queue that takes each key once, and forgets keys that stay away."""
    path = scratch(spark, "queue")
    queue = streams.queue(_streamed(spark, sf, f"{path}/in"), "ts", ["user_id"], keep="400 days")
    queue.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id long").parquet(f"{path}/out")
