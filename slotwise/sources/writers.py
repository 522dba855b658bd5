"""Writing: fixed-column CSV, splits, named audits, metrics, atomic swaps."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.scalars import escaped_cell
from slotwise.sources.archives import filesystem


def fixed_csv(df: DataFrame, path: str, columns: Sequence[str], escape: bool = True) -> None:
    """These columns only, with a header; cells can't be taken for formulas."""
    kinds = dict(df.dtypes)
    df.select(*[escaped_cell(F.col(c)).alias(c) if escape and kinds[c] == "string" else F.col(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def split(df: DataFrame, tag: Column) -> dict[str, DataFrame]:
    """The parts of rows by a tag that is computed once."""
    tagged = df.withColumn("_tag", tag)
    return {name: tagged.where(F.col("_tag") == name).drop("_tag") for name in ("direct", "bulk", "review")}


def audits(views: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Each named view as a CSV folder of its own."""
    out = {}
    for name, view in views.items():
        out[name] = f"{folder}/{name}"
        fixed_csv(view, out[name], view.columns)
    return out


def split_once(df: DataFrame, tag: Column, names: Sequence[str], folder: str) -> tuple[dict[str, str], dict[str, int]]:
    """(folder, rows) of each named part, all written by one pass over df, a folder for each tag; rows with other tags or
    none are an error. A part without rows has its columns as well: a header."""
    seen, name = Observation(), "_part"
    counts = [F.count_if(tag == n).alias(n) for n in names]
    tagged = df.withColumn(name, tag).observe(seen, *counts, F.count("*").alias("_all"))
    kinds = dict(df.dtypes)
    cells = [escaped_cell(F.col(c)).alias(c) if kinds[c] == "string" else F.col(c) for c in df.columns]
    tagged.select(*cells, name).write.mode("overwrite").option("header", True).partitionBy(name).csv(folder)
    rows = {n: seen.get[n] for n in names}
    if sum(rows.values()) != seen.get["_all"]:
        raise ValueError("rows whose tag has no part")
    for n in names:
        if not rows[n]:
            df.limit(0).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}={n}")
    return {n: f"{folder}/{name}={n}" for n in names}, rows


def append_csv(rows: DataFrame, path: str) -> None:
    """Rows appended to a CSV folder whose first write, and no later one, has the header."""
    there = any(not f.getPath().getName().startswith(("_", ".")) for f in _files(rows.sparkSession, path))
    rows.coalesce(1).write.mode("append").option("header", not there).csv(path)


def _files(spark: SparkSession, folder: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listFiles(at, True) if fs.exists(at) else None
    while found is not None and found.hasNext():
        yield found.next()


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, changed (ms) of all files at any depth: a task lists whole entries of the folder; the driver has the
    names of these entries only."""
    fs, at = filesystem(folder)
    top = [(f.path,) for f in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for entry in fs.get_file_info(batch.column(0).to_pylist()):
                found = fs.get_file_info(pafs.FileSelector(entry.path, recursive=True)) if entry.type == pafs.FileType.Directory else [entry]
                files = [f for f in found if f.type == pafs.FileType.File]
                yield pa.RecordBatch.from_pydict({"path": pa.array([f.path for f in files], pa.string()), "length": pa.array([f.size for f in files], pa.int64()), "changed": pa.array([f.mtime_ns // 1_000_000 for f in files], pa.int64())})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.createDataFrame(top, "path string").repartition(n, "path").mapInArrow(run, "path string, length long, changed long")


def remove_orphans(spark: SparkSession, folder: str, suffix: str = ".part", older_ms: int = 0) -> int:
    """Deletes, in tasks, what interrupted writers left: files with the suffix, at any depth, not changed for so long; how
    many. They are counted before, so that a task may run again."""
    until = int(time.time() * 1000) - older_ms
    orphans = listed(spark, folder).where(F.endswith("path", F.lit(suffix)) & (F.col("changed") <= until)).select("path")
    count = orphans.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    fs.delete_file(path)
                except FileNotFoundError:  # an earlier attempt's
                    pass
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    orphans.mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return count


def one_file(spark: SparkSession, parts: str, path: str, head: bytes = b"") -> None:
    """Spark's part files, in their order, as one file after `head`: a task streams them, holding a piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        fs, source = filesystem(parts)
        _, to = filesystem(path)
        folder, _, name = to.rpartition("/")
        fs.create_dir(folder, recursive=True)
        held = f"{folder}/.{name}-{uuid.uuid4().hex}"
        found = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(source)) if f.base_name.startswith("part-"))
        with fs.open_output_stream(held) as out:
            out.write(head)
            for one in found:
                with fs.open_input_stream(one, compression=None) as part:
                    while piece := part.read(8 << 20):
                        out.write(piece)
        fs.move(held, to)
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(found)], pa.int64())})

    spark.range(0, 1, 1, 1).mapInArrow(run, "n long").collect()


def run_summary(results: DataFrame, status: str, error: str, done: str = "DONE") -> tuple[DataFrame, DataFrame]:
    """(one row with total, done and failed, rows that failed) of a run's results."""
    failed = F.coalesce(F.col(status) != done, F.lit(True))
    summary = results.agg(F.count("*").alias("total"), F.count_if(~failed).alias("done"), F.count_if(failed).alias("failed"), F.count_distinct(F.when(failed, F.col(error))).alias("reasons"))
    return summary, results.where(failed)


def append_metrics(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def manifest_files(df: DataFrame, folder: str) -> None:
    """A frozen cohort as JSON lines and CSV."""
    df.write.mode("errorifexists").json(f"{folder}/json")
    fixed_csv(df, f"{folder}/csv", df.columns)
