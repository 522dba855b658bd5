"""Quoted CSV in parallel: records that break over lines, read from all splits of a file at once.

Spark's text reader gives each split its lines in order. A first pass counts, for each split, its quotes and the records
that begin in it, once if it begins outside of quotes and once if inside; running sums over a file's splits then tell
each split which of both it is and how many records are before it. The second pass puts records together within their
split; only pieces of records that go over a split's end are shuffled. So a file has as many tasks as splits, and its
records have the numbers that one task would give them.

A quote opens and closes a quoted part wherever it stands, and is doubled within one (RFC 4180); lines end with \\n or
\\r\\n; blank lines outside of quotes are no records. A quote that is never closed makes the rest of its file a record.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, block: the lines of files, and where the split that they are of begins."""
    return spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The parts of a batch (value, file, block, ...) of one split each, which comes whole before the next."""
    if batch.num_rows:
        file, block = batch.column(1).dictionary_encode().indices.to_numpy(), batch.column(2).to_numpy()
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            part = batch.slice(start, end - start)
            yield (part.column(1)[0].as_py(), part.column(2)[0].as_py()), part


def _quotes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The quotes of each line, and whether it has more than a line's end."""
    value = part.column(0)
    return pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64), ~pc.match_substring_regex(value, "^\r*$").to_numpy(zero_copy_only=False)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, total = None, np.zeros(3, np.int64)

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [now[0]], "block": [now[1]], "quotes": [int(total[0])], "outside": [int(total[1])], "inside": [int(total[2])]})

    for batch in batches:
        for key, part in _runs(batch):
            if key != now:
                if now is not None:
                    yield close()
                now, total = key, np.zeros(3, np.int64)
            quotes, full = _quotes(part)
            odd = (total[0] + np.cumsum(quotes) - quotes) % 2
            total += [int(quotes.sum()), int((full & (odd == 0)).sum()), int((full & (odd == 1)).sum())]
    if now is not None:
        yield close()


def splits(found: DataFrame) -> DataFrame:
    """file, block, odd (whether the split begins inside of quotes), base (the records before it): a row for each split."""
    each = found.mapInArrow(_counted, "file string, block long, quotes long, outside long, inside long")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    told = each.withColumn("odd", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    own = F.when(F.col("odd") == 1, F.col("inside")).otherwise(F.col("outside"))
    return told.select("file", "block", "odd", F.coalesce(F.sum(own).over(before), F.lit(0)).alias("base"))


class _Split:
    """Puts the lines of one split together."""

    def __init__(self, key: tuple[str, int], odd: int, base: int):
        self.key, self.odd, self.at = key, odd, base - 1
        #: the record that isn't closed yet: its lines, and whether it began in this split
        self.held: list[str] = []
        self.began = False

    def rows(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        quotes, full = _quotes(part)
        after = (self.odd + np.cumsum(quotes)) % 2
        starts = (after - quotes) % 2 == 0
        keep = ~starts | full
        numbers, closed = self.at + np.cumsum(starts & full), after == 0
        whole = starts & closed & full  # a line that is a record
        if whole.any():
            yield self._made(numbers[whole], part.column(0).filter(pa.array(whole)), True)
        some = np.flatnonzero(keep & ~whole)
        texts = part.column(0).take(pa.array(some)).to_pylist()
        for i, text in zip(some.tolist(), texts, strict=True):
            if starts[i]:
                self.held, self.began = [], True
            self.held.append(text)
            if closed[i]:
                yield self._made(numbers[i : i + 1], pa.array(["\n".join(self.held)]), self.began)
                self.held, self.began = [], False
        self.odd, self.at = int(after[-1]), int(numbers[-1])

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self._made(np.array([self.at]), pa.array(["\n".join(self.held)]), False)

    def _made(self, numbers: np.ndarray, texts: pa.Array, whole: bool) -> pa.RecordBatch:
        n = len(numbers)
        return pa.RecordBatch.from_arrays([pa.array([self.key[0]] * n, pa.string()), pa.array([self.key[1]] * n, pa.int64()), pa.array(numbers, pa.int64()), texts.cast(pa.string()), pa.array([whole] * n, pa.bool_())], ["file", "block", "number", "text", "whole"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Split | None = None
    for batch in batches:
        for key, part in _runs(batch):
            if now is None or key != now.key:
                if now is not None:
                    yield from now.rest()
                now = _Split(key, part.column(3)[0].as_py(), part.column(4)[0].as_py())
            yield from now.rows(part)
    if now is not None:
        yield from now.rest()


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, number (from 0, in the file), text of each record, the header being one."""
    found = lines(spark, path)
    # a row for each split, of which there are bytes / spark.sql.files.maxPartitionBytes: far fewer than a task's lines
    told = found.join(F.broadcast(splits(found)), ["file", "block"]).select("value", "file", "block", "odd", "base")
    parts = told.mapInArrow(_joined, "file string, block long, number long, text string, whole boolean")
    pieces = parts.where("not whole").groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("p"))  # a record's own
    over = pieces.select("file", "number", F.concat_ws("\n", F.transform("p", lambda x: x["text"])).alias("text"))
    return parts.where("whole").select("file", "number", "text").union(over)


def headers(spark: SparkSession, path: str) -> list[str]:
    """The different first records of files, two at most; other splits than the first are left at once."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_yet: dict[str, list[str]] = {}
        done: set[str] = set()
        for batch in batches:
            for (file, block), part in _runs(batch):
                if block:
                    break
                if file in done:
                    continue
                held = open_yet.setdefault(file, [])
                for text in part.column(0).to_pylist():
                    if held or text.strip("\r"):
                        held.append(text)
                        if "".join(held).count('"') % 2 == 0:
                            yield pa.RecordBatch.from_arrays([pa.array(["\n".join(held).strip("\ufeff\r")], pa.string())], ["text"])
                            done.add(file)
                            del open_yet[file]
                            break
            else:
                continue
            break
        if open_yet:  # it goes on in the next split
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string())], ["text"])

    found = [r["text"] for r in lines(spark, path).mapInArrow(first, "text string").distinct().limit(3).collect()]
    if None in found:
        text = F.regexp_replace(F.regexp_replace("text", "^\ufeff", ""), "\r$", "")
        found = [r["text"] for r in records(spark, path).where("number = 0").select(text.alias("text")).distinct().limit(2).collect()]
    return found[:2]


def rows(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """The columns' names and the rows of CSV files with one header: file, line (the header being 1), a column for each."""
    found = headers(spark, path)
    if len(found) != 1:
        raise ValueError("the files have different headers" if found else "no header")
    names = next(csv.reader(found, strict=True)) if "\n" not in found[0] else next(csv.reader(found[0].splitlines(keepends=True), strict=True))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    text = F.regexp_replace("text", "\r$", "")
    parsed = records(spark, path).where("number > 0").select("file", (F.col("number") + 1).alias("line"), F.from_csv(text, schema, {"escape": '"'}).alias("r"))
    return names, parsed.select("file", "line", *[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])
