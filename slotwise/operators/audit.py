"""Audits of documents' texts, staged files, and identifier dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.operators.select import best

# ---- fixed values
NAME_FILLERS = r"\b(the|inc|incorporated|corp|corporation|company|co|plc|ltd|limited)\b"
ANNUAL_TERMS = r"annual report|report to shareholders|annual financial report"
NO_TEXT, NO_YEAR, NO_NAME = "no extractable text in sampled pages", "fiscal year not found in sampled pages", "company name not found in sampled pages"
STAGED_NAME, STAGED_FOLDER = r"^([A-Z0-9]+)_([0-9]{4})_([A-Z]+)_", "_FY"


def plain(c: Column) -> Column:
    """Lower-case words of letters and digits, without a company name's fillers."""
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), NAME_FILLERS, ""))


def sampled(pages: Column, n: int = 5) -> Column:
    """The first and the last n pages of an array of texts, each once, joined."""
    rest = F.greatest(F.size(pages) - n, F.lit(n))
    return F.array_join(F.filter(pages, lambda p, i: (i < n) | (i >= rest)), " ")


def content_reasons(pages: Column, year: Column, name: Column) -> Column:
    """What the sampled pages lack, joined by "; ", blank if nothing: text, the year, and two of the name's words of
    four letters and more (or the only one)."""
    text = plain(sampled(pages))
    words = F.filter(F.split(plain(name), " +"), lambda w: F.length(w) >= 4)
    hits = F.size(F.filter(words, lambda w: F.contains(text, w)))
    found = [F.when(text == "", NO_TEXT), F.when(~F.contains(text, year.cast("string")), NO_YEAR), F.when(name.isNotNull() & (hits < F.least(F.lit(2), F.size(words))), NO_NAME)]
    return F.concat_ws("; ", *found)


def semantic(text: Column, year: Column, size: Column, pages: Column, least_bytes: int = 50_000, least_pages: int = 5) -> list[Column]:
    """state, semantic, note: FAIL below the least size or pages; else PASS, and whether text names an annual report and its year."""
    small, short = size < least_bytes, pages < least_pages
    low = F.lower(text)
    tells = F.coalesce(low.rlike(ANNUAL_TERMS) & F.contains(low, year.cast("string")), F.lit(False))
    note = F.when(small, F.concat(F.lit("below_min_bytes:"), size.cast("string"))).when(short, F.concat(F.lit("below_min_pages:"), pages.cast("string"))).when(~tells, "semantic_signal_incomplete").otherwise("")
    return [F.when(small | short, "FAIL").otherwise("PASS").alias("state"), F.when(~small & ~short & tells, "PASS").otherwise("WARN").alias("semantic"), note.alias("note")]


def staged(path: Column) -> list[Column]:
    """ticker, fiscal_year, report_type of a staged file: by its name, else by its folder."""
    parts = F.split(path, "/")
    name, folder = F.element_at(parts, -1), F.split(F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("")), STAGED_FOLDER)
    named = name.rlike(STAGED_NAME)
    by_folder = F.size(folder) == 2

    def part(i: int) -> Column:
        return F.regexp_extract(name, STAGED_NAME, i)

    ticker = F.when(named, F.upper(part(1))).when(by_folder, F.upper(F.try_element_at(folder, F.lit(1))))
    year = F.when(named, part(2)).when(by_folder, F.try_element_at(folder, F.lit(2))).try_cast("int")
    return [ticker.alias("ticker"), year.alias("fiscal_year"), F.when(named, F.upper(part(3))).otherwise("AR").alias("report_type")]


def sweep(files: DataFrame, path: str, known: DataFrame) -> DataFrame:
    """Staged files whose ticker has both identifiers in `known` (ticker, lei, isin), with what their paths say."""
    found = files.select("*", *staged(F.col(path))).where("ticker <> '' AND fiscal_year <> 0")
    return found.join(known.where("lei <> '' AND isin <> ''"), "ticker")


def identifiers(dump: DataFrame, item: str, order: str) -> DataFrame:
    """ticker, lei, isin from dumps' items (JSON, each field a text or {"value": text}); the last item that has a
    well-formed identifier of a ticker decides on it."""

    def field(name: str) -> Column:
        return F.upper(F.trim(F.coalesce(F.get_json_object(item, f"$.{name}.value"), F.get_json_object(item, f"$.{name}"), F.lit(""))))

    rows = dump.select(F.col(order).alias("_order"), field("ticker").alias("ticker"), field("lei").alias("lei"), field("isin").alias("isin")).where("ticker <> ''")

    def last(name: str, length: int) -> Column:
        fits = F.length(name) == length
        return F.max_by(F.when(fits, F.col(name)), F.when(fits, F.col("_order"))).alias(name)

    return rows.groupBy("ticker").agg(last("lei", 20), last("isin", 12)).where("lei IS NOT NULL OR isin IS NOT NULL")


#: Halvings that part any range of days (four thousand years have fewer than 2^21).
DEPTH = 22
_HALVES = "{d} <= a.b + int((a.e - a.b) div 2)"


def _halved(days: DataFrame) -> DataFrame:
    """day, n, first, last (days since 1970) of every range that holds a day when all days' range is halved down to days."""
    ends = F.broadcast(days.agg(F.min("day").alias("_b"), F.max("day").alias("_e")))  # one row
    step = f"""aggregate(sequence(1, {DEPTH}), named_struct('b', _b, 'e', _e, 'p', array(named_struct('first', _b, 'last', _e))), (a, i) -> CASE WHEN a.b = a.e THEN a
      WHEN {_HALVES.format(d="day")} THEN named_struct('b', a.b, 'e', a.b + int((a.e - a.b) div 2), 'p', concat(a.p, array(named_struct('first', a.b, 'last', a.b + int((a.e - a.b) div 2)))))
      ELSE named_struct('b', a.b + int((a.e - a.b) div 2) + 1, 'e', a.e, 'p', concat(a.p, array(named_struct('first', a.b + int((a.e - a.b) div 2) + 1, 'last', a.e)))) END, a -> a.p)"""
    return days.crossJoin(ends).select("day", "n", F.explode(F.expr(step)).alias("r")).select("day", "n", "r.first", "r.last")


def bisected(days: DataFrame, day: str, n: str, limit: int | Column, most: int | Column | None = None) -> DataFrame:
    """first, last, n, limit of ranges of days that together cover all from the first to the last, each halved until it
    has fewer rows than the limit. A day that is full by itself is asked again with twice the limit, up to `most` (none:
    `limit`); one that is full even so is an error when it is read, as its rest would be lost. Null days have no range.

    Every day is in one range of each level of halves, so the ranges' sums are one aggregation of days times levels.
    """
    limit, most = limit if isinstance(limit, Column) else F.lit(limit), limit if most is None else most
    most = most if isinstance(most, Column) else F.lit(most)
    each = days.where(F.col(day).isNotNull()).groupBy(F.unix_date(F.col(day)).alias("day")).agg(F.sum(n).alias("n"))
    sums = _halved(each).groupBy("first", "last").agg(F.sum("n").alias("n"))
    middle = F.col("first") + F.floor((F.col("last") - F.col("first")) / 2).cast("int")
    halves = F.array(F.struct(F.col("first"), middle.alias("last")), F.struct((middle + 1).alias("first"), F.col("last")))
    # the range of all days, and the halves of those that are full; a half without rows has no sum
    root = each.agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first IS NOT NULL")
    parts = root.union(sums.where((F.col("n") >= limit) & (F.col("first") < F.col("last"))).select(F.explode(halves).alias("h")).select("h.*"))
    out = parts.join(sums, ["first", "last"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    out = out.where((F.col("n") < limit) | (F.col("first") == F.col("last")))
    doubled = F.expr("filter(transform(sequence(0, 40), i -> least(_most, _limit * shiftleft(1L, i))), x -> x > n)")
    asked = out.withColumns({"_limit": limit.cast("long"), "_most": most.cast("long")}).withColumn("limit", F.element_at(F.concat(doubled, F.array(F.lit(None).cast("long"))), 1))
    told = F.when(F.col("limit").isNull(), F.raise_error(F.concat(F.date_from_unix_date("first").cast("string"), F.lit(" alone has "), F.col("n").cast("string"), F.lit(" rows")))).otherwise(F.col("limit"))
    return asked.select(F.date_from_unix_date("first").alias("first"), F.date_from_unix_date("last").alias("last"), "n", told.cast("long").alias("limit"))


def asked_by_ranges(rows: DataFrame, day: str, key: Sequence[str], order: Sequence[Column], ranges: DataFrame) -> DataFrame:
    """The rows of all ranges' answers, each key once (the first by `order`), with the `first` day of their range."""
    days = rows.where(F.col(day).isNotNull()).select(F.unix_date(F.col(day)).alias("day")).distinct().withColumn("n", F.lit(1))
    wanted = ranges.select(F.unix_date("first").alias("first"), F.unix_date("last").alias("last"))
    of = _halved(days).join(wanted, ["first", "last"]).select(F.date_from_unix_date("day").alias("_day"), F.date_from_unix_date("first").alias("first"))
    return best(rows.join(of, F.col(day) == F.col("_day")).drop("_day"), key, order)
