"""Ledger against files, golden sets, retries, rolling windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def verify(ledger: DataFrame, files: DataFrame, key: str, deep: bool = True) -> DataFrame:
    """key, reason: missing, size mismatch, hash mismatch (deep), or orphan; a row for each finding.
    ledger: key, bytes, sha256; files: key, length, digest."""
    both = ledger.select(key, "bytes", "sha256", F.lit(True).alias("_l")).join(files.select(key, "length", "digest", F.lit(True).alias("_f")), key, "full_outer")
    there = F.col("_l").isNotNull() & F.col("_f").isNotNull()
    found = [F.when(F.col("_f").isNull(), "missing"), F.when(F.col("_l").isNull(), "orphan"), F.when(there & (F.col("bytes") != F.col("length")), "size_mismatch")]
    if deep:
        found.append(F.when(there & (F.col("sha256") != F.col("digest")), "hash_mismatch"))
    return both.select(key, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("reason"))


def content_duplicates(df: DataFrame, parent: Sequence[str], digest: str, key: str) -> DataFrame:
    """Rows whose content an earlier key of the same parent has, with that key."""
    first = df.groupBy(*parent, digest).agg(F.min(key).alias("original"), F.count("*").alias("copies")).where("copies > 1")
    return df.join(first, [*parent, digest]).where(F.col(key) != F.col("original"))


def golden(actual: DataFrame, expected: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: how many are missing, extra, different and equal."""
    a = actual.select(key, F.struct(*columns).alias("_a"))
    b = expected.select(key, F.struct(*columns).alias("_b"))
    state = F.when(F.col("_a").isNull(), "missing").when(F.col("_b").isNull(), "extra").when(F.col("_a") == F.col("_b"), "equal").otherwise("different")
    return a.join(b, key, "full_outer").agg(*[F.count_if(state == s).alias(s) for s in ("missing", "extra", "different", "equal")])


def retries(attempts: DataFrame, key: str, attempt: str, permanent: Sequence[str]) -> DataFrame:
    """The state after the last attempt, and whether another makes sense."""
    last = attempts.groupBy(key).agg(F.max(attempt).alias("attempts"), F.max_by("status", attempt).alias("status"), F.max_by("error", attempt).alias("error"))
    return last.withColumn("retry", (F.col("status") == "FAILED") & ~F.coalesce(F.col("error").isin(*permanent), F.lit(False)))


def rolling(events: DataFrame, by: Sequence[str], ts: str, seconds: int, limit: int, order: str) -> DataFrame:
    """`in_window`: events of the group in the last seconds, this one and those exactly as old included; `wait`:
    seconds until the oldest leaves, if the limit is reached."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    w = W.partitionBy(*by).orderBy(micros).rangeBetween(-seconds * 1_000_000, 0)
    n, oldest = F.count("*").over(w), F.min(micros).over(w)
    return events.withColumn("in_window", n).withColumn("wait", F.when(n >= limit, (oldest + seconds * 1_000_000 - micros) / 1e6).otherwise(0.0))


def size_check(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """missing, zero, mismatch or valid."""
    got = actual.select(key, F.col("length").alias("_length"))
    state = F.when(F.col("_length").isNull(), "missing").when(F.col("_length") == 0, "zero").when(F.col("_length") != F.col("bytes"), "mismatch").otherwise("valid")
    return expected.join(got, key, "left").withColumn("state", state).drop("_length")


def adaptive_limit(events: DataFrame, by: Sequence[str], ts: str, status: str, order: str, start: int = 4, most: int = 16, quiet: int = 60) -> DataFrame:
    """The limit after a group's last response: halved by 429 and 503, one more by a 200 that comes `quiet` seconds
    or more after the last change. A replay in order, so a group's events are one ordered array."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    ordered = events.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(micros.alias("t"), F.col(order).alias("o"), F.col(status).alias("s")))).alias("_e"))
    begin = F.struct(F.lit(start).alias("limit"), F.element_at("_e", 1)["t"].alias("t"))

    def step(a: Column, e: Column) -> Column:
        up = (e["s"] == 200) & (e["t"] - a["t"] >= quiet * 1_000_000)
        limit = F.when(e["s"].isin(429, 503), F.greatest(F.lit(1), F.floor(a["limit"] / 2).cast("int"))).when(up, F.least(F.lit(most), a["limit"] + 1)).otherwise(a["limit"])
        return F.struct(limit.alias("limit"), F.when(e["s"].isin(429, 503) | up, e["t"]).otherwise(a["t"]).alias("t"))

    return ordered.select(*by, F.aggregate("_e", begin, step)["limit"].alias("limit"))


def ranked_configurations(trials: DataFrame, by: Sequence[str], config: Sequence[str], seconds: str, ok: str) -> DataFrame:
    """by, config, `median` and `place` of the configurations whose trials are all ok, the fastest of each group first."""
    each = trials.groupBy(*by, *config).agg(F.median(seconds).alias("median"), F.bool_and(F.coalesce(F.col(ok), F.lit(False))).alias("_ok")).where("_ok").drop("_ok")
    return each.withColumn("place", F.row_number().over(W.partitionBy(*by).orderBy("median", *config)))


def promotions(trials: DataFrame, previous: DataFrame, by: Sequence[str], config: Sequence[str], seconds: str, ok: str, gain: float = 0.95) -> DataFrame:
    """by, config, `median`, `promoted` of each group's fastest valid configuration: promoted where the group has no
    `champion` median in `previous`, or one that this is at most `gain` of."""
    winner = ranked_configurations(trials, by, config, seconds, ok).where("place = 1").drop("place")
    better = F.col("champion").isNull() | (F.col("median") <= gain * F.col("champion"))
    return winner.join(previous, list(by), "left").select(*by, *config, "median", better.alias("promoted"))


def next_configurations(trials: DataFrame, by: Sequence[str], workers: str, lanes: str, seconds: str, ok: str, most: int = 128, most_lanes: int = 2) -> DataFrame:
    """by, workers, lanes of what is worth measuring next to each group's fastest valid configuration: itself, half and
    twice its workers, one lane more and one less, each brought between 1 and the most, each once, as far as there are
    no more lanes than workers."""
    w, n = F.col(workers).cast("long"), F.col(lanes).cast("long")
    half, twice = F.greatest(F.lit(1), F.floor(w / 2)), F.least(F.lit(most), 2 * w)
    fewer, more = F.greatest(F.lit(1), n - 1), F.least(F.lit(most_lanes), n + 1)
    moves = F.array_distinct(F.array(*[F.struct(a.cast("long").alias(workers), b.cast("long").alias(lanes)) for a, b in ((w, n), (half, n), (twice, n), (w, fewer), (w, more))]))
    around = ranked_configurations(trials, by, [workers, lanes], seconds, ok).where("place = 1").select(*by, F.explode(moves).alias("_c")).select(*by, "_c.*")
    return around.where(n <= w)
