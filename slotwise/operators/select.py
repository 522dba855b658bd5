"""Choosing rows: the best of each slot, ties, conflicts, interleaving, samples, shards."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None, count: str | None = None) -> DataFrame:
    """The first n rows of each group. `order` must end in a unique column, so that the choice is determined.
    rank: keep the position under this name; count: add the group's size under this name."""
    w = W.partitionBy(*by).orderBy(*order)
    if count:
        df = df.withColumn(count, F.count("*").over(W.partitionBy(*by)))
    out = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n)
    return out.withColumnRenamed("_rank", rank) if rank else out.drop("_rank")


def argmax_truthy(df: DataFrame, by: Sequence[str], score: Column, tie: Sequence[Column]) -> DataFrame:
    """The row of the greatest score of each group; groups whose greatest score is 0 or NULL vanish."""
    return best(df.withColumn("_score", score), by, [F.desc_nulls_last("_score"), *tie]).where("_score <> 0").drop("_score")


def near_ties(df: DataFrame, by: Sequence[str], score: str, tie: Column, within: float = 25, least: float = 100) -> DataFrame:
    """`selected`: the best of a group if its score isn't negative, and others of at least `least` within `within` of it."""
    w = W.partitionBy(*by)
    ranked = df.withColumn("_best", F.max(score).over(w)).withColumn("_rank", F.row_number().over(w.orderBy(F.desc(score), tie)))
    picked = F.when(F.col("_rank") == 1, F.col(score) >= 0).otherwise((F.col(score) >= least) & (F.col("_best") - F.col(score) <= within))
    return ranked.withColumn("selected", picked).drop("_best", "_rank")


def demote_multiple(df: DataFrame, by: Sequence[str], status: str, good: str, to: str) -> DataFrame:
    """Where a group has several rows of the good status, all of them get the other one."""
    several = F.sum(F.when(F.col(status) == good, 1).otherwise(0)).over(W.partitionBy(*by)) > 1
    return df.withColumn(status, F.when((F.col(status) == good) & several, to).otherwise(F.col(status)))


def conflicts(df: DataFrame, by: Sequence[str], identity: Sequence[str]) -> DataFrame:
    """`n_identities` of each group, by one aggregation joined back; more than 1 is a conflict, equal rows aren't."""
    n = df.groupBy(*by).agg(F.count_distinct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity]).alias("n_identities"))
    return df.join(n, list(by))


def interleaved(df: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """`turn`: the position within its group; ordering by turn and the group takes groups in turn."""
    return df.withColumn("turn", F.row_number().over(W.partitionBy(group).orderBy(*order)))


def numbered_parts(df: DataFrame, by: Sequence[str], part: Column, order: Sequence[Column]) -> DataFrame:
    """Rows of groups with at least two different parts, numbered in order."""
    w = W.partitionBy(*by)
    out = df.withColumn("_part", part).where("_part IS NOT NULL").withColumn("_parts", F.size(F.collect_set("_part").over(w)))
    return out.where("_parts >= 2").withColumn("part_no", F.row_number().over(w.orderBy(*order))).drop("_part", "_parts")


def evenly_spaced(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """n rows at even distances by rank, the first and the last among them.

    Ranks come from sorted partitions and a prefix sum of their sizes, so no task sees all rows.
    """
    ranked, total = _ranked(df, order)
    if total <= n:
        return ranked.drop("_pos")
    want = {round(i * (total - 1) / max(1, n - 1)) for i in range(n)}
    return ranked.where(F.col("_pos").isin(*want)).drop("_pos")


def _ranked(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, int]:
    """Rows with their position in the order, from 0, and how many there are. The sorted rows are written once, in the
    checkpoint folder: the bounds of a sort are sampled, so another run of it may part the rows otherwise."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        at = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not at and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(at or f"file://{tempfile.mkdtemp(prefix='slotwise-')}")
    parts = df.orderBy(*order).checkpoint(eager=True).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    sizes = dict(tuple(r) for r in parts.groupBy("_p").count().collect())  # a number for each partition
    before, starts = 0, {}
    for p in sorted(sizes):
        starts[p], before = before, before + sizes[p]
    first = F.coalesce(*[F.when(F.col("_p") == p, F.lit(s)) for p, s in starts.items()]) if starts else F.lit(0)
    return parts.withColumn("_pos", first + F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_p", "_m"), before


def cohort(df: DataFrame, key: Column, offset: int, n: int) -> DataFrame:
    """n rows from the offset on, ordered by the key and, where that is equal, by all columns; n = 0 means all."""
    out = df.orderBy(key, *df.columns).offset(offset)
    return out.limit(n) if n else out


def shard_crc32(key: Column, n: int) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(n))


def shard_sha1(key: Column, n: int) -> Column:
    """The first 8 bytes of SHA-1, modulo n."""
    return F.pmod(F.conv(F.substring(F.sha1(key), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(n)).cast("int")


def shard_sha256(key: Column, n: int) -> Column:
    """The first 16 hex digits of SHA-256, modulo n."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(n)).cast("int")


def chunk_number(order: Sequence[Column], by: Sequence[str], size: int) -> Column:
    """The number of the chunk of `size` rows that a row of a group is in."""
    return F.floor((F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1) / size)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return best(df, key, order)


def first_nested(flat: DataFrame, key: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """key and the columns of `order` of each key's first exploded item. A minimum, combined before the shuffle: neither
    a window nor a list of a key's items, so a key may have any number of them."""
    keys = [F.col(k) if isinstance(k, str) else k for k in key]
    found = flat.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    return found.select(*[c for c in found.columns if c != "_first"], "_first.*")
