"""Upserts as functions from snapshots to a snapshot; the caller writes the result to a new version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.scalars import coalesce_nonempty
from slotwise.operators.select import best


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows replace old ones of the same key."""
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new)


def last_of_batch(new: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """Within a batch the last write wins."""
    return best(new, key, [F.desc(seq)])


def insert_ignore(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """New rows whose key isn't there yet; the first of a batch wins."""
    return old.unionByName(best(new, key, order).join(old.select(*key), list(key), "left_anti"))


def _joined(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    a = old.select(*key, F.struct(*[c for c in old.columns if c not in key], F.lit(True).alias("_there")).alias("_old"))
    b = new.select(*key, F.struct(*[c for c in new.columns if c not in key], F.lit(True).alias("_there")).alias("_new"))
    return a.join(b, list(key), "full_outer")


def merge(old: DataFrame, new: DataFrame, key: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """A rule for each column: `new` (replace), `old` (keep), `nonempty` (new unless blank), `coalesce` (new unless
    NULL), `set_once` (old unless NULL), `add` (sum), `or` (either)."""
    out = []
    for c, rule in rules.items():
        o, n = F.col(f"_old.{c}") if c in old.columns else F.lit(None), F.col(f"_new.{c}") if c in new.columns else F.lit(None)
        there, fresh = F.coalesce(F.col("_old._there"), F.lit(False)), F.coalesce(F.col("_new._there"), F.lit(False))
        value = {
            "new": lambda o=o, n=n, fresh=fresh: F.when(fresh, n).otherwise(o),
            "old": lambda o=o, n=n, there=there: F.when(there, o).otherwise(n),
            "nonempty": lambda o=o, n=n: coalesce_nonempty(n, o),
            "coalesce": lambda o=o, n=n: F.coalesce(n, o),
            "set_once": lambda o=o, n=n: F.coalesce(o, n),
            "add": lambda o=o, n=n: F.coalesce(o, F.lit(0)) + F.coalesce(n, F.lit(0)),
            "or": lambda o=o, n=n: F.coalesce(o, F.lit(False)) | F.coalesce(n, F.lit(False)),
        }[rule]()
        out.append(value.alias(c))
    return _joined(old, new, key).select(*key, *out)


def snapshot_refresh(old: DataFrame, new: DataFrame, key: Sequence[str], active: str = "active") -> DataFrame:
    """All rows ever seen, with the latest values; active where the new snapshot has the key."""
    values = [c for c in new.columns if c not in key]
    fresh = F.coalesce(F.col("_new._there"), F.lit(False))
    return _joined(old, new, key).select(*key, *[F.when(fresh, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in values], fresh.alias(active))


def accumulate(attempts: DataFrame, key: Sequence[str], seq: str, state: str) -> DataFrame:
    """Attempts added up, and the state of the last."""
    return attempts.groupBy(*key).agg(F.sum("attempts").alias("attempts"), F.max_by(state, seq).alias(state))


def transition(status: Column, allowed: Sequence[str], to: Column) -> Column:
    """The new status where the old one is among the allowed."""
    return F.when(status.isin(*allowed), to).otherwise(status)


def reset_stale(status: Column, stale: str, to: str) -> Column:
    return F.when(status == stale, to).otherwise(status)


def migrate(df: DataFrame, columns: Mapping[str, Column], key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Adds the columns that are missing, with defaults, and keeps the first row of a key."""
    for name, default in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, default)
    return best(df, key, order)


def promotion(staged: DataFrame, existing: DataFrame, path: str, digest: str) -> DataFrame:
    """What becomes of staged files: STAGED_UNRESOLVED_IDENTITY without a path, IDEMPOTENT_EXISTING for the same
    bytes, CONFLICT for others at the path, else PROMOTED."""
    there = existing.select(F.col(path).alias("_path"), F.col(digest).alias("_digest"))
    status = F.when(F.col(path).isNull(), "STAGED_UNRESOLVED_IDENTITY").when(F.col("_path").isNull(), "PROMOTED").when(F.col("_digest") == F.col(digest), "IDEMPOTENT_EXISTING").otherwise("CONFLICT")
    return staged.join(there, F.col(path) == F.col("_path"), "left").withColumn("result", status).drop("_path", "_digest")


def resume(manifest: DataFrame, ledger: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """What to do with each manifest row: skip what is done and there, recover files that the ledger doesn't
    know, error for done ones whose file is gone, else pending."""
    out = manifest.join(ledger.select(key, F.col("status").alias("_status")), key, "left").join(files.select(key, F.lit(True).alias("_file")), key, "left")
    there = F.coalesce(F.col("_file"), F.lit(False))
    done = F.coalesce(F.col("_status") == "DONE", F.lit(False))
    return out.withColumn("action", F.when(done & there, "skip").when(done, "error").when(there, "recover").otherwise("pending")).drop("_status", "_file")
