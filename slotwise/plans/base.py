"""Registering queries: each takes (spark, sf_dir) and returns a DataFrame; most have the SQL for the same rows.

Where the ledger's own tables have no data here, the driver's stand in: customers are issuers, orders
their filings (status, score and priority included), line items the attachments, events the request log.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
FIRST_YEAR, LAST_YEAR = 1995, 2001


class Family:
    """The queries of one module."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.add(f.__name__, f, sql)
            return f

        return add

    def add(self, name: str, f: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"two queries are named {name}")
        self.queries[name] = f
        if sql:
            self.oracles[name] = sql


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared folder of spark.checkpoint.dir; where it is unset (one machine), a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return f"{at or _own()}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _own() -> str:
    """A temporary folder of this process, removed when it ends."""
    at = tempfile.mkdtemp(prefix="slotwise-scratch-")
    atexit.register(shutil.rmtree, at, ignore_errors=True)
    return f"file://{at}"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
