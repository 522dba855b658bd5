"""Ranges that are halved until none is full, and the rows of their answers."""

import datetime
import random

import pytest

from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from slotwise.operators import audit


def plain(counts, limit, most):
    """Ranges by halving, one after another."""
    out, todo = [], [(min(counts), max(counts))] if counts else []
    while todo:
        a, b = todo.pop()
        n = sum(v for k, v in counts.items() if a <= k <= b)
        if n >= limit and a < b:
            m = a + (b - a) // 2
            todo += [(a, m), (m + datetime.timedelta(days=1), b)]
            continue
        own = limit
        while own <= n and own < most:
            own = min(most, 2 * own)
        out.append((a, b, n, own))
    return sorted(out)


@pytest.mark.parametrize("seed, span, days, limit", [(1, 400, 60, 25), (2, 9000, 300, 100), (3, 1, 1, 5), (4, 37, 37, 1000), (5, 2, 2, 3)])
def test_ranges_are_those_of_halving(spark, seed, span, days, limit):
    rng, first = random.Random(seed), datetime.date(1999, 12, 30)
    counts = {first + datetime.timedelta(days=d): rng.choice([0, 1, 3, 30]) for d in rng.sample(range(span), days)}
    df = spark.createDataFrame([(d, n) for d, n in counts.items()] + [(None, 7)], "day date, n long")
    got = sorted(map(tuple, audit.bisected(df.union(df.limit(0)).repartition(3), "day", "n", limit, 64 * limit).collect()))
    assert got == plain(counts, limit, 64 * limit)
    ends = sorted((a, b) for a, b, *_ in got)
    assert ends[0][0] == min(counts) and ends[-1][1] == max(counts)
    assert all(y[0] - x[1] == datetime.timedelta(days=1) for x, y in zip(ends, ends[1:]))


def test_a_day_that_is_too_full(spark):
    df = spark.createDataFrame([(datetime.date(2020, 1, 1), 40), (datetime.date(2020, 1, 2), 1)], "day date, n long")
    assert sorted(r["limit"] for r in audit.bisected(df, "day", "n", 10, 41).collect()) == [10, 41]
    with pytest.raises(PySparkException, match="2020-01-01 alone has 40 rows"):
        audit.bisected(df, "day", "n", 10, 40).collect()
    assert audit.bisected(df.limit(0), "day", "n", 10).collect() == []


def test_rows_of_answers_are_there_once(spark):
    first = datetime.date(2021, 2, 27)
    rows = [(i, first + datetime.timedelta(days=i % 11), i) for i in range(200)]
    df = spark.createDataFrame([*rows, *rows[:50], (999, None, 1)], "id int, day date, v int")
    ranges = audit.bisected(df.where("id < 999").distinct().groupBy("day").agg(F.count("*").alias("n")), "day", "n", 40)
    got = audit.asked_by_ranges(df, "day", ["id"], [F.asc("v")], ranges).collect()
    assert sorted((r["id"], r["v"]) for r in got) == [(i, i) for i in range(200)]
    each = {r["first"]: r for r in ranges.collect()}
    assert all(each[r["first"]]["first"] <= r["day"] <= each[r["first"]]["last"] for r in got)
