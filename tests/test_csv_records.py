"""Records of quoted CSV from many splits are those of one task."""

import csv
import io
import random

import pytest

from slotwise.sources import csv_records, readers


def written(rng, n):
    """A file's text with line breaks, quotes and signs where they hurt, and what one reader makes of it."""
    out = ['﻿id,"te\nxt",more']
    for i in range(n):
        kind = rng.randrange(7)
        cells = [str(i), *(rng.choice(["", "a", 'say ""hi""', "x,y", "l1\nl2", '""', '\n\n""\n', "\r\n", "é漢" * rng.randint(0, 30), "long\n" * rng.randint(0, 60)]) for _ in range(2))]
        if kind < 5:
            line = ",".join([cells[0], *(f'"{c}"' for c in cells[1:])])
        else:
            line = f"{i},plain,end"
        out.append(line + rng.choice(["", "", "\r", "\n", "\r\n\r\n\r"]))
    text = "\n".join(out) + rng.choice(["", "\n", "\r\n"])
    return text, [r for r in csv.reader(io.StringIO(text.lstrip("﻿"), newline="")) if r]


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_splits_make_no_difference(spark, tmp_path, size):
    rng, want = random.Random(size), {}
    for f in range(3 if size > 64 else 1):
        text, rows = written(rng, {7: 12, 64: 60}.get(size, 150))
        (tmp_path / f"f{f}.csv").write_bytes(text.encode())
        want |= {(f"f{f}.csv", i + 1): tuple(c or None for c in r) for i, r in enumerate(rows) if i}
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = csv_records.lines(spark, str(tmp_path))
        if size <= 64:
            assert found.select("block").distinct().count() > 10
        names, df = csv_records.rows(spark, str(tmp_path))
        got = {(r["file"].rpartition("/")[2], r["line"]): tuple(r[n] for n in names) for r in df.collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert names == ["id", "te\nxt", "more"]
    assert got == want


def test_headers_are_one(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(readers.SchemaError, match="different"):
        readers.strict_csv(spark, str(tmp_path), ["a", "b"])
    (tmp_path / "none").mkdir()
    (tmp_path / "none/x.csv").write_text("\n\r\n")
    with pytest.raises(readers.SchemaError, match="no header"):
        readers.strict_csv(spark, str(tmp_path / "none"), ["a"])


def test_a_quote_that_stays_open(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,2\n3,"x\n4,5\n')
    got = {r["number"]: r["text"] for r in csv_records.records(spark, str(tmp_path)).collect()}
    assert got == {0: "a,b", 1: "1,2", 2: '3,"x\n4,5'}
