"""Every query that has SQL gives the same rows in another engine."""

import datetime
import decimal

import duckdb
import pytest

from slotwise.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def value(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([value(r[c]) for c in columns]) for r in df.collect())
    cursor = db.execute(registry.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr([value(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_others_run(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_stock_codes_of_long_keys(spark, tmp_path):
    """Two counters of an issuer whose codes end in the same five digits."""
    keys = [7, 1234, 9999, 10000, 12345, 88888, 123456, 1234567]
    spark.createDataFrame(list(enumerate(keys)), "o_orderkey long, o_custkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    got = registry.QUERIES["stock_code_lists"](spark, str(tmp_path)).select("o_orderkey", "codes")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(registry.ORACLES["stock_code_lists"]).fetchall())


def test_content_audit_of_spaces(spark, tmp_path):
    """Lines of no-break and other spaces are blank in both."""
    blank = "\u00a0\n\u3000 \u2003\n" * 4
    texts = [(i, f"{blank}that tion ment {10 + i}\n{blank}") for i in range(4)] + [(4, None), (5, ""), (6, blank), (7, "\t\nment 17")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = registry.QUERIES["content_audit"](spark, str(tmp_path)).select("doc_id", "reason", "status")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(registry.ORACLES["content_audit"]).fetchall())
