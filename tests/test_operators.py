import difflib
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from slotwise.operators import integrity, merge, resolve, select, spine


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_cohort_order_is_lexicographic(spark):
    df = spark.createDataFrame([(f"T{i}",) for i in range(20)], "ticker string")
    assert [r[0] for r in select.cohort(df, F.upper("ticker"), 0, 5).collect()] == ["T0", "T1", "T10", "T11", "T12"]
    assert select.cohort(df, F.upper("ticker"), 0, 0).count() == 20


def test_spine_has_all_slots(spark):
    e = spark.createDataFrame([("a", 2020), ("b", 2022), ("c", 2030)], "k string, since int")
    assert spine.spine(e, "k", 2020, 2021, ["AR", "SR"]).count() == 12
    assert rows(spine.spine(e, "k", F.greatest(F.lit(2021), F.col("since")), 2022)) == [("a", 2021), ("a", 2022), ("b", 2022)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(2019, 2022)), max_size=20))
def test_expected_is_discovered_and_missing(spark, facts):
    slots = spine.spine(spark.createDataFrame([(i,) for i in range(6)], "k int"), "k", 2019, 2022)
    f = spark.createDataFrame(facts, "k int, year int")
    a, b = spine.covered(slots, f, ["k", "year"]).count(), spine.missing(slots, f, ["k", "year"]).count()
    assert a + b == 24 and a == len(set(facts))


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, name string, note string")
    new = spark.createDataFrame([(2, "c", ""), (3, "d", "z")], "k int, name string, note string")
    once = merge.upsert(old, new, ["k"])
    assert rows(once) == [(1, "a", "x"), (2, "c", ""), (3, "d", "z")]
    assert rows(merge.upsert(once, new, ["k"])) == rows(once)
    assert rows(merge.merge(old, new, ["k"], {"name": "old", "note": "nonempty"})) == [(1, "a", "x"), (2, "b", "y"), (3, "d", "z")]
    fresh = merge.snapshot_refresh(old, new, ["k"])
    assert rows(fresh) == [(1, "a", "x", False), (2, "c", "", True), (3, "d", "z", True)]
    assert rows(merge.insert_ignore(old, new, ["k"], [F.asc("name")])) == [(1, "a", "x"), (2, "b", "y"), (3, "d", "z")]


def test_counters_add_up(spark):
    old, new = spark.createDataFrame([(1, 2)], "k int, n int"), spark.createDataFrame([(1, 3), (2, 1)], "k int, n int")
    assert rows(merge.merge(old, new, ["k"], {"n": "add"})) == [(1, 5), (2, 1)]


def test_shards_are_disjoint_and_complete(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(100)], "k string")
    for shard in (select.shard_crc32, select.shard_sha1, select.shard_sha256):
        found = df.select(shard(F.col("k"), 4).alias("s")).groupBy("s").count().collect()
        assert {r["s"] for r in found} <= {0, 1, 2, 3} and sum(r["count"] for r in found) == 100


def test_interleaving_takes_hosts_in_turn(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "id int, host string")
    assert [r["id"] for r in select.interleaved(df, "host", [F.asc("id")]).orderBy("turn", "host").collect()] == [1, 3, 2, 4]


def test_evenly_spaced_has_both_ends(spark):
    df = spark.range(0, 101).repartition(5)
    assert sorted(r[0] for r in select.evenly_spaced(df, [F.asc("id")], 5).collect()) == [0, 25, 50, 75, 100]
    assert select.evenly_spaced(df, [F.asc("id")], 500).count() == 101


def test_conflicts_and_duplicates(spark):
    df = spark.createDataFrame([("p", "u1"), ("p", "u2"), ("q", "u"), ("q", "u")], "path string, url string")
    assert rows(select.conflicts(df, ["path"], ["url"])) == [("p", "u1", 2), ("p", "u2", 2), ("q", "u", 1), ("q", "u", 1)]


def test_contains_join_finds_what_a_loop_finds(spark):
    texts = [(i, t) for i, t in enumerate(["abcdef", "xabcx", "cab", "ab", "zzz abcd", "bcd"])]
    wanted = [(i, q) for i, q in enumerate(["abc", "bcd", "cab", "zzzz", "ef", "a", "zz"])]
    got = resolve.contains_join(spark.createDataFrame(wanted, "q int, w string"), spark.createDataFrame(texts, "t int, x string"), "w", "x")
    assert rows(got.select("q", "t")) == sorted(((q, t) for q, w in wanted for t, x in texts if w in x), key=repr)


def test_roster_merge(spark):
    schema = "isin string, name string, symbol string, scrip string, flag string"
    nse = spark.createDataFrame([("I1", "ACME", "ACME", "", "NSE"), ("I2", "ZED", "ZED", "", "NSE")], schema)
    bse = spark.createDataFrame([("I1", "ACME LIMITED", "", "500", "BSE"), ("", "ZED", "", "501", "BSE")], schema)
    assert rows(resolve.merge_rosters(nse, bse, "isin", F.upper("name"))) == [("I1", "ACME LIMITED", "ACME", "500", "BSE,NSE"), ("I2", "ZED", "ZED", "501", "BSE,NSE")]


def test_company_match(spark):
    schema = "company_name string, legal_name string, aliases array<string>, isin string, register_no string, profile_no string, profile_name string, profile_type string, previous_names array<string>"
    cases = [
        (("Barclays PLC", "", None, "GB0031348658", "48839", "00048839", "BARCLAYS PLC", "plc", None), "VERIFIED"),
        (("Barclays PLC", "", None, "GB0031348658", "", "00999999", "BARCLAYS LIMITED", "private-limited", None), "REVIEW"),
        (("Glencore PLC", "", None, "JE00B4T3BW64", "", None, None, None, None), "UNAVAILABLE"),
        (("Acme", "", None, "GB0000000001", "", None, None, None, None), "REVIEW"),
        (("New Name PLC", "", None, "GB0000000001", "", "00000007", "OLDCO PLC", "plc", ["New Name PLC"]), "VERIFIED"),
    ]
    df = spark.createDataFrame([c for c, _ in cases], schema)
    assert [r["status"] for r in resolve.company_match(df).collect()] == [w for _, w in cases]


def test_fuzzy_join(spark):
    a = spark.createDataFrame([(1, "x", "acme holdings"), (2, "x", "zzz")], "id int, b string, a string")
    c = spark.createDataFrame([(10, "x", "acme holding"), (11, "x", "other")], "other int, b string, n string")
    assert [(r["id"], r["other"], r["rank"]) for r in resolve.fuzzy(a, c, "b", "a", "n", "id", "other").collect()] == [(1, 10, 1)]


def test_rolling_window_waits_for_the_fourth(spark):
    df = spark.createDataFrame([(i, 1, t) for i, t in enumerate([0.0, 0.1, 0.2, 0.3, 1.1])], "event_id int, k int, s double").withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))
    got = {r["event_id"]: (r["in_window"], round(r["wait"], 3)) for r in integrity.rolling(df, ["k"], "ts", 1, 3, "event_id").collect()}
    assert got == {0: (1, 0.0), 1: (2, 0.0), 2: (3, 0.8), 3: (4, 0.7), 4: (4, 0.0)}


def test_verification(spark):
    ledger = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "path string, bytes long, sha256 string")
    files = spark.createDataFrame([("a", 1, "x"), ("b", 9, "n"), ("d", 4, "w")], "path string, length long, digest string")
    assert rows(integrity.verify(ledger, files, "path")) == [("b", "hash_mismatch"), ("b", "size_mismatch"), ("c", "missing"), ("d", "orphan")]
    assert rows(integrity.verify(ledger, files, "path", deep=False)) == [("b", "size_mismatch"), ("c", "missing"), ("d", "orphan")]


def test_adaptive_limit(spark):
    seen = [(0, 200), (61, 200), (100, 200), (122, 200), (130, 503), (131, 429), (200, 200)]
    df = spark.createDataFrame([(1, i, t, s) for i, (t, s) in enumerate(seen)], "k int, i int, t int, s int").withColumn("ts", F.timestamp_seconds("t"))
    assert [r["limit"] for r in integrity.adaptive_limit(df, ["k"], "ts", "s", "i").collect()] == [2]  # 4, 5, 5, 6, 3, 1, 2


def test_next_configurations(spark):
    df = spark.createDataFrame([("m", 16, 2, 3.0, True), ("m", 16, 2, 5.0, True), ("m", 8, 1, 1.0, False), ("m", 8, 1, 1.0, True), ("m", 32, 2, 4.5, True), ("n", 1, 1, 1.0, True), ("o", 1, 1, 1.0, None)], "host string, workers long, lanes long, s double, ok boolean")
    got = rows(integrity.next_configurations(df, ["host"], "workers", "lanes", "s", "ok"))
    assert got == [("m", 16, 1), ("m", 16, 2), ("m", 32, 2), ("m", 8, 2), ("n", 1, 1), ("n", 2, 1)]


def test_promotions_need_five_per_cent(spark):
    df = spark.createDataFrame([(h, 1, 95.0, True) for h in "abc"] + [("d", 1, 1.0, False)], "host string, workers long, s double, ok boolean")
    before = spark.createDataFrame([("a", 100.0), ("b", 99.0)], "host string, champion double")
    assert rows(integrity.promotions(df, before, ["host"], ["workers"], "s", "ok")) == [("a", 1, 95.0, True), ("b", 1, 95.0, False), ("c", 1, 95.0, True)]


def test_configurations_are_brought_within_bounds(spark):
    df = spark.createDataFrame([("a", 100, 1, 1.0, True), ("b", 1, 1, 1.0, True), ("c", 3, 2, 1.0, True), ("d", 64, 2, 1.0, True)], "host string, workers int, lanes int, s double, ok boolean")
    got = {tuple(r) for r in integrity.next_configurations(df, ["host"], "workers", "lanes", "s", "ok").collect()}
    want = {("a", 100, 1), ("a", 50, 1), ("a", 128, 1), ("a", 100, 2), ("b", 1, 1), ("b", 2, 1), ("c", 3, 2), ("c", 6, 2), ("c", 3, 1), ("d", 64, 2), ("d", 32, 2), ("d", 128, 2), ("d", 64, 1)}
    assert got == want


def test_cascade_levels_and_blanks(spark):
    facts = spark.createDataFrame([(1, "T", "x", "I"), (2, "", "x", "I"), (3, None, None, " "), (4, "U", "x", "J"), (5, "T", "y", None)], "id int, t string, m string, i string")
    dim = spark.createDataFrame([(10, "T", "x", "I"), (11, "U", "x", "I"), (12, "U", "x", "J"), (12, "U", "x", "J"), (13, None, "", "")], "e int, t string, m string, i string")
    keys = [[(F.col("m"), F.col("m")), (F.col("t"), F.col("t"))], [(F.col("i"), F.col("i"))]]
    got = {tuple(r) for r in resolve.cascade(facts, dim, "id", "e", keys).select("id", "e", "level", "n").collect()}
    assert got == {(1, 10, 1, 1), (2, None, 2, 2), (3, None, None, 0), (4, None, 1, 2), (5, None, None, 0)}


def test_a_key_of_a_third_of_the_rows_is_many_tasks(spark):
    facts = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    dim = spark.createDataFrame([(1, "hot"), (2, "4"), (3, "5"), (4, "5")], "e int, k string")
    out = resolve.cascade(facts, dim, "id", "e", [[(F.col("k"), F.col("k"))]])
    assert out.where("e = 1").count() == 10_000 and out.where("n > 0").count() == 10_002
    asked = resolve._told("id", [F.col("k")], facts, "level").withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(resolve.SALTS)))
    parts = asked.where("_key = 'hot'").repartition(64, "_key", "_salt").groupBy(F.spark_partition_id()).count()
    assert parts.agg(F.max("count")).first()[0] < 10_000 / 4
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in text and "Cartesian" not in text


def test_alias_reasons(spark):
    facts = spark.createDataFrame([(1, "a", "b"), (2, "", "b"), (3, "z", None), (4, "c", "a")], "id int, x string, y string")
    dim = spark.createDataFrame([(10, "a"), (11, "b"), (12, "b"), (13, "")], "e int, n string")
    got = {tuple(r) for r in resolve.aliases(facts, "id", [F.col("x"), F.col("y")], dim, "e", F.col("n")).collect()}
    assert got == {(1, 10, None), (2, None, "ambiguous"), (3, None, "unmapped"), (4, 10, None)}


def test_overlap_join_equals_all_pairs(spark):
    rng = random.Random(5)
    for least in (0.01, 0.5, 0.6, 1.0):
        sets = [(i, "ab"[i % 2], rng.choices("abcdefghijklmnop", weights=range(1, 17), k=rng.randint(0, 7))) for i in range(120)] + [(200, "a", None), (201, "a", ["q"]), (202, "b", ["q"])]
        df = spark.createDataFrame(sets, "id int, block string, t array<string>")
        got = {tuple(r) for r in resolve.overlap_join(df, "id", "t", ["block"], least).collect()}
        want = set()
        for i, b, x in sets:
            for j, c, y in sets:
                if i < j and b == c and x and y and len({*x} & {*y}) >= least * min(len({*x}), len({*y})) - 1e-9:
                    want.add((b, i, j, round(len({*x} & {*y}) / min(len({*x}), len({*y})), 3)))
        assert got == want


def test_fuzzy_join_equals_all_pairs(spark):
    rng = random.Random(6)
    names = [(i, "xy"[i % 2], "".join(rng.choices("abcdeé漢 ", k=rng.randint(0, 9)))) for i in range(60)]
    df = spark.createDataFrame(names, "id int, b string, n string")
    for least in (0.55, 0.9):
        got = {tuple(r) for r in resolve.fuzzy(df, df.select("b", F.col("id").alias("o"), F.col("n").alias("m")), "b", "n", "m", "id", "o", 3, least).select("id", "o", "rank", "similarity").collect()}
        want = set()
        for i, b, x in names:
            each = sorted((-difflib.SequenceMatcher(None, x, y).ratio(), j) for j, c, y in names if b == c and i != j)
            want |= {(i, j, r + 1, -s) for r, (s, j) in enumerate(each[:3]) if -s >= least}
        assert got == want


def test_first_nested_items(spark):
    df = spark.createDataFrame([(1, "a", 2, 0), (1, "a", 1, 5), (1, "b", 9, 9), (2, "a", 1, 1)], "id int, kind string, outer int, inner int")
    assert rows(select.first_nested(df, ["id", F.upper("kind").alias("kind")], ["outer", "inner"])) == [(1, "A", 1, 5), (1, "B", 9, 9), (2, "A", 1, 1)]


def test_fuzzy_join_compares_texts_once(spark, monkeypatch):
    compared = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counted(a: pd.Series, b: pd.Series) -> pd.Series:
        compared.add(len(a))
        return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])

    monkeypatch.setattr(resolve.S, "similarity", counted)
    texts = ["acme holding", "acme holdings", "acme folding", None]
    names = [(i, "x", texts[i % 4]) for i in range(100)] + [(100, "x", "acme holdinx"), (None, "x", "acme holding")]
    df = spark.createDataFrame(names, "id int, b string, n string")
    found = resolve.fuzzy(df, df.select("b", F.col("id").alias("o"), F.col("n").alias("m")), "b", "n", "m", "id", "o").select("id", "o", "rank", "similarity")
    got = {tuple(r) for r in found.collect()}
    assert 0 < compared.value <= 16
    want = set()
    for i, _, x in names:
        each = sorted((-difflib.SequenceMatcher(None, x, y).ratio(), j) for j, _, y in names if i is not None and j is not None and x and y and i != j)
        want |= {(i, j, r + 1, -s) for r, (s, j) in enumerate(each[:4]) if -s >= 0.55}
    assert got == want


def test_contains_join_keeps_equal_rows(spark):
    queries = spark.createDataFrame([(1, "acm"), (2, "acm"), (2, "acm"), (3, "m"), (4, None), (5, "zzz")], "q int, w string")
    texts = spark.createDataFrame([(i, "acme") for i in range(1100)] + [(2000, None), (2001, "am")], "t int, x string")
    got = resolve.contains_join(queries, texts, "w", "x").groupBy("q", "w", "x").agg(F.count("*"), F.count_distinct("t"))
    assert rows(got) == sorted([(1, "acm", "acme", 1100, 1100), (2, "acm", "acme", 2200, 1100), (3, "m", "acme", 1100, 1100), (3, "m", "am", 1, 1)], key=repr)


def test_overlaps_of_many_equal_sets(spark):
    words = [["a", "b", "c"], ["b", "c", "d"], ["x", "y"]]
    sets = [(i, "s", words[i % 3]) for i in range(1800)] + [(5000, "t", ["a", "b", "c"]), (None, "s", ["a", "b", "c"])]
    df = spark.createDataFrame(sets, "id int, block string, t array<string>")
    met, every = resolve.overlap_join(df, "id", "t", ["block"], 0.6), resolve.overlap_pairs(df, "id", "t", ["block"])
    own, across = 3 * 600 * 599 // 2, 600 * 600

    def summed(pairs):
        return rows(pairs.where("id < other").groupBy("overlap").agg(F.count("*"), F.count_distinct(F.struct("id", "other"))))

    assert summed(met) == [(0.667, across, across), (1.0, own, own)]
    assert summed(every) == [(0.0, 2 * across, 2 * across), (0.667, across, across), (1.0, own, own)]


def expansions(spark, df):
    """The plan's lines that make rows of arrays, the last one first; those in generated code begin with a star."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" :+-|") for line in plan.splitlines() if "Generate explode" in line]


def test_contains_join_hands_on_rows_of_chunks(spark, monkeypatch):
    """Chunks meet whole, whatever their size and columns, and no task keeps all rows of two chunks."""
    monkeypatch.setattr(resolve, "CHUNK", 7)
    wanted = [(i, ["ab", "bcd", "e", "abcd"][i % 4], i % 3 or None) for i in range(50)]
    texts = [(i % 60 or None, ["abcd", "bcde", "xab"][i % 3]) for i in range(90)]
    queries, catalog = spark.createDataFrame(wanted, "q int, w string, more int"), spark.createDataFrame(texts, "t int, x string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = resolve.contains_join(queries, catalog, "w", "x")
        assert got.columns == ["q", "w", "more", "t", "x"]
        assert rows(got) == sorted(((*q, *t) for q in wanted for t in texts if q[1] in t[1]), key=repr)
        inner, outer = expansions(spark, got)[:2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert inner.startswith("*(") and "_c" in inner
    assert outer.startswith("Generate explode(transform(") and "_q" in outer


def test_overlap_pairs_hand_on_rows_of_chunks(spark, monkeypatch):
    """All pairs of a block, each once, when classes have several chunks; no task keeps all rows of two chunks."""
    monkeypatch.setattr(resolve, "CHUNK", 7)
    words = [["a", "b"], ["b", "c", "d"], ["x"], []]
    sets = [(i, "st"[i % 5 == 0], words[i % 4]) for i in range(100)]
    df = spark.createDataFrame(sets, "id int, block string, t array<string>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = resolve.overlap_pairs(df, "id", "t", ["block"])
        want = [(b, i, j, round(len({*x} & {*y}) / max(1, min(len(x), len(y))), 3)) for i, b, x in sets for j, c, y in sets if i < j and b == c]
        assert rows(got) == sorted(want, key=repr)
        inner, outer = expansions(spark, got)[:2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert inner.startswith("*(") and "_bh" in inner
    assert outer.startswith("Generate explode(transform(") and "_ah" in outer


def test_overlap_join_hands_on_rows_of_chunks(spark, monkeypatch):
    """Pairs of repeated sets, each once, when classes have several chunks; no task keeps all rows of two chunks."""
    monkeypatch.setattr(resolve, "CHUNK", 7)
    words = [["a", "b"], ["b", "c", "d"], ["b", "a", "a", "e"], [], None]
    sets = [(i, "st"[i % 3 == 0], words[i % 5]) for i in range(150)]
    df = spark.createDataFrame(sets, "id int, block string, t array<string>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = resolve.overlap_join(df, "id", "t", ["block"], 0.6)
        pairs = [(b, i, j, len({*x} & {*y}), min(len({*x}), len({*y}))) for i, b, x in sets for j, c, y in sets if i < j and b == c and x and y]
        assert rows(got) == sorted(((b, i, j, round(n / m, 3)) for b, i, j, n, m in pairs if 10 * n >= 6 * m), key=repr)
        inner, outer = expansions(spark, got)[:2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert inner.startswith("*(") and "_bh" in inner
    assert outer.startswith("Generate explode(transform(") and "_ah" in outer
