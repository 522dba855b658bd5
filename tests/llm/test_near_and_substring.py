import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import deduplicated, near_duplicates, sha, shingles_of, simhash, substring_dedup

import corpus_pipeline
from pyspark.sql import functions as F
from slotwise.llm import common, simhash as near, substring_dedup as sub


def some(x):
    return sorted(x, key=repr)


def removed(df):
    return some((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["removed"]), sha(r["kept_text"])) for r in df.collect())


@pytest.mark.parametrize("n, k", [(13, 5), (5, 2), (16, 1)])
def test_substring_dedup_is_exact(odd, odd_pairs, n, k):
    assert removed(sub.dedup(odd, n, k)) == some(substring_dedup(odd_pairs, n))


def test_substring_dedup_on_documents(small):
    docs, pairs = small
    assert removed(sub.dedup(docs.repartition(7))) == some(substring_dedup(pairs))


def test_substring_dedup_of_nothing(none):
    assert sub.dedup(none).collect() == []


def test_substring_dedup_keeps_the_first_of_many(spark):
    pairs = [(i, "one passage that is in very many documents of this table and long enough for a window " + "w" * (i % 3)) for i in range(300)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert removed(sub.dedup(docs)) == some(substring_dedup(pairs))


def classes(df):
    return some((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in df.collect())


def test_simhash_classes_are_exact(odd, odd_pairs):
    assert classes(near.near_duplicates(odd)) == some(near_duplicates(odd_pairs))


def test_simhash_on_documents(small):
    docs, pairs = small
    assert classes(near.near_duplicates(docs)) == some(near_duplicates(pairs))


@pytest.mark.parametrize("budget", [0, 1, 7])
def test_simhash_budgets(small, budget):
    docs, pairs = small
    assert classes(near.near_duplicates(docs, budget=budget)) == some(near_duplicates(pairs, budget))


def test_simhash_of_nothing(none):
    assert near.near_duplicates(none).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.lists(st.integers(0, 63), max_size=5)), min_size=1, max_size=60), st.integers(0, 6))
def test_trie_join_finds_all_pairs(seeds, budget):
    base = [x * 0x9E3779B97F4A7C15 % 2**64 for x in range(7)]
    keys = np.unique(np.array([base[b] ^ sum({1 << f for f in flips}) for b, flips in seeds], np.uint64))
    found = {(int(a), int(b)) for i, j in near.trie_pairs(keys, np.array([0]), np.array([len(keys)]), 0, budget) for a, b in zip(i, j)}
    want = {(a, b) for a in range(len(keys)) for b in range(a + 1, len(keys)) if int(keys[a] ^ keys[b]).bit_count() <= budget}
    assert found == want


def test_components_of_long_chains(spark):
    edges = [(i + 1, i) for i in range(0, 200)] + [(1000 + i, 1000) for i in range(1, 50)] + [(5000, 5000)]
    df = spark.createDataFrame(edges, "u long, v long")
    assert {(r["v"], r["root"]) for r in near.components(df).collect()} == {(i, 0) for i in range(1, 201)} | {(1000 + i, 1000) for i in range(1, 50)}


def test_long_text_fingerprint_in_pieces():
    text = " ".join(f"w{i}" for i in range(40_000))
    assert int(near.fingerprint_chunk([text.encode()], 4, 42)[0]) == simhash(text)


def test_one_document_of_each_class_stays(odd, odd_pairs):
    out = near.deduplicated(odd)
    assert out.columns == odd.columns
    assert some((r["doc_id"], r["text"] or "") for r in out.collect()) == some(deduplicated(odd_pairs))


def test_documents_of_one_id_and_other_texts_are_told_apart(spark):
    rng = random.Random(31)
    a, b = ([f"{x}{rng.randint(0, 4000)}" for _ in range(100)] for x in "ab")
    pairs = [(3, " ".join(a)), (7, " ".join([*a[:-1], "end"])), (7, " ".join(b)), (9, " ".join([*b[:-1], "end"]))]
    out = near.deduplicated(spark.createDataFrame(pairs, "doc_id long, text string"), banded=True)
    assert some(map(tuple, out.collect())) == some([pairs[0], pairs[2]])


@pytest.mark.parametrize("chunk", [512, 3])
def test_near_copies_and_large_classes(spark, monkeypatch, chunk):
    monkeypatch.setattr(near, "CLASS_CHUNK", chunk)
    rng = random.Random(11)
    base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(150)]
    pairs = [(i, " ".join("zz" if j in (i % 37, 3 * i % 149) else w for j, w in enumerate(base))) for i in range(60)]
    pairs += [(1000 + i, " ".join(rng.sample(base, 150))) for i in range(10)] + [(2000, pairs[5][1])]
    out = near.deduplicated(spark.createDataFrame(pairs, "doc_id long, text string"))
    assert some(map(tuple, out.collect())) == some(deduplicated(pairs))
    assert out.count() == 11


def test_no_similar_pair_stays():
    """Of scattered edits near the threshold, which exceed 8 bits of SimHash; no class is given to the plain version."""
    rng = random.Random(13)
    pairs = []
    for i in range(400):
        base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 4000)}" for _ in range(120)]
        pairs += [(2 * i, base), (2 * i + 1, ["zz" if j in (15, 70) else w for j, w in enumerate(base)])]
    sets = [near.shingle_set(" ".join(w).encode(), 5) for _, w in pairs]
    assert all(len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) for a, b in zip(sets[::2], sets[1::2], strict=True))
    keys = near.bands(sets)
    fp = near.fingerprint_chunk([" ".join(w).encode() for _, w in pairs], 2, 42, once=True)
    assert (near.popcount(fp[::2] ^ fp[1::2]) > 8).any() and (keys[::2] == keys[1::2]).any(1).all()


def test_scattered_edits_are_found(spark):
    rng = random.Random(13)
    pairs = []
    for i in range(400):
        base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 4000)}" for _ in range(120)]
        pairs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join("zz" if j in (15, 70) else w for j, w in enumerate(base)))]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(pairs, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(0, 800, 2))


def test_nothing_to_deduplicate(none):
    assert near.deduplicated(none).collect() == []


def test_similar_pairs_are_exact():
    rng = random.Random(12)
    sets = [sorted(rng.sample(range(40), rng.randint(0, 12))) for _ in range(60)] + [[], [], [1, 2, 3, 4], [1, 2, 3, 4, 5]]
    i, j = near.similar_pairs([np.array(x, np.uint64) for x in sets], 0.8)
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]})}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_numpy_hash_is_sparks(spark):
    ids = [0, 1, -1, 2**62, -(2**63), 2**63 - 1, 12345]
    want = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "x long").select(F.xxhash64("x")).collect()]
    assert common.spark_hash(np.array(ids, np.int64)).view(np.int64).tolist() == want


def test_packed_arrays_come_back():
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.int32), np.array([1.5, -2], np.float32), np.array([255], np.uint8)]
    assert [x.tolist() for x in common.unpack(common.pack(arrays))] == [x.tolist() for x in arrays]


def test_spans_with_equal_keys_are_told_apart():
    """What a sort by one hash puts together is parted by the other."""
    key, more = np.array([7, 7, 7, 8, 7], np.uint64), np.array([1, 2, 1, 1, 2], np.uint64)
    assert sub._repeats(key, more, np.array([5, 1, 6, 9, 1])).tolist() == [False, False, True, False, False]
    assert sub._repeats(key, np.zeros(5, np.uint64), np.array([5, 1, 6, 9, 1])).tolist() == [True, False, True, False, False]
    assert sub._repeats(key[:0], more[:0], key[:0]).tolist() == []


def test_tables_left_over_can_be_removed(spark):
    kept = common.leftovers()
    out = near.near_duplicates(spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "doc_id long, text string"))
    assert out.count() == 2 and set(common.leftovers()) > set(kept)
    left = set(common.leftovers()) - set(kept)
    common.clear(spark, keep=kept)
    assert common.leftovers() == kept
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    assert not any(at(x).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at(x)) for x in left)


def test_no_similar_documents_stay(spark):
    """Every pair of documents at 0.8 or more is found by an inverted index; one of each class stays, and nothing else goes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stay = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    sets, where = {}, {}
    for r in docs.select("doc_id", "text").collect():
        sets[r["doc_id"]] = set(shingles_of(r["text"], 5))
        for x in sets[r["doc_id"]]:
            where.setdefault(x, []).append(r["doc_id"])
    links = {}
    for d, own in sets.items():
        for e in {e for x in own for e in where[x]} - {d}:
            if len(own & sets[e]) >= 0.8 * len(own | sets[e]):
                links.setdefault(d, set()).add(e)
    empty = {d for d, own in sets.items() if not own}
    links |= {d: empty - {d} for d in empty}
    root = {}
    for d in sorted(sets):
        todo = [d] if d not in root else []
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = d
                todo += links.get(x, ())
    assert len(links) > 100 and stay == {d for d in sets if root[d] == d}
