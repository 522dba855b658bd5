import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from plain import classes, sha, shingles_of

from pyspark.sql import functions as F
from slotwise.llm import lexical, lloyd, minhash, queries


def some(x):
    return sorted(x, key=repr)


# ---------------------------------------------------------------- ranked search


def words(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))


def plain_search(docs, items, k=20):
    held = [(d, collections.Counter(w), len(w)) for d, t in docs if (w := words(t))]
    n_docs, total, df = len(held), sum(n for *_, n in held), collections.Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked, scores = words(text), []
        for d, c, n in held:
            m = 100 - 25 + 25 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w in asked if w in c)
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scores[:k])]
    return some(out)


ITEMS = [(1, "Alpha3 beta7, beta7 gamma11!"), (1, "Alpha3 beta7, beta7 gamma11!"), (1, "theta1"), (2, None), (3, "?!"), (None, "the École"), (4, "漢字 😀 12½ x85"), (5, "nowhere"), (6, "the of and alpha1 alpha2 alpha3 zeta9 eta10 theta40 the the")]


@pytest.mark.parametrize("block, k, step, cells", [(256 << 10, 20, 8, 4 << 20), (16, 3, 1, 40)])
def test_search_is_exact(spark, odd, odd_pairs, monkeypatch, block, k, step, cells):
    for name, value in (("BLOCK_BYTES", block), ("STEP", step), ("CELLS", cells)):
        monkeypatch.setattr(lexical, name, value)
    items = spark.createDataFrame([(*x, "n", "t") for x in ITEMS], "item_id long, text string, n string, terms string")
    out = lexical.search(odd.repartition(3), items, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert some(map(tuple, out.collect())) == plain_search(odd_pairs, ITEMS, k)


def test_search_of_documents(spark, small):
    docs, pairs = small
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    assert some(map(tuple, queries.op11_lexical(spark, "/root/testdata/sf0.001").collect())) == plain_search(pairs, items)


def test_search_of_nothing(spark, none, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(none, items).collect() == []
    assert lexical.search(odd, items.limit(0)).collect() == []


def test_search_stops_early():
    """Of a thousand documents few are looked up where one term decides."""
    rng = np.random.default_rng(3)
    rows, terms = np.repeat(np.arange(1000), 2), np.tile([0, 1], 1000)
    added = np.stack([rng.permutation(1000) ** 2, np.ones(1000, np.int64)], 1).ravel()
    lists = lexical.Lists(rows, terms, added, 1000, 2)
    docs, scores, looked = lexical.threshold_search(lists, np.array([0, 1]), np.array([1, 1]), 0, 5)
    want = np.sort(lists.table.sum(1))[-5:]
    assert sorted(scores.tolist()) == want.tolist() and looked < 200 and len(docs) == 5


def test_threshold_search_equals_all_scores():
    rng = np.random.default_rng(4)
    for trial in range(60):
        n_docs, n_terms, k = int(rng.integers(1, 60)), int(rng.integers(1, 8)), int(rng.integers(1, 9))
        table = rng.integers(0, 4, (n_docs, n_terms)) * rng.integers(0, 2, (n_docs, n_terms))
        rows, terms = np.nonzero(table)
        lists = lexical.Lists(rows, terms, table[rows, terms], n_docs, n_terms)
        own, times, floor = np.arange(n_terms), rng.integers(1, 3, n_terms), int(rng.integers(0, 8))
        docs, scores, _ = lexical.threshold_search(lists, own, times, floor, k)
        every = table @ times
        kth = np.sort(every)[-k] if n_docs >= k else 0
        want = {(int(d), int(s)) for d, s in enumerate(every) if s > 0 and s >= floor and s >= kth}
        assert want <= set(zip(docs.tolist(), scores.tolist(), strict=True)), trial


# ---------------------------------------------------------------- sketches


def plain_minhash(docs, k=4, percent=80):
    rows = sorted({(d, t or "") for d, t in docs if d is not None})
    sets = {t: frozenset(shingles_of(t, k)) for _, t in rows}

    def linked(a, b):
        x, y = sets[a[1]], sets[b[1]]
        return bool(x) and bool(y) and 100 * len(x & y) >= percent * len(x | y)

    root = classes(rows, linked)
    least = {r: root[r][0] for r in rows}
    out = []
    for d, t in docs:
        component = None if d is None else least[d, t or ""]
        out.append((d, len(set(shingles_of(t, k))), component, None if d is None else d == component))
    return some(out)


@pytest.mark.parametrize("bounds", [{}, {"kept": 16, "small": 2, "pivots": 1, "chunk": 3}, {"kept": 1, "small": 2, "pivots": 1}])
def test_minhash_is_exact(odd, odd_pairs, bounds):
    out = minhash.near_duplicates(odd, **bounds)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    if bounds.get("kept") != 1:
        assert some(map(tuple, out.collect())) == plain_minhash(odd_pairs)
    else:  # one value finds no pair for certain; nothing wrong is linked
        want = {(d, n): c for d, n, c, _ in plain_minhash(odd_pairs)}
        assert all(c is None or c >= want[d, n] for d, n, c, _ in map(tuple, out.collect()))


def test_minhash_on_documents(small):
    docs, pairs = small
    assert some(map(tuple, minhash.near_duplicates(docs.repartition(5)).collect())) == plain_minhash(pairs)


def test_minhash_of_nothing(none):
    assert minhash.near_duplicates(none).collect() == []


def group(rng, n, size, edits, start):
    """A text and copies of it, each with some words of its own."""
    base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 4000)}" for _ in range(size)]
    return [(start + i, " ".join(f"z{start + i}" if j in at else w for j, w in enumerate(base))) for i in range(n) if (at := set(rng.sample(range(size), edits if i else 0))) is not None]


def test_minhash_of_large_groups(spark):
    """Lists of hundreds of nodes: stars of copies, chains, a passage that all share, and copies of copies."""
    rng = random.Random(21)
    pairs = group(rng, 150, 200, 4, 0) + group(rng, 60, 120, 6, 1000) + group(rng, 120, 30, 1, 2000)
    chain = [f"c{i}" for i in range(100)]
    for i in range(40):  # each like the next only
        chain = [*chain[2:], f"n{i}", f"m{i}"]
        pairs.append((3000 + 39 - i, " ".join(chain)))
    passage = " ".join(f"p{i}" for i in range(300))
    pairs += [(4000 + i, passage + " " + " ".join(f"{i}q{j}" for j in range(80 + i % 7))) for i in range(80)]
    pairs += [(5000 + i, pairs[3][1]) for i in range(50)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    want = plain_minhash(pairs)
    assert some(map(tuple, minhash.near_duplicates(docs).collect())) == want
    assert some(map(tuple, minhash.near_duplicates(docs, kept=64, small=3, pivots=1, chunk=50).collect())) == want


def test_long_lists_are_compared_within_tasks(spark):
    """What pivots leave apart is found by chunks: two groups that share no words, in one list; a forest is sent."""
    rng = random.Random(22)
    sets = {i: np.sort(np.array(rng.sample(range(1000), 40), np.uint64)) for i in range(2)}
    rows = []
    for i in range(24):
        own = sets[i % 2].copy()
        own[-1] = 2000 + i
        rows.append((7, i, 40, own.tobytes(), i // 4 * 2 + i % 2))
    members = spark.createDataFrame(rows, "list long, id long, n long, sketch binary, class long")
    for chunk in (5, 1000):
        found = [(r["u"], r["v"]) for r in minhash.likely_between(members, 80, 128, chunk).collect()]
        assert all(u % 2 == v % 2 and u // 4 != v // 4 for u, v in found)
        links = {frozenset(x) for x in found} | {frozenset((i, i + 2)) for i in range(24) if i % 4 < 2}
        root = classes(range(24), lambda a, b: frozenset((a, b)) in links)
        assert {(i, root[i]) for i in range(24)} == {(i, i % 2) for i in range(24)}
        assert chunk == 5 or len(found) == 10


def test_required_overlap_holds():
    """Sets at the threshold share what `required` says, and estimates let them pass."""
    rng = random.Random(23)
    for trial in range(300):
        shared, kept = rng.randint(4, 400), rng.choice([16, 64, 128])
        more = shared // 4  # 0.8 of the union
        left = rng.randint(0, more)
        values = np.array(rng.sample(range(1 << 60), shared + more), np.uint64)
        a, b = values[: shared + left], np.concatenate([values[:shared], values[shared + left :]])
        x, y = np.sort(a)[:kept], np.sort(b)[:kept]
        need = minhash.required(np.array([len(a), len(b)]), 80, kept)
        assert len(np.intersect1d(x, y)) >= need.max(), trial
        assert minhash.estimate(x, len(a), y, len(b), 80, kept) is not None


def test_lists_give_all_pairs_or_those_of_pivots():
    ids = np.array([5, 3, 9, 1, 2, 7, 8], np.int64)
    pairs = minhash.pairs_of_lists(ids, np.array([0, 3]), np.array([3, 4]), 3, 2)
    assert {tuple(x) for x in pairs.tolist()} == {(3, 5), (5, 9), (3, 9), (1, 2), (1, 7), (1, 8), (2, 7), (2, 8)}


# ---------------------------------------------------------------- clusters


def plain_clusters(rows, k, rounds, dim, scale=256, seed=2):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), b"".join(x.to_bytes(4, "little", signed=True) for x in q), q) for i, q in kept if i is not None)
    centroids = [q for *_, q in first[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(q)[1] for _, q in kept]
        for j in range(len(centroids)):
            own = [q for (_, q), x in zip(kept, at) if x == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    last = [(i, *nearest(q)) for i, q in kept]
    total = collections.Counter()
    for _, d, j in last:
        total[j] += d
    return some((i, j, d, total[j], sum(total.values()), sha(",".join(map(str, centroids[j])))) for i, d, j in last)


@pytest.mark.parametrize("k, rounds", [(5, 3), (1, 1), (500, 2), (7, 0)])
def test_clusters_are_exact(spark, k, rounds):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(9)
    rows = [(int(i), rng.normal(i % 4, 0.3, 6).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(90)] + [rows[5], rows[5], (7, [0.5] * 6), (7, [-0.25] * 6), (None, [1.0] * 6)]
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [1.0] * 5 + [None]), (304, [nan] * 6), (305, [inf] + [0.0] * 5), (306, [0.0] * 6), (307, [1e6] * 6), (308, [1e30] * 6)]
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], "vec_id long, embedding array<float>, q string, cluster int")
    out = lloyd.clusters(df.repartition(4), k, rounds, dim=6)
    assert some(map(tuple, out.collect())) == plain_clusters(rows[:-1], k, rounds, 6)


def test_clusters_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert some(map(tuple, queries.op13_centroids(spark, "/root/testdata/sf0.001").collect())) == plain_clusters(rows, 40, 5, 64)


def test_no_clusters(spark):
    df = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<double>")
    out = lloyd.clusters(df)
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_large_components_are_exact():
    x = np.array([[2**26, -(2**26)], [2**26 - 1, -(2**26) + 3], [5, 7]], np.int32)
    c = np.array([[2**26, -(2**26)], [0, 0], [5, 7]], np.int64)
    at, d = lloyd.nearest(x, c)
    assert at.tolist() == [0, 0, 2] and d.tolist() == [0, 1 + 9, 0]
    rng = np.random.default_rng(8)
    x, c = rng.integers(-(2**19), 2**19, (50, 64)).astype(np.int32), rng.integers(-(2**19), 2**19, (9, 64))
    at, d = lloyd.nearest(x, c)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]
    assert at.tolist() == [w.index(min(w)) for w in want] and d.tolist() == [min(w) for w in want]
