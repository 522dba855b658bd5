import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from slotwise.llm import kneser_ney as kn, langid, queries, vptree

SF = "/root/testdata/sf0.01"


def some(x):
    return sorted(x, key=repr)


# ---------------------------------------------------------------- quality


def plain_model(texts, order=kn.ORDER):
    """Interpolated modified Kneser-Ney over bytes, with dictionaries."""
    counts = {order: {}}
    for t in texts:
        x = b"\0" * (order - 1) + t
        for i in range(len(t)):
            g = x[i : i + order]
            counts[order][g] = counts[order].get(g, 0) + 1
    for k in range(order - 1, 0, -1):
        counts[k] = {}
        for g in counts[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1
    rates = {k: kn.discounts(np.array([sum(v == r for v in c.values()) for r in (1, 2, 3, 4)])) for k, c in counts.items()}

    def p(g):
        if not g:
            return 1 / 256
        k, lower = len(g), p(g[1:])
        same = {x: c for x, c in counts[k].items() if x[:-1] == g[:-1]}
        if not same:
            return lower
        own = same.get(g, 0)
        left = sum(rates[k][min(c, 3)] for c in same.values())
        return (own - rates[k][min(own, 3)] + left * lower) / sum(same.values())

    return p


def test_perplexity_equals_the_plain_models(spark):
    rng = random.Random(1)
    words = ["the", "of", "and", "ing", "thé", "zeta"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 25))), "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = docs.where("doc_id % 2 = 0").select("doc_id")
    blocks = 4  # as many as shuffle partitions, for so little text
    block = dict(tuple(r) for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).collect())
    models = {m: plain_model([t.encode() for i, t, _ in rows if i % 2 == 0 and block[i] % 2 != m]) for m in (0, 1)}
    got = {r["doc_id"]: r["perplexity"] for r in kn.scored(docs, trusted).collect()}
    for i, t, _ in rows:
        x = b"\0" * (kn.ORDER - 1) + t.encode()
        bits = -sum(math.log2(models[block[i] % 2](x[j : j + kn.ORDER])) for j in range(len(t.encode())))
        assert got[i] == pytest.approx(2 ** (bits / len(t.encode())), rel=5e-3)


def test_probabilities_add_up():
    raw = [b"the thing and the other thing", b"there and then"]
    keys, counts = kn.distinct(kn.ngrams(raw))
    found = kn.levels(keys, counts, kn.ORDER)
    pairs, first = kn.base(dict(zip(found[2][0].tolist(), found[2][1].tolist())))
    assert first.sum() == pytest.approx(1)
    tables = {k: kn.Level(*found[k], kn.discounts(np.array([(found[k][1] == r).sum() for r in (1, 2, 3, 4)]))) for k in range(3, kn.ORDER + 1)}
    for context in (b"the ", b"then", b"zzzz", b"\0\0\0\0"):
        own = np.uint64(int.from_bytes(context, "big") << 8) | np.arange(256, dtype=np.uint64)
        assert (2.0 ** kn.score(own, tables, pairs, kn.ORDER)).sum() == pytest.approx(1, rel=1e-5)


def test_ngrams_begin_after_zeros():
    raw = [b"abc", b"", b"x", b"longer text"]
    want = [int.from_bytes((b"\0" * 4 + t)[i : i + 5], "big") for t in raw for i in range(len(t))]
    assert kn.ngrams(raw).tolist() == want


def test_quality_separates_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = queries.op1_quality(spark, SF).join(labels, "doc_id", "left").cache()
    good = out.where("quality = 1 AND toxic = 0").agg(F.avg(F.col("keep").cast("int"))).first()[0]
    bad = out.where("quality = 0").agg(F.avg(F.col("keep").cast("int"))).first()[0]
    assert out.count() == 1000 and good > 0.97 and bad < 0.3


def test_toxic_documents_are_rejected(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = queries.op1_quality(spark, sf).join(labels, "doc_id").cache()
    by = out.where("quality = 1").groupBy("toxic", (F.col("lang") == "en").alias("en")).agg(F.avg(F.col("keep").cast("int")).alias("kept"))
    kept = {(r["toxic"], r["en"]): r["kept"] for r in by.collect()}
    assert kept[1, True] < 0.02 and kept[1, False] < 0.75 and min(kept[0, True], kept[0, False]) > 0.97


def test_toxicity_is_of_the_highest_words():
    raw = [b"ab cd  ef gh", b"", b"x" * 200, b"one"]
    times = np.concatenate([np.array([5, 5, 0, 1, 1, 0, 0, 2, 2, 0, -9, 3]), np.ones(200), [1, 1, -4]]).astype(np.float32)
    assert kn.toxicities(raw, times).tolist() == [10 + 2 + 4, 0, 192, -2]


def test_languages_with_few_trusted_documents(spark):
    rng = random.Random(6)
    rows = [(i, "en", 5 * math.exp(rng.gauss(0, 0.1)), rng.gauss(9, 4)) for i in range(600)]
    trusted = list(range(400))
    for n in range(1, 6):
        for at, lang in ((1000 * n, f"like{n}"), (1000 * n + 500, f"rare{n}")):
            rows += [(at + i, lang, (15 if at % 1000 else 5) * math.exp(rng.gauss(0, 0.1)), rng.gauss(20 if at % 1000 else 9, 4)) for i in range(200)]
            trusted += range(at, at + n)
            rows += [(at + 400, lang, 100.0, 9.0), (at + 401, lang, 1.0, 9.0), (at + 402, lang, 15.0, 150.0)]
    scores = spark.createDataFrame(rows, "doc_id long, lang string, perplexity double, toxicity double")
    out = kn.judged(scores, spark.createDataFrame([(i,) for i in trusted], "doc_id long"))
    kept = {tuple(r)[:2]: r["kept"] for r in out.groupBy("lang", (F.col("doc_id") % 500 >= 400).alias("bad")).agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert all(kept[f"{x}{n}", False] > 0.9 and kept[f"{x}{n}", True] == 0 for x in ("like", "rare") for n in range(1, 6))
    assert kept["en", False] > 0.97


def labels_for(spark):
    return spark.createDataFrame([(i, 1, 0, "x") for i in range(100, 140)] + [(5, 1, 0, None), (5, 0, 0, None), (6, None, 0, None), (None, 1, 0, None)], "doc_id long, quality int, toxic int, shard string")


def test_quality_of_odd_documents(spark, odd, odd_pairs):
    out = kn.classify(odd, labels_for(spark)).collect()
    assert some(r["doc_id"] for r in out) == some(d for d, _ in odd_pairs)
    for r in out:
        if r["doc_id"] in (1, 2):
            assert r["n_bytes"] == 0 and r["perplexity"] is None and not r["keep"]
    kept = kn.trustworthy(odd, labels_for(spark))
    assert kept.columns == odd.columns
    assert kept.count() == sum(r["keep"] for r in out) > 30


def test_quality_without_labels_or_rows(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["keep"] == (r["perplexity"] is not None) for r in kn.classify(odd, empty).collect())
    assert kn.classify(none, labels_for(spark)).collect() == []
    assert kn.trustworthy(none, empty).columns == none.columns


# ---------------------------------------------------------------- languages


def plain_phrases(text, sample):
    """Greedy longest matches; a letter that the sample lacks is a phrase."""
    total = at = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        at += n
        total += 1
    return total


@pytest.mark.parametrize("block", [3, 16, 512])
def test_phrases_are_longest_matches(monkeypatch, block):
    """Of whole texts: where they are cut for the parse doesn't show, even if phrases are longer than blocks."""
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = random.Random(4)
    samples = {"a": "".join(rng.choice("abcd ") for _ in range(400)), "b": "".join(rng.choice("aefg ") for _ in range(300))}
    model = langid.Model(samples)
    texts = ["".join(rng.choice("abcdefgz ") for _ in range(n)) for n in (1, 5, 511, 512, 513, 1500)] + ["".join(rng.choice("abcd ") for _ in range(700)), samples["a"][20:390] + "z" + samples["b"][:250], "", "zzz"]
    got = model.phrases(texts)
    assert got.tolist() == [[plain_phrases(t, samples[x]) for x in "ab"] for t in texts]


def test_every_script_and_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    rng = random.Random(8)
    alphabets = {"ar": (0x621, 28), "de": (0x61, 26), "el": (0x3B1, 24), "hi": (0x905, 50), "ja": (0x3041, 80), "ka": (0x10D0, 33), "ru": (0x430, 32), "uk": (0x430, 32), "zh": (0x4E00, 2000)}
    rows = []
    for lang, (first, n) in alphabets.items():
        words = ["".join(chr(first + rng.randrange(n)) for _ in range(rng.randint(2, 6))) for _ in range(150)]
        rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(60)), lang) for i in range(40 if lang == "de" else 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.learn(docs)
    assert [len(m.langs) for m in models] == [3, 3, 3]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, models).collect()}
    assert all(got[d] == lang for d, _, lang in rows)


def test_rare_letters_are_parsed_like_others():
    rng = random.Random(9)
    sample = "".join(chr(0x4E00 + rng.randrange(300)) for _ in range(3000))
    text = sample[500:540] + sample[40:90] + sample[2000:2003]
    assert int(langid.Model({"zh": sample}).phrases([text])[0, 0]) == plain_phrases(text, sample)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    out = queries.op3_language_id(spark, SF).join(docs, "doc_id").where("held_out")
    n, right = out.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 200 and right / n > 0.95


def test_languages_of_odd_documents(odd, odd_pairs, none):
    model = langid.learn(odd)
    got = {}
    for r in langid.identify(odd, model).collect():
        assert 0 <= r["score"] <= 1
        got.setdefault(r["doc_id"], r["lang_pred"])
    assert got[1] == got[2] == got[3] == got[14] == "und" and len(got) == len({d for d, _ in odd_pairs})
    assert langid.identify(none, model).collect() == []
    empty = langid.learn(none)
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}


def test_held_out_rule(spark):
    import zlib

    got = dict(tuple(r) for r in spark.range(200).select("id", langid.held_out(F.col("id"))).collect())
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


# ---------------------------------------------------------------- neighbours


def plain_nearest(rows, k):
    out = []
    for q, x in rows:
        if q % 20 == 0:
            scored = sorted((-float(np.add.accumulate(np.float64(x) * np.float64(y))[-1]), i) for i, y in rows if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def test_factor_one_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(6) * rng.uniform(0.1, 3)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vptree.search(df, df.where("vec_id % 20 = 0"), 20, 1.0, shard_rows=200, query_block=10)
    assert some(map(tuple, got.collect())) == some(plain_nearest(rows, 20))


@pytest.mark.parametrize("kind", ["binary", "constant", "clusters", "integers"])
@pytest.mark.parametrize("factor", [1.0, 1.5])
def test_ties_go_to_the_smaller_id(spark, kind, factor):
    """Hundreds of vectors tie with the k-th; in clusters most shards are out of reach."""
    rng = np.random.default_rng(6)
    vectors = {
        "binary": rng.integers(0, 2, (1200, 10)) + np.eye(1200, 10, -7),
        "constant": np.concatenate([np.ones((300, 4)), 2 * np.ones((300, 4)), np.eye(300, 4) + 1]),
        "clusters": np.repeat(rng.standard_normal((12, 8)) * 20, 100, 0) + rng.standard_normal((1200, 8)),
        "integers": rng.integers(-3, 4, (1200, 3)),
    }[kind].astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True) if v.any()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = some(map(tuple, vptree.search(df, df.where("vec_id % 20 = 0"), 20, factor, shard_rows=100, query_block=16).collect()))
    want = some(plain_nearest(rows, 20))
    if factor == 1.0:
        assert got == want
    else:  # another choice, but true scores in the right order
        score = {(q, i): s for q, x in rows if q % 20 == 0 for i, y in rows if (s := float(np.add.accumulate(np.float64(x) * np.float64(y))[-1])) is not None}
        assert all(score[q, i] == s for q, _, i, s in got) and [(q, r) for q, r, *_ in got] == [(q, r) for q, r, *_ in want]


def test_clusters_out_of_reach_are_not_visited():
    rng = np.random.default_rng(7)
    at = np.repeat(rng.standard_normal((32, 8)) * 50, 100, 0) + rng.standard_normal((3200, 8))
    at *= 100 / np.sqrt((at**2).sum(1))[:, None]
    top = vptree.Top(np.arange(3200), at, 10_000.0, 32)
    floor = top.floor(np.arange(3200), at, 20)
    reached = top.reached(at, floor, 1.0)
    assert reached.mean() < 0.25 and reached[np.arange(3200), top.leaf(at)].all()


def test_recall_with_the_production_factor(spark):
    rows = [(r[0], list(r[1])) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = {}
    for q, _, i, _ in plain_nearest(rows, 20):
        want.setdefault(q, set()).add(i)
    got = {}
    for r in queries.op4_nearest(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(got[q] & want[q]) / 20 for q in want]) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (20, [1.0, 2.0, 3.0]), (21, [1.0, 1.0, 1.0]), (40, []), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (0, [1.0, 0.0]), (-20, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, shard string")
    got = some(map(tuple, vptree.search(df, df.where("vec_id % 20 = 0"), 20).collect()))
    assert got == some([(0, 1, -20, 2.0), (0, 2, 1, 0.5), (0, 3, 7, 0.5), (-20, 1, 0, 2.0), (-20, 2, 1, 1.0), (-20, 3, 7, 1.0), (20, 1, 21, 6.0)])
    assert vptree.search(df.limit(0), df.limit(0)).collect() == []


@pytest.mark.parametrize("shard_rows", [10, 10_000])
def test_components_of_any_magnitude(spark, shard_rows):
    """Squares of these exceed doubles or vanish; bounds and scores must not."""
    rng = np.random.default_rng(17)
    rows = [(i, (rng.standard_normal(4) * 10.0 ** rng.integers(-300, 150)).tolist()) for i in range(200)]
    rows += [(200, [1e155, 1.0, 0.0, 0.0]), (220, [1e-200, 2e-200, 1e-200, 0.0]), (240, [5e-324, 0.0, 0.0, 5e-324]), (260, [1e150, -1e150, 1e-300, 0.0]), (261, [1e154, 1e10, 1e-300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vptree.search(df, df.where("vec_id % 20 = 0"), 20, 1.0, shard_rows=shard_rows, query_block=4)
    with np.errstate(over="ignore", under="ignore"):
        assert some(map(tuple, got.collect())) == some(plain_nearest(rows, 20))


def test_vectors_that_are_all_tiny_or_huge(spark):
    rng = np.random.default_rng(18)
    for scale in (1e-310, 1e-180, 1e150, 1e304):
        rows = [(i, (rng.standard_normal(3) * scale).tolist()) for i in range(60)] + [(100 + i, (rng.standard_normal(2) * scale / 1e5).tolist()) for i in range(30)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        want = []
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            for width in (3, 2):
                want += plain_nearest([r for r in rows if len(r[1]) == width and any(r[1])], 5)
        got = vptree.search(df, df.where("vec_id % 20 = 0"), 5, shard_rows=20).collect()
        if scale < 1e300:  # sums of infinities of both signs are no numbers, and have no order
            assert some(map(tuple, got)) == some(want)


def test_empty_texts_take_no_place_in_a_sample(spark):
    rows = [(i, "" if i % 2 else " 12, 3! ", "xx") for i in range(6000)]
    rows += [(10_000 + i, f"kolmo vanha talo seisoi joen rannalla {'ja sen vieressa kasvoi suuri puu ' * (i % 3)}", "xx") for i in range(20)]
    rows += [(20_000 + i, "quite another kind of words that everyone here knows", "yy") for i in range(50)]
    models = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [x for m in models for x in m.langs] == ["xx", "yy"]


def test_quality_of_documents_with_clashing_names(spark, odd):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100, 130)], "doc_id long, quality int, toxic int")
    assert "_block" in odd.columns
    assert kn.trustworthy(odd, labels).columns == odd.columns
