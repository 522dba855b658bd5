import itertools
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from plain import base_spans, contamination, sha

from slotwise.llm import decontaminate, pii, queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def some(x):
    return sorted(x, key=repr)


def told(df):
    out = []
    for r in df.collect():
        n = sum(s["end"] - s["start"] for s in r["hits"])
        out.append((r["doc_id"], r["n_words"], n, len(r["items"]), sha(",".join(r["items"])), n > 0))
    return some(out)


ITEMS = [(1, "Alpha3 beta4, gamma5"), (2, None), (3, ""), (None, "zeta9 eta8"), (4, "theta1"), (5, "one two three four five six seven eight nine ten eleven"), (5, "one two three four five six seven eight nine ten eleven"), (6, "the of and")]


@pytest.fixture(scope="module")
def bench(spark, odd_pairs):
    long = next(t for d, t in odd_pairs if d == 4)
    return ITEMS + [(7, " ".join(long.split()[5:20])), (8, long.upper())]


@pytest.mark.parametrize("block_words", [400_000, 20])
def test_contamination_is_exact(spark, odd, odd_pairs, bench, block_words):
    items = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, shard string")
    assert told(decontaminate.contamination(odd, items, block_words=block_words)) == some(contamination(odd_pairs, bench))


@pytest.mark.parametrize("block_words", [400_000, 20])
def test_clean_keeps_all_columns(spark, odd, odd_pairs, bench, block_words):
    items = spark.createDataFrame(bench, "item_id long, text string")
    out = decontaminate.clean(odd, items, block_words=block_words)
    assert out.columns == odd.columns
    assert some(r["text"] for r in out.collect()) == some(t for (_, t), row in zip(odd_pairs, contamination(odd_pairs, bench)) if not row[-1])


def test_contamination_of_nothing(spark, none, odd):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(none, empty).collect() == []
    assert all(r["hits"] == [] and r["items"] == [] for r in decontaminate.contamination(odd, empty).collect())


def test_many_shards_and_a_window_of_very_many_items(spark):
    """20,000 items have one window in common; their 30 shards and more are of 40,000 words each."""
    common = " ".join(f"c{i}" for i in range(10))
    bench = [(i, f"{common} x{i} y{i} z{i}") for i in range(20_000)] + [(30_000 + i, " ".join(f"q{i}w{j}" for j in range(12))) for i in range(50)]
    docs = [(1, f"a {common} b"), (2, f"{common} x7 y7 z7"), (3, "c0 c1 c2 c3 c4 c5 c6 c7 c8"), (4, " ".join(f"q3w{j}" for j in range(1, 11)) + " end"), (5, None)] + [(10 + i, f"w{i} {common}") for i in range(30)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    want = some(contamination(docs, bench))
    assert told(decontaminate.contamination(rows, items, block_words=8_000)) == want
    assert sorted(r["doc_id"] for r in decontaminate.clean(rows, items, block_words=8_000).collect()) == [d for d, *_, bad in sorted(want) if not bad]


def test_query_on_documents(spark, small):
    items = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    assert some(map(tuple, queries.op10_decontaminate(spark, "/root/testdata/sf0.001").collect())) == some(contamination(small[1], items))


# ---------------------------------------------------------------- personal data

PARTS = ["1", "2", "25", "255", "256", ".", "..", "@", "a", "b.c", "-", " ", "+", "(", ")", "%", "_", "4111111111111111", "4111 1111 1111 1111", "\n", "é", "x@y.z", "+1 (974) 555-3436", "1.2.3.4", "٣", "0000001"]


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == base_spans(text), text


def test_base_spans_on_documents(small):
    for _, text in small[1]:
        assert pii.base_spans(text or "") == base_spans(text)


def test_base_spans_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 200_000, "@" * 200_000, "+(" * 100_000, "0" * 9_000 + ".1.2.3"):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def field():
    rng = random.Random(5)
    texts = []
    for i in range(300):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        texts.append(f"write to user{i}.x@mail{i % 9}.example.com or call {phone} from {rng.randint(1, 255)}.{rng.randint(0, 255)}.3.4 order {i} item 20{i % 90:02d} code ab{i}cd, card 4111 1111 1111 1111.")
    return pii.Field(texts)


def test_field_agrees_with_its_labels(field):
    texts = ["mail bob.smith@corp.example.org now", "from 10.1.2.3 in 2024", "call +1 (415) 555-2671 today"]
    graph = pii.Graph(texts)
    gold = pii.gold(graph, [pii.base_spans(t) for t in texts])
    assert (field.marginals(graph).argmax(1) == gold).mean() > 0.85


def test_skip_edges_carry_labels(field):
    """A token that is undecided alone takes the label of its sure repetitions."""
    texts = ["x bob@corp.example.org y " + "plain words here " * 30 + "bob@corp.example.org"]
    graph = pii.Graph(texts)
    assert len(graph.skips) >= 1
    alone = field.marginals(graph)
    unary = graph.features.copy()
    graph.features[1] = 0  # the second one's own evidence is gone
    tied = field.marginals(graph)[1, 1]
    graph.skips = graph.skips[:0]
    assert tied > field.marginals(graph)[1, 1]
    assert alone.shape == (2, 5) and unary.shape[0] == 2


def test_the_field_finds_what_the_patterns_lose(field):
    """Digits that follow a phone number or a card make the patterns drop it; a part of one known elsewhere is one too."""
    texts = ["call +1 (415) 555-2671 190.137.223.20 now", "order 12 item 2034 code ab3cd in 2024 or so 77"]
    base = [pii.base_spans(t) for t in texts]
    assert [pii.shown(x) for x in base] == ["ip:23:37", ""]
    assert [pii.shown(x) for x in field.added(texts, base)] == ["phone:5:22", ""]


def test_marginals_equal_enumeration():
    """Without loops message passing is exact; a skip edge closes none here."""
    rng = np.random.default_rng(1)
    for n, edges in ((4, [(0, 1), (1, 2), (1, 3)]), (3, [(0, 2)]), (5, [(0, 1), (2, 3), (1, 4)])):
        unary, tie, skip = rng.normal(size=(n, 3)), rng.normal(size=(3, 3)), rng.normal(size=(3, 3))
        groups = [(np.array(edges[:-1]).reshape(-1, 2), tie), (np.array(edges[-1:]), skip)]
        want = np.zeros((n, 3))
        for labels in itertools.product(range(3), repeat=n):
            score = sum(unary[i, y] for i, y in enumerate(labels)) + sum(t[labels[a], labels[b]] for x, t in groups for a, b in x.tolist())
            for i, y in enumerate(labels):
                want[i, y] += np.exp(score)
        got = pii.beliefs(unary, groups, 200)
        assert np.allclose(got, want / want.sum(1, keepdims=True), atol=0.02)


def test_long_documents_are_taken_in_pieces(field, monkeypatch):
    """A part of a number is known from a piece far away, before or behind."""
    clear, part = "call +1 (415) 555-2671 today", "ask 4155552671 or so"
    filler = " and 12 of 34 on 5" * 30
    for text in (clear + filler + " " + clear, part + filler + " " + clear + filler + " " + part):
        monkeypatch.setattr(pii, "RUN", 50_000)
        whole = field.added([text], [pii.base_spans(text)])
        monkeypatch.setattr(pii, "RUN", 20)
        assert field.added([text], [pii.base_spans(text)]) == whole


def test_digit_heavy_text_stays_in_bounds(field):
    """20 MB of numbers: memory follows RUN, not the text."""
    code = f"""
import resource, sys, time
sys.path.insert(0, {ROOT!r})
from pyspark import cloudpickle
from slotwise.llm import pii
field = pii.Field(["call +1 (415) 555-2671 today, write a.b@mail.example.com, from 10.0.0.1 12"] * 3)
text = "17 " * 5_000_000 + "345 " * 500_000
before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
field.added([text], [[]])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900)
    assert out.returncode == 0 and int(out.stdout) < 500, out.stdout + out.stderr


def test_added_spans_never_meet_base_spans(field):
    texts = ["a b@c.de f +1 (415) 555-2671 g 4111 1111 1111 1111 h user@host i 1.2.3"]
    base = [pii.base_spans(t) for t in texts]
    for s, e, _ in field.added(texts, base)[0]:
        assert all(e <= a or b <= s for a, b, _ in base[0])


def test_masking():
    assert pii.masked_text("a x@y.zz b 1.2.3.4", [(2, 8, 0), (11, 18, 1)]) == "a [EMAIL] b [IP]"
    assert pii.masked_text("abcdef", [(1, 4, 2), (2, 5, 3)]) == "a[CARD]f"


def test_odd_documents(spark, odd, odd_pairs):
    field = pii.learn(odd)
    got = some((r["doc_id"], [(s["start"], s["end"], pii.KINDS.index(s["kind"])) for s in r["base"]]) for r in pii.find(odd, field).collect())
    assert got == some((d, base_spans(t)) for d, t in odd_pairs)
    out = pii.mask(odd, field)
    assert out.columns == odd.columns and out.count() == len(odd_pairs)
    masked = {r["doc_id"]: r["text"] for r in out.collect()}
    assert masked[12].startswith("[EMAIL], [PHONE]; [CARD] and [IP] [EMAIL]") and masked[1] is None


def test_nothing(none):
    assert pii.find(none, pii.learn(none)).collect() == []


def test_query_counts(spark, small):
    for r in queries.op5_pii(spark, "/root/testdata/sf0.001").collect():
        spans = base_spans(dict(small[1])[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for *_, k in spans) for i in range(4)]
        assert r["base_sha256"] == sha(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in spans))


def test_marginals_are_a_documents_own():
    """A document's marginals are the same alone and beside others, whose messages take longer."""
    rng = random.Random(12)
    number = "+1 415 555 2671"
    texts = [" ".join(rng.choice(["call", number, "4111 1111 1111 1111", "10.0.0.1", "ref", "a@b.co", f"{rng.randint(10**6, 10**9)}", number]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    field = pii.Field(texts)
    graph = pii.Graph(texts)
    both = field.marginals(graph)
    assert len(graph.skips) > 100
    for d, text in enumerate(texts):
        alone = pii.Graph([text])
        assert np.abs(field.marginals(alone) - both[graph.doc == d]).max(initial=0) < 1e-12
