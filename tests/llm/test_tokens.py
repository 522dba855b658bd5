import codecs
import random

import numpy as np
import pytest
from plain import VOCAB, bpe as plain_bpe, library, token_files as plain_files

from slotwise.llm import bpe, common, queries, token_files

POOL = ["<|endoftext|>", "<|startoftext|>", "<|END", "'s", "'LL", "ΑΣ", "J̌", "J", "̌", "İ", "ß", "\x1c", "\x85", "\xa0", "　", "é", "́", "漢字", "😀", "1", "23", "½", "²", "...", "!?", "aaaaaaaa", "the", " ", "\n", "abab", "ing", "\x00", "ﬁ", "Ⅷ", "'", "’s", "ñ", "क्षि", "﻿", "K"]


def some(x):
    return sorted(x, key=repr)


@pytest.fixture(scope="module")
def lib():
    return library()


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(VOCAB)


def test_encoding_equals_the_library(codec, lib):
    rng, ours = random.Random(1), token_files.Library(VOCAB)
    ours.words.words.limit = codec.words.words.limit = 30  # the memos turn over all the time
    for _ in range(400):
        texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 12))) for _ in range(10)]
        want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in codec.encode(texts)] == want
        assert [np.frombuffer(x, ours.kind).tolist() for x in ours.encode(texts).to_pylist()] == want


@pytest.mark.parametrize("text", ["a" * 5000, "".join(random.Random(2).choice("abcdeinthor") for _ in range(20_000)), "😀" * 500, "!" * 3000])
def test_long_words_are_streamed(codec, lib, text):
    assert codec.encode([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids


def test_transducer_keeps_constant_memory(codec):
    kept = []
    machine = codec.transducer
    stable = machine._stable
    machine._stable = lambda last: kept.append(len(last)) or stable(last)
    try:
        list(machine.stream("".join(random.Random(3).choice("aeinthors") for _ in range(30_000))))
    finally:
        machine._stable = stable
    assert max(kept) < 12 * (machine.lookahead + 1)


def test_tokens_come_out_before_the_end(codec):
    stream = codec.transducer.stream("thereisanotherwordinthere" * 200)
    next(stream)  # with most of the word unread


def test_byte_level_decoding_is_incremental(codec):
    machine = bpe.Decoder(codec)
    machine.byte_level, machine.byte = True, {c: b for b, c in enumerate(codec.alphabet)}
    machine.state = codecs.getincrementaldecoder("utf-8")("replace")
    machine.names = codec.alphabet
    raw = "é漢😀x".encode() + b"\xff\xe6"
    assert "".join(machine.feed([b]) for b in raw) + machine.end() == raw.decode("utf-8", "replace")


def test_round_trip_of_odd_documents(spark, odd, odd_pairs):
    out = bpe.round_trip(odd, queries._digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    assert some(map(tuple, out.collect())) == some(plain_bpe(odd_pairs))


def test_encode_then_decode(odd, lib):
    out = bpe.decode(bpe.encode(odd.limit(15)))
    assert all(r["decoded"] == lib.decode(r["ids"], skip_special_tokens=False) for r in out.collect())


def test_query_on_documents(spark, small):
    assert some(map(tuple, queries.op8_bpe(spark, "/root/testdata/sf0.001").collect())) == some(plain_bpe(small[1]))


def test_bpe_of_nothing(none):
    assert bpe.decode(bpe.encode(none)).collect() == []


# ---------------------------------------------------------------- files


@pytest.mark.parametrize("top", [1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1])
def test_code_round_trip(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 3, 4, 5, 1000):
        v = rng.integers(0, top, n, dtype=np.uint64, endpoint=True).astype(np.uint32)
        control, data = token_files.write_code(v)
        assert len(control) == -(-n // 4)
        assert token_files.read_code(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n).tolist() == v.tolist()


def test_file_round_trip():
    ids = [np.array(x, np.uint32) for x in ([5, 5, 7], [], [1 << 31, 5], [9])]
    doc_ids, sizes, flat, before = token_files.from_file(token_files.to_file([None, 3, 4, -1], ids, 17))
    assert (doc_ids, sizes.tolist(), flat.tolist(), before) == ([None, 3, 4, -1], [3, 0, 2, 1], [5, 5, 7, 1 << 31, 5, 9], 17)
    with pytest.raises(ValueError):
        token_files.from_file(b"????" + bytes(60))


def test_frequent_ids_take_a_byte():
    ids = np.concatenate([np.full(1000, 40_000), np.arange(300)]).astype(np.uint32)
    control, data = token_files.write_code(np.zeros(1000, np.uint32))
    assert len(data) == 1000
    assert len(token_files.to_file([1], [ids], 0)) < 4200


@pytest.mark.parametrize("file_ids", [100, 2_000_000])
def test_files_of_odd_documents(spark, odd, odd_pairs, file_ids):
    files = token_files.write(odd, common.fresh_dir(spark, "t"), file_ids=file_ids)
    rows = [(r["doc_id"], r["start"], r["ids"]) for r in token_files.read(files).collect()]
    lib = library()
    assert some((d, np.frombuffer(x, "<u4").tolist()) for d, _, x in rows) == some((d, lib.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in odd_pairs)
    at = 0
    for d, start, x in sorted(rows, key=lambda r: r[1]):
        assert start == at
        at += len(x) // 4
    order = [(d is not None, d or 0) for d, _, _ in sorted(rows, key=lambda r: r[1])]
    assert order == sorted(order)


def test_file_query_on_documents(spark, small):
    assert some(map(tuple, queries.op7_token_files(spark, "/root/testdata/sf0.001").collect())) == some(plain_files(small[1]))


def test_files_of_nothing(spark, none):
    assert token_files.read(token_files.write(none, common.fresh_dir(spark, "t"))).collect() == []


def test_all_code_points(codec, lib):
    """Alone, inside words and beside marks: assigned, unassigned and newer than the library's tables or than Python's."""
    ours = token_files.Library(VOCAB)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and not 0xF0000 <= i]
    texts = ["".join(f"a{c}b {c}1{c}{c} x{c}. " for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    want = [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, ours.kind).tolist() for x in ours.encode(texts).to_pylist()] == want
    assert [x.tolist() for x in codec.encode(texts[:3000])] == want[:3000]
    assert [x.tolist() for x in codec.encode(texts[3000::40])] == want[3000::40]


def test_memo_is_bounded():
    memo = bpe.Recent(10)
    for i in range(100):
        assert memo.of([f"w{i}", "same", "x" * 100], lambda words: [w.encode()[:9] for w in words]) == [f"w{i}".encode(), b"same", b"x" * 9]
    assert len(memo) + len(memo.old) <= 22 and not any(len(w) > memo.LONG for w in [*memo, *memo.old])


def test_what_killed_tasks_left_is_removed(spark, none, tmp_path):
    folder = f"file://{tmp_path}/ids"
    token_files.put(f"{folder}/ids-000000-000000.bin.{'0' * 32}", b"x")
    token_files.put(f"{folder}/ids-000009-000000.bin", b"x")
    token_files.write(none, folder)
    assert [p.name for p in (tmp_path / "ids").iterdir()] == ["ids-000009-000000.bin"]
