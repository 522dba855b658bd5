"""Substring dedup by seed and extend.

Words are runs of anything but ASCII white space. Seeds: the k-grams of words that winnowing
picks, the least hash of every min_words - k + 1 in a row; every span of min_words words holds
exactly one seed that is picked for it, at an offset that its words alone decide, so equal spans
meet at equal seeds. Documents are joined on seeds by a packed shuffle: a seed carries its
document, its position and one 48-bit fingerprint for each span of min_words words that it is
picked for, that is, for each way to extend it to the left and right. At a seed, occurrences
whose extensions agree form a group, and all but those of its smallest document are repeats;
occurrences are never paired. Spans that follow each other in a document merge into maximal
repeats, which go to the document's partition, where its words are cut.

Spans repeated within one chunk of a map task are settled there, and only those of the chunk's
smallest document are sent: a passage in a third of all rows is one message per chunk. A span
is known by 108 bits of hash, its seed's 60 and 48 of all its words', which are all compared: among
10^14 spans two that differ are taken for equal with a probability of about 10^-5. (Words beside each
seed in place of fingerprints would multiply what is shuffled by more than two.)

Defined results: null or empty text has no words; a row with null doc_id keeps its words and
justifies no removal; rows with equal doc_id justify no removal in each other and are each
returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C

U64 = np.uint64
#: Spans that a shard compares at a time, about.
GROUP = 400_000
SCHEMA = "doc_id long, n_words long, removed array<struct<start:int,end:int>>, kept_text string"


def runs(start: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where runs begin: the owner changes or the start isn't the one before plus 1."""
    if not len(start):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero((np.diff(start) != 1) | (np.diff(owner) != 0)) + 1])


def _repeats(key: np.ndarray, more: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    """For each position: do an equal key and an equal `more` occur with a smaller doc_id?"""
    if not len(key):
        return np.zeros(0, bool)
    order = np.argsort(key)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(key[order])) + 1])
    rest = more[order]
    if (np.repeat(rest[cuts], np.diff(np.append(cuts, len(key)))) != rest).any():  # equal keys of different spans
        order = np.lexsort((more, key))
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(key[order]) != 0) | (np.diff(more[order]) != 0)) + 1])
    sizes = np.diff(np.append(cuts, len(key)))
    least = np.repeat(np.minimum.reduceat(doc_id[order], cuts), sizes)
    out = np.empty(len(key), bool)
    out[order] = doc_id[order] > least
    return out


def seeds(ids: np.ndarray, sums: np.ndarray, words: list[list[bytes]], hashes: C.WordHashes, min_words: int, k: int, n: int) -> list[tuple[int, bytes]]:
    """Packed rows of one chunk: (shard, blob of seeds) and (n + home, blob of repeats settled here)."""
    sizes = np.array([len(w) for w in words], np.int64)
    h = hashes.of([w for own in words for w in own])
    if len(h) < min_words:
        return []
    doc = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes) - sizes
    w = C.grams(h, min_words)
    least = C.window_minima(C.grams(h, k), min_words - k + 1)
    at = np.flatnonzero(doc[: len(w)] == doc[min_words - 1 :])
    w, least, doc = w[at], least[at], doc[at]
    away = _repeats(w, least >> U64(4), ids[doc])
    out = ranges(ids, sums, doc[away], (at - first[doc])[away], n)
    if away.any():
        w, least, doc, at = w[~away], least[~away], doc[~away], at[~away]
    if not len(w):
        return out
    # one seed for each run of spans that share it
    seat = at + (least & U64(15)).astype(np.int64)
    lead = np.concatenate([[0], np.flatnonzero((np.diff(at) != 1) | (np.diff(seat) != 0) | (np.diff(doc) != 0)) + 1])
    count = np.diff(np.append(lead, len(at)))
    seed, prints, tops = (least >> U64(4))[lead], (w & U64(0xFFFFFFFF)).astype(np.uint32), (w >> U64(48)).astype(np.uint16)
    for s, part in C.split_by((C.mix(seed) % U64(n)).astype(np.int32)):
        docs, local = np.unique(doc[lead[part]], return_inverse=True)
        total = count[part]
        which = np.repeat(lead[part] - np.cumsum(total) + total, total) + np.arange(total.sum())
        out.append((s, C.pack([np.diff(ids[docs], prepend=0), sums[docs], np.diff(local, prepend=0).astype(np.uint32), (at - first[doc])[lead[part]].astype(np.uint32), total.astype(np.uint8), seed[part], prints[which], tops[which]])))
    return out


def _home(ids: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """The partition of a document, by doc_id and text."""
    return C.home(ids.astype(np.int64) ^ (sums.astype(np.int64) << 20), n)


def ranges(ids: np.ndarray, sums: np.ndarray, doc: np.ndarray, start: np.ndarray, n: int) -> list[tuple[int, bytes]]:
    """Packed rows (n + home, blob) of the spans that start there, following ones merged; ordered by doc, start."""
    if not len(doc):
        return []
    lead = runs(start, doc)
    count = np.diff(np.append(lead, len(start)))
    out = []
    for s, part in C.split_by(_home(ids[doc[lead]], sums[doc[lead]], n)):
        own = doc[lead[part]]
        out.append((n + s, C.pack([ids[own], sums[own], start[lead[part]].astype(np.uint32), count[part].astype(np.uint32)])))
    return out


def dedup(docs: DataFrame, min_words: int = 13, k: int = 5) -> DataFrame:
    """doc_id, n_words, removed (merged word ranges), kept_text (kept words joined by a space) of every row."""
    if not 1 <= min_words - k + 1 <= 16:
        raise ValueError("min_words - k + 1 must be from 1 to 16")
    n = C.n_shards(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text")

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = C.WordHashes()
        for part in C.chunks(batches):
            part = part.filter(part.column(0).is_valid()).sort_by("doc_id")
            if part.num_rows:
                raw = C.texts(part)
                yield C.packed_rows(seeds(part.column(0).to_numpy(), np.array([C.crc(x) for x in raw], np.uint32), [x.split() for x in raw], hashes, min_words, k, n))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.lean()
        got: list[list[np.ndarray]] = []
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard >= n:
                    yield C.packed_rows([(shard, blob)])
                    continue
                ids, sums, doc, start, count, seed, prints, tops = C.unpack(blob)
                ids, doc = np.cumsum(ids), np.cumsum(doc.view(np.int32))
                got.append([ids[doc], sums[doc], start, count, seed, prints, tops])
        if not got:
            return
        ids, sums, start, count, seed, prints, tops = (np.concatenate(x) for x in zip(*got, strict=True))
        got.clear()
        first = np.cumsum(count, dtype=np.int64) - count
        groups = -(-len(prints) // GROUP)
        for g in range(groups):  # equal seeds are in one group
            at = np.flatnonzero(seed % U64(groups) == g)
            size = count[at].astype(np.int64)
            own = np.repeat(at, size)
            nth = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
            span = first[own] + nth
            more = tops[span].astype(U64) << U64(32) | prints[span]
            away = np.flatnonzero(_repeats(C.mix(seed[own] * C.MULT + more), more, ids[own]))
            if len(away):
                yield C.packed_rows(ranges(ids, sums, own[away], (start[own] + nth)[away], n))

    # rows that the map tasks settled pass the seeds' shuffle by: they are dealt among all shards, not held
    planted = rows.mapInArrow(plant, C.PACKED)
    shards = planted.repartitionById(n, F.col("shard") % n)
    repeats = shards.mapInArrow(extend, C.PACKED).select((F.col("shard") - n).alias("home"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "payload")
    # rows without doc_id are told nothing and go anywhere
    text_sum = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    key = F.coalesce(F.col("doc_id"), F.xxhash64("text")).bitwiseXOR(F.shiftleft(text_sum, 20))
    own = rows.select(C.home_column(key, n).alias("home"), F.lit(1).alias("kind"), "doc_id", "text", F.lit(None).cast("binary").alias("payload"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, table = [], None
        for batch in batches:
            told = batch.column(1).to_numpy()
            split = int(np.searchsorted(told, 1))
            got += [C.unpack(x) for x in batch.column(4).slice(0, split).to_pylist()]
            for part in C.chunks([batch.slice(split)], "text"):
                if table is None:
                    table = _by_document(got)
                    got.clear()
                yield _cut(part, table, min_words)

    return own.unionByName(repeats).repartitionById(n, F.col("home")).sortWithinPartitions("home", "kind").mapInArrow(cut, SCHEMA)


def _by_document(got: list[list[np.ndarray]]) -> tuple[np.ndarray, ...]:
    if not got:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint32, np.uint32, np.uint32))
    ids, sums, start, count = (np.concatenate(x) for x in zip(*got, strict=True))
    order = np.argsort(ids, kind="stable")
    return ids[order], sums[order], start[order], count[order]


_REMOVED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _cut(part: pa.RecordBatch, table: tuple[np.ndarray, ...], min_words: int) -> pa.RecordBatch:
    ids, sums, start, count = table
    n_words, removed, kept = [], [], []
    for doc, text in zip(part.column(2).to_pylist(), C.texts(part), strict=True):
        words = text.split()
        n_words.append(len(words))
        lo, hi = (0, 0) if doc is None else (np.searchsorted(ids, doc), np.searchsorted(ids, doc, "right"))
        own = np.arange(lo, hi)
        if lo < hi:
            own = own[sums[lo:hi] == C.crc(text)]
        if not len(own):
            removed.append([])
            kept.append(b" ".join(words))
            continue
        s = start[own].astype(np.int64)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, s, 1)
        np.add.at(change, s + count[own] + min_words - 1, -1)
        gone = np.cumsum(change)[:-1] > 0
        edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        removed.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
        kept.append(b" ".join(compress(words, (~gone).tolist())))
    return pa.RecordBatch.from_arrays([part.column(2), pa.array(n_words, pa.int64()), pa.array(removed, _REMOVED), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "removed", "kept_text"])
