"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters (lower-cased) and digits and of anything beyond ASCII. A window
is n consecutive words of an item. Both sides hash k-grams of words and keep the least k-gram
hash of every window of n - k + 1 of them (winnowing): a span of n words that an item and a
document share has the same least hash on both sides, so joining on these fingerprints misses
no shared span. A hit is then extended to the whole window, whose words are compared, and the
covered words of a document are the union of its windows. Items shorter than n words are one
window of their own length, found by the hash of all their words.

The fingerprints of the test set, whatever its size, are broadcast as a Bloom filter of at most
2 ** MOST_BITS bits, made in slices by tasks. One pass over the documents finds the windows whose
fingerprint may be the test set's; only these are shuffled, the words of each once for each chunk
of documents and shard. A shard of the join holds the windows of about block_words words of the
test set, and each is copied to as many tasks as there are partitions for it, among which the
chunks of documents are spread: a window that very many documents have is not one task's. What
comes back is joined to the documents that sent something. Texts never move.

Defined results: null or empty text has no words and no hits; null item texts are no windows; a
null item_id marks words and is listed as an empty string; repeated items count once by their
id; repeated documents are each returned; null doc_ids are kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C

U64 = np.uint64
#: Words of test items whose windows a shard of the join holds, about (100 to 200 bytes each).
BLOCK_WORDS = 400_000
#: Bits of the filter for each word of the test set and at most (2 ** MOST_BITS); bits that a slice of it has.
BITS, MOST_BITS, SLICE_BITS = 32, 28, 22
#: Lower-cases A-Z, keeps other letters, digits and bytes beyond ASCII; the rest separates words.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def prints(h: np.ndarray, size: int, n: int, k: int) -> np.ndarray:
    """The fingerprint of every window of `size` of these words: the least hash of its k-grams, or that of all its words
    where it is shorter than n."""
    own = C.window_minima(C.grams(h, k), n - k + 1) >> U64(4) if size == n else C.grams(h, size)
    return C.mix(own * U64(64) + U64(size))


# ---------------------------------------------------------------- the filter


def places(key: np.ndarray, bits: int, nth: int) -> np.ndarray:
    return (key >> U64(20 * nth)) * (key | U64(1)) >> U64(64 - bits)


class Filter:
    """Which fingerprints may be the test set's, and how long its short items are."""

    PROBES = 3

    def __init__(self, bits: int, slices: dict[int, bytes], sizes: list[int]):
        self.bits, self.sizes = bits, sizes
        each = 1 << min(bits, SLICE_BITS) - 3
        self.table = np.frombuffer(b"".join(slices.get(i, bytes(each)) for i in range(1 << max(0, bits - SLICE_BITS))), np.uint8)

    def maybe(self, key: np.ndarray) -> np.ndarray:
        """The positions of those fingerprints that may be in the test set."""
        at = np.arange(len(key))
        for nth in range(self.PROBES):
            place = places(key[at], self.bits, nth)
            at = at[self.table[place >> U64(3)] >> (place & U64(7)).astype(np.uint8) & 1 == 1]
        return at


def _items(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[str, list[bytes], int]]:
    """(id, words, window size) of items (item_id, text) that have words."""
    for part in C.chunks(batches):
        for item, text in zip(part.column(0).to_pylist(), C.texts(part), strict=True):
            if words := words_of(text):
                yield item, words, min(n, len(words))


def filter_of(bench: DataFrame, n: int, k: int, words: int) -> Filter:
    """The filter of the fingerprints of test items (item_id, text) of so many words at most."""
    bits = min(MOST_BITS, max(15, (BITS * words).bit_length()))

    def spot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sizes = C.WordHashes(), set()
        for _, words, size in _items(batches, n):
            if size < n:
                sizes.add(size)
            key = prints(hashes.of(words), size, n, k)
            place = np.unique(np.concatenate([places(key, bits, nth) for nth in range(Filter.PROBES)]))
            yield C.packed_rows([(s, C.pack([place[at]])) for s, at in C.split_by((place >> U64(SLICE_BITS)).astype(np.int32))])
        yield C.packed_rows([(0, C.pack([np.array([1 << 63 | x for x in sizes], U64)]))])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, sizes = {}, set()
        for batch in batches:
            for s, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place = C.unpack(blob)[0]
                if len(place) and place[-1] >> U64(63):
                    sizes.update((place & U64((1 << 63) - 1)).tolist())
                    continue
                table = tables.setdefault(s, np.zeros(1 << min(bits, SLICE_BITS) - 3, np.uint8))
                place = place & U64((1 << SLICE_BITS) - 1)
                np.bitwise_or.at(table, (place >> U64(3)).astype(np.int64), (1 << (place & U64(7)).astype(np.uint8)).astype(np.uint8))
        yield C.packed_rows([(s, x.tobytes()) for s, x in tables.items()] + [(-1, bytes(sorted(sizes)))])

    slices, sizes = {}, set()
    for s, blob in C.dealt(bench.mapInArrow(spot, C.PACKED), 1 << max(0, bits - SLICE_BITS)).mapInArrow(fill, C.PACKED).toLocalIterator():
        if s < 0:
            sizes.update(blob)
        else:
            slices[s] = bytes(blob)
    return Filter(bits, slices, sorted(sizes))


# ---------------------------------------------------------------- the join

_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_SCANNED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("asks", pa.bool_()), ("shard", pa.int32()), ("windows", pa.list_(pa.binary())), ("at", pa.binary())])
SCANNED = "doc_id long, text_hash long, n_words long, asks boolean, shard int, windows array<binary>, at binary"
_TOLD = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("item", pa.string()), ("windows", pa.list_(pa.binary())), ("at", pa.binary())])
TOLD = "shard int, kind int, item string, windows array<binary>, at binary"
FOUND = "doc_id long, text_hash long, hits array<struct<start:int,end:int>>, items array<string>"
_WINDOWS, _ASKED = 0, 1


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _scan(part: pa.RecordBatch, ours: Filter, hashes: C.WordHashes, n: int, k: int, shards: int, spread: int) -> pa.RecordBatch:
    """A row for each document of a chunk of doc_id, text and one for each shard that some of its windows are asked of."""
    raw = C.texts(part)
    split = [words_of(x) for x in raw]
    sizes = np.array([len(x) for x in split], np.int64)
    words = [w for own in split for w in own]
    doc, first = np.repeat(np.arange(len(raw), dtype=np.int32), sizes), np.cumsum(sizes) - sizes
    text = np.array([xxhash.xxh64_intdigest(x, 42) for x in raw], U64).view(np.int64)
    h, asked = hashes.of(words), []
    for size in (n, *ours.sizes):
        key = prints(h, size, n, k)
        at = ours.maybe(key)
        at = at[doc[at] == doc[at + size - 1]]
        asked.append((at, np.full(len(at), size), (key[at] % U64(shards)).astype(np.int32)))
    at, size, shard = (np.concatenate(x) for x in zip(*asked, strict=True))
    ids, asks = part.column(0), np.zeros(len(raw), bool)
    asks[doc[at]] = True
    rows = [(d, t, c, a, None, None, None) for d, t, c, a in zip(ids.to_pylist(), text.tolist(), sizes.tolist(), asks.tolist(), strict=True)]
    turn = int(text[0]) % spread if len(text) else 0
    null, known = ids.is_null().to_numpy(zero_copy_only=False), pa.compute.fill_null(ids, 0).to_numpy()
    for s, own in C.split_by(shard):
        number: dict[bytes, int] = {}
        which = [number.setdefault(b" ".join(words[a : a + z]), len(number)) for a, z in zip(at[own].tolist(), size[own].tolist(), strict=True)]
        docs, local = np.unique(doc[at[own]], return_inverse=True)
        blob = C.pack([known[docs], null[docs].astype(np.uint8), text[docs], local.astype(np.uint32), (at[own] - first[doc[at[own]]]).astype(np.uint32), size[own].astype(np.uint8), np.array(which, np.uint32)])
        rows.append((None, None, None, None, s * spread + turn, list(number), blob))
    return _rows(rows, _SCANNED)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's windows, in order of their items, and then what is asked of it -> the documents' windows that occur."""
    shard, table = None, {}
    for batch in batches:
        for s, kind, item, windows, blob in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if s != shard:
                shard, table = s, {}
            if kind == _WINDOWS:
                for w in windows:
                    own = table.setdefault(w, [])
                    if not own or own[-1] != item:
                        own.append(item)
                continue
            ids, null, text, local, start, size, which = C.unpack(blob)
            found = [table.get(w) for w in windows]
            real = np.array([x is not None for x in found], bool)[which]
            spans: dict[int, list] = {}
            numbers: dict[int, set] = {}
            for d, a, z, w in zip(*(x[real].tolist() for x in (local, start, size, which)), strict=True):
                spans.setdefault(d, []).append((a, a + z))
                numbers.setdefault(d, set()).add(w)
            rows = []
            for d, own in spans.items():
                items = set().union(*(found[w] for w in numbers[d]))
                rows.append((None if null[d] else int(ids[d]), int(text[d]), [{"start": a, "end": b} for a, b in merged(own)], sorted(items)))
            yield _rows(rows, _FOUND)


_FOUND = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("hits", _SPANS), ("items", pa.list_(pa.string()))])


def found(docs: DataFrame, bench: DataFrame, n: int, k: int, block_words: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_hash, n_words, asks of every row of docs, and doc_id, text_hash, hits, items of those documents, once
    each, that have hits; the first is written."""
    spark = docs.sparkSession
    bench = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where("text is not null")
    words = (bench.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // 2 + 1
    ours = C.Shipped(spark, filter_of(bench, n, k, words))
    shards = max(1, -(-words // (3 * block_words)))  # a word has 5 bytes and a blank, about
    spread = max(1, -(-C.n_shards(spark) // shards))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = C.WordHashes()
        for part in C.chunks(batches):
            yield _scan(part, ours.get(), hashes, n, k, shards, spread)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = C.WordHashes()
        for item, words, size in _items(batches, n):
            shard, rows = (prints(hashes.of(words), size, n, k) % U64(shards)).astype(np.int32), []
            for s, at in C.split_by(shard):
                windows = list({b" ".join(words[a : a + size]) for a in at.tolist()})
                rows.append((s, _WINDOWS, item, windows, None))
            yield _rows(rows, _TOLD)

    scanned = C.written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, SCANNED), "scanned")
    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    told = bench.mapInArrow(tell, TOLD).withColumn("copy", copies).select((F.col("shard") * spread + F.col("copy")).alias("shard"), "kind", "item", "windows", "at")
    asked = scanned.where("shard is not null").select("shard", F.lit(_ASKED).alias("kind"), F.lit(None).cast("string").alias("item"), "windows", "at")
    hits = told.union(asked).repartitionById(shards * spread, F.col("shard")).sortWithinPartitions("shard", "kind", "item").mapInArrow(_find, FOUND)
    # what several shards found of one document; equal rows of one document tell the same
    each = hits.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_set("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return scanned.where("shard is null").select("doc_id", "text_hash", "n_words", "asks"), each


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = [[{"start": a, "end": b} for a, b in merged([(x["start"], x["end"]) for x in own])] for own in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, _SPANS), batch.column(3)], ["doc_id", "n_words", "hits", "items"])


def contamination(docs: DataFrame, bench: DataFrame, n: int = 10, k: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, hits (merged word ranges), items (ids as strings, sorted) of every row of docs."""
    every, each = found(docs, bench, n, k, block_words)
    each = each.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_text"})
    no_hits, no_items = F.array().cast("array<struct<start:int,end:int>>"), F.array().cast("array<string>")
    some = every.where("asks").join(each, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_text")), "left")
    rows = some.select("doc_id", "n_words", F.coalesce("hits", no_hits).alias("hits"), F.coalesce("items", no_items).alias("items"))
    rows = rows.mapInArrow(_merged, "doc_id long, n_words long, hits array<struct<start:int,end:int>>, items array<string>")
    return every.where("not asks").select("doc_id", "n_words", no_hits.alias("hits"), no_items.alias("items")).union(rows)


def clean(docs: DataFrame, bench: DataFrame, n: int = 10, k: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs, all columns, in which no window of an item occurs."""
    _, each = found(docs, bench, n, k, block_words)
    gone = C.written(each.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text")), "contaminated")
    key = [F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")]
    return docs.select(*key).join(gone, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_text")), "left_anti").select("_row.*")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out
