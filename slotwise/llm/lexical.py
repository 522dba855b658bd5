"""Ranked lexical search by Fagin's threshold algorithm over shards of the documents.

One pass over the documents counts what the scores need of all of them (documents with terms, their terms, the
documents that hold each query term; tasks send sums, never terms) and writes a forward index: of each document its
length and the query terms that it holds, with their numbers. A second pass reads that index; a task takes its documents
in chunks, sorts for every query term the chunk's documents by what the term adds to their score, and answers each item
by the threshold algorithm: it goes down the lists of the item's terms side by side, looks the new documents up in the
forward index for their whole scores, and stops when the threshold (the sum of what the lists have just shown, the most
that an unseen document can score) falls strictly below the score of the k-th found so far. That score carries over from
chunk to chunk, so later chunks stop sooner. Each task sends k rows an item, and the k highest of all are the result.

Items are taken in blocks of bounded size (BLOCK_BYTES of text on average, dealt by hash), each a pass of its own, so
what is broadcast doesn't grow with the number of items.

Defined results: items or documents with null text or without terms have no rows (their documents count in nothing).
Rows that repeat an item_id and its text are one item; rows with one item_id and other texts are ranked each by itself.
Null item_id or doc_id are ids like others, doc_id null after all others in ties. Repeated documents are each counted,
ranked and returned. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm import common as C

#: Bytes of item texts in a block, on average.
BLOCK_BYTES = 256 << 10
#: Numbers in a chunk's table of documents by terms; rows of lists read before the threshold is looked at, at first.
CELLS, STEP = 4 << 20, 8
#: Lower-case A-Z and make a blank of every ASCII character that isn't a letter or digit.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
INDEX = "doc_id long, n long, terms binary, counts binary"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_FOLD).split()


class Items:
    """The items of one block: the numbers of their terms and how often each item has them."""

    def __init__(self, rows: list[tuple[int, int | None, str]]):
        counted = [(key, item, Counter(terms_of(text.encode()))) for key, item, text in rows]
        self.number = {t: i for i, t in enumerate(sorted({t for _, _, c in counted for t in c}))}
        self.items = [(key, item, np.array([self.number[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for key, item, c in counted if c]


def index(docs: DataFrame, shipped: C.Shipped) -> DataFrame:
    """doc_id, n, terms and counts (32-bit and 64-bit numbers, terms ascending) of every document with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shipped.get().number
        for part in C.chunks(batches):
            sizes, terms, counts = [], [], []
            for text in C.texts(part):
                words = terms_of(text)
                held = sorted(Counter(number[w] for w in words if w in number).items())
                sizes.append(len(words))
                terms.append(np.array([t for t, _ in held], "<u4").tobytes())
                counts.append(np.array([c for _, c in held], "<i8").tobytes())
            out = pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "n", "terms", "counts"])
            yield out.filter(pa.array(np.array(sizes) > 0))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX)


def statistics(indexed: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms, and the documents that hold each query term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, df = 0, 0, np.zeros(n_terms, np.int64)
        for batch in batches:
            n += batch.num_rows
            total += int(batch.column(0).to_numpy().sum())
            df += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4"), minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some.tolist()], pa.int32()), pa.array([n, total, *df[some].tolist()], pa.int64())], ["term", "s"])

    rows = indexed.select("n", "terms").mapInArrow(run, "term int, s long").groupBy("term").agg(F.sum("s").alias("s")).collect()  # bounded by the block's terms
    got = {r["term"]: r["s"] for r in rows}
    return got.get(-2, 0), got.get(-1, 0), np.array([got.get(t, 0) for t in range(n_terms)], np.int64)


class Lists:
    """A chunk's documents by what each query term adds to their score: lists from the highest, and a table for look-ups."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, added: np.ndarray, n_docs: int, n_terms: int):
        self.table = np.zeros((n_docs, n_terms), np.int64)
        self.table[rows, terms] = added
        order = np.lexsort((rows, -added, terms))
        self.docs, self.added = rows[order], added[order]
        self.at = np.searchsorted(terms[order], np.arange(n_terms + 1))


def threshold_search(lists: Lists, terms: np.ndarray, times: np.ndarray, floor: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The chunk's documents that are among its k highest with a score above 0 and at least floor, their scores, and how
    many were looked up. terms are the item's, times how often it has each."""
    start, end = lists.at[terms], lists.at[terms + 1]
    some = start < end
    terms, times, start, end = terms[some], times[some], start[some], end[some]
    seen = np.zeros(len(lists.table), bool)
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step, kth = 0, STEP, max(floor, 1)
    while len(terms):
        upto = np.minimum(start + depth + step, end)
        sizes = np.maximum(upto - start - depth, 0)
        at = np.repeat(start + depth, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        new = np.unique(lists.docs[at])
        new = new[~seen[new]]
        seen[new] = True
        docs, scores = np.append(docs, new), np.append(scores, lists.table[np.ix_(new, terms)] @ times)
        if len(docs) >= k:
            kth = max(kth, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            high = scores >= kth
            docs, scores = docs[high], scores[high]
        depth, step = depth + step, step * 2
        left = start + depth < end
        # what an exhausted list hasn't shown adds nothing
        if not left.any() or int((lists.added[upto - 1] * times)[left].sum()) < kth:
            break
    high = scores >= kth
    return docs[high], scores[high], int(seen.sum())


def impacts(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight * (1_000_000_000 * tf // (1000 * tf + 12 * m))


def best(indexed: DataFrame, shipped: C.Shipped, n_terms: int, k: int) -> DataFrame:
    """key, item_id, doc_id, score: each task's k highest documents of each item, with ties."""
    n_docs, total, df = statistics(indexed, n_terms)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    rows_at_once = max(1, CELLS // max(1, n_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.lean()
        items = shipped.get().items
        found = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in items]
        for batch in batches:
            for s in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(s, rows_at_once)
                ids, known = np.array(part.column(0).fill_null(0)), np.array(part.column(0).is_valid())
                m = np.array([75 + 25 * n * n_docs // total for n in part.column(1).to_pylist()], np.int64)
                raw = part.column(2).to_pylist()
                row = np.repeat(np.arange(len(raw)), [len(x) // 4 for x in raw])
                terms, tf = np.frombuffer(b"".join(raw), "<u4").astype(np.int64), np.frombuffer(b"".join(part.column(3).to_pylist()), "<i8")
                lists = Lists(row, terms, impacts(tf, m[row], weights[terms]), len(raw), n_terms)
                for i, (_, _, own, times) in enumerate(items):
                    old = found[i]
                    floor = int(np.partition(old[2], len(old[2]) - k)[len(old[2]) - k]) if len(old[2]) >= k else 0
                    docs, scores, _ = threshold_search(lists, own, times, floor, k)
                    if len(docs):
                        merged = np.append(old[0], ids[docs]), np.append(old[1], known[docs]), np.append(old[2], scores)
                        order = np.lexsort((merged[0], ~merged[1], -merged[2]))[:k]
                        found[i] = tuple(x[order] for x in merged)
        for (key, item, _, _), (ids, known, scores) in zip(items, found, strict=True):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(ids), pa.int64()), pa.array([item] * len(ids), pa.int64()), pa.array(ids, mask=~known), pa.array(scores)], ["key", "item_id", "doc_id", "score"])

    return indexed.mapInArrow(run, "key long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: for each item (item_id, text) its k highest-scoring documents (doc_id, text).

    A term's weight w is floor(1000 ln((2 N + 2) / (2 df + 1))), a document's m is 75 + 25 n N div L, and its score sums
    w * (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included.
    """
    spark = docs.sparkSession
    asked = items.where("text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    parts = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()  # one block
        block = Items([(b << 32 | i, r["item_id"], r["text"]) for i, r in enumerate(rows)])
        if block.items:
            shipped = C.Shipped(spark, block)
            indexed = C.written(index(docs, shipped), "forward-index")
            parts.append(best(indexed, shipped, len(block.number), k))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = W.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = functools.reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
