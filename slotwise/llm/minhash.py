"""MinHash near-dedup by bottom-k sketches of one hash function.

A document's sketch is the KEPT least XXH64 of its different shingles (all of them, if it has fewer). Documents with the
same words are one node. Two sets with a Jaccard similarity of 0.8 share most of the KEPT least values of their union:
in how many of them at least, `required` calculates, for all but one in 10^15 such pairs, and always for sets that are
kept whole. From there:

- Inverted lists of retained values. Values are counted over all nodes; one that a single node has makes no pair. Of the
  others a node is only listed below its rarest: two sketches that share `need` values share one of those that are left
  of each when its `need - 1` most frequent are taken away. So what very many documents have in common makes no lists,
  and documents that are mostly their own words are in none.
- Candidates. Lists of up to SMALL nodes give all their pairs, longer ones the pairs with PIVOTS of their nodes. The
  sketch of a pair's union estimates its similarity; pairs below what a similar pair shows are gone. The others make
  candidate classes. Classes that still meet in a longer list make a group, whose nodes are compared by chunks in tasks
  that estimate their pairs and send a forest of what passes, never the pairs: so no pair is lost to a bound.
- Full sets verify: within each class documents are linked by the similarity of their full sets (all 64 bits of all
  shingles' hashes), by chunks in tasks that send forests (`simhash.similar_edges`).

Links then go through star contraction. Defined results: null text and text without words have an empty set, no links
and themselves as component; rows without doc_id link nothing and have a null component and kept; rows with one doc_id
and other texts are documents of their own; repeated rows are each returned; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C
from slotwise.llm import simhash

U64 = np.uint64
#: Values of a sketch; the longest list that gives all its pairs; nodes that a longer one is compared with at first;
#: nodes of a chunk of a list whose nodes aren't connected by these.
KEPT, SMALL, PIVOTS, CHUNK = 128, 8, 1, 1024
COLUMNS = 4096
#: How seldom a pair at the threshold may show less than is required.
ODDS = 1e-15


#: Bounds that were reckoned; a plain table, since a cached function would not travel to tasks by value.
_bounds: dict[tuple[int, int], int] = {}


def binomial_bound(k: int, percent: int) -> int:
    """The least count that k draws, each a success with the given probability, fall below once in 1 / ODDS at most."""
    if (k, percent) not in _bounds:
        p, below, x = percent / 100, 0.0, -1
        while below <= ODDS and x < k:
            x += 1
            below += math.comb(k, x) * p**x * (1 - p) ** (k - x)
        _bounds[k, percent] = x
    return _bounds[k, percent]


def required(n: np.ndarray, percent: int, kept: int) -> np.ndarray:
    """How many values a sketch of a set of n shares at least with that of any set of such a similarity.

    If the union is kept whole, the shared shingles are, which are `percent` of n at least; else the shares of the least
    `kept` of the union are at most as uneven as draws with replacement.
    """
    whole, drawn = -(-n * percent // 100), binomial_bound(kept, percent)
    return np.where(n > kept, drawn, np.where(100 * n <= percent * kept, whole, np.minimum(whole, drawn)))


def sketches(docs: DataFrame, words: int, kept: int) -> DataFrame:
    """doc_id, text_hash (Spark's xxhash64), key (128 bits of hash of the words), n, sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for part in C.chunks(batches):
            keys, sizes, least = [], [], []
            for text in C.texts(part):
                own = text.lower().split()
                size = min(words, len(own))
                found = {digest(b" ".join(own[i : i + size])) for i in range(len(own) - size + 1)} if own else set()
                h = np.fromiter(found, U64, len(found))
                h = np.sort(np.partition(h, kept - 1)[:kept] if len(h) > kept else h)
                keys.append(xxhash.xxh3_128_digest(b" ".join(own)) if own else None)
                sizes.append(len(found))
                least.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(least, pa.binary())], ["doc_id", "text_hash", "key", "n", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, key binary, n long, sketch binary")


# ---------------------------------------------------------------- inverted lists


def _gathered(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    C.lean()
    got = [C.unpack(blob) for batch in batches for blob in batch.column(1).to_pylist()]
    return [np.concatenate(x) for x in zip(*got, strict=True)] if got else []


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    lead = np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1]) if len(sorted_values) else np.zeros(0, np.int64)
    return lead, np.diff(np.append(lead, len(sorted_values)))


def pairs_of_lists(ids: np.ndarray, lead: np.ndarray, size: np.ndarray, small: int, pivots: int) -> np.ndarray:
    """The different pairs (rows of the less and the greater id) of lists of ids: all of small ones, and of longer ones
    those with the first `pivots`."""
    out = [np.zeros((0, 2), np.int64)]
    for s in range(2, small + 1):
        own = ids[lead[size == s][:, None] + np.arange(s)]
        i, j = np.triu_indices(s, 1)
        out.append(np.stack([own[:, i].ravel(), own[:, j].ravel()], 1))
    for at, s in zip(lead[size > small].tolist(), size[size > small].tolist(), strict=True):
        own = ids[at : at + s]
        out += [np.stack([np.full(s - p - 1, own[p]), own[p + 1 :]], 1) for p in range(min(pivots, s - 1))]
    return np.unique(np.sort(np.concatenate(out), 1), axis=0)


def candidates(nodes: DataFrame, percent: int, kept: int, small: int, pivots: int) -> DataFrame:
    """list, u, v: pairs of nodes (id, n, sketch), list null; and of the longer lists their members u, v null."""
    n = C.n_shards(nodes.sparkSession)

    def by_value(values: np.ndarray) -> np.ndarray:
        return (C.mix(values) % U64(n)).astype(np.int32)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, need, raw = batch.column(0).to_numpy(), required(batch.column(1).to_numpy(), percent, kept).astype(np.uint16), batch.column(2).to_pylist()
            own = np.repeat(np.arange(len(ids)), [len(x) // 8 for x in raw])
            h = np.frombuffer(b"".join(raw), U64)
            yield C.packed_rows([(s, C.pack([h[at], ids[own[at]], need[own[at]]])) for s, at in C.split_by(by_value(h))])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if got := _gathered(batches):
            h, ids, need = got
            order = np.argsort(h)
            _, size = _runs(h[order])
            df = np.repeat(size, size)
            order, df = order[df > 1], df[df > 1]
            h, ids, need = h[order], ids[order], need[order]
            yield C.packed_rows([(s, C.pack([h[at], ids[at], need[at], df[at]])) for s, at in C.split_by(C.home(ids, n).astype(np.int32))])

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if got := _gathered(batches):
            h, ids, need, df = got
            order = np.lexsort((h, df, ids))
            h, ids, need = h[order], ids[order], need[order].astype(np.int64)
            lead, size = _runs(ids)
            # a node's values that no other has come before these; the `need - 1` most frequent make no list
            listed = np.arange(len(h)) - np.repeat(lead, size) < np.repeat(size - need[lead] + 1, size)
            h, ids = h[listed], ids[listed]
            yield C.packed_rows([(s, C.pack([h[at], ids[at]])) for s, at in C.split_by(by_value(h))])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if got := _gathered(batches):
            h, ids = got
            order = np.lexsort((C.mix(ids.view(U64)), h))
            h, ids = h[order], ids[order]
            lead, size = _runs(h)
            pairs = pairs_of_lists(ids, lead, size, small, pivots)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["list", "u", "v"])
            long = np.repeat(size > small, size)
            yield pa.RecordBatch.from_arrays([pa.array(h[long].view(np.int64)), pa.array(ids[long]), pa.nulls(int(long.sum()), pa.int64())], ["list", "u", "v"])

    out = nodes.select("id", "n", "sketch").mapInArrow(values, C.PACKED)
    for step in (counted, rarest):
        out = C.dealt(out, n).mapInArrow(step, C.PACKED)
    return C.dealt(out, n).mapInArrow(lists, "list long, u long, v long")


# ---------------------------------------------------------------- estimates


def estimate(a: np.ndarray, na: int, b: np.ndarray, nb: int, percent: int, kept: int) -> float | None:
    """The share of the union's sketch that both sets have, if sets of such a similarity may show it; else null."""
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    shared, union = both[1:][twice], both[np.append(True, ~twice)]
    if na <= kept and nb <= kept:
        return len(shared) / len(union) if 100 * len(shared) >= percent * len(union) else None
    size = min(kept, len(union))
    count = int(np.searchsorted(shared, union[size - 1], "right"))
    return count / size if count >= binomial_bound(kept, percent) else None


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, U64)


def likely(pairs: DataFrame, nodes: DataFrame, percent: int, kept: int) -> DataFrame:
    """Those pairs u, v whose sketches may be of similar sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = [estimate(_numbers(a), na, _numbers(b), nb, percent, kept) is not None for na, a, nb, b in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(fit, pa.bool_()))

    a, b = (nodes.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "uv")
    return pairs.join(a, "u").join(b, "v").select("u", "v", "nu", "su", "nv", "sv").mapInArrow(run, "u long, v long")


def likely_forest(ids: np.ndarray, n: np.ndarray, classes: np.ndarray, sets: list[np.ndarray], percent: int, kept: int) -> list[tuple[int, int]]:
    """Likely pairs of nodes of different classes, enough to connect all that such pairs connect."""
    need, label, out = required(n, percent, kept), classes.copy(), []
    fit = overlaps(sets) >= np.maximum(need[:, None], need[None, :])
    for i in range(len(ids)):
        for j in np.flatnonzero(fit[i] & (label != label[i])).tolist():
            if label[j] != label[i] and estimate(sets[i], n[i], sets[j], n[j], percent, kept) is not None:
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]
    return out


def likely_between(members: DataFrame, percent: int, kept: int, chunk: int) -> DataFrame:
    """u, v: a forest of the likely pairs of nodes (list, id, n, sketch, class) of a list, or group of lists, and
    different classes. Lists are cut into chunks, and every two meet in a task.
    """
    sizes = members.groupBy("list").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    told = members.join(sizes, "list").withColumn("c", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).withColumn("d", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = told.select("list", F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), "id", "n", "class", "sketch")
    rows = rows.repartition(C.n_shards(members.sparkSession), "list", "a", "b").sortWithinPartitions("list", "a", "b", "id")

    def close(group: list[tuple]) -> pa.RecordBatch:
        ids, n, classes = (np.array([r[i] for r in group], np.int64) for i in range(3))
        found = likely_forest(ids, n, classes, [_numbers(r[3]) for r in group], percent, kept)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(2)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for batch in batches:
            columns = [x.to_pylist() for x in batch.columns]
            for key, row in zip(zip(*columns[:3], strict=True), zip(*columns[3:], strict=True), strict=True):
                if key != now:
                    if len(group) > 1:
                        yield close(group)
                    now, group = key, []
                group.append(row)
        if len(group) > 1:
            yield close(group)

    return rows.mapInArrow(run, "u long, v long").distinct()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many values every two sets share."""
    _, which = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    often = np.bincount(which) > 1
    own = often[which]
    which, row = (np.cumsum(often) - 1)[which[own]], row[own]
    order = np.argsort(which, kind="stable")
    which, row = which[order], row[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(which[-1]) + 1 if len(which) else 0, COLUMNS):
        lo, hi = np.searchsorted(which, [start, start + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[lo:hi], which[lo:hi] - start] = 1
        shared += part @ part.T
    return shared.astype(np.int64)


# ---------------------------------------------------------------- the operator


def placed(rows: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """rows (id, ...) with the component of their node, the node itself if it has no links."""
    return rows.join(roots.select(F.col("v").alias("id"), F.col("root").alias("_root")), "id", "left").withColumn(name, F.coalesce("_root", "id")).drop("_root")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80, kept: int = KEPT, small: int = SMALL, pivots: int = PIVOTS, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row: the size of its set, the least doc_id reachable over links
    between sets with 100 |intersection| >= percent |union|, and whether that is its own.

    percent must be 50 at least, so that sketches of similar sets share most of their values.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    spark = docs.sparkSession
    every = C.written(sketches(docs, words, kept), "sketches")
    groups = every.where("doc_id is not null and n > 0").groupBy("key").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = C.written(groups.select(F.monotonically_increasing_id().alias("id"), "key", F.col("least.doc_id").alias("rep"), F.col("least.text_hash").alias("text_hash"), "copies", "n", "sketch"), "nodes")
    found = C.written(candidates(nodes, percent, kept, small, pivots), "candidates")
    pairs = found.where("list is null").select("u", "v").distinct()
    listed = found.where("list is not null").select("list", F.col("u").alias("id"))
    paired = found.where("list is null").select(F.explode(F.array("u", "v")).alias("id")).distinct()
    some = C.written(nodes.join(paired, "id", "left_semi").select("id", "n", "sketch", "rep", "text_hash"), "paired")
    near = C.written(likely(pairs, some, percent, kept), "likely")
    members = C.written(placed(listed, simhash.components(near), "class"), "listed")
    # lists of the same classes are compared once: classes that meet in a list are a group, and its nodes are the members
    parted = members.groupBy("list").agg(F.min("class").alias("first"), F.max("class").alias("last")).where("first < last").select("list", "first")
    met = C.written(members.join(parted, "list").select("id", "class", "first").distinct(), "met")
    groups = simhash.components(met.select(F.col("class").alias("u"), F.col("first").alias("v")).distinct())
    grouped = met.select("id", "class").distinct().join(groups.select(F.col("v").alias("class"), "root"), "class", "left")
    apart = grouped.select(F.coalesce("root", "class").alias("list"), "id", "class").join(some.select("id", "n", "sketch"), "id")
    near = near.union(C.written(likely_between(apart, percent, kept, chunk), "likely"))
    # the nodes of classes of several with their texts: one row of each, by its doc_id and text
    roots = C.written(simhash.components(near), "classes")
    inside = roots.select(F.col("v").alias("id"), F.col("root").alias("class")).union(roots.select("root", "root").distinct())
    wanted = inside.join(some, "id").select("id", "class", F.col("rep").alias("doc_id"), "text_hash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").join(wanted, ["doc_id", "text_hash"])
    bodies = texts.groupBy("id").agg(F.first("class").alias("class"), F.first("text").alias("text")).select("class", F.col("id").alias("doc_id"), "text")
    roots = simhash.components(simhash.similar_edges(bodies, words, percent / 100))
    # every document of a node gets the least doc_id of its component
    own = placed(nodes.select("id", "key", "rep", "copies"), roots, "root")
    least = own.groupBy("root").agg(F.min("rep").alias("component_id"), F.sum("copies").alias("all"))
    named = C.written(own.join(least.where("all > 1"), "root").select("key", "copies", "component_id"), "named")
    total = nodes.agg(F.sum("copies")).first()[0] or 0
    # a text that more rows have than a partition's share, of which there are fewer than partitions, is looked up by broadcast
    hot = F.broadcast(named.where(F.col("copies") * C.n_shards(spark) > total).select("key", F.col("component_id").alias("_c")))
    rows = every.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key")).join(hot, "key", "left")
    cold = rows.where("_c is null").join(named, "key", "left").select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = cold.union(rows.where("_c is not null").select("doc_id", "n", "_c"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
