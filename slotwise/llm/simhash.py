"""SimHash near-dedup: a binary-trie self-join over the fingerprints, then connected components.

Every document gets the majority bits of the XXH64 of its word shingles. Equal fingerprints are
one node (grouped with map-side combining, so a huge group of copies is one row per task). To
find all pairs of nodes within the error budget b, the 64 bits are cut into b + 1 blocks: two
fingerprints within b bits agree on a block at least. For each block the nodes are dealt by the
block's value, and in each such group a binary trie over the rotated fingerprint is joined with
itself: pairs of trie nodes are traversed together, level by level, differing bits add up, and a
pair is pruned as soon as the budget is exceeded. A group never emits its pairs: a union-find
turns them into a forest, one edge per node at most. The forest edges go through alternating
star contraction, each round cut by a table in the shared folder.

Defined results: null text has no words and fingerprint zero, linked like any other; rows with
null doc_id get a fingerprint and a null component and link nothing; repeated rows are each
returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm import common as C

U64 = np.uint64
FINGERPRINTS = "doc_id long, fp long, text_hash long"
#: Pairs of trie nodes that the traversal holds at once; sizes of pairs of nodes that are compared outright, many at
#: once up to LEAF keys times keys, one by one up to DENSE keys each; comparisons at once.
WIDTH, LEAF, DENSE, AT_ONCE = 100_000, 512, 1024, 1 << 20


def fingerprint_chunk(raw: list[bytes], k: int, seed: int, once: bool = False) -> np.ndarray:
    """The fingerprints of some texts, as unsigned 64-bit numbers; once: of their different shingles."""
    hashes, sizes, digest = [], [], xxhash.xxh64_intdigest
    for text in raw:
        words = text.lower().split()
        if not words:
            sizes.append(0)
        elif len(words) <= k:
            hashes.append(digest(b" ".join(words), seed))
            sizes.append(1)
        else:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = [0, *ends[: len(words) - k].tolist()]
            own = [digest(joined[s:e], seed) for s, e in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)]
            hashes.extend(own := list(set(own)) if once else own)
            sizes.append(len(own))
    out = np.zeros(len(raw), U64)
    if not hashes:
        return out
    sizes = np.array(sizes, np.int64)
    h, some = np.array(hashes, U64), np.flatnonzero(sizes)
    at = np.concatenate([[0], np.cumsum(sizes[some])])
    powers = U64(1) << np.arange(64, dtype=U64)
    for i, row in enumerate(some.tolist()):
        count = np.zeros(64, np.int64)
        for s in range(at[i], at[i + 1], 16384):  # a very long text in pieces
            part = h[s : min(s + 16384, at[i + 1])]
            count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint16)
        out[row] = powers[2 * count > sizes[row]].sum(dtype=U64)
    return out


def fingerprints(docs: DataFrame, k: int = 4, seed: int = 42, once: bool = False, words: int = 0) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long), text_hash (Spark's xxhash64 of the text) of every row; if
    words is given, bands of the shingles of so many words too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.chunks(batches):
            raw = C.texts(part)
            fp, own = fingerprint_chunk(raw, k, seed, once), np.array([xxhash.xxh64_intdigest(x, 42) for x in raw], U64)
            columns = {"doc_id": part.column(0), "fp": pa.array(fp.view(np.int64)), "text_hash": pa.array(own.view(np.int64))}
            if words:
                columns["bands"] = pa.array([x.tobytes() for x in bands([shingle_set(x, words) for x in raw])], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FINGERPRINTS + ", bands binary" * bool(words))


# ---------------------------------------------------------------- trie self-join


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where, in the sorted keys, the children with bit 1 at this depth begin in each of the ranges."""
    bit = U64(1) << U64(63 - depth)
    prefix = (keys[lo] >> U64(64 - depth) << U64(64 - depth)) if depth else np.zeros(len(lo), U64)
    return np.clip(np.searchsorted(keys, prefix | bit), lo, hi)


def _compared(keys: np.ndarray, alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The near pairs of many pairs of small ranges, some millions of comparisons at a time."""
    na, nb = ahi - alo, bhi - blo
    total = na * nb
    for part in np.split(np.arange(len(na)), np.flatnonzero(np.diff(np.cumsum(total) // AT_ONCE)) + 1) if len(na) else ():
        own = total[part]
        at = np.repeat(part, own)
        r = np.arange(len(at)) - np.repeat(np.cumsum(own) - own, own)
        i, j = alo[at] + r // nb[at], blo[at] + r % nb[at]
        near = (i < j) & (popcount(keys[i] ^ keys[j]) <= budget)
        if near.any():
            yield i[near], j[near]


def trie_pairs(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of all pairs of the sorted distinct keys, within each range [lo, hi) that shares its first
    depth bits, that differ in at most budget bits. Each range is a trie node; it is joined with itself."""
    todo = [(lo, hi, lo, hi, np.zeros(len(lo), np.int64), depth)]
    while todo:
        alo, ahi, blo, bhi, diff, d = todo.pop()
        if len(alo) > WIDTH:
            for s in range(0, len(alo), WIDTH):
                todo.append((*(x[s : s + WIDTH] for x in (alo, ahi, blo, bhi, diff)), d))
            continue
        product = (ahi - alo) * (bhi - blo)
        small = (product <= LEAF) | (d >= 64)
        yield from _compared(keys, alo[small], ahi[small], blo[small], bhi[small], budget)
        dense = ~small & (np.maximum(ahi - alo, bhi - blo) <= DENSE)
        for x, y, z, w in zip(*(v[dense].tolist() for v in (alo, ahi, blo, bhi)), strict=True):
            near = popcount(keys[x:y, None] ^ keys[None, z:w]) <= budget
            i, j = np.nonzero(np.triu(near, 1) if x == z else near)
            if len(i):
                yield i + x, j + z
        small |= dense
        big = ~small
        if not big.any():
            continue
        alo, ahi, blo, bhi, diff = (x[big] for x in (alo, ahi, blo, bhi, diff))
        same = alo == blo
        am, bm = _split(keys, alo, ahi, d), _split(keys, blo, bhi, d)
        new = [
            (alo, am, blo, bm, diff),
            (am, ahi, bm, bhi, diff),
            (alo, am, bm, bhi, diff + 1),
            *([tuple(x[~same] for x in (am, ahi, blo, bm, diff + 1))] if (~same).any() else []),
        ]
        joined = [np.concatenate([x[f] for x in new]) for f in range(5)]
        live = (joined[0] < joined[1]) & (joined[2] < joined[3]) & (joined[4] <= budget)
        todo.append((*(x[live] for x in joined), d + 1))


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least position in each one's component: labels go down along the pairs, chunk by chunk."""
    parent = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = parent[i], parent[j]
            off = a != b
            if not off.any():
                break
            i, j, a, b = i[off], j[off], a[off], b[off]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while True:  # pointer jumping
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
    return parent


def _rotate(fp: np.ndarray, by: int) -> np.ndarray:
    return fp if not by else (fp << U64(by)) | (fp >> U64(64 - by))


def block_cuts(budget: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the budget + 1 blocks."""
    n = budget + 1
    at = [64 * i // n for i in range(n + 1)]
    return [(at[i], at[i + 1] - at[i]) for i in range(n)]


def near_edges(nodes: DataFrame, budget: int) -> DataFrame:
    """u, v: a spanning forest, within each block group, of the nodes (fp) at most budget bits apart."""
    n, cuts = C.n_shards(nodes.sparkSession), block_cuts(budget)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(U64)
            rows = []
            for b, (first, bits) in enumerate(cuts):
                value = _rotate(fp, first) >> U64(64 - bits)
                shard = (C.mix(value * U64(len(cuts)) + U64(b)) % U64(n)).astype(np.int32)
                rows += [(s, C.pack([np.array([b], np.uint8), fp[at]])) for s, at in C.split_by(shard)]
            yield C.packed_rows(rows)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.lean()
        got: dict[int, list] = {}
        for batch in batches:
            for blob in batch.column(1).to_pylist():
                b, fp = C.unpack(blob)
                got.setdefault(int(b[0]), []).append(fp)
        for b, parts in got.items():
            first, bits = cuts[b]
            fp = np.concatenate(parts)
            keys = _rotate(fp, first)
            order = np.argsort(keys)
            keys, fp = keys[order], fp[order].view(np.int64)
            value = keys >> U64(64 - bits)
            lo = np.concatenate([[0], np.flatnonzero(np.diff(value)) + 1])
            hi = np.append(lo[1:], len(keys))
            some = hi - lo > 1
            parent = forest(len(keys), trie_pairs(keys, lo[some], hi[some], bits, budget))
            linked = np.flatnonzero(parent != np.arange(len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[parent[linked]])], ["u", "v"])

    return C.dealt(nodes.select("fp").mapInArrow(deal, C.PACKED), n).mapInArrow(join, "u long, v long")


# ---------------------------------------------------------------- bands of minima

#: BANDS groups of MINIMA minima of a text's shingles: two texts of similarity s have all minima of no group in common
#: with probability (1 - s ** MINIMA) ** BANDS, which at 0.8 is 1 in 38,000.
BANDS, MINIMA = 20, 4


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Texts x BANDS: the hash of each group of minima of some sets of hashes; all sets of one hash differ in theirs."""
    out = np.zeros((len(sets), BANDS), U64)
    some = np.flatnonzero([len(x) for x in sets])
    if not len(some):
        return out
    h = np.concatenate(sets)
    starts = np.cumsum([0, *(len(sets[i]) for i in some[:-1])])
    for i in range(BANDS * MINIMA):
        # a permutation of the hashes, which are spread already
        least = np.minimum.reduceat(h * (C.mix(np.array([2 * i + 1], U64))[0] | U64(1)), starts)
        out[some, i // MINIMA] = C.mix(out[some, i // MINIMA] ^ least)
    return out


def band_edges(rows: DataFrame) -> DataFrame:
    """u, v: a spanning forest, for each shard of bands, of the fingerprints (fp) of rows that have one of their bands in common."""
    n = C.n_shards(rows.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.frombuffer(b"".join(batch.column(1).to_pylist()), U64).reshape(-1, BANDS)
            key = C.mix(own * U64(BANDS) + np.arange(BANDS, dtype=U64)).ravel()
            both = np.unique(np.stack([key, np.repeat(batch.column(0).to_numpy().view(U64), BANDS)], 1), axis=0)
            yield C.packed_rows([(s, C.pack([both[at, 0], both[at, 1]])) for s, at in C.split_by((both[:, 0] % U64(n)).astype(np.int32))])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.lean()
        got = [C.unpack(blob) for batch in batches for blob in batch.column(1).to_pylist()]
        if got:
            key, fp = (np.concatenate([x[f] for x in got]) for f in (0, 1))
            order = np.argsort(key)
            key, (nodes, at) = key[order], np.unique(fp[order], return_inverse=True)
            lead = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            parent = forest(len(nodes), iter([(np.repeat(at[lead], np.diff(np.append(lead, len(key)))), at)]))
            linked, ids = np.flatnonzero(parent != np.arange(len(nodes))), nodes.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[parent[linked]])], ["u", "v"])

    return C.dealt(rows.select("fp", "bands").mapInArrow(deal, C.PACKED), n).mapInArrow(join, "u long, v long")


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """v, root: for every vertex of the edges (u, v) that isn't the least of its component, that least vertex.

    Alternating large-star and small-star contraction; group minima are combined before the
    shuffle and joined back, so a vertex with very many neighbours is never one task's group.
    """
    spark = edges.sparkSession
    path = C.fresh_dir(spark, "edges")
    now = C.written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", path)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).distinct()
        new = C.fresh_dir(spark, "components")
        small.write.parquet(new)
        now = spark.read.schema("u long, v long").parquet(new)
        C.drop_dir(spark, path)
        path = new
        # done when all are stars: nobody has two roots, and no root has a root
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(now.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below > 1 or below > 0 and above > 0").isEmpty():
            return now.select(F.col("u").alias("v"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, k: int = 4, budget: int = 4, seed: int = 42, once: bool = False, words: int = 0) -> DataFrame:
    """doc_id, fp, text_hash, component_id, several of every row: the least doc_id reachable over links of at most budget
    differing bits and, if words is given, over a band of the minima of shingles of so many words; several: whether the
    component has more than one row."""
    spark = docs.sparkSession
    fps = C.written(fingerprints(docs, k, seed, once, words), "fingerprints")
    own = {x: C.fresh_dir(spark, x) for x in ("nodes", "members")}
    nodes = C.written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "nodes", own["nodes"])
    known = nodes.where("rep is not null")
    edges = near_edges(known, budget)
    if words:
        edges = edges.union(band_edges(fps.where("doc_id is not null")))
    roots = components(edges)
    members = C.written(roots.union(roots.select(F.col("root").alias("v"), "root").distinct()), "members", own["members"])
    least = members.join(known, members.v == known.fp).groupBy("root").agg(F.min("rep").alias("component_id"))
    linked = members.join(least, "root").select(F.col("v").alias("fp"), "component_id")
    named = C.written(nodes.join(linked, "fp", "left").select("fp", "n", F.coalesce("component_id", "rep").alias("component_id"), (F.col("component_id").isNotNull() | (F.col("n") > 1)).alias("several")), "named")
    # a fingerprint of more than a shard's share of the rows, of which there are fewer than shards, is looked up by broadcast
    total = nodes.agg(F.sum("n")).first()[0] or 0
    for path in own.values():
        C.drop_dir(spark, path)
    hot = F.broadcast(named.where(F.col("n") * C.n_shards(spark) > total).select("fp", F.col("component_id").alias("_c"), F.col("several").alias("_s")))
    rows = fps.join(hot, "fp", "left").select("doc_id", "fp", "text_hash", "_c", "_s")
    known = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    names = ["doc_id", "fp", "text_hash", known, "several"]
    rest = rows.where("_s is null").join(named, "fp", "left").select(*names)
    return rest.union(rows.where("_s is not null").withColumnsRenamed({"_c": "component_id", "_s": "several"}).select(*names))


# ---------------------------------------------------------------- keeping one of each class

#: Documents of a class that a task compares with as many others.
CLASS_CHUNK = 512
#: Documents of a class that all its chunks are compared with.
PIVOTS = 16
COLUMNS = 4096


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The hashes of a text's different shingles; all its words, if it has fewer."""
    own = text.lower().split()
    size = min(words, len(own))
    return np.array(sorted({xxhash.xxh64_intdigest(b" ".join(own[i : i + size])) for i in range(len(own) - size + 1)}) if own else [], U64)


def similar_pairs(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i < j) of the sets with a Jaccard similarity of at least `least`; two empty ones are equal."""
    size = np.array([len(x) for x in sets], np.int64)
    _, which = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = np.zeros((len(sets), len(sets)), np.float32)
    often = np.bincount(which) > 1  # the others are in one set only
    keep = often[which]
    which, row = (np.cumsum(often) - 1)[which[keep]], row[keep]
    order = np.argsort(which, kind="stable")
    which, row = which[order], row[order]
    for start in range(0, int(which[-1]) + 1 if len(which) else 0, COLUMNS):
        lo, hi = np.searchsorted(which, [start, start + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[lo:hi], which[lo:hi] - start] = 1
        shared += part @ part.T
    either = size[:, None] + size[None, :] - shared
    return np.nonzero(np.triu(shared >= least * either - 1e-4, 1))


def _told_chunks(members: DataFrame) -> DataFrame:
    """members (class, doc_id, text) with the number of their class's chunks and their own."""
    sizes = members.groupBy("class").agg(F.ceil(F.count("*") / CLASS_CHUNK).cast("int").alias("chunks"))
    return members.join(sizes, "class").withColumn("c", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))


def similar_edges(members: DataFrame, words: int, least: float) -> DataFrame:
    """u, v: links between similar documents of a class (class, doc_id, text), enough to connect all that are connected.

    Each chunk of a class is compared with itself and with the class's PIVOTS documents of the least hashes. Classes
    that are one component then, as many copies of one text are, are done; of the others every two chunks meet in a
    task, but no task gets more than two chunks, and none emits its pairs.
    """
    rows = C.written(_told_chunks(members), "class-chunks")
    large = rows.where("chunks > 1")
    order = F.row_number().over(W.partitionBy("class").orderBy(F.xxhash64("doc_id"), "doc_id"))
    pivots = large.withColumn("nth", order).where(F.col("nth") <= PIVOTS).select("class", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("d"), "c", "doc_id", "text")
    own = rows.select("class", F.col("c").alias("a"), F.col("c").alias("b"), "doc_id", "text")
    near = C.written(_compared_edges(own.union(pivots.where("c <> d").select("class", "d", "d", "doc_id", "text")), words, least), "edges")
    roots = C.written(components(near), "roots")
    # documents of large classes and the components that they are in so far
    placed = large.select("class", "doc_id").join(roots.select(F.col("v").alias("doc_id"), "root"), "doc_id", "left").select("class", F.coalesce("root", "doc_id").alias("root"))
    parted = placed.groupBy("class").agg((F.min("root") < F.max("root")).alias("parted")).where("parted").select("class")
    more = large.join(parted, "class", "left_semi").withColumn("d", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("c <> d")
    pairs = more.select("class", F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), "doc_id", "text")
    return near.union(_compared_edges(pairs, words, least))


def _compared_edges(rows: DataFrame, words: int, least: float) -> DataFrame:
    """u, v: a forest of the similar documents of each group (class, a, b) of doc_id, text."""
    rows = rows.repartition(C.n_shards(rows.sparkSession), "class", "a", "b").sortWithinPartitions("class", "a", "b", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if len(ids) > 1:
                parent = forest(len(ids), iter([similar_pairs(sets, least)]))
                linked = np.flatnonzero(parent != np.arange(len(ids)))
                own = np.array(ids, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own[linked]), pa.array(own[parent[linked]])], ["u", "v"])

        for part in C.chunks(batches):
            for key, doc, text in zip(zip(*(part.column(i).to_pylist() for i in range(3)), strict=True), part.column(3).to_pylist(), C.texts(part), strict=True):
                if key != now:
                    yield from close()
                    now, ids, sets = key, [], []
                ids.append(doc)
                sets.append(shingle_set(text, words))
        yield from close()

    return rows.mapInArrow(run, "u long, v long")


def deduplicated(docs: DataFrame, words: int = 5, least: float = 0.8, k: int = 2, budget: int = 8, seed: int = 42, banded: bool = False) -> DataFrame:
    """The rows of docs, all columns, with one document of each class, that of the least doc_id.

    Candidates are the classes over links of at most `budget` bits between SimHash fingerprints of different shingles of
    k words and, if banded, over bands of minima of the shingles of `words` words, so that a pair at 0.8 is missed by
    the bands once in 38,000 times (without them one in ten near 0.8 is lost); within a candidate class documents are
    linked if their shingles of `words` words have a Jaccard similarity of at least `least`, exactly.
    Rows with equal doc_id and text are one document, of which one row stays; rows with equal doc_id and other texts
    are different ones; null text is empty; rows without doc_id all stay.
    """
    names = docs.columns
    key = [F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text")]
    found = near_duplicates(docs, k, budget, seed, once=True, words=words if banded else 0).where("doc_id is not null and several")
    members = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text"), F.col("component_id").alias("_class")).distinct()
    # one plan at every size: the members grow with the documents, so they are never broadcast
    tagged = C.written(docs.select(F.struct(*names).alias("_row"), *key).join(members.hint("merge"), ["_id", "_text"], "left"), "tagged")
    some = tagged.where("_class IS NOT NULL")
    # a text is a vertex of its own, as one doc_id may have several
    alike = some.groupBy("_class", F.coalesce("_row.text", F.lit("")).alias("text")).agg(F.min("_id").alias("_id"))
    firsts = C.written(alike.select(F.monotonically_increasing_id().alias("doc_id"), F.col("_class").alias("class"), "_id", "text"), "firsts")
    roots = components(similar_edges(firsts.select("class", "doc_id", "text"), words, least))
    named = firsts.join(roots.withColumnRenamed("v", "doc_id"), "doc_id", "left").groupBy(F.coalesce("root", "doc_id").alias("root"))
    stay = named.agg(F.min_by(F.struct("_id", F.xxhash64("text").alias("_text")), F.struct("_id", "text")).alias("first")).select("first.*")
    rows = some.join(stay, ["_id", "_text"], "left_semi").groupBy("_id", "_text").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return tagged.where("_class IS NULL").select("_row.*").unionByName(rows.select("_row.*"))
