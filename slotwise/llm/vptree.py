"""Approximate nearest neighbours by vantage-point trees, one per shard of the vectors.

Nearness is the largest inner product. Vectors get one more component that makes their lengths
equal (the longest one's), and queries get a zero there: then a smaller distance is a larger inner
product, and the triangle inequality holds. A tree node has a vantage point and the median distance
of the others to it, the inside and the outside; leaves have up to LEAF vectors. A search goes to
the side that the query is on first. The other side is left out if its distance bound, times the
factor, is more than the distance of the k-th vector so far: factor 1 restores exact search, ties
included; a larger factor prunes more. Many queries go down a tree together.

The upper levels are a tree as well, which the driver makes of SAMPLE vectors at most (those with
the least hashes) and sends to all: its leaves are the shards, of about SHARD_ROWS vectors; beyond
LEAVES of them a leaf is several shards, dealt by hash. Every vector is dealt to its leaf. A
query's k-th best vector of the sample bounds its distance from the start, and it is sent to those
leaves only that its bound, times the factor, reaches; so what is shuffled and searched depends on
how far the vectors are in clusters. (Where they are not, every leaf is within reach, as for
random directions in many dimensions, and the work is queries times vectors.) Each task keeps its
k best for a query, which are then merged by numpy.

Equal vectors are one point of a tree with the smallest k + 1 of their ids, which loses nothing
among the k nearest, so any number of copies costs no more than one vector a batch. Scores are sums
of the products of the original components in double precision, in order, and decide ties. Bounds
are reckoned with vectors divided by a power of two, so that components of any size that a double
has can be squared.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
as queries or candidates, and so do rows with a null vec_id; vectors of another length than the
query's aren't compared; repeated rows with one vec_id count once per vector; fewer than k
candidates are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C

#: Vectors of different lengths leave narrow margins after the lift, where a larger factor loses recall (0.5 at 1.5 in some
#: clusters), and it saves little on vectors of one length, so the default is exact.
SHARD_ROWS, LEAF, FACTOR = 16_384, 512, 1.0
#: Vectors of the upper levels' sample at most, their leaves at most, queries that go down a tree together.
SAMPLE, LEAVES, QUERY_BLOCK = 8192, 1024, 1024
SCHEMA = "query_id long, rank int, vec_id long, score double"


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, the components added in order."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.add.accumulate(a * b, axis=1)[:, -1] if len(a) else np.zeros(0)


def few(ids: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of at most `most` of the smallest different ids of each distinct vector, their vectors' numbers and which
    among a vector's ids they are."""
    rows = vectors.view([("", vectors.dtype)] * vectors.shape[1]).ravel() if vectors.shape[1] else np.zeros(len(ids))
    _, group = np.unique(rows, return_inverse=True)
    order = np.lexsort((ids, group))
    again = np.concatenate([[False], (np.diff(group[order]) == 0) & (np.diff(ids[order]) == 0)]) if len(ids) else np.zeros(0, bool)
    order = order[~again]
    own = group[order]
    lead = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1]) if len(own) else np.zeros(0, np.int64)
    nth = np.arange(len(own)) - np.repeat(lead, np.diff(np.append(lead, len(own))))
    keep = nth < most
    return order[keep], own[keep], nth[keep]


def lifted(vectors: np.ndarray, radius2: float) -> np.ndarray:
    """With one more component, so that all have the squared length radius2."""
    return np.concatenate([vectors, np.sqrt(np.maximum(0, radius2 - (vectors**2).sum(1)))[:, None]], 1)


def scaled(queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries of length 1; the queries are these times a length times 2 to an exponent."""
    exponent = np.frexp(np.abs(queries).max(1))[1] if len(queries) else np.zeros(0, np.int64)
    queries = np.ldexp(queries, -exponent[:, None])
    length = np.sqrt((queries**2).sum(1))
    return queries / length[:, None], length, exponent


def lost(width: int, length: np.ndarray, exponent: np.ndarray) -> np.ndarray:
    """By how much, with the query of length 1, inner products may differ that are one score, products being too small
    for doubles."""
    with np.errstate(over="ignore", under="ignore"):
        return np.ldexp(2.0 * width / length, -1074 - exponent)


def relative(score: np.ndarray, length: np.ndarray, exponent: np.ndarray, width: int) -> np.ndarray:
    """A bound for inner products with the query of length 1 from one with the query; what exceeds a double is infinite
    as a score, and larger than all others, whatever it is."""
    fraction, own = np.frexp(np.clip(score, -np.finfo(float).max, np.finfo(float).max))
    with np.errstate(over="ignore", under="ignore"):
        return np.where(np.isneginf(score) | np.isnan(score), -np.inf, np.ldexp(fraction / length, own - exponent) - lost(width, length, exponent))


def vantage(points: np.ndarray, rng: np.random.Generator) -> tuple[int, np.ndarray, float]:
    """Of five points the one whose distances to a few others spread the most; all distances to it and their median
    (nan if that doesn't part them)."""
    best, spread, some = 0, -1.0, points[rng.integers(0, len(points), 64)]
    for p in rng.integers(0, len(points), 5).tolist():
        d = np.sqrt(((some - points[p]) ** 2).sum(1))
        if d.std() > spread:
            best, spread = p, float(d.std())
    d = np.sqrt(((points - points[best]) ** 2).sum(1))
    border = float(np.median(d))
    inside = int((d < border).sum())
    return best, d, border if 0 < inside < len(d) else float("nan")


class Tree:
    """A vantage-point tree over distinct vectors, which are numbered by their least ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, leaf: int = LEAF, exponent: int | None = None):
        """exponent: bounds are reckoned with vectors divided by two to this, by default with components up to 1."""
        at, group, nth = few(ids, np.ascontiguousarray(vectors), k + 1)
        first = at[nth == 0]
        rank = np.empty(len(first), np.int64)
        rank[np.argsort(ids[first], kind="stable")] = np.arange(len(first))
        self.copies = np.full((len(first), k + 1), -1, np.int64)
        self.copies[rank[group], nth] = ids[at]
        self.count = np.bincount(rank[group], minlength=len(first))
        self.points = np.empty((len(first), vectors.shape[1]))
        self.points[rank] = vectors[first]
        self.exponent = int(np.frexp(np.abs(self.points).max(initial=0.0))[1]) if exponent is None else exponent
        self.small = np.ldexp(self.points, -self.exponent)
        self.radius2 = float((self.small**2).sum(1).max()) if len(first) else 0.0
        self.k, self.leaf = k, leaf
        self.nodes: list[tuple] = []
        self.root = self._build(lifted(self.small, self.radius2), np.arange(len(first)), np.random.default_rng(len(first)))

    def _build(self, all_points: np.ndarray, at: np.ndarray, rng: np.random.Generator) -> int:
        own = len(self.nodes)
        self.nodes.append((None, 0.0, 0, 0, at))
        if len(at) > self.leaf:
            best, d, border = vantage(all_points[at], rng)
            # where all are as far, the border says nothing and prunes nothing
            inside = np.arange(len(at)) < len(at) // 2 if np.isnan(border) else d < border
            self.nodes[own] = (int(at[best]), border, self._build(all_points, at[inside], rng), self._build(all_points, at[~inside], rng), None)
        return own

    def search(self, queries: np.ndarray, factor: float, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each query the k + 1 nearest points (one may be its own) and their inner products, best first, ties to the
        least id; -1 and -inf where there are fewer or they are below floor, a bound for the query of length 1."""
        k = self.k + 1
        where, near = np.full((len(queries), k), -1, np.int64), np.full((len(queries), k), -np.inf)
        if not len(self.points):
            return where, near
        (unit, length, exponent), reach = scaled(queries), np.sqrt(self.radius2)
        slack = 1e-9 * max(1e-91, reach)  # of vectors whose squares are hardly doubles nothing is pruned

        def least(q: np.ndarray) -> np.ndarray:
            """The inner product with the unit query that a point needs."""
            return np.maximum(relative(near[q, -1], length[q], exponent[q] + self.exponent, self.points.shape[1]), floor[q]) - slack

        def far(q: np.ndarray) -> np.ndarray:
            # a query is scaled to the points' length: d^2 = 2 R^2 - 2 R <unit, x>
            return np.sqrt(np.maximum(0, 2 * self.radius2 - 2 * max(1e-91, reach) * least(q)))

        def take(q: np.ndarray, at: np.ndarray) -> None:
            i, j = np.nonzero(unit[q] @ self.small[at].T >= least(q)[:, None])
            if not len(i):
                return
            i, j = q[i], at[j]
            rows = np.unique(i)
            held, old = np.nonzero(where[rows] >= 0)
            owner = np.concatenate([i, rows[held]])
            score = np.concatenate([dots(queries[i], self.points[j]), near[rows[held], old]])
            point = np.concatenate([j, where[rows[held], old]])
            order = np.lexsort((point, -score, owner))
            owner, score, point = owner[order], score[order], point[order]
            lead = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
            nth = np.arange(len(owner)) - np.repeat(lead, np.diff(np.append(lead, len(owner))))
            keep = nth < k
            near[owner[keep], nth[keep]], where[owner[keep], nth[keep]] = score[keep], point[keep]

        def visit(node: int, q: np.ndarray) -> None:
            if not len(q):
                return
            point, border, inner, outer, at = self.nodes[node]
            if at is not None:
                for start in range(0, len(at), self.leaf):
                    take(q, at[start : start + self.leaf])
                return
            if np.isnan(border):
                visit(inner, q)
                visit(outer, q)
                return
            d = np.sqrt(np.maximum(0, 2 * self.radius2 - 2 * reach * (unit[q] @ self.small[point])))
            inside = d < border
            visit(inner, q[inside])
            visit(outer, q[~inside])
            more = np.abs(d - border) * factor - slack <= far(q)
            visit(outer, q[inside & more])
            visit(inner, q[~inside & more])

        visit(self.root, np.arange(len(queries)))
        return where, near

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, factor: float, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's position, vec_id, score) of each query's k best, the query's own id left out."""
        where, near = self.search(queries, factor, np.full(len(queries), -np.inf) if floor is None else floor)
        q, j = np.nonzero(where >= 0)
        point, score = where[q, j], near[q, j]
        many = self.count[point]
        q, score, point = np.repeat(q, many), np.repeat(score, many), np.repeat(point, many)
        nth = np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
        ids = self.copies[point, nth]
        keep = ids != query_ids[q]
        return best(q[keep], ids[keep], score[keep], self.k)


class Top:
    """The upper levels: a complete tree over a sample, whose nodes part all vectors and bound all queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, radius2: float, leaves: int, exponent: int = 0):
        """radius2: the squared length of the longest of all vectors, divided by two to the exponent."""
        self.ids, self.original, self.vectors, self.radius2, self.exponent = ids, vectors, np.ldexp(vectors, -exponent), radius2, exponent
        self.width, self.depth = vectors.shape[1], max(0, int(leaves - 1).bit_length())
        nodes = (1 << self.depth) - 1
        self.points, self.border = np.zeros((nodes, self.width + 1)), np.full(nodes, np.nan)
        own = np.unique(lifted(self.vectors, radius2), axis=0)
        rng, todo = np.random.default_rng(len(own)), [(0, own)]
        while todo:
            node, some = todo.pop()
            if node >= nodes or not len(some):
                continue
            best, d, border = vantage(some, rng)
            self.points[node], self.border[node] = some[best], border
            todo += [(2 * node + 1, some[d < border]), (2 * node + 2, some[~(d < border)])]

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector; a node without a border has all outside."""
        node, own = np.zeros(len(vectors), np.int64), lifted(np.ldexp(vectors, -self.exponent), self.radius2)
        for _ in range(self.depth):
            d = np.sqrt(np.maximum(0, 2 * self.radius2 - 2 * (own * self.points[node]).sum(1)))
            node = 2 * node + 2 - (d < self.border[node])
        return node - len(self.border)

    def floor(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
        """For each query, of length 1, an inner product that its k-th best vector has at least: that of the sample's."""
        if len(self.ids) <= k:
            return np.full(len(queries), -np.inf)
        unit, length, exponent = scaled(queries)
        found = unit @ self.vectors.T
        found[self.ids[None, :] == query_ids[:, None]] = -np.inf
        return np.partition(found, len(self.ids) - k, axis=1)[:, len(self.ids) - k] - 1e-9 * np.sqrt(self.radius2) - lost(self.width, length, exponent + self.exponent)

    def known(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's id, vec_id, score) of the sample's vectors that are no less than the floor."""
        q, j = np.nonzero((scaled(queries)[0] @ self.vectors.T >= floor[:, None]) & (self.ids[None, :] != query_ids[:, None]))
        return query_ids[q], self.ids[j], dots(queries[q], self.original[j])

    def reached(self, queries: np.ndarray, floor: np.ndarray, factor: float) -> np.ndarray:
        """Queries x leaves: whether the leaf may hold one of the k best."""
        reach, unit = np.sqrt(self.radius2), scaled(queries)[0]
        slack = 1e-9 * reach
        far = np.sqrt(np.maximum(0, 2 * self.radius2 - 2 * reach * (floor - slack)))
        d = np.sqrt(np.maximum(0, 2 * self.radius2 - 2 * reach * (unit @ self.points[:, :-1].T)))
        bound = np.zeros((len(queries), 1))
        for level in range(self.depth):
            now = slice((1 << level) - 1, (2 << level) - 1)
            away = np.where(np.isnan(self.border[now]), 0.0, d[:, now] - self.border[now])
            bound = np.stack([np.maximum(bound, away), np.maximum(bound, -away)], 2).reshape(len(queries), -1)
        return bound * factor - slack <= far[:, None]


def best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, best first, ties to the smaller id; an id once per query, by its best score."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    once = np.lexsort((np.arange(len(q)), ids, q))
    twice = np.concatenate([[False], (np.diff(q[once]) == 0) & (np.diff(ids[once]) == 0)]) if len(q) else np.zeros(0, bool)
    keep = np.ones(len(q), bool)
    keep[once[twice]] = False
    q, ids, score = q[keep], ids[keep], score[keep]
    lead = np.concatenate([[0], np.flatnonzero(np.diff(q)) + 1]) if len(q) else np.zeros(0, np.int64)
    nth = np.arange(len(q)) - np.repeat(lead, np.diff(np.append(lead, len(q))))
    return q[nth < k], ids[nth < k], score[nth < k]


# ---------------------------------------------------------------- shards

TOLD = "shard int, kind int, payload binary"
_ROWS, _QUERIES, _KNOWN = 0, 1, 2


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of a batch of vec_id, embedding, for each length of vectors."""
    ids, size = batch.column(0).to_numpy(), pa.compute.list_value_length(batch.column(1)).to_numpy()
    flat = pa.compute.list_flatten(batch.column(1)).to_numpy()
    ends = np.cumsum(size)
    for width in np.unique(size).tolist():
        at = np.flatnonzero(size == width)
        yield ids[at], flat[(ends[at] - width)[:, None] + np.arange(width)]


def _told(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["shard", "kind", "payload"])


def _blob(ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray) -> bytes:
    return C.pack([ids, np.array([vectors.shape[1]], np.int64), vectors.ravel(), floor])


def _vectors(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, width, flat, floor = C.unpack(blob)
    return ids, flat.reshape(len(ids), int(width[0])), floor


def usable(rows: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col("vec_id").cast("long"), v.alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda x: x != 0))


def top_of(rows: DataFrame, shard_rows: int, sample: int = SAMPLE) -> tuple[Top, int]:
    """The upper levels for usable rows, and how many shards a leaf is."""
    count, largest = rows.agg(F.count("*"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))))).first()
    exponent = max(int(np.frexp(largest or 0.0)[1]), -1000)
    # in two steps, since the divisor may be no double
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(x * 2.0 ** -(exponent // 2) * 2.0 ** -(exponent - exponent // 2), 2))
    longest = rows.agg(F.max(square)).first()[0]
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    by: dict[int, list] = {}
    for r in some:
        by.setdefault(len(r["embedding"]), []).append(r)
    own = by[max(by, key=lambda w: (len(by[w]), w))] if by else []
    ids, first = np.unique(np.array([r["vec_id"] for r in own], np.int64), return_index=True)
    vectors = np.array([own[i]["embedding"] for i in first.tolist()], np.float64).reshape(len(ids), -1) if len(ids) else np.zeros((0, 1))
    shards = max(1, -(-count // shard_rows))
    top = Top(ids, vectors, float(longest or 0.0), min(shards, LEAVES), exponent)
    return top, -(-shards // (1 << top.depth))


def search(rows: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows nearest to each query (both: vec_id, embedding), not itself."""
    spark = rows.sparkSession
    rows, queries = usable(rows), usable(queries)
    top, parts = top_of(rows, shard_rows)
    leaves, n, upper, exponent = 1 << top.depth, C.n_shards(spark), C.Shipped(spark, top), top.exponent

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = upper.get()
        for batch in batches:
            out = []
            for ids, vectors in _arrays(batch):
                at, _, _ = few(ids, vectors, k + 1)
                ids, vectors = ids[at], vectors[at]
                part = (C.mix(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
                leaf = top.leaf(vectors) if vectors.shape[1] == top.width else np.zeros(len(ids), np.int64)
                out += [(s, _ROWS, _blob(ids[own], vectors[own], np.zeros(0))) for s, own in C.split_by((leaf * parts + part).astype(np.int32))]
            yield _told(out)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = upper.get()
        for batch in batches:
            for ids, vectors in _arrays(batch):
                for start in range(0, len(ids), query_block):
                    own, asked = ids[start : start + query_block], vectors[start : start + query_block]
                    if vectors.shape[1] == top.width:
                        floor = top.floor(own, asked, k)
                        reached = top.reached(asked, floor, factor)
                    else:  # vectors of other lengths are all in the first leaf
                        floor, reached = np.full(len(own), -np.inf), np.arange(leaves)[None, :] == np.zeros((len(own), 1))
                    blobs = [(leaf, _blob(own[at], asked[at], floor[at])) for leaf in range(leaves) if len(at := np.flatnonzero(reached[:, leaf]))]
                    yield _told([(leaf * parts + p, _QUERIES, blob) for leaf, blob in blobs for p in range(parts)])
                    if factor > 1 and np.isfinite(floor).any():  # k vectors at least, whatever is left out
                        yield _told([(0, _KNOWN, C.pack(list(top.known(own, asked, floor))))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, trees, asked = None, {}, {}, {}

        def answer(width: int) -> Iterator[pa.RecordBatch]:
            ids, vectors, floor = (np.concatenate(x) for x in zip(*asked.pop(width), strict=True))
            if width not in trees:
                if width not in held:
                    return
                trees[width] = Tree(*(np.concatenate(x) for x in zip(*held.pop(width), strict=True)), k, exponent=exponent)
            _, lead = np.unique(np.concatenate([ids[:, None], vectors.view(np.int64)], 1), axis=0, return_index=True)
            ids, vectors, floor = ids[lead], vectors[lead], floor[lead]
            q, near, score = trees[width].nearest(ids, vectors, factor, floor)
            yield C.packed_rows([(s, C.pack([ids[q[at]], near[at], score[at]])) for s, at in C.split_by(C.home(ids[q], n).astype(np.int32))])

        for batch in batches:
            for s, kind, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if s != shard:
                    for width in list(asked):
                        yield from answer(width)
                    shard, held, trees = s, {}, {}
                if kind == _KNOWN:
                    q, near, score = C.unpack(blob)
                    yield C.packed_rows([(s, C.pack([q[at], near[at], score[at]])) for s, at in C.split_by(C.home(q, n).astype(np.int32))])
                    continue
                ids, vectors, floor = _vectors(blob)
                width = vectors.shape[1]
                if kind == _ROWS:
                    held.setdefault(width, []).append((ids, vectors))
                    continue
                asked.setdefault(width, []).append((ids, vectors, floor))
                if sum(len(x[0]) for x in asked[width]) >= query_block:
                    yield from answer(width)
        for width in list(asked):
            yield from answer(width)

    told = rows.mapInArrow(deal, TOLD).union(queries.mapInArrow(ask, TOLD))
    found = told.repartitionById(leaves * parts, F.col("shard")).sortWithinPartitions("shard", "kind").mapInArrow(find, C.PACKED)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, more = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), []
        size = 0

        def settled() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return best(*(np.concatenate(x) for x in zip(held, *more, strict=True)), k)

        for batch in batches:
            for blob in batch.column(1).to_pylist():
                more.append(C.unpack(blob))
                size += len(more[-1][0])
                if size > max(1 << 20, len(held[0])):
                    held, more, size = settled(), [], 0
        q, ids, score = settled()
        if len(q):
            lead = np.concatenate([[0], np.flatnonzero(np.diff(q)) + 1])
            rank = np.arange(len(q)) - np.repeat(lead, np.diff(np.append(lead, len(q)))) + 1
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(rank.astype(np.int32)), pa.array(ids), pa.array(score)], ["query_id", "rank", "vec_id", "score"])

    return C.dealt(found, n).mapInArrow(merge, SCHEMA)
