"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over bytes of UTF-8, ORDER of them at a time, so its alphabet is closed and an n-gram
is an exact integer. Counting and scoring are sharded count joins by packed shuffle:

1. Documents are dealt to blocks of about BLOCK_BYTES by a hash. A block counts the n-grams of
   its trusted documents and lists the distinct n-grams of all its documents, each sent to the
   shard of the n-gram's two bytes before the last, sorted and compressed.
   Blocks of even and odd number have a model each, of the other blocks' trusted documents, so no
   document is scored by a model that has seen it, and trusted documents are like any others.
2. A shard adds up the counts, FAN blobs at a time by partitions of its own and then those, so
   no task gets every block's. All n-grams of orders 3 to ORDER that end in the same context of
   two bytes are in one shard, so continuation counts are exact there; those of orders 1 and 2
   are at most 65,536 numbers, added up over the shards, as are the counts of counts.
3. A shard's counts go to replicas, among which the blocks are spread, so a very common context is
   not one task's. A replica answers each block's list with log-probabilities, and the block adds
   them up for each document: its perplexity per byte.

Toxic wording is a few words among many, which an average over the document doesn't show. The text
labelled toxic has two models of its own, made by the same joins, and the answers tell as well how
many times likelier they find each n-gram, as a logarithm. These add up over each word (between
blanks, cut every WORD_BYTES), and a document's toxicity is the sum of its WORDS highest words'.

What is gathered grows with the corpus; nothing is sampled. Thresholds are quantiles of the
trusted documents' perplexities and toxicities in each language; a document is rejected above the
upper perplexity (text unlike the trusted), below the lower one (the same few words again and
again) or above the toxicity. Few documents tell little of their
language's quantiles, so those of n documents count n / (n + FEW); the rest is the widest of them, of
all trusted documents' and of these moved to the language's median. Languages without trusted documents use the quantiles of all trusted
documents; without any trusted document nothing is rejected, and without any toxic one toxicity is 0.

Defined results: null or empty text has no bytes, null perplexity, and is rejected; null lang is
a language of its own; null doc_ids are never trusted; repeated rows are each returned; labels
for one document that disagree don't make it trusted, one that says toxic makes it toxic; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C

U64 = np.uint64
ORDER, BLOCK_BYTES, PACK_BYTES = 5, 2 << 20, 32 << 20
LOW, HIGH, FEW = 0.005, 0.995, 20
WORDS, WORD_BYTES = 3, 64
#: Log-probabilities travel as multiples of 1 / STEP bits; none is below -100 bits.
STEP = 256
#: Logarithms of how many times likelier travel as multiples of 1 / TIMES bits, within 127 of them.
TIMES = 4
#: Shards of the model at most, and partial sums that a task of the last step merges.
SHARDS, FAN = 64, 32
#: Kinds of rows: counts for model 0 and 1 and toxic model 2 and 3, a block's list of n-grams, the stats.
_COUNTS, _LIST, _STATS = (0, 1, 2, 3), 4, -1


def ngrams(raw: list[bytes], order: int = ORDER) -> np.ndarray:
    """The n-grams that end at each byte of the texts, one after the other; each text begins after zeros."""
    pad = b"\0" * (order - 1)
    flat = np.frombuffer(b"".join([pad + x for x in raw]), np.uint8).astype(U64)
    n = len(flat) - order + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = flat[:n].copy()
    for j in range(1, order):
        out <<= U64(8)
        out |= flat[j : j + n]
    size = np.array([len(x) for x in raw], np.int64)
    starts = np.cumsum(size + order - 1) - size - order + 1
    own = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return out[own]


def distinct(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g = np.sort(g)
    lead = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1]) if len(g) else np.zeros(0, np.int64)
    return g[lead], np.diff(np.append(lead, len(g)))


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    lead = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    return keys[lead], np.add.reduceat(counts, lead)


def shard_of(g: np.ndarray, n: int) -> np.ndarray:
    return (C.mix((g >> U64(8)) & U64(0xFFFF)) % U64(n)).astype(np.int32)


def low(order: int) -> np.uint64:
    return U64((1 << 8 * order) - 1)


def levels(keys: np.ndarray, counts: np.ndarray, order: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts of the highest order and continuation counts of the lower ones down to 2, of the n-grams given."""
    out = {order: (keys, counts)}
    for k in range(order - 1, 1, -1):
        out[k] = add_up(out[k + 1][0] & low(k), np.ones(len(out[k + 1][0]), np.int64))
    return out


def discounts(n: np.ndarray) -> np.ndarray:
    """0, D1, D2, D3+ of an order from how many n-grams have the counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not n1 or not n2 or not n3:
        return np.array([0, 0.5, 0.75, 0.9])  # too little text to estimate them
    y = n1 / (n1 + 2 * n2)
    d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.9, 2.85])


class Level:
    """One order's n-grams with their discounted counts, and its contexts with totals and left-over mass."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, d: np.ndarray):
        self.keys, taken = keys, d[np.minimum(counts, 3)]
        self.kept = counts - taken
        context = keys >> U64(8)
        lead = np.concatenate([[0], np.flatnonzero(np.diff(context)) + 1]) if len(keys) else np.zeros(0, np.int64)
        self.contexts = context[lead]
        self.total = np.add.reduceat(counts.astype(np.float64), lead) if len(keys) else np.zeros(0)
        self.left = np.add.reduceat(taken, lead) if len(keys) else np.zeros(0)

    def interpolate(self, keys: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities of n-grams, given those of their ends one shorter."""
        if not len(self.keys):
            return lower
        at = np.minimum(np.searchsorted(self.contexts, keys >> U64(8)), len(self.contexts) - 1)
        known = self.contexts[at] == keys >> U64(8)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        kept = np.where(self.keys[i] == keys, self.kept[i], 0)
        return np.where(known, (kept + self.left[at] * lower) / self.total[at], lower)


def base(pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Dense probabilities of order 2 (65,536 of them) from its continuation counts; and order 2's and 1's discounts."""
    two = np.zeros(65536, np.int64)
    for key, count in pairs.items():
        two[key] = count
    seen = np.flatnonzero(two).astype(U64)
    one = np.bincount((seen & U64(255)).astype(np.int64), minlength=256)
    flat = np.full(256, 1 / 256)
    used = np.flatnonzero(one)
    d1, d2 = (discounts(np.array([(x == r).sum() for r in (1, 2, 3, 4)])) for x in (one, two))
    first = flat
    if len(used):
        taken = d1[np.minimum(one, 3)]
        first = (one - taken + taken.sum() * flat) / one.sum()
    return Level(seen, two[seen.astype(np.int64)], d2).interpolate(np.arange(65536, dtype=U64), np.tile(first, 256)), first


def score(keys: np.ndarray, tables: dict[int, Level], pairs: np.ndarray, order: int) -> np.ndarray:
    """log2 of the n-grams' probabilities."""
    p = pairs[(keys & U64(0xFFFF)).astype(np.int64)]
    for k in range(3, order + 1):
        p = tables[k].interpolate(keys & low(k), p)
    return np.log2(p).astype(np.float32)


# ---------------------------------------------------------------- the joins

_TOLD = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
TOLD = "shard int, kind int, block long, payload binary"


def _told(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], _TOLD.field(i).type) for i in range(4)]


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _documents(blobs: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in blobs]).combine_chunks()


def _block_texts(docs: pa.Table) -> list[bytes]:
    return [x or b"" for x in docs.column("text").cast(pa.binary()).to_pylist()]


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first column is the block -> a packed row for each block, of up to PACK_BYTES of text at a time."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        out = []
        for block, at in C.split_by(rows.column(0).to_numpy()):
            own = rows.drop_columns([rows.column_names[0]]).take(pa.array(at)).combine_chunks().to_batches()
            out += [(block, _packed(x)) for x in own]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["block", "payload"])

    held, size = [], 0
    for part in C.chunks(batches):
        held.append(part)
        size += part.nbytes
        if size >= PACK_BYTES:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def _lists(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    return C.split_by(shard_of(keys, n)) if len(keys) else iter(())


def _count(n: int):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        rows, block = [], key[0].as_py()
        toxic = dict(zip(right.column("doc_id").to_pylist(), right.column("toxic").to_pylist(), strict=True))
        if left.num_rows and toxic:
            docs = _documents(left.column("payload").to_pylist())
            texts, ids = _block_texts(docs), docs.column("doc_id").to_pylist()
            for bad in (False, True):
                keys, counts = distinct(ngrams([x for x, doc in zip(texts, ids, strict=True) if doc is not None and toxic.get(doc) is bad]))
                rows += [(s, _COUNTS[2 * bad + 1 - block % 2], block, C.pack([np.diff(keys[at], prepend=U64(0)), counts[at]])) for s, at in _lists(keys, n)]
        return pa.Table.from_arrays(_told(rows), schema=_TOLD)

    return run


def _list(n: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        C.lean()
        keys, _ = distinct(ngrams(_block_texts(_documents(rows.column("payload").to_pylist()))))
        return pa.Table.from_arrays(_told([(s, _LIST, key[0].as_py(), C.pack([np.diff(keys[at], prepend=U64(0))])) for s, at in _lists(keys, n)]), schema=_TOLD)

    return run


def _summed(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [C.unpack(x) for x in blobs]
    if not parts:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return add_up(np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts]), np.concatenate([p[1] for p in parts]))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts rows -> one for each shard and model of the partition, its block any of theirs."""
    held: dict[tuple[int, int], list] = {}
    for batch in batches:
        for shard, kind, block, blob in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            own = held.setdefault((shard, kind), [block, None, []])
            own[0] = min(own[0], block)
            own[2].append(blob)
            if len(own[2]) >= FAN:
                own[1], own[2] = _sum_of(own[1], own[2]), []
    rows = []
    for (shard, kind), (block, done, blobs) in held.items():
        keys, counts = _sum_of(done, blobs)
        rows.append((shard, kind, block, C.pack([np.diff(keys, prepend=U64(0)), counts])))
    yield pa.RecordBatch.from_arrays(_told(rows), schema=_TOLD)


def _sum_of(done: tuple[np.ndarray, np.ndarray] | None, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = _summed(blobs)
    return (keys, counts) if done is None else add_up(np.concatenate([done[0], keys]), np.concatenate([done[1], counts]))


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, value: for model m, order 2's continuation counts by n-gram + 65,536 m, and for each higher order k, at
    -(1000 m + 10 k + r), how many n-grams have count r."""
    blobs: dict[int, list[bytes]] = {}
    for batch in batches:
        for kind, x in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if kind in _COUNTS:
                blobs.setdefault(kind, []).append(x)
    for m, own in blobs.items():
        found = levels(*_summed(own), ORDER)
        keys, values = [found[2][0].astype(np.int64) + 65536 * m], [found[2][1]]
        for k in range(3, ORDER + 1):
            keys.append(np.array([-(1000 * m + 10 * k + r) for r in (1, 2, 3, 4)]))
            values.append(np.array([(found[k][1] == r).sum() for r in (1, 2, 3, 4)]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(values))], ["key", "value"])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stats, a shard's counts and then the blocks' lists -> log-probabilities for each list."""
    stats, blobs, models = {}, {m: [] for m in _COUNTS}, {}
    for batch in batches:
        rows = []
        for shard, kind, block, blob in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if kind == _STATS:
                stats = dict(zip(*(x.tolist() for x in C.unpack(blob)), strict=True))
                continue
            if kind in _COUNTS:
                blobs[kind].append(blob)
                continue
            own = block % 2, 2 + block % 2
            for m in own:
                if m not in models:
                    found = levels(*_summed(blobs.pop(m)), ORDER)
                    tables = {k: Level(*found[k], discounts(np.array([stats.get(-(1000 * m + 10 * k + r), 0) for r in (1, 2, 3, 4)]))) for k in range(3, ORDER + 1)}
                    pairs = {k - 65536 * m: v for k, v in stats.items() if 65536 * m <= k < 65536 * (m + 1)}
                    models[m] = (tables, base(pairs)[0]) if pairs or m < 2 else None
            keys = np.cumsum(C.unpack(blob)[0], dtype=U64)
            log = score(keys, *models[own[0]], ORDER)
            times = score(keys, *models[own[1]], ORDER) - log if models[own[1]] else np.zeros(len(keys), np.float32)
            rows.append((shard, _LIST, block, C.pack([np.round(log * STEP).astype(np.int16), np.clip(np.round(times * TIMES), -127, 127).astype(np.int8)])))
        yield pa.RecordBatch.from_arrays(_told(rows), schema=_TOLD)


def toxicities(raw: list[bytes], times: np.ndarray) -> np.ndarray:
    """For each text the sum over its WORDS highest words, of the bytes' values that are given one text after the other."""
    size = np.array([len(x) for x in raw], np.int64)
    out = np.zeros(len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8)
    if not len(flat):
        return out
    owner = np.repeat(np.arange(len(raw)), size)
    lead = np.concatenate([[True], (flat[:-1] <= 32) | (np.diff(owner) != 0)])
    at = np.flatnonzero(lead)
    lead[(np.arange(len(flat)) - np.repeat(at, np.diff(np.append(at, len(flat))))) % WORD_BYTES == 0] = True
    at = np.flatnonzero(lead)
    words, owner = np.add.reduceat(times, at), owner[at]
    order = np.lexsort((-words, owner))
    words, owner = words[order], owner[order]
    first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    highest = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner)))) < WORDS
    np.add.at(out, owner[highest], words[highest])
    return out


def _score(n: int, schema: pa.Schema):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        C.lean()
        docs = _documents(left.column("payload").to_pylist())
        raw = _block_texts(docs)
        size = np.array([len(x) for x in raw], np.int64)
        told = dict(zip(right.column("shard").to_pylist(), right.column("payload").to_pylist(), strict=True))
        g = ngrams(raw)
        order = np.argsort(g)
        lead = np.concatenate([[True], np.diff(g[order]) != 0]) if len(g) else np.zeros(0, bool)
        keys = g[order][lead]
        log, times = np.zeros(len(keys), np.float32), np.zeros(len(keys), np.float32)
        for s, at in _lists(keys, n):
            got = C.unpack(told[s])
            log[at], times[at] = got[0] / STEP, got[1] / TIMES
        which = np.cumsum(lead) - 1
        each, more = np.empty(len(g), np.float64), np.empty(len(g), np.float32)
        each[order], more[order] = log[which], times[which]
        bits = np.zeros(len(raw))
        some = np.flatnonzero(size)
        if len(some):
            bits[some] = -np.add.reduceat(each, (np.cumsum(size) - size)[some])
        perplexity = np.exp2(bits / np.maximum(size, 1))
        return pa.Table.from_arrays([*docs.columns, pa.array(size), pa.array(perplexity, mask=size == 0), pa.array(toxicities(raw, more), mask=size == 0)], schema=schema)

    return run


def scored(docs: DataFrame, trusted: DataFrame, names: tuple[str, str, str] = ("n_bytes", "perplexity", "toxicity"), toxic: DataFrame | None = None) -> DataFrame:
    """All columns of docs (doc_id and text among them) and three more: the text's bytes, its perplexity under the
    model of the texts whose doc_id is in trusted, and its toxicity by that of those in toxic, which are others."""
    spark = docs.sparkSession
    n = C.n_shards(spark)
    shards = min(SHARDS, math.ceil(math.sqrt(n)))
    replicas = -(-n // shards)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = 2 * max(-(-n // 2), -(-total // (2 * BLOCK_BYTES)))

    own_name = "_block"
    while own_name in (x.lower() for x in docs.columns):
        own_name = f"_{own_name}"

    def block(*of):
        return F.pmod(F.xxhash64(*of), F.lit(blocks))

    def dealt_to(rows: DataFrame, spread: int) -> DataFrame:
        """Rows by shard, and within it by block among `spread` partitions."""
        return rows.repartitionById(shards * spread, (F.col("shard") * spread + F.pmod("block", F.lit(spread))).cast("int"))

    packed = docs.select(block(F.col("doc_id").cast("long"), F.when(F.col("doc_id").isNull(), F.col("text"))).alias(own_name), *docs.columns).mapInArrow(_deal, "block long, payload binary")
    dealt = packed.repartition(n, "block")
    ids = trusted.select(F.col("doc_id").cast("long"), F.lit(False).alias("toxic"))
    ids = ids.union(toxic.select(F.col("doc_id").cast("long"), F.lit(True))) if toxic is not None else ids
    ids = ids.where("doc_id is not null").distinct().select("doc_id", "toxic", block("doc_id").alias("block"))
    model, spread = dealt.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_count(shards), TOLD), replicas
    while True:
        model = dealt_to(model, spread).mapInArrow(_merged, TOLD)
        if spread == 1:
            break
        spread = -(-spread // FAN)
    stats = model.mapInArrow(_stats, "key long, value long").groupBy("key").agg(F.sum("value").alias("value"))

    def to_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0).to_pylist():
                blob = C.pack([np.array([r["key"] for r in rows], np.int64), np.array([r["value"] for r in rows], np.int64)])
                yield pa.RecordBatch.from_arrays(_told([(s, _STATS, r, blob) for s in range(shards) for r in range(replicas)]), schema=_TOLD)

    # at most 4 * (65,536 + 4 * ORDER) rows, gathered to one and sent to every replica
    gathered = stats.agg(F.collect_list(F.struct("key", "value")).alias("rows")).mapInArrow(to_all, TOLD)
    copies = model.select("shard", "kind", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(replicas - 1).cast("long"))).alias("block"), "payload")
    lists = dealt.groupBy("block").applyInArrow(_list(shards), TOLD)
    answers = dealt_to(copies.union(lists).union(gathered), replicas).sortWithinPartitions("shard", "kind").mapInArrow(_answer, TOLD)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField(names[0], LongType()), StructField(names[1], DoubleType()), StructField(names[2], DoubleType())])
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(shards, to_arrow_schema(schema, prefers_large_types=False)), schema)


def thresholds(known: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """lang, lower, upper, most from the lang, perplexity and toxicity of trusted documents; a row with `every` true for all of them."""
    q = [F.percentile_approx("perplexity", [low, 0.5, high], 10_000).alias("q"), F.percentile_approx("toxicity", [0.5, high], 10_000).alias("t"), F.count("*").alias("n")]
    own, every = known.groupBy("lang").agg(*q), known.agg(F.lit(None).cast("string").alias("lang"), *q).where("q is not null")
    whole = F.broadcast(every.select(F.col("q").alias("eq"), F.col("t").alias("et")))
    # as wide as all trusted documents', and as theirs moved to the language's median
    wide = own.join(whole).select(
        "lang", "q", "t", (F.col("n") / (F.col("n") + FEW)).alias("w"),
        F.least(F.col("q")[0], F.col("eq")[0], F.col("q")[1] * F.col("eq")[0] / F.col("eq")[1]).alias("l"),
        F.greatest(F.col("q")[2], F.col("eq")[2], F.col("q")[1] * F.col("eq")[2] / F.col("eq")[1]).alias("u"),
        F.greatest(F.col("t")[1], F.col("et")[1], F.col("t")[0] + F.col("et")[1] - F.col("et")[0]).alias("m"),
    )
    mixed = [(F.col("w") * x + (1 - F.col("w")) * F.col(y)).alias(z) for x, y, z in ((F.col("q")[0], "l", "lower"), (F.col("q")[2], "u", "upper"), (F.col("t")[1], "m", "most"))]
    each = wide.select("lang", F.lit(False).alias("every"), *mixed)
    return each.union(every.select("lang", F.lit(True), F.col("q")[0], F.col("q")[2], F.col("t")[1]))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The doc_ids whose labels all say quality 1 and toxic 0."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    return labels.groupBy("doc_id").agg(F.min(good).alias("good")).where("good").select("doc_id")


def toxic_ids(labels: DataFrame) -> DataFrame:
    """The doc_ids with a label that says toxic."""
    return labels.where("toxic = 1").select("doc_id").distinct()


def judged(scores: DataFrame, trusted: DataFrame) -> DataFrame:
    """scores (doc_id, lang, perplexity, toxicity; read more than once) with lower, upper, most and keep."""
    known = scores.join(trusted.select(F.col("doc_id").cast("long")), "doc_id", "left_semi").where("perplexity is not null").select("lang", "perplexity", "toxicity")
    limits = C.written(thresholds(known), "thresholds")
    names = ["lower", "upper", "most"]
    own = limits.where("not every").select(F.col("lang").alias("_lang"), *[F.col(x).alias(f"_{x}") for x in names])
    every = limits.where("every").first() or {"lower": 0.0, "upper": float("inf"), "most": float("inf")}
    out = scores.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    out = out.withColumns({x: F.coalesce(f"_{x}", F.lit(every[x])) for x in names}).drop(*[f"_{x}" for x in names])
    return out.withColumn("keep", F.coalesce(F.col("perplexity").between(F.col("lower"), F.col("upper")) & (F.col("toxicity") <= F.col("most")), F.lit(False)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, toxicity, lower, upper, most, keep of every row of docs."""
    trusted, toxic = C.written(trusted_ids(labels), "trusted"), C.written(toxic_ids(labels), "toxic")
    scores = C.written(scored(docs.select(F.col("doc_id").cast("long"), "lang", "text"), trusted, toxic=toxic).drop("text"), "scores")
    return judged(scores, trusted)


def trustworthy(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that classify() would keep."""
    names = ["n_bytes", "perplexity", "toxicity"]
    while set(names) & set(docs.columns):
        names = [f"_{x}" for x in names]
    trusted, toxic = C.written(trusted_ids(labels), "trusted"), C.written(toxic_ids(labels), "toxic")
    scores = scored(docs, trusted, tuple(names), toxic)
    columns = [F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col(names[1]).alias("perplexity"), F.col(names[2]).alias("toxicity")]
    rows = C.written(scores.select(*columns), "scores")
    return judged(rows, trusted).where("keep").select("row.*")
