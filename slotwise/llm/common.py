"""What the operators share: the shared folder, word hashes, k-gram hashes, winnowing and packed shuffles.

A *packed shuffle* sends one binary row per (chunk of input, shard) in place of one row per
item: a map task sorts its items by shard with numpy and emits a blob for each, the rows are
dealt by shard id, and the receiving task decodes its blobs with numpy. The number of shuffled
rows depends on chunks and shards, never on the number of items or on how often a key occurs.
"""

from __future__ import annotations

import atexit
import os
import shutil
import struct
import sys
import tempfile
import types
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one chunk of a map task holds at most (a longer text is a chunk of its own).
CHUNK_BYTES = 4 << 20
U64 = np.uint64
M1, M2, MULT = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- shared folder


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset and all runs on one machine (tests), a temporary one of it."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        own = tempfile.mkdtemp(prefix="slotwise-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        at = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


#: Folders in the shared folder that this driver has named and not removed.
_made: list[str] = []


def fresh_dir(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def leftovers() -> list[str]:
    """The tables that returned DataFrames may still read."""
    return list(_made)


def clear(spark: SparkSession, keep: Iterable[str] = ()) -> None:
    """Removes them, but those to keep: for a caller whose results are written elsewhere."""
    for path in set(_made) - set(keep):
        drop_dir(spark, path)


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that fresh_dir named and that no later plan reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    if path in _made:
        _made.remove(path)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut the lineage: write df as a Parquet table in the shared folder (at path, if given) and read it back."""
    spark, path = df.sparkSession, path or fresh_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shipped:
    """An object of bounded size that all tasks share. It is broadcast as bytes, its class among them, so executors need
    no copy of the package; a worker process keeps the one that it used last."""

    def __init__(self, spark: SparkSession, what):
        self.key, self.sent = uuid.uuid4().hex, spark.sparkContext.broadcast(cloudpickle.dumps(what))

    def get(self):
        store = sys.modules.setdefault("_slotwise_kept", types.ModuleType("_slotwise_kept")).__dict__
        if store.get("shipped", ("",))[0] != self.key:
            store["shipped"] = None  # before the next is loaded
            store["shipped"] = (self.key, cloudpickle.loads(self.sent.value))
            self.sent.__dict__.pop("_value", None)  # the bytes are on disk as well
        return store["shipped"][1]


def n_shards(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- chunks of rows


def lean() -> None:
    """Makes this worker process give memory back: large arrays are mapped one by one, and Arrow keeps no pool."""
    import ctypes

    store = sys.modules.setdefault("_slotwise_kept", types.ModuleType("_slotwise_kept")).__dict__
    if store.get("lean"):
        return
    store["lean"] = True
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, which else grows with what is freed
        libc.mallopt(-1, 4 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):
        pass  # another C library: a hint less


def give_back() -> None:
    """Returns what this worker process has freed to the system, at a task's end."""
    import ctypes
    import gc

    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: a hint less


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts come to at most limit bytes, one row at least."""
    lean()
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


# ---------------------------------------------------------------- hashes


class WordHashes(dict):
    """Word -> XXH64, with a bounded number of words kept."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(30))) * M1
    x = (x ^ (x >> U64(27))) * M2
    return x ^ (x >> U64(31))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of every k consecutive items of h; empty where h is shorter."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= MULT
        out += h[j : j + n]
    return mix(out)


def window_minima(g: np.ndarray, w: int) -> np.ndarray:
    """For every w <= 16 consecutive hashes, the least by its upper 60 bits, the leftmost of equals; its offset is in the lower 4 bits."""
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, U64)
    v = g & ~U64(15)
    out = v[:n].copy()
    for j in range(1, w):
        np.minimum(out, v[j : j + n] | U64(j), out=out)
    return out


_P = [U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def spark_hash(x: np.ndarray, seed: int = 42) -> np.ndarray:
    """What Spark's xxhash64() gives for a long."""
    with np.errstate(over="ignore"):
        h = np.full(len(x), U64(seed) + _P[4] + U64(8), U64)
        h ^= _rotl(x.astype(np.int64).view(U64) * _P[1], 31) * _P[0]
        h = _rotl(h, 27) * _P[0] + _P[3]
        h = (h ^ (h >> U64(33))) * _P[1]
        h = (h ^ (h >> U64(29))) * _P[2]
        return h ^ (h >> U64(32))


def home(ids: np.ndarray, n: int) -> np.ndarray:
    """The partition of a long id: pmod(xxhash64(id), n)."""
    return np.mod(spark_hash(ids).view(np.int64), n)


def home_column(col, n: int):
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


# ---------------------------------------------------------------- packed rows

PACKED = "shard int, payload binary"
_PACKED = pa.schema([("shard", pa.int32()), ("payload", pa.binary())])


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers as one blob, compressed."""
    raw = [np.ascontiguousarray(a) for a in arrays]
    head = struct.pack("<B", len(raw)) + b"".join(struct.pack("<2sQ", a.dtype.str[1:].encode(), a.nbytes) for a in raw)
    return head + pa.compress(b"".join(a.tobytes() for a in raw), "zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    n = blob[0]
    heads = [struct.unpack_from("<2sQ", blob, 1 + 10 * i) for i in range(n)]
    raw, out, at = pa.decompress(blob[1 + 10 * n :], sum(h[1] for h in heads), "zstd", asbytes=True), [], 0
    for kind, size in heads:
        out.append(np.frombuffer(raw, np.dtype("<" + kind.decode()), size // int(kind[1:]), at))
        at += size
    return out


def packed_rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=_PACKED)


def split_by(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions in their old order) for every shard that occurs."""
    order = np.argsort(shard, kind="stable")
    own = shard[order]
    cuts = np.flatnonzero(np.diff(own)) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(shard[part[0]]), part


def dealt(df: DataFrame, n: int) -> DataFrame:
    """Rows with a shard column, each shard a partition of its own."""
    return df.repartitionById(n, F.col("shard"))


def crc(text: bytes) -> int:
    return zlib.crc32(text)


def vocab_path(name: str, folder: str | None = None) -> str:
    """Where a public tokenizer file is; folder overrides the installed package."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def kept(kind: str, path: str, make):
    """make(path), made once in a worker process and used again by its later tasks; for what is bounded in bytes."""
    store = sys.modules.setdefault("_slotwise_kept", types.ModuleType("_slotwise_kept")).__dict__
    if (kind, path) not in store:
        store[kind, path] = make(path)
    return store[kind, path]
