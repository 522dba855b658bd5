"""Token ids in binary files: frequency-ranked ids in a byte-aligned variable-length code.

A map task encodes whole texts with the tokenizers library, appends the end id and sends each
document to the shard of its doc_id's range; a shard sorts its documents by doc_id and writes
files of about FILE_IDS ids (a longer document is a file of its own). A file is self-contained:
its header has the ids it uses ranked by frequency, and the ids follow as ranks of 1 to 4 bytes,
low byte first, whose lengths are in separate control bytes, four ranks to a byte. Ranking within
each file needs no pass over the corpus before the one that writes. Reading looks the control
bytes up in a table of 256 rows, all in numpy.

Files go to a name of their own and are then moved, so a task that runs again overwrites a file
with the same bytes. A document's start is its offset within the shard plus the shards before,
of which there are as many as shuffle partitions.

File: magic `SLW1`; int64 each of documents, ids, distinct ids, data bytes and ids of the shard
before this file; then int64 doc_ids, uint8 whether each is null, int64 ids per document, uint32
ids by rank, control bytes, data bytes; little-endian.

Defined results: null text is empty, so only the end id; null doc_ids come first; documents with
equal doc_id are ordered by their ids; an empty table gives no files; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm import bpe
from slotwise.llm import common as C

FILE_IDS = 2_000_000
#: Bytes of text of which a word is encoded once.
CHUNK = 8 << 20
MAGIC, HEAD = b"SLW1", "<4s5q"
#: For each control byte the lengths of its four ranks.
LENGTHS = np.array([[1 + (c >> 2 * j & 3) for j in range(4)] for c in range(256)], np.uint8)


# ---------------------------------------------------------------- the code


def write_code(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = values.astype(np.uint32)
    more = (v >= 1 << 8).astype(np.uint8) + (v >= 1 << 16) + (v >= 1 << 24)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = more
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    width = int(more.max()) + 1 if len(v) else 1
    data = v.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width][more[:, None] >= np.arange(width, dtype=np.uint8)]
    return control.tobytes(), data.tobytes()


def read_code(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values, by table lookup of the control bytes."""
    size = LENGTHS[control].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    out = data[at].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for j in range(1, 4):
        has = np.flatnonzero(size > j)
        if not len(has):
            break
        out[has] |= data[at[has] + j].astype(np.uint32) << np.uint32(8 * j)
    return out


def to_file(doc_ids: list[int | None], ids: list[np.ndarray], before: int) -> bytes:
    flat = np.concatenate(ids).astype(np.uint32) if ids else np.zeros(0, np.uint32)
    if len(flat) and int(flat.max()) < 1 << 22:
        count = np.bincount(flat)
        used = np.flatnonzero(count)
        count, place = count[used], None
    else:
        used, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.lexsort((used, -count))
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    if place is None:
        of = np.zeros(int(used[-1]) + 1 if len(used) else 0, np.uint32)
        of[used] = rank
        ranks = of[flat]
    else:
        ranks = rank[place]
    control, data = write_code(ranks)
    head = struct.pack(HEAD, MAGIC, len(ids), len(flat), len(used), len(data), before)
    return b"".join([head, np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], np.uint8).tobytes(), np.array([len(x) for x in ids], "<i8").tobytes(), used[order].astype("<u4").tobytes(), control, data])


def from_file(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """doc_ids, ids per document, all ids, ids of the shard before."""
    magic, docs, n, used, size, before = struct.unpack_from(HEAD, raw)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = struct.calcsize(HEAD)
    parts = []
    for kind, count in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<u4", used), ("u1", -(-n // 4)), ("u1", size)):
        parts.append(np.frombuffer(raw, kind, count, at))
        at += parts[-1].nbytes
    doc_ids = [None if null else x for x, null in zip(parts[0].tolist(), parts[1].tolist(), strict=True)]
    ranks = read_code(parts[4], parts[5], n)
    return doc_ids, parts[2], parts[3][ranks] if n else np.zeros(0, np.uint32), before


# ---------------------------------------------------------------- encoding with the library


class Library:
    """The tokenizers library, asked once for words that come again soon."""

    def __init__(self, path: str):
        self.lib = _tokenizer(path)
        added = {x.content: i for i, x in self.lib.get_added_tokens_decoder().items()}
        self.model, self.alphabet, self.kind = self.lib.model, bpe.byte_alphabet(), _kind(self.lib)
        self.words = bpe.Words(added, self._words, self._whole, self.kind)
        self.encode = self.words.ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """The library's model gets normalized and split words, in the byte-level alphabet."""
        tokenize, table, out, kind = self.model.tokenize, self.alphabet, [], self.kind[1:].replace("u2", "H").replace("u4", "I")[-1]
        for word in words:
            if not word.isascii() or not word.isprintable():
                word = "".join([table[b] for b in word.encode()])
            out.append(array(kind, [t.id for t in tokenize(word)]).tobytes())
        return out


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    return lib


def _kind(lib) -> str:
    """The numbers that hold the vocabulary's ids on their way to the files."""
    return "<u2" if max([lib.get_vocab_size(), *lib.get_added_tokens_decoder()]) < 1 << 16 else "<u4"


def write(docs: DataFrame, folder: str, end_id: int = 1, path: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files; returns file, shard, n_ids, first (ids before the file, over all), a row for each file."""
    spark = docs.sparkSession
    path = path or C.vocab_path(bpe.VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    n = C.n_shards(spark)
    kind = _kind(_tokenizer(path))
    bounds = np.array(sorted(set(rows.select("doc_id").stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n))), np.float64) if n > 1 else np.zeros(0)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = C.kept("library", path, Library)  # with its memo, of a bounded number of words of bounded length
        for part in C.chunks(batches, limit=CHUNK):
            ids = lib.encode([x or "" for x in part.column(1).to_pylist()])
            doc = part.column(0)
            shard = np.searchsorted(bounds, pa.compute.fill_null(doc, -(1 << 63)).to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), doc, ids.cast(pa.binary())], ["shard", "doc_id", "ids"])
        C.give_back()

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, doc_ids, ids, held, before, seq = None, [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, ids, held, before, seq
            name = f"{folder}/ids-{shard:06d}-{seq:06d}.bin"
            put(name, to_file(doc_ids, ids, before))
            out = pa.RecordBatch.from_pydict({"file": [name], "shard": pa.array([shard], pa.int32()), "n_ids": [held]})
            doc_ids, ids, before, held, seq = [], [], before + held, 0, seq + 1
            return out

        for batch in batches:
            for s, doc, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = np.append(np.frombuffer(blob, kind).astype(np.uint32), np.uint32(end_id))
                if ids and (s != shard or held + len(own) > file_ids):
                    yield flush()
                if s != shard:
                    shard, before, seq = s, 0, 0
                doc_ids.append(doc)
                ids.append(own)
                held += len(own)
        if ids:
            yield flush()

    sent = rows.mapInArrow(encode, "shard int, doc_id long, ids binary").repartitionById(n, F.col("shard"))
    files = C.written(sent.sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids").mapInArrow(store, "file string, shard int, n_ids long"), "token-files")
    _tidy(folder)
    total, starts = 0, {}
    for s, size in sorted(tuple(r) for r in files.groupBy("shard").agg(F.sum("n_ids")).collect()):  # a row for each shard
        starts[s], total = total, total + size
    first = F.coalesce(F.element_at(F.lit([starts.get(s, 0) for s in range(n)]), F.col("shard") + 1), F.lit(0)).cast("long")
    inside = F.sum("n_ids").over(W.partitionBy("shard").orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    return files.withColumn("first", first + F.coalesce(inside, F.lit(0)))


def _at(name: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(name.replace("s3a://", "s3://", 1))


def put(name: str, raw: bytes) -> None:
    fs, path = _at(name)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as f:
        f.write(raw)
    fs.move(part, path)


def _tidy(folder: str) -> None:
    """Removes what tasks that were killed left beside the files."""
    fs, path = _at(folder)
    for x in fs.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True)):
        if not x.base_name.endswith(".bin"):
            fs.delete_file(x.path)


def get(name: str) -> bytes:
    fs, path = _at(name)
    with fs.open_input_stream(path) as f:
        return f.read()


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, ids (little-endian 32-bit numbers) of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids, sizes, ids, _ = from_file(get(name))
                ends = np.cumsum(sizes)
                raw, starts = ids.astype("<u4").tobytes(), (ends - sizes).tolist()
                blobs = [raw[4 * s : 4 * e] for s, e in zip(starts, ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(ends - sizes + first), pa.array(blobs, pa.binary())], ["doc_id", "start", "ids"])

    n = C.n_shards(files.sparkSession)
    return files.select("file", "first").repartition(n, "file").mapInArrow(run, "doc_id long, start long, ids binary")
