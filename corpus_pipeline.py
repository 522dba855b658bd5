"""The corpus pipeline: documents pass STAGES in order, each written as Parquet and read by the next.

Each stage works on all that its predecessor kept. All but the last return the columns of
documents: the quality classifier drops what it rejects, near-dedup keeps one document of each
class, decontamination drops documents that a benchmark window occurs in, and personal data is
masked in the text. The last stage encodes the texts and checks that decoding them works.
"""

from __future__ import annotations

import hashlib
import sys

import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import slotwise
from slotwise.llm import bpe, common, decontaminate, kneser_ney, pii, simhash

# executors need no copy of the package: its functions travel by value
cloudpickle.register_pickle_by_value(slotwise)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the classifier keeps."""
    return kneser_ney.trustworthy(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each class of near duplicates, similar in 0.8 of their shingles of five words."""
    return simhash.deduplicated(docs, words=5, least=0.8, banded=True)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents without any window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: personal data masked; n_chars follows the text."""
    out = pii.mask(docs, pii.learn(docs))
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _tokens(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes = pa.compute.list_value_length(batch.column(1)).cast(pa.int64())
    texts = [hashlib.sha256(x).hexdigest() for x in batch.column(2).cast(pa.binary()).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(0), sizes, batch.column(1), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "decoded_sha256"])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: doc_id, n_tokens, ids and the digest of the decoded text."""
    return bpe.round_trip(docs, _tokens, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("pii", masked),
    ("bpe", encoded),
]

#: The classifier and the field learn, and SQL has no BPE; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
