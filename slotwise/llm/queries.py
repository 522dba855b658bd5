"""The queries of this subpackage and their SQL; each applies its operator to its whole table."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import kneser_ney

    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import substring_dedup

    out = substring_dedup.dedup(table(spark, sf_dir, "documents"), min_words=13)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import langid

    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False))
    return langid.identify(docs, langid.learn(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import vptree

    rows = table(spark, sf_dir, "embeddings")
    return vptree.search(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import pii

    docs = table(spark, sf_dir, "documents")
    out = pii.find(docs, pii.learn(docs))

    def joined(name: str):
        return F.array_join(F.transform(name, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, pii.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import html_text

    return html_text.texts(table(spark, sf_dir, "pages")).withColumn("n_lines", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import common, token_files

    files = token_files.write(table(spark, sf_dir, "documents"), common.fresh_dir(spark, "ids"), end_id=1)
    return token_files.read(files).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def _digests(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes, ids, texts = [], [], []
    for own, text in zip(batch.column(1), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
        numbers = own.values.to_numpy().tolist()
        sizes.append(len(numbers))
        ids.append(hashlib.sha256(" ".join(map(str, numbers)).encode()).hexdigest())
        texts.append(hashlib.sha256(text).hexdigest())
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import bpe

    return bpe.round_trip(table(spark, sf_dir, "documents"), _digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import simhash

    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, budget=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import decontaminate

    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import lexical

    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import minhash

    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from slotwise.llm import lloyd

    return lloyd.clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, seed=2)


QUERIES = {
    f.__name__: f
    for f in (op1_quality, op2_substring_dedup, op3_language_id, op4_nearest, op5_pii, op6_html_text, op7_token_files, op8_bpe, op9_simhash, op10_decontaminate, op11_lexical, op12_minhash, op13_centroids)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_ROUND = """
a{r} AS MATERIALIZED (SELECT id, any_value(v.q) AS q, min(list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT * 64 + c.c) AS best FROM v, c{r} AS c GROUP BY id)"""
_MOVE = """,
s{n} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT best % 64 AS c, unnest(range(1, 65)) AS i, unnest(q) AS x FROM a{r}) GROUP BY c, i),
c{n} AS MATERIALIZED (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{r} AS c LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM s{n} GROUP BY c) AS m USING (c)),"""

#: SQL for what SQL can express over whole tables; the other operators are tested against plain versions.
ORACLES = {
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
m AS (SELECT k, min(doc_id) AS first FROM s GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM (SELECT s.doc_id, s.i FROM s JOIN m USING (k) WHERE m.first < s.doc_id)),
words AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT words.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS kept FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM iw))),
hit AS (SELECT DISTINCT doc_id, item_id, n, i FROM dw JOIN iw USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_lexical": f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
t AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
g AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
wt AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM t, g GROUP BY term, n_docs),
q AS (SELECT item_id, text, term, count(*) AS times FROM (SELECT item_id, text, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
s AS (SELECT q.item_id, q.text, t.r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w) * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN t USING (term) JOIN wt USING (term) JOIN d USING (r), g GROUP BY q.item_id, q.text, t.r)
SELECT item_id, row_number() OVER (PARTITION BY item_id, s.text ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s JOIN d USING (r) WHERE score > 0
QUALIFY rank <= 20""",
    "op12_minhash": f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (SELECT u, v FROM (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s AS a JOIN s AS b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id) AS p
      JOIN n AS x ON x.doc_id = u JOIN n AS y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
near AS (SELECT doc_id, doc_id AS v FROM d UNION SELECT near.doc_id, links.v FROM near JOIN links ON near.v = links.u)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(v) AS component_id, doc_id = min(v) AS kept FROM near LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op13_centroids": f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS c, q FROM v WHERE vec_id IS NOT NULL QUALIFY c < 40),{"".join(_ROUND.format(r=r) + _MOVE.format(r=r, n=r + 1) for r in range(5))}{_ROUND.format(r=5)},
o AS MATERIALIZED (SELECT vec_id, (best % 64)::INTEGER AS cluster, best // 64 AS distance FROM v JOIN a5 USING (id))
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c5.q, ',')) AS centroid_sha256
FROM o JOIN c5 ON c5.c = o.cluster""",
}
