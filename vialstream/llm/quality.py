"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are hashed words, trigrams of character shapes and marks of repeated words; tf-idf
vectors of a labelled sample are reduced to ``DIMS`` latent dimensions by a singular value decomposition.
The sample's vectors are broadcast, each document's exact cosine with all of them is computed in blocks,
and the ``NEIGHBOURS`` nearest labels vote with the similarity as weight; a vote also counts by how many
labelled rows of its class one sampled row stands for.

The sample is ``PER_CLASS`` rows of each label at most, the first by a hash of the id.  Cases: texts that
are null, empty or like none of the sample get the labelled rows' mean; without labels all score 0.5; a
document labelled more than once counts with its lowest label, null labels not at all; of several texts of a
labelled id the least is learnt; repeated documents are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, SPACE, crc_mod, own_columns, slices, table, word_bounds, word_hashes

PER_CLASS = 1000
DIMS = 48
NEIGHBOURS = 25
KEEP_SCORE = 0.7
WORD_SLOTS = 2048
SHAPES = 16
SHAPE_SLOTS = SHAPES**3
REPEATS = 8
TERMS = SHAPE_SLOTS + WORD_SLOTS + REPEATS

_SHAPE = np.full(256, 15, np.uint8)  # other marks
for _k, _group in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\t\x0b\x0c", b".", b",", b"!?", b"|/\\_", b"*#%$&", b"@:;", b"'\"-", b"<>[]{}()"]):
    _SHAPE[list(_group)] = _k
_SHAPE[0x80:] = 13


def term_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Relative frequencies of all terms, a row for each text, the three kinds each summing to 1."""
    n = len(offs) - 1
    out = np.zeros((n, TERMS), np.float32)
    if len(data) == 0:
        return out
    doc = np.repeat(np.arange(n), np.diff(offs))
    shape = _SHAPE[data].astype(np.int32)
    if len(data) > 2:
        tri = (shape[:-2] * SHAPES + shape[1:-1]) * SHAPES + shape[2:]
        same = doc[:-2] == doc[2:]
        # runs of plain letters, most of any text, say nothing
        same &= (tri != 0)
        at = doc[:-2][same].astype(np.int64) * SHAPE_SLOTS + tri[same]
        out[:, :SHAPE_SLOTS] = np.bincount(at, minlength=n * SHAPE_SLOTS).reshape(n, SHAPE_SLOTS)
    start, end, who = word_bounds(~SPACE[data], offs)
    if len(start):
        h = word_hashes(LOWER[data], start, end)
        at = who * WORD_SLOTS + (h % np.uint64(WORD_SLOTS)).astype(np.int64)
        out[:, SHAPE_SLOTS : SHAPE_SLOTS + WORD_SLOTS] = np.bincount(at, minlength=n * WORD_SLOTS).reshape(n, WORD_SLOTS)
        again = np.zeros(n)
        twice = (h[1:] == h[:-1]) & (who[1:] == who[:-1])
        np.add.at(again, who[1:][twice], 1)
        words = np.bincount(who, minlength=n)
        level = np.minimum(REPEATS - 1, (again / np.maximum(words, 1) * REPEATS * 2).astype(int))
        has = words > 0
        out[np.flatnonzero(has), SHAPE_SLOTS + WORD_SLOTS + level[has]] = 1
    for a, b in ((0, SHAPE_SLOTS), (SHAPE_SLOTS, SHAPE_SLOTS + WORD_SLOTS)):
        out[:, a:b] /= np.maximum(out[:, a:b].sum(1, keepdims=True), 1)
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The weights of the terms, in the place of their frequencies."""
    x = np.sqrt(counts, out=counts)
    x *= idf
    x[:, SHAPE_SLOTS : SHAPE_SLOTS + WORD_SLOTS] *= 0.5
    return x


def _sample_terms(batches):
    for rows, data, offs in slices(batches):
        x = term_counts(data, offs)
        at = [np.flatnonzero(r) for r in x]
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())), pa.array([r[a] for r, a in zip(x, at, strict=True)], pa.list_(pa.float32()))], ["doc_id", "quality", "at", "value"])


def fit(docs: DataFrame, labels: DataFrame, may_learn, per_class: int = PER_CLASS, dims: int = DIMS) -> dict | None:
    """The model from a bounded sample: idf, projection, latent vectors, labels and their weights."""
    known = own_columns(labels, "doc_id", "quality").filter("quality in (0, 1) and doc_id is not null").filter(may_learn).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    total = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if not total:
        return None
    rows = None
    for q in sorted(total):
        part = known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").limit(per_class)
        rows = part if rows is None else rows.unionByName(part)
    ids = rows.collect()  # 2 * per_class ids at most
    rows = docs.sparkSession.createDataFrame([(r["doc_id"], r["quality"]) for r in ids], "doc_id long, quality int")
    texts = own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).join(F.broadcast(rows), "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    got = sorted(texts.mapInArrow(_sample_terms, "doc_id long, quality int, at array<int>, value array<float>").collect(), key=lambda r: r["doc_id"])
    if not got:
        return None
    x = np.zeros((len(got), TERMS), np.float32)
    for k, r in enumerate(got):
        x[k, r["at"]] = r["value"]
    y = np.array([r["quality"] for r in got])
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    a = weighted(x, idf)  # in place
    value, vector = np.linalg.eigh((a @ a.T).astype(np.float64))
    top = np.argsort(-value)[:dims]
    top = top[value[top] > 1e-9]
    projection = (a.T @ (vector[:, top] / np.sqrt(value[top]))).astype(np.float32)
    latent = a @ projection
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    stands = {q: total[q] / max(1, int((y == q).sum())) for q in total}
    weight = np.array([stands[q] for q in y])
    return {"idf": idf, "projection": projection, "latent": latent.astype(np.float32), "label": y.astype(np.float32), "weight": weight.astype(np.float32), "mean": float((weight * y).sum() / weight.sum())}


def votes(model: dict, data: np.ndarray, offs: np.ndarray, neighbours: int = NEIGHBOURS, block: int = 256) -> np.ndarray:
    """Scores of the texts, blocks of them against all labelled vectors."""
    n = len(offs) - 1
    score = np.full(n, model["mean"])
    k = min(neighbours, len(model["label"]))
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        x = weighted(term_counts(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]), model["idf"])
        z = x @ model["projection"]
        size = np.linalg.norm(z, axis=1)
        sim = (z / np.maximum(size, 1e-9)[:, None]) @ model["latent"].T
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(sim, near, 1), 0) * model["weight"][near]
        total = w.sum(1)
        ok = (total > 1e-12) & (size > 1e-9)
        score[lo:hi][ok] = ((w * model["label"][near]).sum(1)[ok]) / total[ok]
    return np.clip(score, 0, 1)


def _score(model):
    def run(batches):
        for rows, data, offs in slices(batches):
            s = votes(model.value, data, offs) if model.value else np.full(rows.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(s)], [*rows.schema.names[:-1], "score"])

    return run


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out and score for (doc_id, held_out, text) rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_score(sent), "doc_id long, held_out boolean, score double")


def _held_out():
    return crc_mod("doc_id", 4) == 2


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), ~_held_out())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _held_out().alias("held_out"), "text")
    return scored(rows, model).withColumn("predicted", (F.col("score") >= KEEP_SCORE).cast("int"))


def _keep(model):
    def run(batches):
        for rows, data, offs in slices(batches):
            s = votes(model.value, data, offs) if model.value else np.full(rows.num_rows, 0.5)
            yield rows.filter(pa.array(s >= (KEEP_SCORE if model.value else 0)))

    return run


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go; without labels none goes."""
    rows = own_columns(docs, "doc_id", "text", "lang", "source", "n_chars")
    model = fit(rows, table(spark, sf_dir, "labels"), ~_held_out())
    return rows.mapInArrow(_keep(spark.sparkContext.broadcast(model)), rows.schema)
