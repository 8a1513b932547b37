"""Language ID by language-bitmask n-gram filters.

A bit-sliced Bloom filter holds, for each slot, one bit per language; the AND of an n-gram's slots is the
set of all languages that have the n-gram.  A document's score for a language is its share of n-grams with
that bit (a popcount), corrected for the filter's false positives: (share - f) / (1 - f), where f is the
share of full slots to the power of the number of hashes.  The highest score decides.

N-grams are ``N`` bytes of the lower-cased text, all but letters (and bytes over 127) as spaces, with two
letter bytes at least.  A language has those that make up ``LEAST`` of its training n-grams or more.

Training takes about ``TRAIN_DOCS`` documents of each language, drawn by a hash of the id at a rate that
follows from their number; null languages teach nothing.  Cases: a null text, or one without any letter, is ``und`` with score 0; ties go
to the language with more training documents, then to the smaller name; without training rows all is
``und``; repeated rows are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc_mod, mix, own_columns, slices, table

N = 4
HASHES = 2
SLOTS = 1 << 21
LEAST = 1.5e-5
TRAIN_DOCS = 4000
_LETTER = re.compile(r"[^\W\d_]")
_KEEP = np.full(256, 0x20, np.uint8)
_KEEP[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEEP[0x80:] = np.arange(0x80, 256)


def slots(v: np.ndarray, n_slots: int = SLOTS) -> tuple[np.ndarray, ...]:
    h = mix(v.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    top = np.uint64(n_slots - 1)
    return tuple(((h >> np.uint64(21 * k)) & top).astype(np.int32) for k in range(HASHES))


def _joined(data, offs):
    """Each slice's texts, lower-cased, each after N spaces, with each one's range of n-grams: none holds two texts' bytes."""
    texts = [data[a:b].tobytes().decode() for a, b in zip(offs[:-1], offs[1:], strict=True)]
    low = [t.lower().encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(x) + N for x in low])])
    b = _KEEP[np.frombuffer((b" " * N).join([b"", *low, b""]), np.uint8)]
    return texts, at, b


def _grams(b: np.ndarray) -> np.ndarray:
    w = b.astype(np.uint32)
    v = (w[:-3] << np.uint32(24)) | (w[1:-2] << np.uint32(16)) | (w[2:-1] << np.uint32(8)) | w[3:]
    blank = (b == 0x20).astype(np.uint8)
    v[blank[:-3] + blank[1:-2] + blank[2:-1] + blank[3:] > 2] = 0
    return v


def _count(batches):
    """(language, n-gram, count) of a task's training texts."""
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for rows, data, offs in slices(batches):
        langs = rows.column(0).to_pylist()
        _, at, b = _joined(data, offs)
        v = _grams(b)
        for name in dict.fromkeys(langs):
            part = np.concatenate([v[at[k] : at[k + 1]] for k, x in enumerate(langs) if x == name])
            g, n = np.unique(part[part != 0], return_counts=True)
            if name in found:
                og, on = found[name]
                g, back = np.unique(np.concatenate([og, g]), return_inverse=True)
                n = np.bincount(back, np.concatenate([on, n])).astype(np.int64)
            found[name] = g, n
    for name, (g, n) in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(g)), pa.array(g.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, least: float = LEAST, n_slots: int = SLOTS) -> dict:
    """The filters, from (doc_id, text, lang) rows.  At most 1 / ``least`` n-grams a language come to the driver."""
    rows = own_columns(docs, "doc_id", "text", "lang").filter("lang is not null and text is not null")
    per = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # a row for each language
    rate = F.lit(0.0)
    for r in per:
        rate = F.when(F.col("lang") == r["lang"], min(1.0, train_docs / r["count"])).otherwise(rate)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) / float(1 << 20)
    counted = rows.filter(draw < rate).select("lang", "text").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    share = counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
    langs = [r["lang"] for r in per]
    words = -(-max(1, len(langs)) // 64)
    masks = np.zeros((words, n_slots), np.uint64)
    chosen = share.filter(F.col("share") >= least).groupBy("lang").agg(F.sort_array(F.collect_list("gram")).alias("g")).collect()
    for r in chosen:
        k = langs.index(r["lang"])
        for s in slots(np.array(r["g"], np.uint64), n_slots):
            masks[k // 64][s] |= np.uint64(1) << np.uint64(k % 64)
    full = np.array([((masks[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(langs))])
    small = masks.astype(np.uint8) if len(langs) <= 8 else masks
    return {"langs": langs, "masks": small, "false": full**HASHES, "slots": n_slots}


def _predict(model):
    def run(batches):
        m = model.value
        langs, masks, false = m["langs"], m["masks"], m["false"]
        for rows, data, offs in slices(batches):
            texts, at, b = _joined(data, offs)
            v = _grams(b)
            real = v != 0
            n = np.add.reduceat(np.append(real, False), np.minimum(at[:-1], len(real)), dtype=np.int64) if len(texts) else np.zeros(0, np.int64)
            s = slots(v, m["slots"])
            scores = np.zeros((len(texts), len(langs)))
            for w in range(len(masks)):
                have = masks[w][s[0]]
                for other in s[1:]:
                    have &= masks[w][other]
                have[~real] = 0
                for k in range(64 * w, min(len(langs), 64 * w + 64)):
                    bit = (have >> np.array(k % 64, have.dtype)) & np.array(1, have.dtype)
                    hits = np.add.reduceat(np.append(bit, 0), np.minimum(at[:-1], len(bit)), dtype=np.int64)
                    share = hits / np.maximum(n, 1)
                    scores[:, k] = np.clip((share - false[k]) / max(1e-9, 1 - false[k]), 0, 1)
            best = scores.argmax(1) if len(langs) else np.zeros(len(texts), int)
            known = [bool(langs) and _LETTER.search(t) is not None for t in texts]
            names = [langs[k] if ok else "und" for k, ok in zip(best, known, strict=True)]
            score = [float(scores[i, k]) if ok else 0.0 for i, (k, ok) in enumerate(zip(best, known, strict=True))]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(names), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: dict, held_out) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(_predict(sent), "doc_id long, held_out boolean, lang_pred string, score double")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    return predict(docs, fit(docs.filter(~held_out)), held_out)
