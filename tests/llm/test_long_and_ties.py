"""Very long texts (far beyond a slice) and equal texts under different ids."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialstream.llm import decontaminate, fingerprints, language, lm, mixing, quality
from vialstream.llm.common import SLICE_BYTES, crc_mod

LONG = " ".join(f"Word{k % 997} of{k % 13}" for k in range(120_000))
TAIL = " ".join(f"planted{k}" for k in range(10))


@pytest.fixture(scope="module")
def both(spark, rows):
    assert len(LONG) > SLICE_BYTES
    two = [(r[0] + 10_000, *r[1:]) for r in rows] + [(k, LONG + " " + TAIL, "aa", "src0", 1, "x", 1, None) for k in (90_000, 90_001)]
    every = [*rows, *two]
    df = spark.createDataFrame(every, "doc_id long, text string, lang string, source string, n_chars long, key string, h long, score double").repartition(3, "doc_id")
    return df, every


def by_text(every, got, value):
    """Every text's set of results: one each."""
    out: dict = {}
    for k, t, *_ in every:
        out.setdefault(t or "", set()).add(value(got[k]))
    return out


def test_quality(spark, both):
    df, every = both
    labels = spark.createDataFrame([(k, k % 2) for k in range(70)], "doc_id long, quality int")
    held = crc_mod("doc_id", 4) == 2
    got = {r["doc_id"]: r for r in quality.scored(df.select("doc_id", held.alias("held_out"), "text"), quality.fit(df, labels, ~held)).collect()}
    for scores in by_text(every, got, lambda r: r["score"]).values():
        assert max(scores) - min(scores) < 1e-6 and 0 <= min(scores) and max(scores) <= 1


def test_language(both):
    df, every = both
    held = crc_mod("doc_id", 3) == 1
    got = {r["doc_id"]: r for r in language.predict(df, language.fit(df.filter(~held)), held).collect()}
    assert {t[:40]: v for t, v in by_text(every, got, lambda r: (r["lang_pred"], r["score"])).items() if len(v) > 1} == {}
    assert got[90_000]["lang_pred"] in ("aa", "bb")


def test_language_model(both):
    df, every = both
    held = crc_mod("doc_id", 7) == 2
    got = {r["doc_id"]: r for r in lm.likelihoods(df, held, *lm.fit(df.filter(~held))).collect()}
    words = lambda t: [*(t or "").encode().lower().split(), None]
    c = Counter(w for k, t, *_ in every if zlib.crc32(str(k).encode()) % 7 != 2 for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(LONG + " " + TAIL))
    assert math.isclose(got[90_000]["base_score"], want, rel_tol=1e-9) and got[90_000]["n_tokens"] == 240_011
    for scores in by_text(every, got, lambda r: r["score"]).values():
        assert max(scores) - min(scores) <= 1e-5 * (1 + abs(min(scores)))


def test_decontamination_reads_to_the_end(spark, both):
    df, every = both
    items = spark.createDataFrame([("a", TAIL, "")], "item_id string, question string, answer string")
    bench = items.select("item_id", F.col("question").alias("text"))
    got = {r["doc_id"]: r for r in decontaminate.contamination(df, bench).collect()}
    assert {k for k, r in got.items() if r["contaminated"]} == {90_000, 90_001} and got[90_000]["n_hit"] == 10 and got[90_000]["n_words"] == 240_010


def test_fingerprints(both):
    df, every = both
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(df).collect()}
    assert all(len(v) == 1 for v in by_text(every, got, lambda r: r["fingerprint"]).values())


def test_mixing(both):
    df, every = both
    got = {r["doc_id"]: r for r in mixing.mixture(df).collect()}
    assert got[90_000]["size"] == 240_010 and all(r["taken"] <= 3 * r["size"] for r in got.values()) and len(got) == len(every)
    again = {r["doc_id"]: r["taken"] for r in mixing.mixture(df.repartition(5)).collect()}
    assert again == {k: r["taken"] for k, r in got.items()}


def test_ngrams_of_a_text_are_its_own():
    """Against a plain loop; neighbours don't matter."""
    texts = ["Bego.", "", "Kiri  pu-ti", "x", "日本 ab", "ab"]
    raw = [t.encode() for t in texts]
    _, at, b = language._joined(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    v = language._grams(b)
    for k, t in enumerate(texts):
        s = b"    " + bytes(x if 0x61 <= x <= 0x7A or x >= 0x80 else 0x20 for x in t.lower().encode()) + b"    "
        want = [int.from_bytes(s[i : i + 4], "big") for i in range(len(s) - 3) if s[i : i + 4].count(b" ") <= 2]
        assert [int(x) for x in v[at[k] : at[k + 1]] if x] == want
