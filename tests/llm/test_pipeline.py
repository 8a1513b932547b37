import zlib

import corpus_pipeline
import numpy as np
import pytest

import __spark_entry__
from vialstream.llm import decontaminate, mixing, neardup, quality, tokens

SF = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, f in corpus_pipeline.STAGES:
        out.append(docs)
        docs = f(spark, docs, SF).persist()
        docs.count()
    return [*out, docs]


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_take_effect(spark, stages):
    start, good, distinct, clean, mixed, files = stages
    scores = {r["doc_id"]: r["predicted"] for r in quality.op1_quality(spark, SF).collect()}
    assert ids(good) == sorted(k for k, p in scores.items() if p == 1)
    assert ids(distinct) == sorted(r["doc_id"] for r in neardup.near_duplicates(good, neardup.STAGE_PERCENT).collect() if r["kept"])
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(clean) == sorted(r["doc_id"] for r in decontaminate.contamination(distinct, bench).collect() if not r["contaminated"])
    assert ids(mixed) == sorted(r["doc_id"] for r in mixing.mixture(clean).collect() for _ in range(r["copies"]))
    assert all(df.columns == start.columns for df in (good, distinct, clean, mixed))


def test_last_stage_reads_back(stages):
    mixed, files = stages[4], stages[5]
    tok = tokens.vocabulary(tokens.default_tokenizer())
    text = {r["doc_id"]: r["text"] for r in mixed.collect()}
    rows = sorted(files.collect(), key=lambda r: r["start"])
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
        raw = np.frombuffer(text[r["doc_id"]].encode(), np.uint8)
        want = tok.encode(raw, np.array([0, len(raw)]))[0].astype("<u4")
        assert (len(want), zlib.crc32(want.tobytes())) == (r["n_tokens"], r["ids_crc32"])
    assert [r["doc_id"] for r in rows] == ids(mixed)


def test_run(spark, stages):
    key = lambda r: (r["doc_id"], r["start"])
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(tuple(r) for r in stages[5].select("doc_id", "start", "n_tokens", "ids_crc32").collect())


def test_pipeline_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, rid string, score double, size long"


def odd_rows(spark):
    """Nulls in any column, repeated rows, one id with two texts, copies without id, and columns that clash."""
    words = [f"w{k}" for k in range(60)]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").filter("text is not null").orderBy("item_id").first()["text"]
    rows = [
        (1, " ".join(words), "aa", "s1", 5), (1, " ".join(words), "aa", "s1", 5), (None, " ".join(words), None, None, None), (None, " ".join(words), None, None, None),
        (2, "one text of id two, by itself", "aa", "s1", 1), (2, " ".join(words), "aa", "s2", 1), (3, None, None, "s2", None), (None, None, None, None, None), (4, "", "bb", None, 0),
        (5, f"before {bench} after", "aa", "s1", 3), (None, f"so {bench} there " + " ".join(f"q{k}" for k in range(90)), "aa", None, 3), (5, "a clean text that shares its id with a dirty one", "bb", "s1", 3),
    ]
    return spark.createDataFrame([(*r, "x", 0.5, 7) for r in rows], COLUMNS)


def test_stages_decide_by_row(spark):
    docs = odd_rows(spark)
    text = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    every = text(docs)
    words = next(t for k, t in every if k == 1)
    kept = text(neardup.distinct_documents(spark, docs, SF))
    assert kept == sorted([*((k, t) for k, t in every if t != words), (1, words)], key=str)  # one of six copies
    clean = text(decontaminate.clean_documents(spark, docs, SF))
    assert len(clean) == 10 and (5, "a clean text that shares its id with a dirty one") in clean
    mixed = mixing.mixed_documents(spark, docs, SF)
    assert mixed.columns == COLUMNS.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")[:5] and set(text(mixed)) <= set(every)
    good = quality.good_documents(spark, docs, SF)
    assert good.columns == mixed.columns and set(text(good)) <= set(every)
    files = tokens.tokenized(spark, docs, SF)
    assert files.count() == len(every)
    for stage in (quality.good_documents, neardup.distinct_documents, decontaminate.clean_documents, mixing.mixed_documents):
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_a_very_long_text_passes_all_stages(spark):
    long = " ".join(f"word{k % 997} of{k % 13}" for k in range(250_000))
    docs = spark.createDataFrame([(1, long, "aa", "s", 1), (2, long + " end", "aa", "s", 1), (3, "a short one", "aa", "t", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = neardup.distinct_documents(spark, docs, SF)
    assert ids(kept) == [1, 3] and ids(decontaminate.clean_documents(spark, kept, SF)) == [1, 3]
    assert quality.good_documents(spark, docs, SF).count() <= 3
    assert {r["n_tokens"] > 500_000 for r in tokens.tokenized(spark, docs.filter("doc_id < 3"), SF).collect()} == {True}
