import random

from pyspark.sql import functions as F

from vialstream.llm import fingerprints


def likeness_of(spark, rows, a, b):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pair = spark.createDataFrame([(a, b)], "a string, b string")
    got = fingerprints.fingerprint_columns(pair, {"x": "a", "y": "b"}, fingerprints.lexicon(docs))
    return got.select(fingerprints.likeness(F.col("x"), F.col("y"))).first()[0]


def texts(seed=3):
    r = random.Random(seed)
    others = [" ".join(f"o{r.randrange(400)}" for _ in range(40)) for _ in range(80)]
    return r, others, [f"w{k}" for k in range(100)]


def test_copies_stay_in_the_lexicon(spark):
    _, others, base = texts()
    rows = list(enumerate([*others, *[" ".join(base)] * 40]))
    lex = fingerprints.lexicon(spark.createDataFrame(rows, "doc_id long, text string"))
    held = {t for b in spark.range(1).select(lex.alias("l")).first()["l"] for t in b}
    word = spark.range(1).select(F.xxhash64(F.lit("w5"))).first()[0]
    assert word in held


def test_near_copies_of_a_crowded_group_look_alike(spark):
    r, others, base = texts()
    copies = []
    for k in range(40):
        w = base[:]
        for _ in range(2):
            w[r.randrange(100)] = f"x{r.randrange(10_000)}"
        copies.append(" ".join(w))
    rows = list(enumerate([*others, *copies]))
    assert likeness_of(spark, rows, copies[0], copies[1]) > 0.5
    assert likeness_of(spark, rows, copies[0], " ".join(base[:99])) > 0.5
    assert likeness_of(spark, rows, copies[0], others[0]) < 0.2
