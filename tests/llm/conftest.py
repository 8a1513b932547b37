import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, h long, score double"


def make_docs(seed=5, n=70):
    """Prose of two invented languages with copies, near copies, nulls, empty texts, repeated rows and clashing columns."""
    r = random.Random(seed)
    vocab = {"aa": ["".join(r.choice("bcdfglm") + r.choice("aeo") for _ in range(r.randint(1, 3))) for _ in range(120)], "bb": ["".join(r.choice("kprstz") + r.choice("iuy") for _ in range(r.randint(1, 3))) for _ in range(120)]}
    texts = []
    for k in range(n):
        lang = "aa" if k % 2 else "bb"
        w = [r.choice(vocab[lang]) for _ in range(r.choice([1, 3, 8, 40, 120, 200]))]
        texts.append((lang, " ".join(w).capitalize() + "."))
    rows = [(k, t, lang, f"src{k % 3}", len(t), "x", 7, 0.5) for k, (lang, t) in enumerate(texts)]
    base = max(rows, key=lambda x: len(x[1]))[1]
    words = base.split()
    near = " ".join([*words[:-3], "changed", "end", "now"])
    far = " ".join(words[: len(words) // 2] + ["other"] * (len(words) // 2))
    more = [base, near, far, base, "", None, "!!! ???", "one two three", "ONE two\tthree", "Mixed\n\n  white   space ", "e-mail a.b@c.de and +1 (988) 555-2485, 10.0.0.1", "ümläut ñandú 日本", "im. " * 120, base + " " + base]
    for k, t in enumerate(more):
        rows.append((1000 + k, t, None if k % 4 == 0 else "aa", None if k % 5 == 0 else "src9", None, "y", 1, None))
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def repeated(spark, rows):
    """Rows that repeat, ids with two texts, and a null id."""
    odd = [rows[3], rows[3], rows[5], (rows[5][0], "another text of the same id", *rows[5][2:]), (None, rows[8][1], *rows[8][2:]), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame([*rows[:12], *odd], SCHEMA)
