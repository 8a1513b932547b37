"""The tagger against brute force and on words that it never saw; lemmas, and recognition by them."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vialstream.operators import ner, tagging

# a small grammar: a determiner, adjectives, a noun, a verb, perhaps an object
STEMS = {"NN": ["lesion", "tumour", "graft", "valve", "nodule", "tremor", "ulcer", "fever", "cyst", "polyp"], "VB": ["inflam", "develop", "report", "resolv", "worsen", "persist", "occurr", "improv"], "JJ": ["hepat", "ren", "cutane", "gastr", "sever", "mild", "diffus"]}
ENDINGS = {"NN": ["s", "itis"], "VB": ["ed", "ing"], "JJ": ["ic", "ous"]}


def sentence(r, fresh=False):
    def word(tag):
        base = "".join(r.choice("bdfklmnprt") + r.choice("aeiou") for _ in range(3)) if fresh else r.choice(STEMS[tag])
        return base + r.choice(ENDINGS[tag]), tag

    noun = lambda: [("the", "DT"), *[word("JJ") for _ in range(r.randint(0, 2))], word("NN")]
    return [*noun(), word("VB"), *(noun() if r.random() < 0.5 else [])]


def tagged(spark, sentences):
    return spark.createDataFrame([(k, n, w, t) for k, s in enumerate(sentences) for n, (w, t) in enumerate(s)], "id long, n int, word string, tag string")


@pytest.fixture(scope="module")
def tagger(spark):
    r = random.Random(1)
    return tagging.train(tagged(spark, [sentence(r, k % 2 == 0) for k in range(400)]))


def test_paths_against_all_paths(tagger):
    r = random.Random(2)
    rows = [[w for w, _ in sentence(r, True)][: r.randint(0, 5)] for _ in range(40)] + [[], ["Zzz"]]
    words, first, size = tagging._flat(pa.array(rows, pa.list_(pa.string())))
    scores = tagger.scores(words)
    got = tagger.paths(scores, first, size)
    n = range(len(tagger.tags))
    for f, s in zip(first, size, strict=True):
        worth = lambda p: tagger.start[p[0]] + scores[f][p[0]] + sum(tagger.after[a, b] + scores[f + k + 1][b] for k, (a, b) in enumerate(itertools.pairwise(p)))  # noqa: B023, E731
        if s:
            best = max(itertools.product(n, repeat=int(s)), key=worth)
            assert np.isclose(worth(best), worth(tuple(got[f : f + s])))


def test_counts(spark):
    t = tagged(spark, [[("A", "X"), ("b", "Y"), (None, "Y")], [("a", "Y"), ("b", None)]])
    assert sorted(map(tuple, tagging.word_tags(t).collect())) == [("a", "X", 1), ("a", "Y", 1), ("b", "Y", 1)]
    assert sorted(map(str, tagging.tag_pairs(t).collect())) == sorted(map(str, spark.createDataFrame([(None, "X", 1), (None, "Y", 1), ("X", "Y", 1)], "before string, tag string, n long").collect()))
    assert {(r["ending"], r["tag"]): r["n"] for r in tagging.ending_tags(tagging.word_tags(t)).collect()} == {("", "X"): 1, ("", "Y"): 2, ("a", "X"): 1, ("a", "Y"): 1, ("b", "Y"): 1}
    with pytest.raises(ValueError, match="tagged rows"):
        tagging.train(t.filter("false"))


def test_accuracy_on_words_never_seen(spark, tagger):
    r = random.Random(77)
    held = [sentence(r, True) for _ in range(300)]
    known = set(tagger.known.to_pylist())
    got = tagging.tags_of(pa.array([[w for w, _ in s] for s in held], pa.list_(pa.string())), tagger).to_pylist()
    new = [(t, g) for s, gs in zip(held, got, strict=True) for (w, t), g in zip(s, gs, strict=True) if w not in known]
    assert len(new) > 700 and np.mean([t == g for t, g in new]) > 0.97


def test_tags_and_lemmas_in_spark(spark, tagger):
    r = random.Random(5)
    train = tagged(spark, [sentence(r) for _ in range(200)])
    lemmas = tagging.lemma_dictionary(tagging.rule_triples(tagging.word_tags(train)))
    rows = spark.createDataFrame([(1, ["the", "Tumours", "worsened", "slowly"]), (2, None), (3, []), (4, ["the", "mice"])], "id int, w array<string>")
    got = {x["id"]: (x["t"], x["l"]) for x in rows.select("id", tagging.tags(spark, tagger, F.col("w")).alias("t"), tagging.lemmatised(spark, tagger, lemmas, F.col("w")).alias("l")).collect()}
    assert got[1][0][:3] == ["DT", "NN", "VB"] and got[1][1] == ["the", "tumour", "worsen", "slowly"]
    assert got[2][0] is None and got[2][1] is None and got[3] == ([], [])
    assert got[4][1] == ["the", "mice"]  # no triple, no change


def test_recognition_by_lemmas(spark, tagger):
    """Irregular forms are no stems of each other: only the pass by lemmas finds them."""
    terms = spark.createDataFrame([("A1", "tooth loss", "PT"), ("A2", "hives", "PT")], "aui string, term string, tty string")
    rows = spark.createDataFrame([(1, "The teeth loss worsened"), (2, "hives persisted"), (3, "no evidence of teeth loss")], "id int, sentence string")
    tagged_rows = tagged(spark, [[("the", "DT"), ("teeth", "NN"), ("loss", "NN"), ("worsened", "VB")]] * 3 + [[("hives", "NN"), ("persisted", "VB")]] * 3)
    model = tagging.train(tagged_rows)
    lemmas = tagging.lemma_dictionary(tagging.rule_triples(tagging.word_tags(tagged_rows)))
    entries = ner.dictionary(terms, stemmed=True)
    plain = {(r["id"], r["key"]) for r in ner.recognise(rows, entries, "AE", True).collect()}
    third = {(r["id"], r["key"]) for r in ner.recognise(rows, entries, "AE", True, lemmas=(model, lemmas)).collect()}
    assert plain == {(2, "hive")} and third == {(1, "tooth loss"), (2, "hive")}
