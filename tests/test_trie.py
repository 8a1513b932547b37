"""The trie against plain scans."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vialstream.functions import text
from vialstream.operators import trie


def scan(words, keys):
    return sorted({n for n, k in enumerate(keys) if k and keys.index(k) == n and any(words[i : i + len(k)] == k for i in range(len(words)))})


def removed(words, keys):
    words = list(words)
    for n in range(max(map(len, keys), default=0), 0, -1):
        for i in range(len(words) - n + 1):
            if words[i : i + n] in [k for k in keys if len(k) == n]:
                words[i : i + n] = [None] * n
    return [w for w in words if w is not None]


@pytest.mark.parametrize("seed", range(6))
def test_keys_against_plain_scans(seed):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(r.choice([2, 5, 30, 300]))]
    keys = [[r.choice(vocab) for _ in range(r.randint(1, 5))] for _ in range(r.choice([1, 10, 200, 1500]))] + [[], None, ["only", "here"]]
    rows = [[r.choice([*vocab, "other", "é"]) for _ in range(r.randint(0, 25))] for _ in range(120)] + [None, []]
    t = trie.Trie(keys)
    lists = pa.array(rows, pa.list_(pa.string()))
    assert trie.keys_in(lists, t).to_pylist() == [scan(w or [], keys) for w in rows]
    assert trie.keys_in(lists.slice(7, 40), t).to_pylist() == [scan(w or [], keys) for w in rows[7:47]]
    assert trie.without_keys(lists, t).to_pylist() == [removed(w or [], [k for k in keys if k]) for w in rows]


def test_longer_phrases_go_first():
    keys = [["b", "c", "d"], ["a", "b"], ["x", "x"], ["e"]]
    rows = [["a", "b", "c", "d"], ["a", "b", "c"], ["x", "x", "x", "x", "x"], ["a", "b", "e", "c"]]
    got = trie.without_keys(pa.array(rows, pa.list_(pa.string())), trie.Trie(keys)).to_pylist()
    assert got == [["a"], ["c"], ["x"], ["c"]] == [removed(w, keys) for w in rows]


def test_a_large_trie_stays_compact():
    r = random.Random(3)
    keys = [[f"v{int(r.paretovariate(0.6)) % 20_000}" for _ in range(r.randint(1, 6))] for _ in range(30_000)]
    t = trie.Trie(keys)
    nodes = len({tuple(k[: n + 1]) for k in keys for n in range(len(k))})
    assert len(t.check) < 2 * nodes + len(t.words) + 2
    some = [keys[k] for k in range(0, 30_000, 997)]
    got = trie.keys_in(pa.array(some, pa.list_(pa.string())), t).to_pylist()
    assert all(keys.index(k) in g for k, g in zip(some, got, strict=True))


def test_phrases_of_a_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("# comment\n\nthe\n As  Well As \nwell\nin the absence of\n")
    phrases = text.read_phrases(spark, str(path))
    assert phrases == (("the",), ("as", "well", "as"), ("well",), ("in", "the", "absence", "of"))
    rows = spark.createDataFrame([(1, "The cat, AS WELL as a well-fed dog!"), (2, "in the absence of the well as well as"), (3, None), (4, ""), (5, "as well"), (6, "x the y")], "id int, t string")
    got = {r["id"]: r["c"] for r in rows.select("id", text.without_phrases(spark, F.col("t"), phrases).alias("c")).collect()}
    assert got == {1: "cat well-fed dog", 2: "", 3: "", 4: "", 5: "as", 6: ""}


def test_batches_are_walked_in_slices(monkeypatch):
    """No walk sees more words than the bound, but for a longer row; the result is that of the whole batch."""
    import random

    import pyarrow as pa

    from vialstream.operators import trie

    r = random.Random(2)
    rows = [[r.choice("abcdef") for _ in range(r.choice((0, 3, 9, 40)))] for _ in range(200)] + [None, ["a"] * 500, []]
    lists, t = pa.array(rows, pa.list_(pa.string())), trie.Trie([["a", "b"], ["c"], ["a", "b", "d"]])
    seen = []

    def noted(f):
        return lambda part: (seen.append((len(part), len(part.flatten()))), f(part, t))[1]

    monkeypatch.setattr(trie, "MOST_WORDS", 100)
    for f in (trie.keys_in, trie.without_keys):
        assert trie._sliced(lists, noted(f)).to_pylist() == f(lists, t).to_pylist()
    assert all(words <= 100 or n == 1 for n, words in seen) and sum(n for n, _ in seen) == 2 * len(rows)
    assert trie._sliced(lists.slice(0, 0), noted(trie.keys_in)).to_pylist() == []


def test_keys_that_are_parts_of_longer_ones_go():
    r = random.Random(8)
    keys = sorted({" ".join(r.choice("abcdef") for _ in range(r.randint(1, 4))) for _ in range(150)} | {"", "g", "x\u00e9 g"})
    parts = trie.Parts(keys)
    rows = [[r.randrange(-len(keys), len(keys)) for _ in range(r.randint(0, 40))] for _ in range(300)] + [[], None, list(range(len(keys)))]

    def own(numbers):
        plain = {n for n in numbers if n >= 0}
        w = {n: keys[n].split(" ") for n in plain}
        stay = {a for a in plain if not any(len(w[b]) > len(w[a]) and set(w[a]) <= set(w[b]) for b in plain)}
        return sorted(stay | {-1 - n for n in numbers if n < 0})

    lists = pa.array(rows, pa.list_(pa.int32()))
    want = [own(x or []) for x in rows]
    assert trie.without_parts(lists, parts).to_pylist() == want
    assert trie.without_parts(lists.slice(5, 90), parts).to_pylist() == want[5:95]
    most, trie.MOST_WORDS = trie.MOST_WORDS, 50
    try:
        assert trie.without_parts(lists, parts).to_pylist() == want
    finally:
        trie.MOST_WORDS = most
    assert trie.without_parts(lists.slice(0, 0), parts).to_pylist() == []


def test_words_of_a_line():
    got = trie._split(pa.array([" a  b\x0bc\t", "", " \t", None, "\u00e9 \u00a0x"])).to_pylist()
    assert [x or [] for x in got] == [["a", "b", "c"], [], [], [], ["\u00e9", "\u00a0x"]]
