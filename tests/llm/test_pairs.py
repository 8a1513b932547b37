import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from vialstream.llm import components, decontaminate, neardup, suffixes

WS = r"[^\x20\x09-\x0D]+"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = re.findall(WS, low(t))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def groups(rows):
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    out = []
    for k, r in enumerate(rows):
        ids = [x[0] for j, x in enumerate(rows) if root(j) == root(k) and x[0] is not None]
        least = min(ids) if ids else None
        out.append((r[0], len(sets[k]), least, r[0] == least))
    return sorted(out, key=str)


def test_near_duplicates_against_brute_force(docs, rows):
    got = neardup.near_duplicates(docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == groups(rows)


def test_near_duplicates_edges(spark, repeated, empty):
    got = neardup.near_duplicates(repeated).collect()
    want = groups([tuple(r) for r in repeated.collect()])
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted(((a, b, c if c is not None else a) for a, b, c, _ in want), key=str)
    assert neardup.near_duplicates(empty).count() == 0


def test_rows_without_id_are_linked(spark):
    base = [f"w{k}" for k in range(200)]
    near = [*base[:-2], "other", "end"]
    rows = [(None, " ".join(base)), (None, " ".join(base)), (7, " ".join(near)), (None, "alone here"), (None, None), (9, "q r s t u v"), (9, " ".join(near))]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, 196, 7, False)] * 2 + [(7, 196, 7, True), (9, 196, 7, False), (9, 2, 9, True), (None, 1, None, True), (None, 0, None, True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    docs = spark.createDataFrame([(*r, "aa", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stay = [(r["doc_id"], r["text"]) for r in neardup.distinct_documents(spark, docs, "").collect()]
    assert sorted(stay, key=str) == sorted([(7, rows[2][1]), (9, "q r s t u v"), (None, "alone here"), (None, None)], key=str)


def test_recall_near_the_threshold(spark):
    """Thousands of pairs between 0.85 and 0.90 that have no other partner: all are linked."""
    r = random.Random(8)
    rows = []
    for k in range(2000):
        w = [f"p{k}x{j}" for j in range(r.choice([80, 200]))]
        v, changed = w[:], 0
        both = shingles(" ".join(w))
        while True:
            v[(at := r.randrange(len(v)))] = f"n{k}y{changed}"
            changed += 1
            other = shingles(" ".join(v))
            j = len(both & other) / len(both | other)
            if j < 0.905:
                break
            last = v[:]
        if j < 0.85:
            v = w[: -max(1, len(w) // 9)] + []
            other = shingles(" ".join(v))
            j = len(both & other) / len(both | other)
        if 0.85 <= j < 0.92:
            rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
    assert len(rows) > 3000
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got.filter("kept").count() == len(rows) // 2


def test_many_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)  # several blocks, every two compared
    r = random.Random(2)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(60):
        w = base[:]
        for _ in range(r.choice([0, 1, 2, 3, 5])):
            w[r.randrange(150)] = f"x{r.randrange(1000)}"
        rows.append((k, " ".join(w)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(x) for x in got), key=str) == groups(rows)


def test_stage_links_at_its_own_percent(spark):
    base = [f"w{k}" for k in range(504)]
    rows = [(0, " ".join(base)), (1, " ".join([*base[:450], *(f"x{k}" for k in range(54))]))]
    a, b = (shingles(t) for _, t in rows)
    assert 0.80 <= len(a & b) / len(a | b) < 0.85
    docs = spark.createDataFrame([(*r, "aa", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in neardup.distinct_documents(spark, docs, "").collect()] == [0]
    assert all(r["kept"] for r in neardup.near_duplicates(docs).collect())


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_at_the_threshold_are_missed_with_a_known_chance(percent):
    p = percent / 100
    trees, need, n = neardup.tree_count(percent), neardup.least_agreement(percent), neardup.PERMUTATIONS
    few = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(need))
    assert trees * neardup.LEAST <= n and few + (1 - p**neardup.LEAST) ** trees <= 1e-5


def test_components(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 101), (100, 101)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {101: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_cut(rows):
    """doc_id -> result, by all 100-byte strings in order."""
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: r[0]):
        b = (r[1] or "").encode()
        keep = np.ones(len(b), bool)
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                keep[s : s + 100] = False
            seen.add(w)
        spans = int((~keep & np.concatenate([[True], keep[:-1]])[: len(keep)]).sum()) if len(b) else 0
        out.append((r[0], len(b), int((~keep).sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[keep])).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [suffixes.CROWD, 0])
def test_repeated_strings_against_brute_force(docs, rows, crowd):
    got = suffixes.without_repeats(docs, crowd).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(tuple(r) for r in got) == brute_cut(rows)
    assert sum(r["n_removed"] for r in got) > 1000


def test_repeated_strings_edges(spark, repeated, empty, monkeypatch):
    assert suffixes.without_repeats(empty).count() == 0
    assert suffixes.without_repeats(repeated).count() == repeated.count()
    text = "abcdefghij" * 40
    got = suffixes.without_repeats(spark.createDataFrame([(5, text), (5, text)], "doc_id long, text string")).collect()
    assert {r["n_removed"] for r in got} == {390}  # identical rows are one document, which repeats itself
    data = np.frombuffer(np.random.default_rng(1).bytes(3000), np.uint8)
    monkeypatch.setattr(suffixes, "SEGMENT", 500)
    parts = [(base + s, n) for base, p, o in suffixes._segments(data, np.array([0, len(data)])) for s, n in zip(*(x.tolist() for x in suffixes.samples(p, o)[1:3]), strict=True)]
    assert sorted(x for s, n in parts for x in range(s, s + n)) == list(range(2901))


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_hits(rows, items):
    def words(t):
        return re.findall(WORD, low(t))

    out = []
    for r in rows:
        w, hit, who = words(r[1]), set(), set()
        for i, t in items:
            v = words(t)
            for k in range(max(1, len(v) - 9) if v else 0):
                p = v[k : k + 10]
                for j in range(len(w) - len(p) + 1):
                    if w[j : j + len(p)] == p:
                        hit.update(range(j, j + len(p)))
                        who.add(str(i))
        out.append((r[0], len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [decontaminate.AUTOMATON_NODES, 200])
def test_decontamination_against_brute_force(spark, docs, rows, size):
    long = max(rows, key=lambda r: len(r[1] or ""))[1].split()
    items = [(1, " ".join(long[5:17])), (2, "one TWO three"), (3, None), (4, ""), (10, " ".join(long[8:18])), (11, "!!!"), (12, "ümläut"), (12, "never there at all")]
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, b, nodes=size)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in got.select(cols).collect()), key=str) == brute_hits(rows, items)
    text = {r[0]: r[1] for r in rows}
    for r in got.filter("contaminated").collect():
        for s in r["spans"]:
            part = low(text[r["doc_id"]][s["start"] : s["end"]])
            assert re.fullmatch(WORD, part[0]) and re.fullmatch(WORD, part[-1])


def test_decontamination_edges(spark, repeated, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(empty, none).count() == 0
    got = decontaminate.contamination(repeated, none).collect()
    assert len(got) == repeated.count() and not any(r["contaminated"] for r in got)
