"""Repeated word windows, the manifest and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vialstream.llm import manifest, search, substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, runs string, tree string, pos long, rid long"


def frame(spark, rows, parts=3):
    """(doc_id, text, source, lang, n_chars) rows beside extra columns with clashing names."""
    return spark.createDataFrame([(d, t, l, s, n, "x", 0.5, "r", "t", 1, 2) for d, t, s, l, n in rows], SCHEMA).repartition(parts)


def plain(rows):
    return [(d, t, s, l, n) for d, t, l, s, n, *_ in rows]


def same(got, want):
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# ---- repeated windows ----------------------------------------------------------------------


def windows_by_force(rows, size=13):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (r[1] or "").encode()) for r in rows]
    order = lambda d: -(1 << 63) if d is None else d
    least = {}
    for r, w in zip(rows, words, strict=True):
        for k in range(len(w) - size + 1):
            x = tuple(w[k : k + size])
            least[x] = min(least.get(x, order(r[0])), order(r[0]))
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - size + 1):
            if least[tuple(w[k : k + size])] < order(r[0]):
                gone.update(range(k, k + size))
        out.append((r[0], len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return out


def removed(df):
    return [tuple(r) for r in substrings.without_repeats(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]


def test_windows_fixture(spark, rows, docs, repeated):
    same(removed(docs), windows_by_force(plain(rows)))
    odd = [tuple(r) for r in repeated.select("doc_id", "text", "source", "lang", "n_chars").collect()]
    same(removed(repeated), windows_by_force(odd))


def passages(seed, n=160):
    """Passages of 9 to 60 words at all offsets in documents, a hot line, a hot passage, copies and near copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    pool = [[word() for _ in range(r.choice([9, 12, 13, 14, 19, 20, 33, 60]))] for _ in range(12)]
    line, hot = [word() for _ in range(8)], [word() for _ in range(40)]
    rows, texts = [], []
    for k in range(n):
        w = [word() for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(w))
            w[at:at] = r.choice(pool)
        if k % 3 == 0:
            at = r.randint(0, len(w))
            w[at:at] = line
        if k % 3 == 1:
            at = r.randint(0, len(w))
            w[at:at] = hot
        if texts and k % 4 == 0:
            w = list(r.choice(texts))
            if k % 8 == 0 and w:
                w[r.randrange(len(w))] = word()
        texts.append(w)
        rows.append((r.randint(0, 10**6), r.choice([" ", "\n", " \t"]).join(w), "s", "l", 0))
    rows += [(rows[3][0], rows[5][1], "s", "l", 0), rows[7], rows[7], (None, rows[9][1], "s", "l", 0), (None, rows[11][1], "s", "l", 0), (-5, " ".join(["im."] * 300), "s", "l", 0), (5, " ".join(["im."] * 280), "s", "l", 0)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("parts", [1, 5])
def test_windows_at_all_offsets(spark, seed, parts):
    rows = passages(seed)
    same(removed(frame(spark, rows, parts)), windows_by_force(rows))


def test_windows_of_small_slices_and_segments(spark, monkeypatch):
    """Slices of few documents, segments of one long text, and runs that are shuffled, not broadcast."""
    rows = passages(3, 90)
    long = " ".join(t for _, t, *_ in rows if t)
    rows += [(2_000_000, long, "s", "l", 0), (-1, long[len(long) // 3 :], "s", "l", 0)]
    e = [(substrings, "SEGMENT_WORDS", 200), (substrings, "SLICE", 2_000), (substrings, "BROADCAST_ROWS", 2)]
    data = np.frombuffer(long.encode(), np.uint8)
    monkeypatch.setattr(*e[0])
    whole = list(substrings.pieces(data, np.array([0, len(data)])))
    assert len(whole) > 5 and whole[-1].pos[-1] == len(long.split()) - 1
    monkeypatch.setattr(*e[2])
    same(removed(frame(spark, rows)), windows_by_force(rows))
    # the steps themselves, in one process
    for x in e:
        monkeypatch.setattr(*x)
    import pyarrow as pa

    rows = [(k, t) for k, (_, t, *_) in enumerate(rows)]
    table = pa.table({"id": pa.array([d for d, _ in rows], pa.int64()), "th": pa.array([0] * len(rows), pa.int64()), "text": [t for _, t in rows]})
    sent = [b for x in table.to_batches(50) for b in substrings._scan(7)(iter([x]))]
    by = lambda bs, kinds: pa.concat_tables([pa.Table.from_batches(bs, substrings._SCHEMA)]).filter(pa.compute.is_in(pa.Table.from_batches(bs, substrings._SCHEMA)["kind"], pa.array(kinds, pa.int32()))).sort_by([("kind", "ascending"), ("part", "ascending")]).to_batches()
    met = [b for b in substrings._meet(7)(iter(by(sent, [0, 1, 2])))]
    opened = pa.Table.from_batches([b for b in substrings._collect(iter(by(met, [3])))], substrings._RUNS).to_pylist()
    runs = {r["id"]: r["runs"] for r in opened}
    some = [(d, t) for d, t in rows if d in runs]
    beside = pa.table({"id": pa.array([d for d, _ in some], pa.int64()), "th": pa.array([0] * len(some), pa.int64()), "text": [t for _, t in some], "runs": pa.array([runs[d] for d, _ in some], pa.binary())})
    more = [b for x in beside.to_batches(20) for b in substrings._extend(7)(iter([x]))]
    last = [b for b in substrings._first(7)(iter(by(met + more, [1])))]
    found = pa.Table.from_batches([b for b in substrings._collect(iter(by(met + more + last, [2])))], substrings._RUNS).to_pylist()
    runs = {r["id"]: r["runs"] for r in found}
    cut = pa.table({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": [t for _, t in rows], "runs": pa.array([runs.get(d) for d, _ in rows], pa.binary())})
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for b in substrings._cut(iter(cut.to_batches())) for r in b.to_pylist()]
    same(got, windows_by_force([(d, t, "", "", 0) for d, t in rows]))


def test_windows_send_one_entry_an_anchor(spark):
    """A slice of many copies sends as much as one copy."""
    r = random.Random(4)
    text = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(400))
    rows = [(k, text, "s", "l", 0) for k in range(300)]
    one = substrings._identified(frame(spark, rows[:1], 1)).select("id", "th", "text").mapInArrow(substrings._scan(8), substrings.ROW)
    many = substrings._identified(frame(spark, rows, 1)).select("id", "th", "text").mapInArrow(substrings._scan(8), substrings.ROW)
    size = lambda df: sum(len(x["blob"]) for x in df.filter("kind = 0").collect())
    assert size(one) == size(many)
    same(removed(frame(spark, rows)), windows_by_force(rows))


def test_windows_of_nothing(spark, empty):
    assert substrings.without_repeats(empty).collect() == []


def test_cover_has_every_difference():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


# ---- manifest ------------------------------------------------------------------------------


def manifest_by_force(rows):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, t, s, l, n: sha("".join(field(v) for v in (d, s, l, n, t)))

    def climb(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
        return out

    sources = {}
    for r in rows:
        sources.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names}
    upper = climb([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (_, _, own, (d, t, _, l, n)) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            even = zlib.crc32(("" if d is None else str(d)).encode()) % 2 == 0
            cur, proof = leaf(d, t.replace("\n", "") if even and t is not None else t, s, l, n), ""
            for tree, p in ((trees[s], at), (upper, k)):
                for low in tree[:-1]:
                    run = low[p // 3 * 3 : p // 3 * 3 + 3]
                    rest = [x for j, x in enumerate(run) if j != p % 3]
                    proof += "".join(rest)
                    cur = sha("".join([*run[: p % 3], cur, *run[p % 3 + 1 :]]))
                    p //= 3
            root = upper[-1][0]
            out.append((d, own, trees[s][-1][0], root, sha(proof), cur, cur == root))
    return out


def signed(df, **kw):
    return [tuple(r) for r in manifest.manifest(df, **kw).collect()]


def test_manifest_fixture(spark, rows, docs, repeated):
    same(signed(docs), manifest_by_force(plain(rows)))
    same(signed(repeated), manifest_by_force([tuple(r) for r in repeated.select("doc_id", "text", "source", "lang", "n_chars").collect()]))


@pytest.fixture(scope="module")
def many_rows():
    r = random.Random(8)
    return [(r.randint(-50, 900), r.choice(["a\nb", "", None, "x", "é\n" * 9]) if k % 7 else "line\n" * 5_000, r.choice([None, "hot", "hot", "hot", "", "é", "z", f"one{k}"]), r.choice(["en", None]), r.choice([None, 3])) for k in range(400)]


def test_manifest_of_blocks(spark, many_rows, monkeypatch):
    """Blocks of nine rows: hot sources of many blocks, small ones of one, sources without companions, tied and null ids."""
    monkeypatch.setattr(manifest, "BLOCK", 9)
    monkeypatch.setattr(manifest, "DEPTH", 2)
    want = manifest_by_force(many_rows)
    # tasks run in other processes with blocks of their own size, so blocks are driven here
    for most in (10_000, 60, 5):
        same(by_hand(many_rows, most), want)


def by_hand(rows, most):
    """The operator's functions over plain lists, level by level."""
    import pyarrow as pa

    want = {}
    for d, t, s, l, n in rows:
        want.setdefault(s, []).append((d, t, s, l, n))
    full = manifest_by_force(rows)
    leaves = {}
    for r, own in zip([x for s in sorted(want, key=lambda s: (s is not None, (s or "").encode())) for x in want[s]], full, strict=True):
        leaves.setdefault(r[2], []).append(own)
    nodes = []
    others = tampered(rows)
    for s, own in leaves.items():
        for at, x in enumerate(own):
            nodes.append({"tree": s, "pos": at, "n": len(own), "digest": bytes.fromhex(x[1]), "doc_id": x[0], "other": others.get(x[1])})

    def blocked(nodes, suffixes=None):
        out = [x | {"block": x["pos"] // manifest.BLOCK} for x in nodes]
        if suffixes is not None:
            by = {(x["tree"], x["pos"]): x for x in suffixes}
            out = [x | {c: by[x["tree"], x["block"]][c] for c in ("suffix", "subroot", "root")} for x in out]
        out.sort(key=lambda x: (x["tree"] is not None, x["tree"] or "", x["block"], x["pos"]))
        schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("block", pa.int64()), ("doc_id", pa.int64()), ("other", pa.binary()), ("suffix", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])
        return iter(pa.Table.from_pylist(out, schema).to_batches(max_chunksize=7))

    def rows_of(batches):
        return [x for b in batches for x in b.to_pylist()]

    def suffixes(nodes, one_tree=False):
        if len(nodes) <= most:
            return [dict(zip(("tree", "pos", "suffix", "subroot", "root"), r, strict=True)) for r in manifest.top([(x["tree"], x["pos"], x["digest"]) for x in nodes], one_tree)]
        if max(x["n"] for x in nodes) > 1:
            parents = rows_of(manifest._roots(blocked(nodes)))
            return rows_of(manifest._suffixes(blocked(nodes, suffixes(parents, one_tree))))
        order = sorted(nodes, key=lambda x: (x["tree"] is not None, (x["tree"] or "").encode()))
        row = [{"tree": "", "pos": k, "n": len(order), "digest": x["digest"], "doc_id": None, "other": None} for k, x in enumerate(order)]
        above = {x["pos"]: x for x in suffixes(row, True)}
        return [{"tree": x["tree"], "pos": 0, "suffix": above[k]["suffix"], "subroot": x["digest"], "root": above[k]["root"]} for k, x in enumerate(order)]

    parents = rows_of(manifest._roots(blocked(nodes)))
    return [tuple(r.values()) for r in rows_of(manifest._finish(blocked(nodes, suffixes(parents))))]


def tampered(rows):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    out = {}
    for d, t, s, l, n in rows:
        if t is not None and zlib.crc32(("" if d is None else str(d)).encode()) % 2 == 0:
            out[sha("".join(field(v) for v in (d, s, l, n, t)))] = bytes.fromhex(sha("".join(field(v) for v in (d, s, l, n, t.replace("\n", "")))))
    return out


@pytest.mark.parametrize("most", [10_000, 60, 5])
def test_manifest_of_many_sources(spark, many_rows, most):
    """More sources than the driver takes: subroots are numbered and reduced as rows are."""
    same(signed(frame(spark, many_rows), most=most), manifest_by_force(many_rows))


def test_manifest_of_a_large_source(spark):
    rows = [(k, f"t{k}\n", "one", None, k) for k in range(5_000)] + [(7, "x", None, None, None)]
    same(signed(frame(spark, rows)), manifest_by_force(rows))


def test_manifest_of_nothing(spark, empty):
    assert signed(empty) == []


# ---- ranked search -------------------------------------------------------------------------


def search_by_force(rows, items, k=20):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low))
    docs = [(r[0], Counter(cut(r[1]))) for r in rows]
    n_docs, total = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in docs:
            m = 100 - 25 + (25 * c.total() * n_docs) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in cut(text) if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "a", 1) for i, t in items], "item_id long, text string, doc_id string, score long")


def ranked(docs, items, **kw):
    return [tuple(r) for r in search.search(docs, items, **kw).collect()]


def test_search_fixture(spark, rows, docs, repeated):
    items = [(1, rows[0][1]), (2, rows[1][1]), (3, None), (4, "!! ?"), (5, "nowhere to be found zz9"), (6, "ONE one two"), (2, rows[1][1]), (None, "white space"), (8, "ümläut 日本 im im")]
    same(ranked(docs, items_of(spark, items)), search_by_force(plain(rows), items))
    same(ranked(docs, items_of(spark, items), k=3, block_terms=5), search_by_force(plain(rows), items, 3))
    odd = [tuple(r) for r in repeated.select("doc_id", "text", "source", "lang", "n_chars").collect()]
    same(ranked(repeated, items_of(spark, items)), search_by_force(odd, items))


def test_search_ties_long_texts_and_shards(spark):
    r = random.Random(5)
    vocab = [f"w{k}" for k in range(60)]
    rows = [(r.randint(0, 10**6), " ".join(r.choices(vocab, k=r.randint(1, 30))), "s", "l", 0) for _ in range(300)]
    rows += [(k, "same words here", "s", "l", 0) for k in range(900, 800, -1)] + [(5_000_000, "long " * 200_000 + "same", "s", "l", 0)]
    items = [(k, " ".join(r.choices(vocab, k=6))) for k in range(12)] + [(99, "same words here"), (98, "long")]
    for parts in (1, 7):
        same(ranked(frame(spark, rows, parts), items_of(spark, items)), search_by_force(rows, items))


def test_best_is_tie_safe():
    score, ids = np.array([5, 5, 5, 5, 0, 9]), np.array([4, 3, 2, 0, 1, 8])
    null = np.array([False, False, False, True, False, False])
    assert search.best(score, ids, null, 3).tolist() == [5, 3, 2]


def test_shard_holds_every_term():
    import pyarrow as pa

    texts = ["b a a", "", "é a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    row = search.shard(pa.array([1, None, 3]), data, np.array([0, 5, 5, 9]))
    assert (row["docs"], row["filled"], row["tokens"]) == (3, 2, 5)
    known = search.Terms([b"a", b"zz", "é".encode(), b"b"])
    mine, at = known.found(row)
    first, doc, tf = search._read(row, "first", "<u4"), np.cumsum(search._read(row, "doc", "<i4")), search._read(row, "tf", "<u4")
    got = {known.words[m].decode(): list(zip(doc[first[t] : first[t + 1]].tolist(), tf[first[t] : first[t + 1]].tolist(), strict=True)) for m, t in zip(mine.tolist(), at.tolist(), strict=True)}
    assert got == {"a": [(0, 2), (2, 1)], "b": [(0, 1)], "é": [(2, 1)]}


def test_search_of_nothing(spark, docs, empty):
    assert ranked(empty, items_of(spark, [(1, "a b")])) == []
    assert ranked(docs, items_of(spark, [])) == []
