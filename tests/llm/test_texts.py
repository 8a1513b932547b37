import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialstream.llm import common, fingerprints, language, lm, mixing, pii, quality, recurrent, tokens
from vialstream.llm.common import crc_mod

WS = r"[^\x20\x09-\x0D]+"


# ---- fingerprints -----------------------------------------------------------------------


def test_next_text_and_edits(docs, rows, empty):
    got = {r["doc_id"]: r for r in fingerprints.with_next(docs, shard_docs=7).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for a, b in zip(order, [*order[1:], order[0]], strict=True):
        assert got[a[0]]["next_text"] == (b[1] or "")
    assert fingerprints.with_next(empty).count() == 0


def test_fingerprints(docs, rows, empty, repeated):
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    by_text = {}
    for r in rows:
        by_text.setdefault(r[1] or "", set()).add(got[r[0]])
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprints.fingerprints(empty).count() == 0 and fingerprints.fingerprints(repeated).count() == repeated.count()


def test_ranges_in_chunks(spark):
    ids = [*range(-40, 400, 3), None, 7, 7]
    docs = spark.createDataFrame([(k,) for k in ids], "doc_id long")
    one, _ = common.range_shards(docs, 5)
    two, n = common.range_shards(docs, 5, chunk=4)
    got = [{(r["doc_id"], r["shard"]) for r in x.collect()} for x in (one, two)]
    assert got[0] == got[1] and {s for _, s in got[0]} == set(range(n)) and (None, 0) in got[0]
    assert [s for _, s in sorted(x for x in got[0] if x[0] is not None)] == sorted(s for k, s in got[0] if k is not None)


def test_op4_against_brute_force(spark, tmp_path):
    r = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in r.integers(0, 300, n)) for n in r.integers(0, 90, 60)] + ["", "é ü", "x", "日本 語", "a" * 30_000]
    rows = [(3 * k, t) for k, t in enumerate(texts)] + [(500, None), (501, texts[5]), (502, texts[5])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x["doc_id"]: x for x in fingerprints.op4_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(rows, key=lambda x: -x[0])

    def alike(a, b):
        a, b = a.split("-"), b.split("-")
        either = sum(1 for x, y in zip(a, b, strict=True) if x or y) if len(a) == len(b) else 0
        return 1.0 if a == b else sum(1 for x, y in zip(a, b, strict=True) if x and x == y) / either if either else 0.0

    for (k, t), (n, follow) in zip(order, [*order[1:], order[0]], strict=True):
        t, follow, x = t or "", follow or "", got[k]
        half = len(t) // 2
        edited = t[: len(t) - half] + follow[:half]
        assert (x["n_chars"], x["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert math.isclose(x["near_edited"], alike(x["fingerprint"], x["edited_fingerprint"])) and math.isclose(x["near_next"], alike(x["fingerprint"], got[n]["fingerprint"]))
        if edited == t:
            assert x["fingerprint"] == x["edited_fingerprint"]
    assert got[501]["fingerprint"] == got[502]["fingerprint"] == got[15]["fingerprint"]


def test_likeness(spark):
    df = spark.createDataFrame([(["a", "", "c"], ["a", "", "d"]), (["a"], ["a"]), (["a"], ["b"]), (["a", "b", ""], ["x"]), (["", ""], ["", "q"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(fingerprints.likeness(F.col("a"), F.col("b"))).collect()] == [0.5, 1.0, 0.0, 0.0, 0.0]


# ---- language ---------------------------------------------------------------------------


def test_language(docs, rows, empty, repeated):
    held = crc_mod("doc_id", 3) == 1
    model = language.fit(docs.filter(~held))
    got = {r["doc_id"]: r for r in language.predict(docs, model, held).collect()}
    right = [got[k]["lang_pred"] == lang for k, t, lang, *_ in rows[:70] if len(t) > 30 and zlib.crc32(str(k).encode()) % 3 == 1]
    assert len(right) > 8 and np.mean(right) > 0.9
    assert all(got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= got[k]["score"] <= 1 for k in got)
    for k, t, *_ in rows:
        if t is None or not re.search(r"[^\W\d_]", t):
            assert got[k]["lang_pred"] == "und"
    none = language.fit(empty)
    assert {r["lang_pred"] for r in language.predict(docs, none, held).collect()} == {"und"}
    assert language.predict(empty, model, held).count() == 0 and language.predict(repeated, model, held).count() == repeated.count()


# ---- quality ----------------------------------------------------------------------------


def test_quality(spark, docs, empty, repeated):
    junk = [(5000 + k, "EDTH!! ERERER!! ON!! " * (k + 3)) for k in range(30)]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(junk, "doc_id long, text string"))
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 70, 2)] + [(5000 + k, 0, 0) for k in range(0, 30, 2)] + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    held = crc_mod("doc_id", 4) == 2
    model = quality.fit(every, labels, ~held)
    rows = every.select("doc_id", held.alias("held_out"), "text")
    got = {r["doc_id"]: r["score"] for r in quality.scored(rows, model).collect()}
    assert np.mean([got[k] >= 0.7 for k in range(1, 70, 2)]) > 0.9 and np.mean([got[5000 + k] < 0.7 for k in range(1, 30, 2)]) > 0.9
    assert abs(got[1005] - model["mean"]) < 1e-9 and all(0 <= s <= 1 for s in got.values())
    assert quality.fit(every, labels.filter("false"), ~held) is None
    assert {r["score"] for r in quality.scored(rows, None).collect()} == {0.5}
    assert quality.scored(empty.select("doc_id", held.alias("held_out"), "text"), model).count() == 0
    assert quality.scored(repeated.select("doc_id", held.alias("held_out"), "text"), model).count() == repeated.count()


def test_votes_against_brute_force():
    texts = [b"a b c", b"A B! C!", b"x x x x", b""]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    r = np.random.default_rng(1)
    lat = r.standard_normal((9, 4)).astype(np.float32)
    lat /= np.linalg.norm(lat, axis=1, keepdims=True)
    m = {"idf": np.ones(quality.TERMS, np.float32), "projection": r.standard_normal((quality.TERMS, 4)).astype(np.float32), "latent": lat, "label": r.integers(0, 2, 9).astype(np.float32), "weight": r.random(9).astype(np.float32) + 0.5, "mean": 0.3}
    z = quality.weighted(quality.term_counts(data, offs), m["idf"]) @ m["projection"]
    want = []
    for v in z:
        if np.linalg.norm(v) < 1e-9:
            want.append(0.3)
            continue
        sim = lat @ (v / np.linalg.norm(v))
        near = np.argsort(-sim)[:3]
        w = m["weight"][near] * np.maximum(sim[near], 0)
        want.append(float((w * m["label"][near]).sum() / w.sum()))
    assert np.allclose(quality.votes(m, data, offs, neighbours=3, block=2), want, atol=1e-4)


# ---- language model ---------------------------------------------------------------------


def toks(t):
    return [*(t or "").encode().lower().split(), None]


def test_base_scores_and_counts(docs, rows, empty, repeated):
    held = crc_mod("doc_id", 7) == 2
    model, weights, counts = lm.fit(docs.filter(~held))
    got = {r["doc_id"]: r for r in lm.likelihoods(docs, held, model, weights, counts).collect()}
    c = Counter()
    for k, t, *_ in rows:
        if zlib.crc32(str(k).encode()) % 7 != 2:
            c.update(toks(t))
    n, v = sum(c.values()), len(c)
    for k, t, *_ in rows:
        r, w = got[k], toks(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r["score"] < 0
    long = [k for k, t, *_ in rows if len(t or "") > 300]
    assert sum(got[k]["score"] for k in long) > sum(got[k]["base_score"] for k in long)
    assert lm.likelihoods(empty, held, model, weights, counts).count() == 0
    assert lm.likelihoods(repeated, held, model, weights, counts).count() == repeated.count()
    nothing = lm.fit(empty)
    assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in lm.likelihoods(docs, held, *nothing).collect())


def _network(seed=1):
    counts = np.sort(np.random.default_rng(seed).integers(1, 500, 60))[::-1].astype(np.float64)
    lay = recurrent.Layout(counts, np.ones(recurrent.RARE_CLASSES))
    return lay, recurrent.start_weights(lay, seed)


def test_score_is_a_distribution_and_carries_state():
    lay, w = _network()
    n = lay.words + recurrent.RARE_CLASSES
    h = np.random.default_rng(2).standard_normal((1, recurrent.HIDDEN)).astype(np.float32)
    p = np.exp(recurrent.log_probs(w, lay, np.repeat(h, n, 0), np.arange(n)))
    assert abs(p.sum() - 1) < 1e-4
    r = np.random.default_rng(3)
    parts = [r.integers(0, n, k) for k in (5, 90, 1, 33)]
    got = recurrent.score(w, lay, np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]), window=8)
    for ids, s in zip(parts, got, strict=True):
        h, total = np.zeros((1, recurrent.HIDDEN), np.float32), 0.0
        for i in ids:
            total += float(recurrent.log_probs(w, lay, h, np.array([i]))[0])
            h = recurrent.step(w, h, np.array([i]))
        assert math.isclose(total, s, rel_tol=1e-4)


def test_gradients():
    lay, w = _network()
    w = {k: v.astype(np.float64) for k, v in w.items()}
    r = np.random.default_rng(4)
    x = r.integers(0, lay.words + recurrent.RARE_CLASSES, (6, 1))
    begins = np.zeros((6, 1), bool)
    begins[0] = begins[3] = True

    def loss(w):
        h, total = np.zeros((1, recurrent.HIDDEN)), 0.0
        for k in range(6):
            h = np.where(begins[k][:, None], 0, h)
            total -= recurrent.log_probs(w, lay, h, x[k])[0]
            h = recurrent.step(w, h, x[k])
        return total

    grads = {}

    class Probe(recurrent.Trainer):
        def _apply(self, key, grad, rows=slice(None)):
            full = grads.setdefault(key, np.zeros_like(self.w[key]))
            full[rows] += grad

    Probe({k: v.copy() for k, v in w.items()}, lay, 0.1, streams=1).update(np.zeros((1, recurrent.HIDDEN)), x, begins)
    for key in ("u", "x", "c", "w"):
        flat = np.argsort(-np.abs(grads[key]).ravel())[:4]
        for f in flat:
            at = np.unravel_index(f, w[key].shape)
            eps = 1e-5
            up = {k: v.copy() for k, v in w.items()}
            up[key][at] += eps
            down = {k: v.copy() for k, v in w.items()}
            down[key][at] -= eps
            assert math.isclose((loss(up) - loss(down)) / (2 * eps), grads[key][at], rel_tol=2e-2, abs_tol=1e-4), key


# ---- personal data ----------------------------------------------------------------------

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 1 and any(int(x) > 255 for x in m[0].split("."))) or (k == 2 and not (13 <= len(d) <= 19 and pii.luhn(d))) or (k == 3 and not 9 <= len(d) <= 15):
                continue
            out.append((k, *m.span()))
    return out


ODD = ["a@b a@b.c.@d.e f@@g.h x@y.z@q.w.", "1.2.3.4.5.6.7.8.9 1..2.3.4 300.1.1.1 01.002.3.4", "4111 1111 1111 1111 4111-1111-1111-1111-0", "+1 (988) 555-2485 4524132264652876 + 1 +12", "é@x.de ü.ö@x.de", "@", "+", "9" * 50]


def test_base_spans_against_patterns(rows):
    for t in [*ODD, *(r[1] for r in rows)]:
        assert pii.base_spans(t or "") == brute_spans(t)


def test_long_words_take_linear_time():
    for t in ("1" * 400_000, "a" * 400_000 + "@", "1." * 200_000, "+1" * 200_000, "a@" * 200_000):
        pii.base_spans(t)


def runs_of(labels):
    out, k = set(), 0
    while k < len(labels):
        end = k + 1
        if labels[k]:
            while end < len(labels) and labels[end] == 2 + 2 * ((labels[k] - 1) // 2):
                end += 1
            out.add(((labels[k] - 1) // 2, k, end))
        k = end
    return out


def test_field_on_held_out_rows():
    """Other numbers, names and surroundings than in training."""
    r = np.random.default_rng(6)
    rows = []
    for words, labels in pii.labelled_rows(500, 77):
        more = ["".join(chr(97 + k) for k in r.integers(0, 26, 6)) for _ in range(r.integers(0, 9))]
        rows.append(([*more, *words, *more], [0] * len(more) + labels + [0] * len(more)))
    got = pii.field().decode([w for w, _ in rows])
    hit = [(runs_of(y), runs_of(g)) for (_, y), g in zip(rows, got, strict=True)]
    both, true, found = (sum(len(x) for x in v) for v in ([a & b for a, b in hit], [a for a, _ in hit], [b for _, b in hit]))
    assert both / true > 0.97 and both / found > 0.97
    for kind in range(4):
        assert sum(1 for _, b in hit for x in b if x[0] == kind) > 20


def test_field_adds_and_keeps():
    t = ["call (988) 555-2485 now", "+1 (269) 555-3296 4524132264652876 and", "license 4.0. on 2020-10-11", "mail jürgen@bücher.example", "host 10.0.0.1:8080 and", "pay 4111.1111.1111.1111 today"]
    base = [pii.base_spans(x) for x in t]
    full = pii.all_spans(t, base)
    assert all(set(b) <= set(s) for b, s in zip(base, full, strict=True))
    assert [[t[k][s:e] for _, s, e in sp] for k, sp in enumerate(full)] == [["(988) 555-2485"], ["4524132264652876", "+1 (269) 555-3296"], [], ["jürgen@bücher.example"], ["10.0.0.1"], ["4111.1111.1111.1111"]]


def test_decoding_is_exact():
    f, r = pii.field(), np.random.default_rng(1)

    def best(words):
        e = f.emissions([pii.features(words, k) for k in range(len(words))])
        a = e[0]
        for k in range(1, len(words)):
            a = (a[:, None] + f.move).max(0) + e[k]
        return a.max()

    def score(words, labels):
        e = f.emissions([pii.features(words, k) for k in range(len(words))])
        return sum(e[k, x] for k, x in enumerate(labels)) + sum(f.move[x, y] for x, y in zip(labels[:-1], labels[1:], strict=True))

    seqs = [w for w, _ in pii.labelled_rows(60, 9)] + [["x"] * n for n in (1, 2, 5, 700)] + [["7"], ["a", "7"], ["7", "a"]]
    seqs += [["x"] * int(r.integers(0, 700)) + w + ["y"] * int(r.integers(0, 700)) for w, _ in pii.labelled_rows(10, 10)]
    odd = pii.Field(pii.labelled_rows(20, 3), steps=3)
    odd.emit += r.standard_normal(odd.emit.shape)  # a field that labels plain words as well
    odd._ready()
    for f in (pii.field(), odd):
        for w, labels in zip(seqs, f.decode(seqs), strict=True):
            assert len(labels) == len(w) and math.isclose(best(w), score(w, labels), abs_tol=1e-6)
    assert f.decode([[], ["a"]])[0] == []


def test_personal_data_rows(docs, rows, empty, repeated):
    got = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    for k, t, *_ in rows:
        b = brute_spans(t)
        assert got[k]["base_sha256"] == hashlib.sha256(",".join(f"{pii.KINDS[x]}:{s}:{e}" for x, s, e in b).encode()).hexdigest()
        assert [got[k][f"n_{n}"] for n in pii.KINDS] == [sum(x == j for x, _, _ in b) for j in range(4)]
    assert pii.personal_data(empty).count() == 0 and pii.personal_data(repeated).count() == repeated.count()


# ---- tokens -----------------------------------------------------------------------------


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


def buffers(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def ids_of(v, texts):
    ids, at = v.encode(*buffers(texts))
    return [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:], strict=True)]


def odd_texts(n=400, seed=11):
    """Random strings of white space of all kinds, letters, marks, contractions and added tokens."""
    r = np.random.default_rng(seed)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x00", "\x7f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "a", "Word", "é", "ß", "×", "÷", "Ω", "日", "本語", "😀", "'", "'s", "'re", "'x", ".", ",", "-", "_", "12", "3", "½", "«", "…", "<|endoftext|>", "<|", "e\u0301", "averylongwordthatgoesbeyondakey"]
    return ["".join(parts[k] for k in r.integers(0, len(parts), r.integers(0, 14))) for _ in range(n)]


def test_tokens_equal_the_library(rows):
    tok = library()
    texts = [r[1] or "" for r in rows] + ["  a  b\n\n c ", "x\x1c y", "a <|endoftext|>  b", "it's we'll\tz\r\n", "²x ½ ª_a", "a\n b", "q\nr s\nt", " ", "\n"] + odd_texts()
    v = tokens.Vocabulary(tokens.default_tokenizer())
    for _ in range(2):  # the second time from the kept pieces
        assert ids_of(v, texts) == [[*e.ids, 0] for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(v, []) == [] and ids_of(v, [""]) == [[0]]


def test_small_tables_and_long_texts(rows):
    tok = library()
    for most in (0, 50):
        v = tokens.Vocabulary(tokens.default_tokenizer(), most)
        for r in rows:
            assert ids_of(v, [r[1] or ""]) == [[*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]]
        assert len(v.pieces.n) <= most
    for t in ("x" * 100_000, "ab c. " * 40_000, " " * 50_000, "é" * 50_000):
        assert ids_of(tokens.Vocabulary(tokens.default_tokenizer()), [t, "z"]) == [[*tok.encode(x, add_special_tokens=False).ids, 0] for x in (t, "z")]


def test_coder_round_trip():
    r = np.random.default_rng(7)
    ids = r.zipf(1.3, 20_000) % 5000
    c = tokens.Coder(tokens.scaled(np.bincount(ids, minlength=5000)))
    for n in (1, 1023, 1024, 1025, 20_000):
        x, words, (step, at, mid) = c.encode(ids[:n])
        assert (c.decode(n, x, words)[0] == ids[:n]).all()
        head, tail = c.decode(n, x, words, 0, step)[0], c.decode(n, mid, words[at:], step)[0]
        assert (np.concatenate([head, tail]) == ids[:n]).all()


def test_files(spark, docs, rows, empty, repeated, tmp_path):
    tok = library()
    path = tokens.encode_corpus(docs, block_ids=500, path=str(tmp_path / "files"))
    assert path == str(tmp_path / "files")
    got = {r["doc_id"]: r for r in tokens.decode(spark, path, keep_ids=True).collect()}
    start = 0
    for k, t, *_ in sorted(rows):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        r = got[k]
        assert (r["start"], r["n_tokens"], list(r["ids"]), r["ids_crc32"]) == (start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokens.decode(spark, tokens.encode_corpus(empty)).count() == 0
    rows = sorted(tokens.decode(spark, tokens.encode_corpus(repeated)).collect(), key=lambda r: r["start"])
    assert len(rows) == repeated.count() and [r["start"] for r in rows] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in rows])[:-1]]).tolist()
    known = [r["doc_id"] for r in rows]
    assert known == sorted(known, key=lambda k: (k is not None, k or 0))


def test_a_damaged_file_is_told(spark, docs, tmp_path):
    path = tokens.encode_corpus(docs, path=str(tmp_path / "files"))
    spark.read.parquet(f"{path}/blocks").withColumn("words", F.concat(F.col("words"), F.lit(b"x"))).write.parquet(f"{path}2/blocks")
    spark.read.parquet(f"{path}/frequencies").write.parquet(f"{path}2/frequencies")
    with pytest.raises(Exception, match="checksum"):
        tokens.decode(spark, f"{path}2").collect()
    spark.read.parquet(f"{path}/frequencies").withColumn("crc", F.col("crc") + 1).write.parquet(f"{path}3/frequencies")
    with pytest.raises(ValueError, match="checksum"):
        tokens.decode(spark, f"{path}3")


# ---- mixing -----------------------------------------------------------------------------


def fill(sizes, weights=(5, 2, 1), top=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    free, left, out = set(order), float(sum(sizes.values())), {}
    while True:
        level = left / sum(w[s] for s in free) if free else 0
        over = [s for s in free if w[s] * level > top * sizes[s]]
        if not over:
            return out | {s: w[s] * level for s in free}
        for s in over:
            out[s] = top * sizes[s]
            left -= out[s]
            free.remove(s)


def test_mix(docs, rows, empty, repeated):
    size = {r[0]: len(re.findall(WS, r[1] or "")) for r in rows}
    total = Counter()
    for r in rows:
        total[r[3]] += size[r[0]]
    want = fill(total)
    got = mixing.mixture(docs).collect()
    taken = Counter()
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[r["source"]] and math.isclose(r["target"], want[r["source"]], abs_tol=1e-6)
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = {s: max(size[r[0]] for r in rows if r[3] == s) for s in total}
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 for s in want)  # whole documents can't come nearer for sure
    assert sorted(map(str, mixing.mixture(docs.repartition(5)).collect())) == sorted(map(str, got))
    assert mixing.mixture(empty).count() == 0 and mixing.mixture(repeated).count() == repeated.count()


def drawn(rows, want):
    """Copies of each document: the level by halving, then a whole sort of each source by odds over odds."""
    size = {r[0]: len(re.findall(WS, r[1] or "")) for r in rows}
    out = {}
    for s, target in want.items():
        ids = [r[0] for r in rows if r[3] == s]
        share = {k: 2 ** (math.floor(math.log2(max(size[k] ** mixing.POWER, 1e-9)) * 16) / 16) for k in ids}
        low, high = 0.0, 1e12
        for _ in range(300):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(size[k] * min(3, mid * share[k]) for k in ids) < target else (low, mid)
        owed = {k: min(3.0, high * share[k]) for k in ids}
        left, order = target - sum(size[k] * math.floor(owed[k] + 1e-12) for k in ids), []
        for k in ids:
            out[k] = math.floor(owed[k] + 1e-12)
            part = owed[k] - out[k]
            if part > 1e-9:
                u = (int(hashlib.md5(f"{k}|mix".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                order.append(((u / (1 - u)) / (part / (1 - part)), k))
        before = 0
        rest = []
        for _, k in sorted(order):
            if before + size[k] <= left and not rest:
                out[k] += 1
                before += size[k]
            else:
                rest.append(k)
        near = [k for k in rest if 0 < size[k] and abs(left - before - size[k]) < left - before]
        if near:
            out[min(near, key=lambda k: abs(left - before - size[k]))] += 1
    return out


def test_draw_against_brute_force(spark):
    r = np.random.default_rng(3)
    rows = [(k, " ".join(["w"] * int(n)), None, f"s{k % 3}" if k % 7 else None) for k, n in enumerate(r.integers(0, 400, 300))]
    total = Counter()
    for x in rows:
        total[x[3]] += len(re.findall(WS, x[1]))
    got = {x["doc_id"]: x["copies"] for x in mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    want = drawn(rows, fill(total))
    differ = [k for k in want if got[k] != want[k]]
    assert len(differ) <= 4, [(k, got[k], want[k]) for k in differ]  # the bins' edge and equal gaps may part at rounding


def test_longer_documents_are_likelier(spark):
    rows = [(k, "w " * (2000 if k % 2 else 20), "a" if k % 4 < 2 else "b") for k in range(2000)]
    got = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 4), ceiling=9).filter("source = 'a'").collect()
    long, short = (np.mean([x["copies"] for x in got if x["size"] == n]) for n in (2000, 20))
    assert 0 < short < 0.5 * long < 1


def test_repeated_rows_close_once(spark):
    rows = [(1, "a b c d e", "x")] * 50 + [(2, "a b", "y")]
    got = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 1)).collect()
    taken, target = sum(x["taken"] for x in got if x["doc_id"] == 1), next(x["target"] for x in got if x["doc_id"] == 1)
    assert abs(taken - target) <= 5


def test_order_sample_prefers_weight(spark):
    d = spark.createDataFrame([(k, "w " * 10, "a" if k % 2 else "b", 9.0 if k % 4 == 1 else 1.0) for k in range(400)], "doc_id long, text string, source string, weight double")
    got = mixing.mixture(d, weights=(1, 3), weight="weight", keep=("weight",)).filter("source = 'a'").collect()
    heavy = [r["copies"] for r in got if r["weight"] > 1]
    light = [r["copies"] for r in got if r["weight"] == 1]
    assert np.mean(heavy) > 3 * np.mean(light)


def test_head_threshold(spark):
    rows = [(k, 0, n) for k, n in enumerate([100, 100, 50, 50, 7, 3, 3, 3, 1, 1, 1, 1])]
    counts = spark.createDataFrame(rows, "t long, k int, n long")
    for most in (0, 1, 2, 4, 5, 9, 12, 100):
        least = lm.head_threshold(counts, most)
        head = [n for _, _, n in rows if n >= least]
        assert len(head) <= most and (most < 2 or head)
    assert lm.head_threshold(counts.limit(0), 5) > 0
