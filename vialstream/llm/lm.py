"""LM scoring: training counts over all training text, a recurrent model, and whole-document log-likelihoods.

1. All training tokens are counted (64-bit token hashes; counts of each task are summed before the shuffle).
2. The ``HEAD`` most frequent tokens are broadcast with their counts; the ``recurrent.WORDS`` first of them
   are the network's words.
3. The network's starting weights come from a warm-up on about ``WARM_DOCS`` training documents, drawn by a hash
   of the id.  Then every task trains on its part of all training documents, from those weights; the results'
   mean, by tokens, is the model.  Means are taken slice by slice in the cluster.
4. Every document is scored whole, the state carried across windows.  Tokens outside the head join the
   counts, so that base_score and the rare tokens' part of score are exact.

Cases: a null or empty text is just its end; without training rows each token is as unlikely as the next
(N = V = 0); repeated rows are rows of their own and count as often; extra columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import recurrent
from .common import LOWER, SPACE, crc_mod, own_columns, slices, table, word_bounds, word_hashes, written

HEAD = 1 << 18
WARM_DOCS = 1000
WARM_UPDATES = 400
WARM_RATE, RATE = 0.06, 0.02
#: Distinct tokens that a counting task holds at most before it merges, and after that before it sends them on.
MOST_HELD, MOST_MERGED = 1_000_000, 750_000
TOGETHER = 4_000_000
PARTS = 64
END = np.uint64(0x5EED5EED5EED5EED)

_PUNCT = np.full(256, 3, np.uint8)
_PUNCT[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 0
_PUNCT[ord(".")], _PUNCT[ord(",")] = 1, 2


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with each document's end, their rare classes, and the n + 1 bounds of documents."""
    n = len(offs) - 1
    low = LOWER[data]
    start, end, doc = word_bounds(~SPACE[data], offs)
    sizes = (np.bincount(doc, minlength=n) if len(doc) else np.zeros(n, np.int64)) + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    h = np.empty(bounds[-1], np.uint64)
    k = np.zeros(bounds[-1], np.int8)
    last = bounds[1:] - 1
    inner = np.ones(len(h), bool)
    inner[last] = False
    h[last] = END
    if len(start):
        h[inner] = word_hashes(low, start, end)
        tail = _PUNCT[low[end - 1]]
        a = np.maximum(end - 1 - (tail > 0), start)
        b = np.maximum(a - 1, start)
        kinds = recurrent.RARE_CLASSES // 4
        k[inner] = tail * kinds + ((low[a].astype(np.int64) * 7 + low[b] * 3) % kinds)
    return h, k, bounds


class Table:
    """An open-addressing table of 64-bit keys, probed in vector form."""

    def __init__(self, keys: np.ndarray) -> None:
        size = 1 << max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.mask = np.uint64(size - 1)
        self.key, self.value = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        left, self.rounds = np.arange(len(keys)), 0
        while len(left):
            slot = ((keys[left] + np.uint64(self.rounds)) & self.mask).astype(np.int64)
            free = self.value[slot] < 0
            cand, cslot = left[free], slot[free]
            _, first = np.unique(cslot, return_index=True)
            self.key[cslot[first]], self.value[cslot[first]] = keys[cand[first]], cand[first]
            placed = np.zeros(len(keys), bool)
            placed[cand[first]] = True
            left = left[~placed[left]]
            self.rounds += 1

    def find(self, h: np.ndarray) -> np.ndarray:
        """Each key's number, or -1."""
        slot = (h & self.mask).astype(np.int64)
        out = np.where(self.key[slot] == h, self.value[slot], -1)
        left = np.flatnonzero((out < 0) & (self.value[slot] >= 0))
        for r in range(1, self.rounds):
            if not len(left):
                break
            slot = ((h[left] + np.uint64(r)) & self.mask).astype(np.int64)
            hit = (self.key[slot] == h[left]) & (self.value[slot] >= 0)
            out[left[hit]] = self.value[slot[hit]]
            left = left[~hit & (self.value[slot] >= 0)]
        return out


def _count(batches):
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        h, k, n = (np.concatenate(x) for x in zip(*held, strict=True))
        u, first, back = np.unique(h, return_index=True, return_inverse=True)
        return u, k[first], np.bincount(back, n).astype(np.int64)

    def batch(m):
        return pa.RecordBatch.from_arrays([pa.array(m[0].view(np.int64)), pa.array(m[1].astype(np.int32)), pa.array(m[2])], ["t", "k", "n"])

    for _, data, offs in slices(batches):
        h, k, _ = tokens(data, offs)
        u, first, n = np.unique(h, return_index=True, return_counts=True)
        held.append((u, k[first], n))
        size += len(u)
        if size > MOST_HELD:
            held = [merged()]
            size = len(held[0][0])
            if size > MOST_MERGED:
                yield batch(held[0])
                held, size = [], 0
    if held:
        yield batch(merged())


class Model:
    """What the tasks need of the counts: the head, the layout of classes, and the totals."""

    def __init__(self, head: list, total: int, distinct: int, classes: dict[int, tuple[int, int]]) -> None:
        """head: (hash, rare class, count) by falling count; classes: tokens and distinct ones of each rare class."""
        self.total, self.distinct = total, distinct
        key = np.array([r[0] for r in head], np.int64).view(np.uint64)
        self.count = np.array([r[2] for r in head], np.int64)
        kind = np.array([r[1] for r in head], np.int64)
        self.table = Table(key)
        words = min(recurrent.WORDS, len(head))
        rare, mass = np.zeros(recurrent.RARE_CLASSES), np.ones(recurrent.RARE_CLASSES)
        for c, (n, v) in classes.items():
            rare[c] += n
            mass[c] += n + v
        np.subtract.at(rare, kind[:words], self.count[:words])
        np.subtract.at(mass, kind[:words], self.count[:words] + 1)
        self.mass = np.log10(mass)
        self.layout = recurrent.Layout(self.count[:words], rare)
        self.words = words
        self.unit = np.log10(total + distinct + 1)
        self.log_count = np.log10(self.count + 1.0)

    def ids(self, h: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers in the head (-1: outside) and the network's ids."""
        at = self.table.find(h) if len(self.count) else np.full(len(h), -1, np.int32)
        return at, np.where((at >= 0) & (at < self.words), at, self.words + k.astype(np.int32)).astype(np.int32)


def _begins(bounds: np.ndarray) -> np.ndarray:
    b = np.zeros(bounds[-1], bool)
    b[bounds[:-1]] = True
    return b


def _warm(model):
    def run(batches):
        m = model.value
        texts = [(m.ids(h, k)[1], _begins(b)) for h, k, b in (tokens(data, offs) for _, data, offs in slices(batches))]
        w = recurrent.start_weights(m.layout)
        if texts:
            t = recurrent.Trainer(w, m.layout, WARM_RATE, streams=96)
            need = WARM_UPDATES * 96 * t.window
            while t.tokens < need:
                before = t.tokens
                for ids, begins in texts:
                    t.text(ids, begins)
                if t.tokens == before:
                    break
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(w)], pa.binary())], ["w"])

    return run


def _flat(w: dict) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def _train(model, start):
    def run(batches):
        m = model.value
        w = {k: v.copy() for k, v in start.value.items()}
        t = recurrent.Trainer(w, m.layout, RATE)
        for _, data, offs in slices(batches):
            h, k, b = tokens(data, offs)
            t.text(m.ids(h, k)[1], _begins(b))
        if t.tokens:
            parts = np.array_split(_flat(w) * np.float32(t.tokens / 1e6), PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS, dtype=np.int32)), pa.array([t.tokens / 1e6] * PARTS), pa.array([p.astype(np.float32).tobytes() for p in parts], pa.binary())], ["part", "n", "w"])

    return run


def _sum(batches):
    sums: dict[int, list] = {}
    for b in batches:
        for part, n, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            v = np.frombuffer(raw, np.float32).astype(np.float64)
            if part in sums:
                sums[part][0] += n
                sums[part][1] += v
            else:
                sums[part] = [n, v]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s[0] for s in sums.values()], pa.float64()), pa.array([s[1].tobytes() for s in sums.values()], pa.binary())], ["part", "n", "w"])


SCORED = "doc_id long, held_out boolean, n_tokens long, known long, base double, part double, tail array<long>"


def _score(model, weights):
    ln10 = np.log(10)

    def counted(m, rows, data, offs):
        """A slice's columns but for the network's part, and the network's ids."""
        h, k, b = tokens(data, offs)
        at, ids = m.ids(h, k)
        inside = at >= 0
        log_count = np.where(inside, m.log_count[np.maximum(at, 0)] if len(m.count) else 0.0, 0.0)
        starts, n = b[:-1], np.diff(b)
        base = np.add.reduceat(log_count, starts) - n * m.unit
        rare = np.add.reduceat(np.where(ids >= m.words, log_count - m.mass[k], 0.0), starts)
        known = np.add.reduceat(inside.astype(np.int64), starts)
        where = np.concatenate([[0], np.cumsum(n - known)]).astype(np.int32)
        tail = pa.ListArray.from_arrays(pa.array(where), pa.array(h[~inside].view(np.int64)))
        return rows.column(0), rows.column(1), n, known, base, rare, tail, ids

    def lines(m, held):
        """The network scores several slices together, so that a step's documents are many."""
        bounds = np.concatenate([[0], np.cumsum(np.concatenate([x[2] for x in held]))])
        p, first = recurrent.score(weights.value, m.layout, np.concatenate([x[7] for x in held]), bounds) / ln10, 0
        for doc_id, held_out, n, known, base, rare, tail, _ in held:
            part = p[first : first + len(n)] + rare
            first += len(n)
            yield pa.RecordBatch.from_arrays([doc_id, held_out, pa.array(n), pa.array(known), pa.array(base), pa.array(part), tail], [x.split()[0] for x in SCORED.split(", ")])

    def run(batches):
        m = model.value
        held, size = [], 0
        for rows, data, offs in slices(batches):
            held.append(counted(m, rows, data, offs))
            size += len(held[-1][7])
            if size >= TOGETHER:
                yield from lines(m, held)
                held, size = [], 0
        if held:
            yield from lines(m, held)

    return run


def head_threshold(counts: DataFrame, most: int) -> int:
    """The least count that ``most`` tokens at most have or exceed, to a sixteenth of an octave.

    Counts are summed in bins (about a thousand at any size), so no task sorts the tokens.
    """
    bins = counts.groupBy(F.floor(F.log2("n") * 16).alias("b")).agg(F.count("*").alias("v"), F.min("n").alias("least")).collect()
    held, least = 0, 1 << 62
    for r in sorted(bins, key=lambda r: -r["b"]):
        held += r["v"]
        if held > most:
            break
        least = r["least"]
    return least


def fit(train: DataFrame) -> tuple[Model, dict, DataFrame]:
    """The counts' model, the network's weights, and the table of all counts, from (doc_id, text) rows."""
    spark = train.sparkSession
    counts = written(train.select("text").mapInArrow(_count, "t long, k int, n long").groupBy("t", "k").agg(F.sum("n").alias("n")), "counts")
    total = counts.agg(F.sum("n"), F.count("*")).first()
    classes = {r["k"]: (r["n"], r["v"]) for r in counts.groupBy("k").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}  # RARE_CLASSES rows
    head = counts.filter(F.col("n") >= head_threshold(counts, HEAD)).toPandas().sort_values(["n", "t"], ascending=[False, True])  # HEAD rows at most
    model = Model(list(zip(head["t"], head["k"], head["n"], strict=True)), int(total[0] or 0), int(total[1]), classes)
    sent = spark.sparkContext.broadcast(model)
    # about WARM_DOCS ids by their hash; of each the least text
    n_docs = counts.filter(F.col("t") == int(END.view(np.int64))).agg(F.sum("n")).first()[0] or 1
    draw = F.xxhash64("doc_id", F.lit("warm"))
    warm = train.filter(F.shiftrightunsigned(draw, 1) / float(1 << 63) < WARM_DOCS / n_docs).groupBy(draw.alias("h")).agg(F.min("text").alias("text"))
    warmed = warm.repartition(1).sortWithinPartitions("h").select("text").mapInArrow(_warm(sent), "w binary").first()
    start = pickle.loads(warmed[0]) if warmed else recurrent.start_weights(model.layout)
    first = spark.sparkContext.broadcast(start)
    sums = train.select("text").mapInArrow(_train(sent, first), "part int, n double, w binary").repartition(PARTS, "part").mapInArrow(_sum, "part int, n double, w binary")
    means = {r["part"]: np.frombuffer(r["w"], np.float64) / r["n"] for r in sums.collect()}  # PARTS rows
    if means:
        flat, at = np.concatenate([means[k] for k in range(PARTS)]).astype(np.float32), 0
        for k in sorted(start):
            start[k] = flat[at : at + start[k].size].reshape(start[k].shape)
            at += start[k].size
    return model, start, counts


def likelihoods(docs: DataFrame, held_out, model: Model, weights: dict, counts: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    sent, w = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(weights)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    scored = written(rows.mapInArrow(_score(sent, w), SCORED).withColumn("rid", F.monotonically_increasing_id()), "scored")
    tails = scored.select("rid", F.explode("tail").alias("t")).join(counts.select("t", "n"), "t").groupBy("rid").agg(F.sum(F.log10(F.col("n") + 1)).alias("logs"), F.count("*").alias("more"))
    out = scored.drop("tail").join(tails, "rid", "left").withColumn("logs", F.coalesce("logs", F.lit(0.0))).withColumn("more", F.coalesce("more", F.lit(0)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("more")).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("logs")).alias("base_score"), (F.col("part") + F.col("logs")).alias("score"),
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = own_columns(table(spark, sf_dir, "documents"), "doc_id", "text")
    held_out = crc_mod("doc_id", 7) == 2
    return likelihoods(docs, held_out, *fit(docs.filter(~held_out)))
