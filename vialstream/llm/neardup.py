"""Near-duplicates by MinHash and an LSH forest, with links confirmed on full shingle sets.

1. Each text's set of ``SHINGLE``-word shingles (64-bit hashes) gets a digest and ``PERMUTATIONS`` minima of
   16 bits.  Texts with equal sets are one class; only classes go on.
2. ``tree_count(percent)`` orders sort the classes by different runs of ``DEPTH`` minima.  A region of an order
   is what shares the first ``LEAST`` minima, which no other order has first.  Within a region, classes join along the order: the neighbours with the
   longest common prefix first, then, where those leave parts, the depth drops step by step and the parts'
   members are compared at that depth, until at ``LEAST`` all of them were.  Two classes join if their minima
   agree in ``least_agreement(percent)`` places.  Only spanning edges
   leave a region.  Regions above ``BLOCK`` classes are cut into blocks, and every two blocks are compared.
3. The components of these edges are loose groups.  The texts of each group meet (in blocks, as above), and
   pairs not yet linked are confirmed on full sets: 100 * intersection >= ``percent`` * union.
4. The components of the confirmed links are the result.

A pair at the threshold meets in no order with a chance below ``MISS``, and agrees in too few minima with a
chance below ``MISS``; so it is missed with a chance below 1e-5.  Copies never expand into pairs.
Cases: a null text and one without words have an empty set, and stand alone; a text with fewer words than a
shingle has one shingle of all; rows are told apart by numbers of their own, so rows that repeat a doc_id or
have none are linked like others; a null doc_id is never a component's id if it has another member; no rows
give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, SPACE, mix, numbered, own_columns, released, slices, small, table, text_buffers, word_bounds, word_hashes, written
from .components import components

SHINGLE = 5
PERCENT = 85
STAGE_PERCENT = 80
DEPTH, LEAST = 8, 4
PERMUTATIONS = 128
MISS = 5e-6
BLOCK = 1024
BLOCK_BYTES = 2 << 20

_rng = np.random.Generator(np.random.PCG64(20))
_MULTIPLY = _rng.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_PLACE = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tree_count(percent: int) -> int:
    """So many orders that a pair at the threshold shares no region of any with a chance of ``MISS`` at most."""
    trees = math.ceil(math.log(MISS) / math.log(1 - min(percent / 100, 0.99) ** LEAST))
    if trees * LEAST > PERMUTATIONS:
        raise ValueError(f"{percent} % needs {trees} orders; {PERMUTATIONS} minima give {PERMUTATIONS // LEAST}")
    return trees


def least_agreement(percent: int) -> int:
    """The most minima that a pair at the threshold agrees in but for a chance of ``MISS`` at most."""
    p, tail = percent / 100, 0.0
    for k in range(PERMUTATIONS + 1):
        tail += math.comb(PERMUTATIONS, k) * p**k * (1 - p) ** (PERMUTATIONS - k)
        if tail > MISS:
            return k
    return PERMUTATIONS


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct shingle hashes, sorted, end to end, and the n + 1 bounds."""
    n = len(offs) - 1
    start, end, doc = word_bounds(~SPACE[data], offs)
    words = np.bincount(doc, minlength=n) if len(doc) else np.zeros(n, np.int64)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    w = word_hashes(LOWER[data], start, end)
    parts, owners = [], []
    if len(w) >= size:
        h = np.zeros(len(w) - size + 1, np.uint64)
        for k in range(size):
            h += w[k : k + len(h)] * _PLACE[k]
        same = doc[: len(h)] == doc[size - 1 :]
        parts.append(mix(h[same]))
        owners.append(doc[: len(h)][same])
    few = np.flatnonzero((words > 0) & (words < size))
    if len(few):
        first = np.searchsorted(doc, few)
        h = np.zeros(len(few), np.uint64)
        for k in range(size - 1):
            has = words[few] > k
            h[has] += w[first[has] + k] * _PLACE[k]
        parts.append(mix(h + words[few].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
        owners.append(few)
    h, who = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((h, who))
    h, who = h[order], who[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    h, who = h[new], who[new]
    return h, np.searchsorted(who, np.arange(n + 1))


def digests(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit digests of each set."""
    out = []
    for salt in (0x1234567, 0x89ABCDEF01):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(salt)), dtype=np.uint64)])
        out.append((sums[at[1:]] - sums[at[:-1]]).view(np.int64))
    return out[0], out[1]


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """PERMUTATIONS minima of each non-empty set, 16 bits each."""
    sizes = np.diff(at)
    some = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), PERMUTATIONS), np.uint16)
    if len(some):
        for p in range(PERMUTATIONS):
            v = ((h * _MULTIPLY[p] + _ADD[p]) >> np.uint64(32)).astype(np.uint32)
            m = np.minimum.reduceat(v, at[some])
            out[some, p] = (m ^ (m >> np.uint32(16))).astype(np.uint16)
    return out


SIGNED = "rid long, doc_id long, n_shingles long, h1 long, h2 long, n_bytes long, sig binary"


def _sign(batches):
    for rows, data, offs in slices(batches):
        h, at = shingle_sets(data, offs)
        h1, h2 = digests(h, at)
        sig = signatures(h, at)
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.diff(at)), pa.array(h1), pa.array(h2), pa.array(np.diff(offs)), pa.array([s.tobytes() for s in sig], pa.binary())], [x.split()[0] for x in SIGNED.split(", ")])


class Sets:
    """Disjoint sets of 0..n-1; the root is the least member."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _agree(sig: np.ndarray, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    return (sig[rows][:, None, :] == sig[others][None, :, :]).sum(2, dtype=np.int16)


def forest_edges(sig: np.ndarray, tree: int, need: int) -> list[tuple[int, int]]:
    """Spanning edges among the rows of one region of one order."""
    n = len(sig)
    part = sig[:, (tree * LEAST + np.arange(DEPTH)) % PERMUTATIONS]
    order = np.lexsort(part.T[::-1])
    edges, sets = [], Sets(n)
    if n > 1:  # neighbours in the order: the longest common prefixes
        a, b = order[:-1], order[1:]
        for x, y in zip(a[(ok := (sig[a] == sig[b]).sum(1) >= need)].tolist(), b[ok].tolist(), strict=True):
            if sets.join(x, y):
                edges.append((x, y))
    sorted_part = part[order]
    for depth in range(DEPTH, LEAST - 1, -1):
        cut = np.concatenate([[True], (sorted_part[1:, :depth] != sorted_part[:-1, :depth]).any(1), [True]])
        at = np.flatnonzero(cut)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if hi - lo < 3:
                continue
            rows = order[lo:hi]
            roots = np.array([sets.root(x) for x in rows.tolist()])
            if (roots == roots[0]).all():
                continue
            for k in range(0, len(rows), 128):
                some = rows[k : k + 128]
                hit = (_agree(sig, some, rows) >= need) & (roots[k : k + 128][:, None] != roots[None, :])
                for i, j in zip(*np.nonzero(hit), strict=True):
                    if sets.join(int(some[i]), int(rows[j])):
                        edges.append((int(some[i]), int(rows[j])))
    return edges


def confirmed_edges(sets_: list[np.ndarray], sig: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning edges of the links among full sets, the likeliest pairs first."""
    n = len(sets_)
    size = np.array([len(s) for s in sets_])
    need = least_agreement(percent)
    sets, edges = Sets(n), []
    cands: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in range(0, n, 64):
        rows = np.arange(k, min(n, k + 64))
        others = np.arange(k, n)
        agree = _agree(sig, rows, others)
        small = np.minimum(size[rows][:, None], size[others][None, :])
        large = np.maximum(size[rows][:, None], size[others][None, :])
        hit = (agree >= need) & (rows[:, None] < others[None, :]) & (100 * small >= percent * large)
        i, j = np.nonzero(hit)
        cands.append((rows[i], others[j], agree[i, j]))
    if not cands:
        return edges
    a, b, g = (np.concatenate(x) for x in zip(*cands, strict=True))
    for x in np.argsort(-g, kind="stable"):
        i, j = int(a[x]), int(b[x])
        if sets.root(i) == sets.root(j):
            continue
        s, t = (sets_[i], sets_[j]) if size[i] <= size[j] else (sets_[j], sets_[i])
        place = np.searchsorted(t, s)
        place[place == len(t)] = len(t) - 1
        common = int((t[place] == s).sum())
        if 100 * common >= percent * (len(s) + len(t) - common) and sets.join(i, j):
            edges.append((i, j))
    return edges


def _runs(batches, width: int):
    """Rows of each key (the first ``width`` columns) as one table; keys are sorted within the task."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = [tuple(k) for k in zip(*(b.column(c).to_pylist() for c in range(width)), strict=True)]
        lo = 0
        for k in range(1, len(keys) + 1):
            if k < len(keys) and keys[k] == keys[lo]:
                continue
            if held and keys[lo] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = keys[lo]
            held.append(b.slice(lo, k - lo))
            lo = k
    if held:
        yield last, pa.Table.from_batches(held)


def _signature_rows(column: pa.ChunkedArray) -> np.ndarray:
    data, _ = text_buffers(column)
    return np.frombuffer(data.tobytes(), np.uint16).reshape(-1, PERMUTATIONS)


def _edge_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])


def _region_edges(percent: int):
    need = least_agreement(percent)

    def run(batches):
        out: list[tuple[int, int]] = []
        for (tree, *_), rows in _runs(batches, 4):
            cid = rows.column(4).to_pylist()
            out += [(cid[x], cid[y]) for x, y in forest_edges(_signature_rows(rows.column(5)), tree, need)]
            if len(out) > 10_000:
                yield _edge_batch(out)
                out = []
        yield _edge_batch(out)

    return run


def _group_edges(percent: int):
    def run(batches):
        out: list[tuple[int, int]] = []
        for _, rows in _runs(batches, 3):
            sets_: list[np.ndarray] = []
            cid: list[int] = []
            for part, data, offs in slices(rows.to_batches()):
                h, at = shingle_sets(data, offs)
                sets_ += [h[at[k] : at[k + 1]].copy() for k in range(part.num_rows)]
                cid += part.column(3).to_pylist()
            part_at = np.concatenate([[0], np.cumsum([len(s) for s in sets_])])
            sig = signatures(np.concatenate(sets_) if sets_ else np.zeros(0, np.uint64), part_at)
            out += [(cid[x], cid[y]) for x, y in confirmed_edges(sets_, sig, percent)]
            if len(out) > 10_000:
                yield _edge_batch(out)
                out = []
        yield _edge_batch(out)

    return run


def _blocks(df: DataFrame, count, node: str = "cid") -> DataFrame:
    """Each row once for every pair of blocks that its own block belongs to: (x, y) with x <= y; (0, 0) for one block."""
    own = F.pmod(F.xxhash64(node, F.lit("block")), count).cast("int")
    df = df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    return df.withColumn("x", F.least("_own", "_other")).withColumn("y", F.greatest("_own", "_other")).drop("_own", "_other")


LINKED = ("rid", "doc_id", "n_shingles", "component_id", "kept", "first")


def linked_rows(rows: DataFrame, percent: int = PERCENT, used: list | None = None) -> DataFrame:
    """``LINKED`` of each row of a written table (rid, doc_id, text): ``first`` marks one row of each component.

    That row has the least doc_id, and of equal ones the least rid; rows without shingles are first each.
    ``used`` gets the tables that the result reads, for ``released``.
    """
    rows = own_columns(rows, "rid", "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    wide = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = written(rows.mapInArrow(_sign, SIGNED), "signed")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    same = signed.filter("n_shingles > 0").groupBy("h1", "h2", "n_shingles").agg(F.min(rank).alias("rep"), F.first("sig").alias("sig"), F.min("n_bytes").alias("n_bytes"))
    classes = written(same.withColumn("cid", F.monotonically_increasing_id()), "classes")
    if used is not None:
        used += [signed, classes]
    # regions with two classes or more
    keyed = classes.select("cid", F.explode(F.transform(F.sequence(F.lit(0), F.lit(tree_count(percent) - 1)), lambda t: F.struct(t.alias("tree"), F.substring(F.col("sig"), t * (2 * LEAST) + 1, F.lit(2 * LEAST)).alias("key")))).alias("k")).select("cid", "k.tree", "k.key")
    regions = keyed.groupBy("tree", "key").count().filter("count > 1")
    shared = keyed.join(regions, ["tree", "key"]).join(classes.select("cid", "sig"), "cid")
    shared = _blocks(shared, F.ceil(F.col("count") / BLOCK))
    shared = shared.repartition(2 * wide, "tree", "key", "x", "y").sortWithinPartitions("tree", "key", "x", "y")
    loose = components(shared.select("tree", "key", "x", "y", "cid", "sig").mapInArrow(_region_edges(percent), "a long, b long"))
    loose = loose.unionByName(loose.select(F.col("root").alias("node"), "root").distinct())
    # the texts of each loose group
    members = classes.select("cid", F.col("rep.rid").alias("rid"), "n_bytes").join(loose.withColumnRenamed("node", "cid"), "cid")
    groups = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    groups = groups.select("root", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).alias("parts"))
    members = small(members.join(groups, "root").select("rid", "cid", "root", "parts"), "members")
    texts = _blocks(rows.select("rid", "text").join(members, "rid"), F.col("parts"))
    texts = texts.repartition(2 * wide, "root", "x", "y").sortWithinPartitions("root", "x", "y", "cid")
    linked = components(texts.select("root", "x", "y", "cid", "text").mapInArrow(_group_edges(percent), "a long, b long"))
    # each class's component: the least row of its classes
    whole = classes.select("cid", "h1", "h2", "n_shingles", "rep").join(linked.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = whole.groupBy("root").agg(F.min("rep").alias("least"))
    named = whole.join(least, "root").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("n_shingles").alias("g3"), "least")
    out = signed.select("rid", "doc_id", "n_shingles", "h1", "h2").join(named, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("n_shingles") == F.col("g3")), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id"))
    out = out.select("rid", "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("rid") == F.col("least.rid"), F.lit(True)).alias("first"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select(*LINKED)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each document."""
    return linked_rows(numbered(own_columns(docs, "doc_id", "text")), percent).select(*LINKED[1:5])


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group at ``STAGE_PERCENT`` stays, that with the least id."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = numbered(own_columns(docs, *cols))
    used: list[DataFrame] = []
    gone = small(linked_rows(rows, STAGE_PERCENT, used).filter(~F.col("first")).select("rid"), "gone")
    released(*used)
    return rows.join(gone, "rid", "left_anti").select(*cols)
