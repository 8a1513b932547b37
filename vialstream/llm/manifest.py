"""Merkle manifest of a dataset: per-source trees below one root, a proof for each row, and a check of tampered rows.

A leaf is the digest of a row's columns.  Leaves of a source ascend by doc_id; runs of ``FAN`` nodes become
their digest until one is left, the source's subroot; the subroots in the order of their sources make the root.

1. ``positions``: rows are sorted in ranges, and a prefix sum over ranges gives each row its place in its source.
2. Blocks of ``BLOCK`` consecutive nodes are reduced in parallel to one node each.  A source of any size is many blocks.
3. What is left, ``TOP`` nodes at most, is the top tree.  The driver builds it and broadcasts each block's path
   to the root (its suffix).  Where more is left (billions of rows, or very many sources), blocks are reduced
   again, and the suffixes of the lower nodes are made by the same step that finishes rows.
4. Each block is built once more beside its suffix: a row's siblings make its proof, and its (tampered) leaf is
   folded with them.

Cases: a null column counts as ``-``; a null doc_id comes first, and for the choice of tampered rows counts as
empty text; rows that share a doc_id are ordered by their leaves, identical rows each have a place; a null
source is a source of its own; no rows give no rows; texts of any length are hashed whole; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint_dir, crc_mod, own_columns, released, small, table, written

FAN = 3
#: Nodes of a block: 3 ** 7.
BLOCK = 2187
#: Nodes of the top tree at most: digests and suffixes of about 1 KB each, so 20 MB are broadcast at most.
TOP = 20_000
#: A leaf's columns, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row, as 32 bytes; ``changed`` columns take the place of the row's own."""
    return F.unhex(F.sha2(F.concat(*[_field(changed.get(c, F.col(c))) for c in FIELDS]).cast("binary"), 256))


def digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels(nodes: list[str], depth: int | None = None) -> list[list[str]]:
    """All levels above ``nodes``: ``depth`` of them, or until one node is left."""
    out = [nodes]
    while len(out) <= depth if depth is not None else len(out[-1]) > 1:
        low = out[-1]
        out.append([digest(low[k : k + FAN]) for k in range(0, len(low), FAN)])
    return out


Path = list[tuple[list[str], list[str]]]


def path(tree: list[list[str]], at: int) -> Path:
    """The left and right siblings of a node, level by level."""
    found = []
    for low in tree[:-1]:
        first = at - at % FAN
        found.append((low[first:at], low[at + 1 : first + FAN]))
        at //= FAN
    return found


def folded(node: str, way: Path) -> str:
    for left, right in way:
        node = digest([*left, node, *right])
    return node


def packed(way: Path) -> bytes:
    return b"".join(bytes([len(left) * FAN + len(right)]) + bytes.fromhex("".join([*left, *right])) for left, right in way)


def unpacked(raw: bytes) -> Path:
    found, at = [], 0
    while at < len(raw):
        n, m = divmod(raw[at], FAN)
        nodes = [raw[k : k + 32].hex() for k in range(at + 1, at + 1 + 32 * (n + m), 32)]
        found.append((nodes[:n], nodes[n:]))
        at += 1 + 32 * (n + m)
    return found


def positions(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Each row's place within its ``tree`` (``pos``), and its tree's number of rows (``n``); the order must be total."""
    order = [F.col("tree").asc_nulls_first(), *order]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("_p", F.shiftright("_m", 33))
    runs = rows.groupBy("_p", "tree").agg(F.min("_m").alias("first"), F.count("*").alias("size"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("size").over(whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("_p").alias("_q"), F.col("tree").alias("_t"), (before - F.col("first")).alias("_base"), F.sum("size").over(whole).alias("n"))
    rows = rows.join(small(runs, "runs"), (F.col("_p") == F.col("_q")) & F.col("tree").eqNullSafe(F.col("_t")))
    return rows.withColumn("pos", F.col("_m") + F.col("_base")).drop("_m", "_p", "_q", "_t", "_base")


def _blocked(nodes: DataFrame) -> DataFrame:
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes.withColumn("block", F.expr(f"pos div {BLOCK}")).repartition(parts, "tree", "block")


def _sorted(blocked: DataFrame) -> DataFrame:
    """Sorted last: a sort below a join would be taken out of the plan."""
    return blocked.sortWithinPartitions("tree", "block", "pos")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block at a time, in the order of their places; the input is sorted."""
    held: list[pa.RecordBatch] = []
    key = None

    for b in batches:
        trees, blocks = b.column("tree").to_pylist(), b.column("block").to_pylist()
        first = 0
        for k in range(b.num_rows + 1):
            if k < b.num_rows and (trees[k], blocks[k]) == key:
                continue
            if k > first:
                held.append(b.slice(first, k - first))
            if k < b.num_rows:
                if held:
                    yield pa.Table.from_batches(held)
                held, key, first = [], (trees[k], blocks[k]), k
    if held:
        yield pa.Table.from_batches(held)


def _tree(block: pa.Table, n: int) -> list[list[str]]:
    """A block's levels: those of a whole small tree, or as many as every block of a larger one has."""
    nodes = [d.hex() for d in block.column("digest").to_pylist()]
    return levels(nodes) if n <= BLOCK else levels(nodes, DEPTH)


DEPTH = next(k for k in range(64) if FAN**k == BLOCK)
NODE = "tree string, pos long, n long, digest binary"
_NODE = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])


def _roots(batches):
    rows: list[tuple] = []
    for block in _blocks(batches):
        n = block.column("n")[0].as_py()
        rows.append((block.column("tree")[0].as_py(), block.column("block")[0].as_py(), -(-n // BLOCK), bytes.fromhex(_tree(block, n)[-1][0])))
        if len(rows) >= 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(_NODE.names, r, strict=True)) for r in rows], _NODE)
            rows = []
    yield pa.RecordBatch.from_pylist([dict(zip(_NODE.names, r, strict=True)) for r in rows], _NODE)


SUFFIX = "tree string, pos long, suffix binary, subroot binary, root binary"
_SUFFIX = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("suffix", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])


def _suffixes(batches):
    """Nodes of blocks beside their block's suffix: the nodes' own suffixes."""
    for block in _blocks(batches):
        tree, rest = _tree(block, block.column("n")[0].as_py()), block.column("suffix")[0].as_py()
        mine = [packed(path(tree, k)) + rest for k in range(block.num_rows)]
        yield from pa.table([block.column("tree"), block.column("pos"), pa.array(mine, pa.binary()), block.column("subroot"), block.column("root")], schema=_SUFFIX).to_batches()


def top(rows: list[tuple], one_tree: bool) -> list[tuple]:
    """(tree, pos, suffix, subroot, root) of (tree, pos, digest) nodes; ``one_tree``: they are subroots in order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    trees: dict = {}
    for r in rows:
        trees.setdefault(r[0], []).append(bytes(r[2]).hex())
    inner = {t: levels(nodes) for t, nodes in trees.items()}
    outer = levels([inner[t][-1][0] for t in trees])
    if not rows:
        return []
    root = bytes.fromhex(outer[-1][0])
    above = {t: packed([] if one_tree else path(outer, k)) for k, t in enumerate(trees)}
    return [(t, p, packed(path(inner[t], p)) + above[t], bytes.fromhex(inner[t][-1][0]), root) for t, p, _ in rows]


def _joined(nodes: DataFrame, suffixes: DataFrame) -> DataFrame:
    s = suffixes.withColumnsRenamed({"tree": "_t", "pos": "_b"})
    return _sorted(_blocked(nodes).join(s, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("block") == F.col("_b"))).drop("_t", "_b"))


def suffixes(nodes: DataFrame, most: int = TOP, one_tree: bool = False) -> DataFrame:
    """(tree, pos, suffix, subroot, root) of (tree, pos, n, digest) nodes: from the driver's top tree, broadcast, where they are few."""
    spark = nodes.sparkSession
    many, largest = nodes.agg(F.count("*"), F.max("n")).first()
    if many <= most:
        found = top([tuple(r) for r in nodes.select("tree", "pos", "digest").collect()], one_tree)
        return F.broadcast(spark.createDataFrame(found, SUFFIX))
    if largest > 1:
        parents = written(_sorted(_blocked(nodes)).mapInArrow(_roots, NODE), "nodes")
        return written(_joined(nodes, suffixes(parents, most, one_tree)).mapInArrow(_suffixes, SUFFIX), "suffixes")
    row = positions(nodes.select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest"), [F.col("own").asc_nulls_first()])
    row = written(row, "subroots")
    above = suffixes(row.select("tree", "pos", "n", "digest"), most, True).withColumnsRenamed({"tree": "_t", "pos": "_q"})
    return row.join(above, F.col("pos") == F.col("_q")).select(F.col("own").alias("tree"), F.lit(0).cast("long").alias("pos"), "suffix", F.col("digest").alias("subroot"), "root")


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_RESULT = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())])


def _finish(batches):
    """Leaves of blocks beside their block's suffix: proofs and folds."""
    for block in _blocks(batches):
        tree = _tree(block, block.column("n")[0].as_py())
        rest = unpacked(block.column("suffix")[0].as_py())
        rest_text = "".join(x for left, right in rest for x in [*left, *right])
        subroot, root = (block.column(c)[0].as_py().hex() for c in ("subroot", "root"))
        proofs, folds = [], []
        for k, other in enumerate(block.column("other").to_pylist()):
            mine = path(tree, k)
            proofs.append(digest([x for left, right in mine for x in [*left, *right]] + [rest_text]))
            folds.append(folded(folded(other.hex() if other is not None else tree[0][k], mine), rest))
        n = len(folds)
        columns = [block.column("doc_id"), tree[0], [subroot] * n, [root] * n, proofs, folds, [f == root for f in folds]]
        yield from pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, _RESULT.field(k).type) for k, c in enumerate(columns)], schema=_RESULT).to_batches()


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, other): ``other`` is the tampered row's leaf (its text without line feeds), null where nothing is tampered."""
    rows = own_columns(docs, *FIELDS).withColumns({c: F.col(c).cast("long") for c in ("doc_id", "n_chars")})
    tampered = (crc_mod("doc_id", 2) == 0) & F.col("text").contains("\n")
    return rows.select("doc_id", "source", leaf().alias("leaf"), F.when(tampered, leaf(text=F.replace("text", F.lit("\n"), F.lit("")))).alias("other"))


def manifest(docs: DataFrame, most: int = TOP) -> DataFrame:
    """A row for each document: leaf, subroot, root, digest of its proof, and what its (tampered) leaf folds to."""
    checkpoint_dir(docs.sparkSession)
    own = written(leaves(docs).withColumn("rid", F.monotonically_increasing_id()), "leaves")
    nodes = positions(own.select(F.col("source").alias("tree"), "doc_id", F.col("leaf").alias("digest"), "other", "rid"), [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("rid")])
    nodes = written(nodes.drop("rid"), "places")
    released(own)
    parents = written(_sorted(_blocked(nodes.select("tree", "pos", "n", "digest"))).mapInArrow(_roots, NODE), "nodes")
    return _joined(nodes, suffixes(parents, most)).mapInArrow(_finish, RESULT)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
