"""Ranked lexical search: document-sharded postings with integer impacts.

1. ``index``: each slice of whole documents becomes a shard, a row of a written table: its dictionary (terms
   sorted by hash, with their bytes) and its postings in compressed sparse rows (documents ascending, and how
   often each holds the term).  Every term of every document is indexed.
2. ``search``: the items' terms, in blocks of ``BLOCK_TERMS``, are broadcast.  Document frequencies come from the
   shards' dictionaries; with them each shard computes the impacts of the block's postings once, then adds
   them up term at a time in a dense accumulator for each item.  ``argpartition`` finds the k-th score; all
   documents with that score are kept until doc_id decides.
3. Each task merges its shards' best k, then salted groups and at last each item merge theirs.

Terms are compared by hash and bytes.  Cases: null and empty texts have no terms and are never found; items
without terms, or whose terms no document has, give no rows; equal scores go by doc_id (null first), and rows
that share a doc_id are documents of their own; repeated items each get their rows; a text of any length is
one document of one shard; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, checkpoint_dir, numbered, own_columns, slices, table, word_bounds, word_hashes

#: Bytes of text in a shard (a longer text is a shard of its own).
SHARD = 4 << 20
#: Terms of the items of one pass (or one item's).
BLOCK_TERMS = 200_000
TOP_K = 20
#: Fixed values of the ranking: length's share, scale, and saturation of term frequencies.
LENGTH_SHARE, SCALE, SATURATION = 25, 1_000_000_000, 12

INSIDE = np.zeros(256, bool)
INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes, and of all terms: start, end, document, hash."""
    start, end, doc = word_bounds(INSIDE[data], offs)
    lower = LOWER[data]
    return lower, start, end, doc, word_hashes(lower, start, end)


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    skip = np.cumsum(size) - size
    return np.arange(size.sum()) - np.repeat(skip - first, size)


INDEX = "docs int, filled int, tokens long, doc_id binary, null_id binary, size binary, hash binary, word binary, word_end binary, first binary, doc binary, tf binary"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
_INDEX = pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in INDEX.split(", "))])


def shard(doc_id: pa.Array, data: np.ndarray, offs: np.ndarray) -> dict:
    lower, start, end, doc, h = terms(data, offs)
    size = np.bincount(doc, minlength=len(offs) - 1)
    order = np.argsort(h, kind="stable")  # documents stay in order
    hs, ds = h[order], doc[order]
    word = np.ones(len(hs), bool)
    word[1:] = hs[1:] != hs[:-1]
    post = word.copy()
    post[1:] |= ds[1:] != ds[:-1]
    at = np.flatnonzero(post)
    lead = order[np.flatnonzero(word)]
    length = end[lead] - start[lead]
    return {
        "docs": len(size), "filled": int((size > 0).sum()), "tokens": len(h),
        "doc_id": doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), "null_id": doc_id.is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes(),
        "size": size.astype("<u4").tobytes(), "hash": hs[word].astype("<u8").tobytes(), "word": lower[ranges(start[lead], length)].tobytes(), "word_end": np.cumsum(length).astype("<u4").tobytes(),
        "first": np.append(np.flatnonzero(word[at]), len(at)).astype("<u4").tobytes(), "doc": np.diff(ds[at], prepend=0).astype("<i4").tobytes(), "tf": np.diff(np.append(at, len(hs))).astype("<u4").tobytes(),
    }


def _index(batches):
    for rows, data, offs in slices(batches, limit=SHARD):
        yield pa.RecordBatch.from_pylist([shard(rows.column(0), data, offs)], _INDEX)


def index(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The shards, written under ``path`` (a folder of its own if none is named) in small row groups, since rows are large."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/vialstream-index-{uuid.uuid4().hex}"
    rows = own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_index, INDEX)
    rows.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).option("parquet.block.size.row.check.min", 1).option("parquet.page.size.row.check.min", 1).parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def _read(row: dict, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(row[name], kind).astype(np.int64 if kind != "<u8" else np.uint64)


class Terms:
    """Distinct terms of a block of items, found in a shard's dictionary by hash and bytes."""

    def __init__(self, words: list[bytes]) -> None:
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        h = word_hashes(data, ends - [len(w) for w in words], ends)
        self.order = np.argsort(h, kind="stable")
        self.hash, self.words = h[self.order], words

    def found(self, row: dict) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms that the shard has, and their numbers there."""
        theirs, word, ends = _read(row, "hash", "<u8"), row["word"], _read(row, "word_end", "<u4")
        at = np.minimum(np.searchsorted(theirs, self.hash), max(0, len(theirs) - 1))
        hit = np.flatnonzero(theirs[at] == self.hash) if len(theirs) else np.zeros(0, np.int64)
        mine, at = self.order[hit], at[hit]
        same = [word[int(ends[t - 1]) if t else 0 : int(ends[t])] == self.words[m] for m, t in zip(mine.tolist(), at.tolist(), strict=True)]
        same = np.array(same, bool)
        return mine[same], at[same]


def _frequencies(block):
    def run(batches):
        known = Terms(block.value[0])
        total = np.zeros(len(known.words), np.int64)
        for b in batches:
            for row in b.to_pylist():
                mine, at = known.found(row)
                first = _read(row, "first", "<u4")
                total[mine] += first[at + 1] - first[at]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    return run


def best(score: np.ndarray, doc_id: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """The k best documents with a score above 0: by score, then doc_id, null first."""
    some = np.flatnonzero(score > 0)
    if len(some) > k:
        least = score[some[np.argpartition(-score[some], k - 1)[k - 1]]]
        some = some[score[some] >= least]
    return some[np.lexsort((doc_id[some], ~null[some], -score[some]))][:k]


BEST = "item long, doc_id long, score long"


def _score(block, weight, n_docs: int, n_tokens: int, k: int):
    def run(batches):
        words, items = block.value
        known, w = Terms(words), weight.value
        held: dict[int, list[np.ndarray]] = defaultdict(list)  # of an item: its best so far as (score, doc_id, null)
        for b in batches:
            for row in b.to_pylist():
                mine, at = known.found(row)
                if not len(mine):
                    continue
                doc_id, null, size = _read(row, "doc_id", "<i8"), np.frombuffer(row["null_id"], "u1").astype(bool), _read(row, "size", "<u4")
                first, doc, tf = _read(row, "first", "<u4"), np.cumsum(_read(row, "doc", "<i4")), _read(row, "tf", "<u4")
                n = first[at + 1] - first[at]
                take = ranges(first[at], n)
                doc, tf = doc[take], tf[take]
                m = 100 - LENGTH_SHARE + (LENGTH_SHARE * size * n_docs) // n_tokens
                impact = np.repeat(w[mine], n) * ((SCALE * tf) // (1000 * tf + SATURATION * m[doc]))
                stop = np.cumsum(n)
                part = {t: (doc[e - c : e], impact[e - c : e]) for t, e, c in zip(mine.tolist(), stop.tolist(), n.tolist(), strict=True)}
                total = np.zeros(row["docs"], np.int64)
                for item, asked in items:
                    total[:] = 0
                    for t, times in asked:
                        if t in part:
                            total[part[t][0]] += times * part[t][1]
                    top = best(total, doc_id, null, k)
                    if len(top):
                        held[item].append(np.array([total[top], doc_id[top], null[top]]))
                        if len(held[item]) >= 16:
                            held[item] = [_merged(held[item], k)]
        out = [(i, _merged(x, k)) for i, x in held.items()]
        if out:
            every = np.concatenate([x for _, x in out], axis=1)
            item = np.repeat([i for i, _ in out], [x.shape[1] for _, x in out])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(every[1], mask=every[2].astype(bool)), pa.array(every[0])], ["item", "doc_id", "score"])

    return run


def _merged(parts: list[np.ndarray], k: int) -> np.ndarray:
    x = np.concatenate(parts, axis=1)
    return x[:, best(x[0], x[1], x[2].astype(bool), k)]


def _asked(batches):
    """(item, term, times) of items."""
    for rows, data, offs in slices(batches):
        lower, start, end, doc, _ = terms(data, offs)
        text = lower.tobytes()
        count: dict[tuple[int, bytes], int] = defaultdict(int)
        for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True):
            count[d, text[s:e]] += 1
        rid = rows.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([rid[d] for d, _ in count], pa.int64()), pa.array([t for _, t in count], pa.binary()), pa.array(count.values(), pa.int64())], ["item", "term", "times"])


def blocks(asked: DataFrame, most: int = BLOCK_TERMS):
    """Of each block of items: its distinct terms, and the items as (item, [(number of term, times)]).

    Blocks are hashed from the items' numbers, in as many as it takes that none has more than ``most`` rows or
    one item's; the driver holds one block at a time.
    """
    total, item = asked.groupBy("item").count().agg(F.sum("count"), F.max("count")).first()
    n = max(1, -(-(total or 0) // most))
    part = lambda: F.pmod(F.xxhash64("item"), F.lit(n))
    while n > 1 and asked.groupBy(part().alias("b")).count().agg(F.max("count")).first()[0] > max(most, item):
        n *= 2
    for k in range(n):
        number: dict[bytes, int] = {}
        items: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for r in asked.filter(part() == k).collect():
            items[r["item"]].append((number.setdefault(bytes(r["term"]), len(number)), r["times"]))
        if number:
            yield list(number), sorted(items.items())


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    shards = index(docs)
    n_docs, n_tokens = shards.agg(F.coalesce(F.sum("filled"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    items = numbered(own_columns(items, "item_id", "text"))
    asked = items.select("rid", "text").mapInArrow(_asked, "item long, term binary, times long").persist()
    found = spark.createDataFrame([], BEST)
    for block in blocks(asked, block_terms):
        shared = send(block)
        df = shards.select("hash", "word", "word_end", "first").mapInArrow(_frequencies(shared), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
        weight = np.zeros(len(block[0]), np.int64)
        for r in df:
            weight[r["term"]] = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
        found = found.unionByName(shards.drop("filled", "tokens").mapInArrow(_score(shared, send(weight), n_docs, n_tokens, k), BEST))
    asked.unpersist()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    found = found.withColumn("salt", F.spark_partition_id() % 64)
    for keys in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return found.join(items.select(F.col("rid").alias("item"), "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
