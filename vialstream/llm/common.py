"""Shared helpers of the training-data operators: tables, checkpoints, byte-level batches."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty string."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.  On one machine without such a setting it lies beside the warehouse; a cluster must name one."""
    if d := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return d
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-checkpoints"


def numbered(df: DataFrame) -> DataFrame:
    """``df`` as a written table with a number ``rid`` for each row, the same in every later scan."""
    return written(df.withColumn("rid", F.monotonically_increasing_id()), "rows")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cuts the lineage by a Parquet table in the shared folder, and reads it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/vialstream-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of ids and numbers that are broadcast at most (tens of MB); beyond it the join shuffles.
MOST_BROADCAST = 400_000


def small(df: DataFrame, tag: str = "small") -> DataFrame:
    """A written table of ids and numbers, to be joined: broadcast if it is small, which is counted."""
    df = written(df, tag)
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def released(*tables: DataFrame) -> None:
    """Empties tables that ``written`` made and that nothing reads any more."""
    for df in tables:
        for path in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, taken by exact name, so that extra ones can't clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def range_shards(docs: DataFrame, shard_docs: int, most: int = 1 << 16, chunk: int = 256) -> tuple[DataFrame, int]:
    """``docs`` with a column ``shard``: the number of quantile cuts below doc_id (0 for null ids).

    The cuts are numbers, ``most`` at most; a row looks through the last cuts of all chunks, then through one chunk.
    """
    n = docs.count()
    parts = max(1, min(most, -(-n // shard_docs)))
    cuts: list = []
    if parts > 1:
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], max(10_000, 2 * parts))).first()[0] or []))
    if not cuts:
        return docs.withColumn("shard", F.lit(0)), 1
    chunks = [cuts[k : k + chunk] for k in range(0, len(cuts), chunk)]
    lasts = F.from_json(F.lit(json.dumps([c[-1] for c in chunks])), "array<bigint>")
    below = lambda a: F.size(F.filter(a, lambda c: c < F.col("doc_id")))
    docs = docs.withColumn("_chunk", F.greatest(below(lasts), F.lit(0)))
    inner = F.coalesce(F.try_element_at(F.from_json(F.lit(json.dumps(chunks)), "array<array<bigint>>"), F.col("_chunk") + 1), F.array().cast("array<bigint>"))
    shard = F.when(F.col("doc_id").isNull(), 0).otherwise(F.least(F.col("_chunk") * chunk + below(inner), F.lit(len(cuts))))
    return docs.withColumn("shard", shard.cast("int")).drop("_chunk"), len(cuts) + 1


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its n + 1 offsets; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


#: What operators keep in a Python worker between tasks, and how to drop it.
kept_by: dict[str, Callable[[], None]] = {}


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, owner: str = "") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of about ``limit`` bytes of text at most (a longer text is a slice of its own).

    Workers are used again by other operators: what anyone but ``owner`` keeps there is dropped first.
    """
    for name, drop in kept_by.items():
        if name != owner:
            drop()
    for batch in batches:
        data, offs = text_buffers(batch.column(batch.schema.get_field_index(column)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
            hi = min(n, max(hi, lo + 1))
            yield batch.slice(lo, hi - lo), data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            lo = hi


# ---- byte classes and hashes -------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on uint64 arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x = x * _M2
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_RADIX = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_RADIX, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """radix ** i and its inverse modulo 2 ** 64, for i up to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, base in enumerate((_RADIX, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


class Rolling:
    """Polynomial hashes of any range of one buffer, from one cumulative sum."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_HEAD_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words' bytes and lengths, eight bytes at a time; words above 64 bytes by blake2b."""
    words = np.ndarray(len(data) + 8, "<u8", np.concatenate([data, np.zeros(16, np.uint8)]), strides=(1,))
    size = end - start
    h = mix((words[start] & _HEAD_MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    left = np.flatnonzero(size > 8)
    for k in range(8, 64, 8):
        if not len(left):
            return h
        h[left] = mix(h[left] ^ (words[start[left] + k] & _HEAD_MASK[np.minimum(size[left] - k, 8)]))
        left = left[size[left] > k + 8]
    for k in left.tolist():
        h[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return h


def word_bounds(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each maximal run of ``inside`` bytes; documents part words."""
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(start, offs)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)
