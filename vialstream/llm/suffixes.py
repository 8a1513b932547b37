"""Exact removal of repeated ``LENGTH``-byte strings by a sampled suffix sort.

A difference cover samples suffixes so that any two positions have a sampled one at one common distance; the
sampled suffixes are sorted and named, the others are merged by the bytes up to the next sample, and adjacent
prefixes are compared.  Here the cover is chosen by content (a synchronizing set) instead of by residues of
the position, which would ship two thirds of all suffixes: of the ``WINDOW`` substrings of ``GRAM`` bytes in
a 100-byte string, the one with the least hash (the leftmost of equals) is its sample.  Equal strings thus
have the sample at an equal distance, wherever they start.  A sample serves a run of neighbouring starts.

1. Samples are sorted by name (hash of the gram), then by the hash of all bytes that their run's strings
   touch, then by place.  Where both are equal, all but the first of a class repeat earlier strings.
2. A name with several such classes needs the remaining suffixes: the bytes of each class's first run are
   fetched, and their strings compared under one name: (distance to the sample, 100-byte prefix), by place.
   A name with more than ``CROWD`` classes goes by string to many tasks, not to one.
3. All starts found so cover the bytes that go.

Equality of strings is equality of 64-bit hashes.  Place is (doc_id, start).  Cases: null, empty and short
texts lose nothing; texts of any length are cut into overlapping segments; rows that share a doc_id are
ordered by their text's hash, and identical rows are one document (each gets its result); a null doc_id comes
first; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rolling, mix, own_columns, slices, table, text_buffers, written

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1
SEGMENT = 4 << 20
CROWD = 20_000
_PLACE_BITS = 26


def samples(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of starts that share a sample: document, first start (in the buffer), number, sample's distance, name, class."""
    n = len(data)
    z = np.zeros(0, np.int64)
    if n < LENGTH:
        return z, z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    roll = Rolling(data)
    at = np.arange(n - GRAM + 1)
    name = mix((roll.sums[GRAM:] - roll.sums[: n - GRAM + 1]) * roll.down[: n - GRAM + 1])
    low = np.uint64((1 << _PLACE_BITS) - 1)
    m = (name & ~low) | at.astype(np.uint64)
    width = 1
    while 2 * width <= WINDOW:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if WINDOW > width:
        m = np.minimum(m[: len(m) - (WINDOW - width)], m[WINDOW - width :])
    chosen = (m & low).astype(np.int64)  # of the string that starts at each place
    sizes = np.diff(offs)
    valid = np.zeros(n + 1, np.int32)
    long = sizes >= LENGTH
    np.add.at(valid, offs[:-1][long], 1)
    np.add.at(valid, offs[1:][long] - LENGTH + 1, -1)
    ok = np.cumsum(valid)[: len(chosen)] > 0
    first = ok.copy()
    first[1:] &= ~(ok[:-1] & (chosen[1:] == chosen[:-1]))
    begins = offs[:-1][long]
    first[begins] = True
    start = np.flatnonzero(first)
    last = ok.copy()
    last[:-1] &= ~ok[1:] | first[1:]
    end = np.flatnonzero(last)
    doc = np.searchsorted(offs, start, "right") - 1
    far = chosen[start] - start
    klass = mix(roll.of(start, end + LENGTH) + far.astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
    return doc, start, end - start + 1, far, name[chosen[start]], klass


def _segments(data: np.ndarray, offs: np.ndarray):
    """(first document, base, data, offsets) of buffers of bounded size."""
    if len(offs) == 2 and len(data) > SEGMENT:
        for lo in range(0, len(data) - LENGTH + 1, SEGMENT):
            part = data[lo : lo + SEGMENT + LENGTH - 1]
            yield lo, part, np.array([0, len(part)])
    else:
        yield 0, data, offs


def _merge(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of starts, sorted, with those that touch joined."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], start[order] + n[order]
    if not len(doc):
        return doc, start, n
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.maximum.reduceat(stop, at) - start[at]


SAMPLE = "h long, c long, uid long, place long, n int"  # place: 128 * start + distance; n < 0: -n starts known to repeat


def _sample(batches):
    for rows, data, offs in slices(batches):
        uid = rows.column(0).to_numpy(zero_copy_only=False)
        for base, part, bounds in _segments(data, offs):
            doc, start, n, far, h, c = samples(part, bounds)
            own = start - bounds[doc] + base
            # the first of equal samples in this buffer stays, the others repeat it
            order = np.lexsort((own, uid[doc], c, h))
            same = np.zeros(len(order), bool)
            same[1:] = (h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1])
            keep, drop = order[~same], order[same]
            # identical rows are one document: equal places are no repeats
            if len(drop):
                lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))][same]
                drop = drop[(uid[doc[drop]] != uid[doc[lead]]) | (own[drop] != own[lead])]
            md, ms, mn = _merge(doc[drop], own[drop], n[drop])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([h[keep].view(np.int64), mix(uid[md].astype(np.uint64) + ms.astype(np.uint64)).view(np.int64)])),
                    pa.array(np.concatenate([c[keep].view(np.int64), np.zeros(len(md), np.int64)])),
                    pa.array(np.concatenate([uid[doc[keep]], uid[md]])),
                    pa.array(np.concatenate([own[keep] * 128 + far[keep], ms * 128])),
                    pa.array(np.concatenate([n[keep], -mn]).astype(np.int32)),
                ],
                ["h", "c", "uid", "place", "n"],
            )


FOUND = "open boolean, h long, uid long, place long, n int"


def _found(open_: bool, h, uid, place, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(uid), open_)), pa.array(h), pa.array(uid), pa.array(place), pa.array(n.astype(np.int32))], ["open", "h", "uid", "place", "n"])


def _classes(batches):
    """Sorted samples: repeats of a class's first are known; firsts of names with several classes stay open."""
    prev = None  # h, c, uid, place of the last class's first
    held = None  # the name's only class so far
    for b in batches:
        h, c, uid, place, n = (b.column(k).to_numpy(zero_copy_only=False) for k in range(5))
        known = n < 0
        if known.any():
            yield _found(False, h[known], uid[known], place[known], -n[known])
        real = np.flatnonzero(~known)
        if not len(real):
            continue
        h, c, uid, place, n = h[real], c[real], uid[real], place[real], n[real]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        if prev is not None:
            new[0] = (h[0], c[0]) != prev[:2]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
        lu = np.where(lead >= 0, uid[np.maximum(lead, 0)], prev[2] if prev else 0)
        lp = np.where(lead >= 0, place[np.maximum(lead, 0)], prev[3] if prev else 0)
        again = ~new & ((uid != lu) | (place != lp))
        if again.any():
            yield _found(False, h[again], uid[again], place[again] // 128 * 128, n[again])
        firsts = np.flatnonzero(new)
        if len(firsts):
            fh = h[firsts]
            head = held[0] if held is not None else None
            count_before = np.concatenate([[head is not None and head == fh[0]], fh[1:] == fh[:-1]])
            follows = np.concatenate([fh[:-1] == fh[1:], [False]])
            open_ = count_before | follows
            if held is not None:
                if count_before[0] and held[4] is not None:
                    yield _found(True, *(np.array([x]) for x in held[:1] + held[1:4]))
                    held = (*held[:4], None)
            out = firsts[open_]
            if len(out):
                yield _found(True, h[out], uid[out], place[out], n[out])
            k = firsts[-1]
            held = (h[k], uid[k], place[k], n[k], None if open_[-1] else True)
            prev = (h[k], c[k], uid[k], place[k])


CONTEXT = "h long, hot boolean, uid long, place long, n int, bytes binary"


def _fetch(batches):
    """The bytes that each open run's strings touch; columns: uid, text, open runs."""
    for b in batches:
        data, offs = text_buffers(b.column(1))
        out = [[], [], [], [], [], []]
        for k, runs in enumerate(b.column(2).to_pylist()):
            for r in runs:
                s = offs[k] + r["place"] // 128
                for column, v in zip(out, (r["h"], r["hot"], b.column(0)[k].as_py(), r["place"], r["n"], data[s : s + r["n"] + LENGTH - 1].tobytes()), strict=True):
                    column.append(v)
            if len(out[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, _CONTEXT_TYPES, strict=True)], _CONTEXT_NAMES)
                out = [[], [], [], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, _CONTEXT_TYPES, strict=True)], _CONTEXT_NAMES)


_CONTEXT_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
_CONTEXT_NAMES = [x.split()[0] for x in CONTEXT.split(", ")]


def _strings(h, place, n, blob: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all starts of the runs: key (name, distance, 100-byte prefix), row, and number within the run."""
    data, offs = text_buffers(blob)
    roll = Rolling(data)
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    s = offs[:-1][row] + step
    far = (place[row] % 128 - step).astype(np.uint64)
    return mix(roll.of(s, s + LENGTH) ^ mix(h.view(np.uint64)[row] + far)), row, step


def _repeats(batches):
    """Open runs sorted by name, then place: starts whose string an earlier run of the name has."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def solve(t: pa.Table):
        h, uid, place, n = (t.column(k).to_numpy() for k in (0, 2, 3, 4))
        key, row, step = _strings(h, place, n, t.column(5))
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        lead = first[back]
        dup = np.flatnonzero(lead != np.arange(len(key)))
        same = (uid[row[dup]] == uid[row[lead[dup]]]) & (place[row[dup]] // 128 + step[dup] == place[row[lead[dup]]] // 128 + step[lead[dup]])
        dup = dup[~same]
        d, s, m = _merge(row[dup], place[row[dup]] // 128 + step[dup], np.ones(len(dup), np.int64))
        return _found(False, h[d], uid[d], s * 128, m)

    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows < 20_000:
            continue
        t = pa.Table.from_batches(held)
        last = t.column(0)[-1]
        cut = pc.index(t.column(0), last).as_py()  # the last name may go on
        if cut:
            yield solve(t.slice(0, cut).combine_chunks())
        held = t.slice(cut).combine_chunks().to_batches()
        rows = t.num_rows - cut
    if held and rows:
        yield solve(pa.Table.from_batches(held))


def _explode(batches):
    for b in batches:
        for lo in range(0, b.num_rows, 4096):
            p = b.slice(lo, 4096)
            h, uid, place, n = (p.column(k).to_numpy() for k in (0, 2, 3, 4))
            key, row, step = _strings(h, place, n, p.column(5))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(uid[row]), pa.array(place[row] // 128 + step)], ["key", "uid", "start"])


def _numbered(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, text): uid is doc_id where ids are unique and not null, else a number in the order of places."""
    rows = own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.coalesce("text", F.lit("")))
    ids = rows.groupBy("doc_id").count().agg(F.max(F.when(F.col("doc_id").isNull(), 2).otherwise(F.col("count")))).first()[0]
    if (ids or 0) <= 1:
        return rows.select(F.col("doc_id").alias("uid"), "doc_id", "text")
    rows = rows.withColumn("th", F.xxhash64("text"))
    order = written(rows.select("doc_id", "th").distinct().orderBy(F.col("doc_id").asc_nulls_first(), "th").withColumn("uid", F.monotonically_increasing_id()), "uids")
    order = order.select(F.col("doc_id").alias("d2"), F.col("th").alias("t2"), "uid")
    return written(rows.join(order, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2"))).select("uid", "doc_id", "text"), "numbered")


def _release(spark: SparkSession) -> None:
    """Lets the driver drop shuffle files that no table needs any more."""
    spark.sparkContext._jvm.System.gc()


def repeated_starts(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(uid, start, n): ranges of starts whose string also starts earlier, for (uid, text) rows."""
    wide = 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sampled = rows.select("uid", "text").filter(F.length("text") >= LENGTH // 4).mapInArrow(_sample, SAMPLE)
    sampled = sampled.repartition(wide, "h").sortWithinPartitions("h", "c", "uid", "place")
    found = written(sampled.mapInArrow(_classes, FOUND), "found")
    del sampled
    _release(rows.sparkSession)
    crowded = found.filter("open").groupBy("h").count().filter(F.col("count") > crowd).select("h", F.lit(True).alias("hot"))
    runs = found.filter("open").join(crowded, "h", "left").groupBy("uid").agg(F.collect_list(F.struct("h", F.coalesce("hot", F.lit(False)).alias("hot"), "place", "n")).alias("runs"))
    context = rows.select("uid", "text").join(runs, "uid").select("uid", "text", "runs").mapInArrow(_fetch, CONTEXT)
    context = written(context, "context")
    _release(rows.sparkSession)
    quiet = context.filter("not hot").repartition(wide, "h").sortWithinPartitions("h", "uid", "place").mapInArrow(_repeats, FOUND)
    strings = context.filter("hot").mapInArrow(_explode, "key long, uid long, start long").distinct()
    least = strings.groupBy("key").agg(F.min(F.struct("uid", "start")).alias("first"))
    loud = strings.join(least, "key").filter(F.struct("uid", "start") != F.col("first")).select("uid", "start", F.lit(1).alias("n"))
    return found.filter("not open").unionByName(quiet).select("uid", F.floor(F.col("place") / 128).cast("long").alias("start"), "n").unionByName(loud)


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _cut(batches):
    for b in batches:
        data, offs = text_buffers(b.column(1))
        out = [[], [], [], [], []]
        for k, runs in enumerate(b.column(2).to_pylist()):
            text = data[offs[k] : offs[k + 1]]
            keep = np.ones(len(text), bool)
            spans = []
            if runs:
                s = np.array([r["start"] for r in runs], np.int64)
                e = s + np.array([r["n"] for r in runs], np.int64) - 1 + LENGTH
                _, s, n = _merge(np.zeros(len(s), np.int64), s, e - s)
                for x, y in zip(s.tolist(), (s + n).tolist(), strict=True):
                    keep[x:y] = False
                    spans.append({"start": x, "end": y})
            for column, v in zip(out, (len(text), int(len(text) - keep.sum()), len(spans), hashlib.sha256(text[keep].tobytes()).hexdigest(), spans), strict=True):
                column.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, t in zip(out, kinds, strict=True))], [x.split()[0] for x in REMOVED.replace("struct<start:long,end:long>", "").split(", ")])


def without_repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """A row for each document: what is removed (spans of bytes), and a digest of what stays."""
    rows = _numbered(docs)
    starts = repeated_starts(rows, crowd).groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    return rows.join(starts, "uid", "left").select("doc_id", "text", "runs").mapInArrow(_cut, REMOVED)


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
