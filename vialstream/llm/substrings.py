"""Exact removal of word windows that an earlier document has, by difference-cover anchors.

Of the positions of a document only those whose remainder modulo ``PERIOD`` is in ``COVER`` are anchors.  The
differences of the cover's members are all remainders, so two equal windows of ``WINDOW`` words, wherever they
start, have an anchor at one common distance below ``PERIOD``; the ``ANCHOR`` words that start there lie within
both.  An anchor stands for the windows around it (its context: ``PERIOD - 1`` words more on either side).

1. ``_scan`` hashes anchors and contexts of whole texts.  Equal contexts are one class: all windows in it repeat
   those of its earliest document.  Within a slice all but the earliest are found at once, so that a slice sends
   one entry an anchor, however many copies it holds.
2. Anchors meet by hash.  Again all but a class's earliest are found.  Where one anchor has several contexts, the
   earliest of each class stays open: its match has to be extended.
3. Extension: the windows around open anchors are hashed whole, and the earliest document of each is kept.  A
   slice whose own documents show that an anchor is open extends it at once, and tells so to the others.
4. The windows found cover the words that go.

Entries travel packed, as columns of bytes, by ranges of hashes.  Equality is that of 96 bits of hashes.
Cases: null, empty and short texts lose nothing; a null doc_id counts as less than all others; rows that share
a doc_id don't take words from each other, and each row has a result, identical ones the same; a document's
own repeats stay; a text of any length is judged whole (its word bounds are held at once, the rest by segments);
no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, mix, own_columns, powers, released, slices, table, word_bounds, word_hashes, written

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text of a slice (a longer text is a slice of its own), and words hashed at once.
SLICE = 4 << 20
SEGMENT_WORDS = 1 << 20
#: Bytes of text behind one range of hashes, and behind one task.
RANGE_BYTES, TASK_BYTES = 2 << 20, 32 << 20
#: Rows of runs, and their bytes, that are broadcast to texts at most; beyond it texts are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
NO_ID = -(1 << 63)

_IS_ANCHOR = np.isin(np.arange(PERIOD), COVER)
_OTHER = np.uint64(0xD1B54A32D192ED03)

# ---- words and hashes --------------------------------------------------------------------


class Words:
    """Words of a piece of text: their documents (numbers within the slice), positions there, and hashes of their ranges."""

    def __init__(self, h: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> None:
        n = len(h)
        self.doc, self.pos = doc, pos
        bounds = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.append(bounds, n))
        self.first, self.last = np.repeat(bounds, sizes), np.repeat(bounds + sizes, sizes)
        up, self.down = powers(n + 1)
        self.sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(x) * up[:n])]) for x in (h, h ^ _OTHER)]

    def hash(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[k][end] - self.sums[k][start]) * self.down[start] + (end - start).astype(np.uint64))

    def anchors(self) -> tuple[np.ndarray, ...]:
        """Of each anchor in a document of a window or more: hash, context's hash, first word and number of its windows."""
        s = np.flatnonzero(_IS_ANCHOR[self.pos % PERIOD])
        s = s[(s + ANCHOR <= self.last[s]) & (self.last[s] - self.first[s] >= WINDOW)]
        lo, hi = np.maximum(self.first[s], s - (PERIOD - 1)), np.minimum(self.last[s], s + WINDOW)
        ok = hi - lo >= WINDOW
        s, lo, hi = s[ok], lo[ok], hi[ok]
        context = mix(self.hash(1, lo, hi) + (s - lo).astype(np.uint64) * _OTHER)
        return self.hash(0, s, s + ANCHOR), (context >> np.uint64(32)).astype(np.uint32), lo, hi - lo - WINDOW + 1

    def windows(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of the windows that start at words ``s``."""
        return self.hash(0, s, s + WINDOW), (self.hash(1, s, s + WINDOW) >> np.uint64(32)).astype(np.uint32)


def pieces(data: np.ndarray, offs: np.ndarray) -> Iterator[Words]:
    """The words of a slice, or of the segments of a long text, each with a window's words less one of the next."""
    start, end, doc = word_bounds(~SPACE[data], offs)
    pos = np.arange(len(start)) - np.searchsorted(start, offs)[doc]
    for lo in range(0, max(1, len(start) - WINDOW + 1), SEGMENT_WORDS) if len(offs) == 2 else (0,):
        hi = min(len(start), lo + SEGMENT_WORDS + WINDOW - 1) if len(offs) == 2 else len(start)
        yield Words(word_hashes(data, start[lo:hi], end[lo:hi]), doc[lo:hi], pos[lo:hi])


# ---- packed entries ------------------------------------------------------------------------

#: An entry: hash, second hash, doc_id, text's hash (where a doc_id has many), first window, number of windows (OPENED: extended already).
Entries = list[np.ndarray]
_KINDS = ("<u8", "<u4", "<i8", "<i8", "<u4", "u1")
OPENED = 0x80
ROW = "kind int, part int, blob binary"
ANCHORS, WINDOWS, FOUND, OPEN = range(4)
_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("blob", pa.binary())])


def taken(e: Entries, at: np.ndarray) -> Entries:
    return [x[at] for x in e]


def packed(kind: int, e: Entries, parts: int) -> Iterator[pa.RecordBatch]:
    """Entries by ranges of their hash, or for a kind that goes to documents, by document."""
    if not len(e[0]):
        return
    key = e[0] if kind in (ANCHORS, WINDOWS) else mix(e[2].view(np.uint64) ^ e[3].view(np.uint64))
    part = ((key >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, e = part[order], taken(e, order)
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
    blobs = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        x = [c[a:b] for c in e]
        x[2], x[3] = np.diff(x[2], prepend=0), np.diff(x[3], prepend=0)
        columns = range(6) if kind in (ANCHORS, WINDOWS) else range(2, 6)
        blobs.append(b"".join(np.ascontiguousarray(x[c], _KINDS[c]).tobytes() for c in columns))
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(blobs), kind, np.int32)), pa.array(part[cuts[:-1]]), pa.array(blobs, pa.binary())], schema=_SCHEMA)


def unpacked(kind: int, blobs: list[bytes]) -> Entries:
    columns = list(range(6) if kind in (ANCHORS, WINDOWS) else range(2, 6))
    width = [np.dtype(_KINDS[c]).itemsize for c in columns]
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    for blob in blobs:
        n, at = len(blob) // sum(width), 0
        for c, w in zip(columns, width, strict=True):
            x = np.frombuffer(blob, _KINDS[c], n, at)
            out[c].append(np.cumsum(x) if c in (2, 3) else x)
            at += n * w
    return [np.concatenate(x) if x else np.zeros(0, _KINDS[c]) for c, x in enumerate(out)]


def _grouped(batches, others: bool = False) -> Iterator:
    """(kind, entries) of one range at a time; rows come sorted by kind and part.  ``others``: kinds that pass as they are."""
    held: list[bytes] = []
    key = None
    for b in batches:
        kinds, parts, blobs = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
        if others:
            pass_on = pa.array([k in (WINDOWS, FOUND) for k in kinds])
            if any(pass_on.to_pylist()):
                yield None, b.filter(pass_on)
        for k, part, blob in zip(kinds, parts, blobs, strict=True):
            if others and k in (WINDOWS, FOUND):
                continue
            if (k, part) != key:
                if held:
                    yield key[0], unpacked(key[0], held)
                held, key = [], (k, part)
            held.append(blob.as_py())
    if held:
        yield key[0], unpacked(key[0], held)


class Classes:
    """Entries whose hash repeats, sorted into groups of one hash and classes of both hashes; ``alone``: the others."""

    def __init__(self, e: Entries) -> None:
        h, c, ids = e[:3]
        order = np.argsort(h, kind="stable")
        hs = h[order]
        size = np.diff(np.append(np.flatnonzero(np.append(True, hs[1:] != hs[:-1])), len(hs))) if len(hs) else np.zeros(0, np.int64)
        many = np.repeat(size > 1, size)
        self.alone, rest = order[~many], order[many]
        self.rest = rest = rest[np.lexsort((ids[rest], c[rest], h[rest]))]
        h, c, ids = h[rest], c[rest], ids[rest]
        if not len(rest):
            self.first = self.open = self.lead = np.zeros(0, bool)
            self.group = np.zeros(0, np.int64)
            return
        new_group = np.append(True, h[1:] != h[:-1])
        new_class = new_group | np.append(True, c[1:] != c[:-1])
        self.group, klass = np.cumsum(new_group) - 1, np.cumsum(new_class) - 1
        groups, classes = np.flatnonzero(new_group), np.flatnonzero(new_class)
        #: Of its class's earliest document.
        self.first = ids == ids[classes][klass]
        least, most = np.minimum.reduceat(ids, groups), np.maximum.reduceat(ids, groups)
        #: Several contexts of several documents.
        self.open = ((np.bincount(self.group[classes]) > 1) & (least < most))[self.group]
        # the first class that has the group's earliest document
        has = ids[classes] == least[self.group[classes]]
        leads = np.full(len(groups), len(classes))
        np.minimum.at(leads, self.group[classes][has], np.flatnonzero(has))
        self.lead = self.first & (klass == leads[self.group])


def merged(e: Entries) -> Entries:
    """Runs of windows, those of one document that touch joined."""
    ids, th, start = e[2], e[3], e[4].astype(np.int64)
    n = (e[5] & (OPENED - 1)).astype(np.int64)
    order = np.lexsort((start, th, ids))
    ids, th, start, stop = ids[order], th[order], start[order], (start + n)[order]
    if not len(ids):
        return [ids, th, start, n]
    new = np.append(True, (ids[1:] != ids[:-1]) | (th[1:] != th[:-1]))
    # the farthest end so far, within a document
    base = (np.cumsum(new) - 1) * (int(stop.max()) + 1)
    far = np.maximum.accumulate(stop + base)
    new[1:] |= start[1:] + base[1:] > far[:-1]
    at = np.flatnonzero(new)
    return [ids[at], th[at], start[at], np.maximum.reduceat(stop, at) - start[at]]


# ---- steps ---------------------------------------------------------------------------------


def _extended(w: Words, starts: np.ndarray, ids: np.ndarray, th: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Windows at ``starts``: a slice's earliest of each go to meet the others', the rest repeat them."""
    h, c = w.windows(starts)
    e = [h, c, ids[w.doc[starts]], th[w.doc[starts]], w.pos[starts].astype(np.uint32), np.ones(len(starts), np.uint8)]
    k = Classes(e)
    yield from packed(WINDOWS, taken(e, np.concatenate([k.alone, k.rest[k.first]])), parts)
    yield from packed(FOUND, taken(e, k.rest[~k.first]), parts)


def _marks(n: int, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers in the ranges, once each."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + size, -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def _scan(parts: int):
    """Columns: doc_id, text's hash, text."""

    def run(batches):
        for rows, data, offs in slices(batches, limit=SLICE):
            ids, th = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for w in pieces(data, offs):
                h, c, lo, n = w.anchors()
                e = [h, c, ids[w.doc[lo]], th[w.doc[lo]], w.pos[lo].astype(np.uint32), n.astype(np.uint8)]
                k = Classes(e)
                opened = k.rest[k.open & k.first]
                e[5][k.rest[k.open & k.lead]] |= OPENED
                yield from packed(ANCHORS, taken(e, np.concatenate([k.alone, k.rest[k.first & (~k.open | k.lead)]])), parts)
                yield from packed(FOUND, taken(e, k.rest[~k.first]), parts)
                yield from _extended(w, _marks(len(w.doc), lo[opened], n[opened]), ids, th, parts)

    return run


def _meet(parts: int):
    """Anchors of one range of hashes: what repeats, and what stays open; windows and runs found pass."""

    def run(batches):
        for kind, e in _grouped(batches, others=True):
            if kind is None:
                yield e
                continue
            k = Classes(e)
            yield from packed(FOUND, taken(e, k.rest[~k.first]), parts)
            if len(k.rest):
                told = (e[5][k.rest] & OPENED) > 0
                some = np.zeros(k.group[-1] + 1, bool)
                some[k.group[told]] = True
                yield from packed(OPEN, taken(e, k.rest[k.first & ~told & (k.open | some[k.group])]), parts)

    return run


def _extend(parts: int):
    """Columns: doc_id, text's hash, text, runs."""

    def run(batches):
        for rows, data, offs in slices(batches, limit=SLICE):
            ids, th = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            runs = [np.frombuffer(x.as_buffer(), "<i8").reshape(-1, 2) for x in rows.column(3)]
            doc = np.repeat(np.arange(len(runs)), [len(x) for x in runs])
            runs = np.concatenate(runs)
            for w in pieces(data, offs):
                if not len(w.doc):
                    continue
                # a run's windows that lie whole in this piece
                base = np.full(len(offs) - 1, -1)
                head = np.flatnonzero(w.first == np.arange(len(w.doc)))
                base[w.doc[head]] = head
                at = base[doc]
                here = at >= 0
                at, first, n = at[here], runs[here, 0], runs[here, 1]
                lo = np.maximum(at, at + first - w.pos[at])
                hi = np.minimum(w.last[at] - WINDOW + 1, at + first - w.pos[at] + n)
                ok = lo < hi
                yield from _extended(w, _marks(len(w.doc), lo[ok], (hi - lo)[ok]), ids, th, parts)

    return run


def _first(parts: int):
    def run(batches):
        for _, e in _grouped(batches):
            k = Classes(e)
            yield from packed(FOUND, taken(e, k.rest[~k.first]), parts)

    return run


RUNS = "id long, th long, runs binary"
_RUNS = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("runs", pa.binary())])


def _collect(batches):
    """One row a document: its runs of windows as pairs of first word and number."""
    for _, e in _grouped(batches):
        ids, th, start, n = merged(e)
        cuts = np.append(np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (th[1:] != th[:-1]))), len(ids))
        both = np.stack([start, n], axis=1).astype("<i8")
        blobs = [both[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[cuts[:-1]]), pa.array(th[cuts[:-1]]), pa.array(blobs, pa.binary())], schema=_RUNS)


REMOVED = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>"
_REMOVED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _cut(batches):
    """Columns: doc_id, text, runs."""
    for rows, data, offs in slices(batches):
        out: list[list] = [[], [], [], []]
        for k, blob in enumerate(rows.column(2)):
            words = data[offs[k] : offs[k + 1]].tobytes().split()
            total, spans = len(words), []
            if blob.is_valid:
                runs = np.frombuffer(blob.as_buffer(), "<i8").reshape(-1, 2)
                start, stop = runs[:, 0], runs.sum(axis=1) - 1 + WINDOW
                new = np.append(True, start[1:] > stop[:-1])
                at = np.flatnonzero(new)
                start, stop = start[at], np.maximum.reduceat(stop, at)
                keep = np.ones(total, bool)
                for a, b in zip(start.tolist(), stop.tolist(), strict=True):
                    keep[a:b] = False
                    spans.append({"start": a, "end": b})
                words = list(compress(words, keep))
            for column, v in zip(out, (total, total - len(words), hashlib.sha256(b" ".join(words)).hexdigest(), spans), strict=True):
                column.append(v)
        yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(v, _REMOVED.field(c + 1).type) for c, v in enumerate(out))], schema=_REMOVED)


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, id, th, text): ``th`` tells the texts of one doc_id apart, 0 where it has one row."""
    rows = own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    many = written(rows.groupBy("id").count().filter("count > 1").select(F.col("id").alias("many")), "many")
    n = many.count()
    if n == 0:
        return rows.select("doc_id", "id", F.lit(0).cast("long").alias("th"), "text")
    rows = rows.join(F.broadcast(many) if n <= BROADCAST_ROWS else many, F.col("id") == F.col("many"), "left")
    return rows.select("doc_id", "id", F.when(F.col("many").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long")).alias("th"), "text")


def _beside(rows: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    """``rows`` with their documents' runs: broadcast if they are few, which is counted."""
    n, size = runs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("runs")), F.lit(0))).first()
    runs = runs.withColumnsRenamed({"id": "_id", "th": "_th"})
    few = n <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    return rows.join(F.broadcast(runs) if few else runs, (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th")), how)


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(id, th, runs): each document's windows that a lesser id's document has, for (id, th, text) rows."""
    spark = rows.sparkSession
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks, parts = max(least, size // TASK_BYTES), max(least, size // RANGE_BYTES)
    dealt = lambda df: df.repartition(tasks, "part").sortWithinPartitions("kind", "part")
    found = written(dealt(rows.select("id", "th", "text").filter(F.length("text") >= 2 * WINDOW - 1).mapInArrow(_scan(parts), ROW)).mapInArrow(_meet(parts), ROW), "found")
    open_ = written(dealt(found.filter(F.col("kind") == OPEN)).mapInArrow(_collect, RUNS), "open")
    more = written(_beside(rows.select("id", "th", "text"), open_, "inner").select("id", "th", "text", "runs").mapInArrow(_extend(parts), ROW), "extended")
    every = found.unionByName(more)
    last = dealt(every.filter(F.col("kind") == WINDOWS)).mapInArrow(_first(parts), ROW)
    runs = written(dealt(every.filter(F.col("kind") == FOUND).unionByName(last)).mapInArrow(_collect, RUNS), "runs")
    released(found, open_, more)
    return runs


def without_repeats(docs: DataFrame) -> DataFrame:
    """A row for each document: its words, those removed (spans of words), and a digest of what stays."""
    rows = _identified(docs)
    return _beside(rows, repeated_windows(rows), "left").select("doc_id", "text", "runs").mapInArrow(_cut, REMOVED)


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
