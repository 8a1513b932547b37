"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

``contamination`` scans each whole text once.  An automaton has ``AUTOMATON_NODES`` nodes at most; what a
benchmark has beyond that (an item of any length may be parted, with overlap) makes further automatons, of
which one is in memory at a time: each marks the documents that it hits, in a table of its own.  Words are maximal runs of ASCII letters, digits and
non-ASCII characters after A-Z are lower-cased; an item gives each run of ``window`` words, a shorter
item itself.  Cases: null or wordless texts have no words and no hits; null or wordless items give no
window; equal items each count; repeated documents each get a row; no rows give no rows; extra
columns of either table are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_by, numbered, own_columns, slices, table, written

WINDOW = 10
#: Nodes of one automaton (about 45 bytes each).
AUTOMATON_NODES = 2_000_000

WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_built: dict[str, object] = {}
kept_by["automaton"] = _built.clear

#: An item, or a part of one: its number, its id as text, and its words.
Item = tuple[int, str, list[bytes]]
HITS = "rid long, marks array<int>, items array<struct<number:long,id:string>>"
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<start:long,end:long>>"


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


def parts(benchmark: DataFrame, window: int = WINDOW, nodes: int = AUTOMATON_NODES):
    """Lists of items for one automaton each, streamed through the driver one list at a time."""
    held: list[Item] = []
    room = nodes
    for number, (item_id, text) in enumerate(own_columns(benchmark, "item_id", "text").orderBy("item_id", "text").toLocalIterator()):
        words = words_of((text or "").encode())
        first = 0
        while first < len(words) and (first == 0 or first + window <= len(words)):
            stop, size = first, 0  # windows that start from first to stop - 1 fit
            while stop == first or (stop + window <= len(words) and size <= room):
                size += sum(map(len, words[stop : stop + window])) + window + 1
                stop += 1
            if size > room and held:
                yield held
                held, room = [], nodes
                continue
            held.append((number, "" if item_id is None else str(item_id), words[first : stop + window - 1]))
            first, room = stop, room - size
    if held:
        yield held


def automaton(items: list[Item], window: int):
    """Windows, framed by single spaces; each one's value: its number of words and its items."""
    import ahocorasick

    windows: dict[bytes, tuple[int, set[tuple[int, str]]]] = {}
    for number, name, words in items:
        for k in range(max(1, len(words) - window + 1) if words else 0):
            part = words[k : k + window]
            windows.setdefault(b" ".join(part), (len(part), set()))[1].add((number, name))
    found = ahocorasick.Automaton()
    for key, (n, who) in windows.items():
        found.add_word(f" {key.decode('latin-1')} ", (n, tuple(sorted(who))))
    if windows:
        found.make_automaton()
    return found if windows else None


def scan(raw: bytes, found) -> tuple[int, list[tuple[int, int]], set[tuple[int, str]]]:
    """Number of words, hit word runs (merged, end exclusive), and the items."""
    words = words_of(raw)
    if not words or found is None:
        return len(words), [], set()
    line = f" {b' '.join(words).decode('latin-1')} "
    who: set[tuple[int, str]] = set()
    ends = []
    for at, (n, numbers) in found.iter(line):
        ends.append((at, n))
        who.update(numbers)
    if not ends:
        return len(words), [], who
    gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    stop = np.searchsorted(gaps, [at for at, _ in ends])
    return len(words), merged((int(s) - n, int(s)) for s, (_, n) in zip(stop, ends, strict=True)), who


def merged(ranges) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for b, a in sorted(ranges):
        if runs and b <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], a)
        else:
            runs.append([b, a])
    return [(b, a) for b, a in runs]


def original_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """Word runs as code-point offsets of the original text."""
    if not runs:
        return []
    at = [m.span() for m in _WORD.finditer(raw)]
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(points[at[b][0]]), "end": int(points[at[a - 1][1]])} for b, a in runs]


def _machine(key: str, items, window: int):
    if key not in _built:
        _built.clear()  # one automaton in memory at a time
        _built[key] = automaton(items.value, window)
    return _built[key]


_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
_NAMES = [x.split()[0] for x in RESULT.split("struct")[0].split(", ")[:7]] + ["spans"]


def _rows(doc_id, found: list) -> pa.RecordBatch:
    """Result rows from (raw text, number of words, runs, items)."""
    out = [[], [], [], [], [], [], []]
    for raw, n, runs, who in found:
        names = sorted(name for _, name in who)
        for column, v in zip(out, (n, sum(a - b for b, a in runs), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(runs), names, original_spans(raw, runs)), strict=True):
            column.append(v)
    return pa.RecordBatch.from_arrays([doc_id, *(pa.array(v, t) for v, t in zip(out, _KINDS, strict=True))], _NAMES)


def _texts(data: np.ndarray, offs: np.ndarray) -> list[bytes]:
    return [data[a:b].tobytes() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def _scan(items, window: int):
    key = uuid.uuid4().hex

    def run(batches):
        for rows, data, offs in slices(batches, owner="automaton"):
            found = _machine(key, items, window)
            yield _rows(rows.column(0), [(raw, *scan(raw, found)) for raw in _texts(data, offs)])

    return run


def _hits(items, window: int):
    key = uuid.uuid4().hex

    def run(batches):
        for rows, data, offs in slices(batches, owner="automaton"):
            found = _machine(key, items, window)
            hit = [(rid, *scan(raw, found)[1:]) for rid, raw in zip(rows.column(0).to_pylist(), _texts(data, offs), strict=True)]
            hit = [x for x in hit if x[1]]
            marks = pa.array([[v for r in runs for v in r] for _, runs, _ in hit], pa.list_(pa.int32()))
            who = pa.array([[{"number": n, "id": i} for n, i in sorted(w)] for *_, w in hit], pa.list_(pa.struct([("number", pa.int64()), ("id", pa.string())])))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in hit], pa.int64()), marks, who], ["rid", "marks", "items"])

    return run


def _joined(batches):
    for rows, data, offs in slices(batches):
        found = []
        for raw, marks, items in zip(_texts(data, offs), rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True):
            flat = marks or []
            found.append((raw, len(words_of(raw)), merged(zip(flat[::2], flat[1::2], strict=True)), {(x["number"], x["id"]) for x in items or []}))
        yield _rows(rows.column(0), found)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, nodes: int = AUTOMATON_NODES) -> DataFrame:
    """A row for each document: word counts, hit words, items, and the hit spans of the original text."""
    send = docs.sparkSession.sparkContext.broadcast
    docs = own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    lists = parts(benchmark, window, nodes)
    first, more = next(lists, []), next(lists, None)
    if more is None:
        return docs.mapInArrow(_scan(send(first), window), RESULT)
    rows = numbered(docs)
    hits = written(rows.select("rid", "text").mapInArrow(_hits(send(first), window), HITS), "hits")
    while more is not None:
        hits = hits.unionByName(written(rows.select("rid", "text").mapInArrow(_hits(send(more), window), HITS), "hits"))
        more = next(lists, None)
    marks = hits.groupBy("rid").agg(F.flatten(F.collect_list("marks")).alias("marks"), F.flatten(F.collect_list("items")).alias("items"))
    return rows.join(marks, "rid", "left").select("doc_id", "text", "marks", "items").mapInArrow(_joined, RESULT)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _clean(items, window: int):
    key = uuid.uuid4().hex

    def run(batches):
        for rows, data, offs in slices(batches, owner="automaton"):
            found = _machine(key, items, window)
            yield rows.filter(pa.array([not scan(raw, found)[1] for raw in _texts(data, offs)], pa.bool_()))

    return run


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows that hold a benchmark window go, in the scan itself; all others stay as they are."""
    rows = own_columns(docs, "doc_id", "text", "lang", "source", "n_chars")
    found, lists = rows, parts(table(spark, sf_dir, "benchmark"))
    for k, items in enumerate(lists):
        found = (written(found, "clean") if k else found).mapInArrow(_clean(spark.sparkContext.broadcast(items), WINDOW), rows.schema)
    return found
