"""Token-ID files: range asymmetric numeral coding with static, shared frequency tables.

``encode_corpus`` writes two Parquet tables under one path: ``blocks``, independent blocks in ascending order
of doc_id, and ``frequencies``, the table that they share with its checksum.  ``decode`` needs nothing but that
path.  A block holds whole documents, about ``BLOCK_IDS`` ids.  Its ids are dealt to ``LANES`` coder states that
share one stream of 32-bit words; a checkpoint in the middle (step, word position, states) lets two readers
decode one block, and a crc32 guards each block.  The frequency table counts all ids of all documents, scaled
to 2 ** ``SCALE`` with at least 1 for each id that occurs.

Documents are dealt to shards by ranges of doc_id, as many as the session has shuffle partitions; a shard is
streamed block by block, so a task's memory holds a block and not a shard.  Cases: a null or empty text has
only the end id; a null doc_id comes first; equal doc_ids are ordered by their ids' bytes; no rows give no
blocks; extra columns are ignored; a very long text makes one larger block.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint_dir, kept_by, mix, own_columns, released, slices, table, text_buffers, written

END_ID = 0
SCALE = 18
LANES = 1024
BLOCK_IDS = 1 << 18
LOW = np.uint64(1 << 31)
#: Pieces that a worker keeps with their ids; others are encoded again in each slice.
PIECES = 1 << 18
#: Bytes of a piece that fit its key: three words, the last byte of which is the length.
KEY_BYTES = 23
LINE = "\n"
_loaded: dict[str, "Vocabulary"] = {}
kept_by["tokens"] = _loaded.clear

BLOCKS = "shard int, block int, n_ids long, doc_ids binary, null_ids binary, lengths binary, states binary, words binary, checkpoint binary, crc long"

#: Kinds of bytes: white space, marks, digits, letters, control characters, bytes of longer characters.
_SPACE, _MARK, _DIGIT, _ALPHA, _CONTROL, _LONG = range(6)
_KIND = np.full(256, _CONTROL, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[0x30:0x3A] = _DIGIT
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _ALPHA
_KIND[0x80:] = _LONG
#: Bytes that stand in no white space.
_BLACK = np.isin(_KIND, (_MARK, _DIGIT, _ALPHA, _LONG))
_BLACK[[0xC2, 0xE1, 0xE2, 0xE3]] = False
_KEY_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_starts(data: np.ndarray, offs: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where pieces start: at each non-empty text, at ASCII white space that follows what is surely none, and at
    ASCII marks that follow a letter.

    No pre-token of the byte-level pattern goes from another character to white space, or from a letter to a
    mark, so encoding pieces apart is encoding the text.  Texts marked in ``whole`` are one piece.
    """
    kind = _KIND[data]
    first = np.zeros(len(data), bool)
    first[1:] = (kind[1:] == _SPACE) & ((kind[:-1] == _ALPHA) | (kind[:-1] == _MARK) | (kind[:-1] == _DIGIT)) | (kind[1:] == _MARK) & (kind[:-1] == _ALPHA)
    at = np.flatnonzero((kind[1:] <= _MARK) & (data[:-1] >= 0x80)) + 1
    if len(at):  # after a character of several bytes: U+00C0 to U+07FF, from U+4000 and from U+10000 none is white space
        lead = [np.where(at >= d, data[at - np.minimum(at, d)], 0) for d in (2, 3, 4)]
        tail = (lead[0] >= 0x80) & (lead[0] < 0xC0)
        black = ((lead[0] >= 0xC3) & (lead[0] <= 0xDF)) | tail & ((lead[1] >= 0xE4) & (lead[1] <= 0xEF) | (lead[1] >= 0x80) & (lead[1] < 0xC0) & (lead[2] >= 0xF0))
        letter = (lead[0] == 0xC3) & (data[at - 1] != 0x97) & (data[at - 1] != 0xB7)  # Latin-1
        first[at] = np.where(kind[at] == _SPACE, black, letter)
    for k in np.flatnonzero(whole):
        first[offs[k] : offs[k + 1]] = False
    first[offs[:-1][np.diff(offs) > 0]] = True
    return np.flatnonzero(first)


def piece_keys(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three words that hold the bytes and the length of pieces of up to ``KEY_BYTES`` bytes."""
    padded = np.concatenate([data, np.zeros(32, np.uint8)])
    words = np.ndarray(len(data) + 24, "<u8", padded, strides=(1,))
    one, two, three = (words[start + 8 * k] & _KEY_MASK[np.clip(size - 8 * k, 0, 8)] for k in range(3))
    return one, two, three | (size.astype(np.uint64) << np.uint64(56))


class Pieces:
    """An open-addressing table from pieces to their ids, probed in vector form; keys are exact."""

    def __init__(self, most: int) -> None:
        self.most, size = most, 1 << max(6, (2 * most - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros((size, 3), np.uint64)
        self.row = np.full(size, -1, np.int32)
        self.rounds = 1
        self.at, self.n, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def _slot(self, keys: tuple, r: int) -> np.ndarray:
        h = mix(keys[0] ^ (mix(keys[1] ^ (keys[2] * np.uint64(0x9E3779B97F4A7C15)))))
        return ((h + np.uint64(r)) & self.mask).astype(np.int64)

    def find(self, keys: tuple) -> np.ndarray:
        """Each piece's row, or -1."""
        out = np.full(len(keys[0]), -1, np.int32)
        left = None
        for r in range(self.rounds):
            part = keys if left is None else tuple(k[left] for k in keys)
            if not len(part[0]):
                break
            slot = self._slot(part, r)
            row, have = self.row[slot], self.keys[slot]
            hit = (row >= 0) & (have[:, 0] == part[0]) & (have[:, 1] == part[1]) & (have[:, 2] == part[2])
            if left is None:
                out = np.where(hit, row, np.int32(-1))
                left = np.flatnonzero(~hit & (row >= 0))
            else:
                out[left[hit]] = row[hit]
                left = left[~hit & (row >= 0)]
        return out

    def add(self, keys: tuple, n: np.ndarray, ids: np.ndarray) -> None:
        """New distinct pieces with their numbers of ids, and all ids end to end; what is over ``most`` is left out."""
        room = self.most - len(self.n)
        if room < len(n):
            keys, n = tuple(k[:room] for k in keys), n[:room]
            ids = ids[: int(n.sum())]
        if not len(n):
            return
        first = len(self.n)
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(n) - n])
        self.n, self.ids = np.concatenate([self.n, n]), np.concatenate([self.ids, ids])
        left, r = np.arange(len(n)), 0
        while len(left):
            slot = self._slot(tuple(k[left] for k in keys), r)
            free = np.flatnonzero(self.row[slot] < 0)
            taken, which = np.unique(slot[free], return_index=True)
            mine = left[free[which]]
            self.row[taken] = first + mine
            self.keys[taken] = np.stack([k[mine] for k in keys], 1)
            placed = np.zeros(len(n), bool)
            placed[mine] = True
            left = left[~placed[left]]
            r += 1
        self.rounds = max(self.rounds, r)


class Vocabulary:
    """One tokenizer, and the ids of the first ``pieces`` pieces that were met."""

    def __init__(self, path: str, pieces: int | None = None) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        if self.tok.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        form = json.loads(self.tok.to_str())
        pre = form.get("pre_tokenizer") or {}
        #: Whether texts may be cut into pieces at all.
        self.cuts = not form.get("normalizer") and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex")) and not pre.get("add_prefix_space")
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.pieces = Pieces(PIECES if pieces is None else pieces)
        line = self.tok.encode(LINE, add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None

    def fresh(self, found: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of distinct pieces, and all ids end to end, from the library.

        ``plain`` pieces hold no white space but for one space at the start: they go there as lines of one text.
        """
        if self.line is None:
            plain = np.zeros(len(found), bool)
        lines, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        parts = [lines[k : k + 256] for k in range(0, len(lines), 256)]
        got = self.tok.encode_batch_fast([LINE + b"\n".join([found[k] for k in p]).decode() for p in parts], add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint16), *(np.array(e.ids, np.uint16) for e in got)])
        cuts = np.flatnonzero(ids == self.line) if len(lines) else lines
        if len(cuts) != len(lines):
            raise ValueError("the tokenizer joins line ends with other text")
        got = self.tok.encode_batch_fast([found[k].decode() for k in others], add_special_tokens=False)
        n = np.concatenate([np.diff(np.append(cuts, len(ids))) - 1, [len(e.ids) for e in got]]).astype(np.int64)
        ids = np.concatenate([np.delete(ids, cuts), *(np.array(e.ids, np.uint16) for e in got)])
        order = np.argsort(np.concatenate([lines, others]), kind="stable")
        begin = (np.cumsum(n) - n)[order]
        n = n[order]
        return n, ids[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(len(ids))]

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, and the n + 1 bounds."""
        texts = len(offs) - 1
        raw = data.tobytes()
        whole = np.full(texts, not self.cuts)
        for mark in self.added:
            if mark in raw:
                whole |= [mark in raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        start = piece_starts(data, offs, whole)
        size = np.diff(np.append(start, len(data)))
        doc = np.searchsorted(offs, start, "right") - 1
        keys = piece_keys(data, start, size)
        row = self.pieces.find(keys)
        row[size > KEY_BYTES] = -1
        miss = np.flatnonzero(row < 0)
        at, n, ids = self.pieces.at, self.pieces.n, self.pieces.ids
        if len(miss):
            a, b = start[miss].tolist(), (start[miss] + size[miss]).tolist()
            seen: dict[bytes, int] = {}
            rows = np.array([seen.setdefault(raw[x:y], len(seen)) for x, y in zip(a, b, strict=True)])
            _, lead = np.unique(rows, return_index=True)
            first = start[miss[lead]]
            white = np.concatenate([[0], np.cumsum(~_BLACK[data])])
            white = white[first + size[miss[lead]]] - white[first]
            fn, fids = self.fresh(list(seen), ((white == 0) | (white == 1) & (data[first] == 0x20) & (size[miss[lead]] > 1)) & ~whole[doc[miss[lead]]])
            row[miss] = rows + len(n)
            at = np.concatenate([at, len(ids) + np.cumsum(fn) - fn])
            n, ids = np.concatenate([n, fn]), np.concatenate([ids, fids])
            short = size[miss[lead]] <= KEY_BYTES
            keep = miss[lead][short]
            self.pieces.add(tuple(k[keep] for k in keys), fn[short], fids[np.repeat(short, fn)])
        each = n[row]
        ends = np.cumsum(np.bincount(doc, each, texts).astype(np.int64) + 1)
        out = np.full(int(ends[-1]) if texts else 0, END_ID, np.uint16)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[inner] = ids[np.repeat(at[row] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))]
        return out, np.concatenate([[0], ends])


def vocabulary(path: str, pieces: int | None = None) -> Vocabulary:
    key = f"{path}|{pieces}"
    if key not in _loaded:
        _loaded.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[key] = Vocabulary(path, pieces)
    return _loaded[key]


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The runs of ``values`` between the bounds as binary values, without a copy of each."""
    if int(bounds[-1]) * values.itemsize >= 1 << 31:
        return pa.array([values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.large_binary()).cast(pa.binary())
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _tokenize(path: str, pieces: int | None):
    def run(batches):
        for rows, data, offs in slices(batches, owner="tokens"):
            yield pa.RecordBatch.from_arrays([rows.column(0), binaries(*vocabulary(path, pieces).encode(data, offs))], ["doc_id", "ids"])

    return run


def _count(batches):
    total = np.zeros(1 << 16, np.int64)
    for b in batches:
        raw, _ = text_buffers(b.column(0))
        total += np.bincount(np.frombuffer(raw.tobytes(), "<u2"), minlength=1 << 16)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["id", "n"])


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2 ** scale, in proportion to the counts, at least 1 where one occurs."""
    seen = counts > 0
    room = (1 << scale) - int(seen.sum())
    freq = seen + (counts.astype(np.float64) * (room / max(1, counts.sum()))).astype(np.int64)
    freq[int(np.argmax(counts))] += (1 << scale) - int(freq.sum())
    return freq


class Coder:
    """Encoder and decoder over one frequency table."""

    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.most = self.freq << np.uint64(63 - SCALE)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.int32), freq)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[int, int, np.ndarray]]:
        """Final states, words in reading order, and the checkpoint of the middle step."""
        steps = -(-len(ids) // LANES)
        x = np.full(LANES, LOW, np.uint64)
        out: list[np.ndarray] = []
        mid = steps // 2
        after, states = 0, x
        for t in range(steps - 1, -1, -1):
            s = ids[t * LANES : (t + 1) * LANES]
            v = x[: len(s)]
            full = np.flatnonzero(v >= self.most[s])
            if len(full):
                out.append((v[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                v[full] >>= np.uint64(32)
            f = self.freq[s]
            q = v // f
            v[:] = (q << np.uint64(SCALE)) + (v - q * f) + self.start[s]
            if t == mid:
                after, states = len(out), x.copy()
        words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
        return x, words, (mid, int(sum(map(len, out[after:]))), states)

    def decode(self, n: int, x: np.ndarray, words: np.ndarray, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """The ids of steps first to last, from the states there and the words from there on."""
        steps = -(-n // LANES)
        last = steps if last is None else last
        x = x.copy()
        ids = np.empty(max(0, min(n, last * LANES) - first * LANES), np.int32)
        at, mask, low = 0, np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
        for t in range(first, last):
            m = min(LANES, n - t * LANES)
            v = x[:m]
            low_bits = v & mask
            s = self.slot[low_bits.astype(np.int64)]
            ids[(t - first) * LANES : (t - first) * LANES + m] = s
            v[:] = self.freq[s] * (v >> low) + low_bits - self.start[s]
            short = np.flatnonzero(v < LOW)
            if len(short):
                v[short] = (v[short] << np.uint64(32)) | words[at : at + len(short)]
                at += len(short)
        return ids, x, at


def _pack(coder: Coder, shard: int, block: int, docs: list[tuple[int | None, np.ndarray]]) -> dict:
    ids = np.concatenate([i for _, i in docs])
    states, words, (step, at, mid) = coder.encode(ids)
    row = {
        "shard": shard, "block": block, "n_ids": len(ids),
        "doc_ids": np.array([d or 0 for d, _ in docs], "<i8").tobytes(), "null_ids": np.array([d is None for d, _ in docs], "u1").tobytes(),
        "lengths": np.array([len(i) for _, i in docs], "<u8").tobytes(), "states": states.astype("<u8").tobytes(), "words": words.tobytes(),
        "checkpoint": np.array([step, at], "<u8").tobytes() + mid.astype("<u8").tobytes(),
    }
    return row | {"crc": zlib.crc32(row["lengths"] + row["states"] + row["words"] + row["checkpoint"])}


def _schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in BLOCKS.split(", "))])


def _encode(freq, block_ids: int):
    def run(batches):
        coder, shard, block, held, n = Coder(freq.value), TaskContext.get().partitionId(), 0, [], 0
        schema = _schema()

        def flush():
            nonlocal held, n, block
            row = _pack(coder, shard, block, held)
            held, n, block = [], 0, block + 1
            return pa.RecordBatch.from_pylist([row], schema)

        for b in batches:
            for d, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held.append((d, np.frombuffer(raw.as_buffer(), "<u2")))
                n += len(held[-1][1])
                if n >= block_ids:
                    yield flush()
        if held:
            yield flush()

    return run


def _decode(freq, keep_ids: bool):
    def run(batches):
        coder = Coder(freq.value)
        for b in batches:
            for r in b.to_pylist():
                if zlib.crc32(r["lengths"] + r["states"] + r["words"] + r["checkpoint"]) != r["crc"]:
                    raise ValueError(f"shard {r['shard']}, block {r['block']}: the checksum differs")
                words, n = np.frombuffer(r["words"], "<u4"), r["n_ids"]
                mark = np.frombuffer(r["checkpoint"], "<u8")
                step, at = int(mark[0]), int(mark[1])
                # two independent halves, as two readers would take them
                head, _, _ = coder.decode(n, np.frombuffer(r["states"], "<u8"), words, 0, step)
                tail, end, _ = coder.decode(n, mark[2:], words[at:], step)
                if (end != LOW).any():
                    raise ValueError(f"shard {r['shard']}, block {r['block']}: the coder states don't end where they began")
                ids = np.concatenate([head, tail]).astype("<u4")
                lengths = np.frombuffer(r["lengths"], "<u8").astype(np.int64)
                cuts = np.concatenate([[0], np.cumsum(lengths)])
                none = np.frombuffer(r["null_ids"], "u1").astype(bool)
                each = [ids[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                cols = [
                    pa.array(np.frombuffer(r["doc_ids"], "<i8"), mask=none), pa.array(np.full(len(none), r["shard"], np.int32)), pa.array(np.full(len(none), r["block"], np.int32)),
                    pa.array(cuts[:-1]), pa.array(lengths), pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()),
                ]
                names = ["doc_id", "shard", "block", "offset", "n_tokens", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def encode_corpus(docs: DataFrame, tokenizer: str | None = None, block_ids: int = BLOCK_IDS, path: str | None = None, pieces: int | None = None) -> str:
    """Writes the blocks and their frequency table under ``path`` (a folder of its own if none is named); returns it."""
    spark = docs.sparkSession
    name = tokenizer or default_tokenizer()
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/vialstream-tokens-{uuid.uuid4().hex}"
    rows = own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    ids = written(rows.mapInArrow(_tokenize(name, pieces), "doc_id long, ids binary"), "ids")
    counted = ids.select("ids").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most 65,536 rows
    counts = np.zeros(vocabulary(name).tok.get_vocab_size(), np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    freq = scaled(counts)
    spark.createDataFrame([(bytearray(freq.astype("<u4").tobytes()), zlib.crc32(freq.astype("<u4").tobytes()))], "frequencies binary, crc long").coalesce(1).write.parquet(f"{path}/frequencies")
    order = [F.col("doc_id").asc_nulls_first(), F.col("ids").asc()]
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranges of doc_id alone: equal ids share a shard
    ordered = ids.repartitionByRange(wide, order[0]).sortWithinPartitions(*order)
    ordered.mapInArrow(_encode(spark.sparkContext.broadcast(freq), block_ids), BLOCKS).write.parquet(f"{path}/blocks")
    released(ids)
    return path


def frequencies(spark: SparkSession, path: str) -> np.ndarray:
    """The scaled table of the files under ``path``."""
    r = spark.read.parquet(f"{path}/frequencies").first()
    raw = bytes(r["frequencies"])
    if zlib.crc32(raw) != r["crc"]:
        raise ValueError("the frequency table's checksum differs")
    return np.frombuffer(raw, "<u4").astype(np.int64)


def decode(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Documents from the files under ``path``: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids."""
    freq = spark.sparkContext.broadcast(frequencies(spark, path))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sizes = blocks.select("shard", "block", "n_ids")
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each shard, as many as shuffle partitions
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("total")).select("shard", F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    starts = sizes.select("shard", "block", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0)).alias("inner")).join(shards, "shard").select("shard", "block", (F.col("base") + F.col("inner")).alias("at"))
    kinds = "doc_id long, shard int, block int, offset long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids
    rows = blocks.mapInArrow(_decode(freq, keep_ids), kinds).join(starts, ["shard", "block"])
    return rows.select("doc_id", (F.col("at") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(spark, encode_corpus(table(spark, sf_dir, "documents")))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents' place and checksum in the token files."""
    return decode(spark, encode_corpus(docs))
