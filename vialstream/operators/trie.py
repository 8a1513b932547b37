"""A double-array trie over words: all keys of a bounded dictionary in one walk over a batch of sentences.

A state's child for word ``w`` is at slot ``base[state] + w`` if that slot's ``check`` names the state.  The walk goes
over all positions of an Arrow batch at once, one word deeper each step, so a batch costs as many array steps as the
longest key has words.  Keys of one child lie wherever a slot is free; others take the first place that fits.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Words that are walked at once; a batch of more goes in slices of rows (one row is never cut).
MOST_WORDS = 1 << 18
#: Places tried for a state's children, twice, before they go to the end.
TRIES = 256


class Trie:
    """Keys are word lists; a key's number is its place among them (of equal keys the first counts)."""

    def __init__(self, keys: list[list[str]]) -> None:
        keys = [k or [] for k in keys]
        often = Counter(w for k in keys for w in k[1:])
        # words that follow others often have small numbers, so that children lie near each other
        self.words = pa.array(sorted({w for k in keys for w in k}, key=lambda w: (-often[w], w)), pa.string())
        number = {w: n for n, w in enumerate(self.words.to_pylist())}
        size = max(1, 2 * sum(map(len, keys)) + len(number) + 2)
        self.base, self.check, self.value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.check[0], self.base[0] = -2, 1
        self.end = 1 + len(number)
        state = np.zeros(len(keys), np.int64)
        length = np.array([len(k) for k in keys], np.int64)
        for depth in range(int(length.max(initial=0))):
            on = np.flatnonzero(length > depth)
            word = np.array([number[keys[k][depth]] for k in on.tolist()], np.int64)
            pair, back = np.unique(state[on] * len(number) + word, return_inverse=True)
            parent, word = pair // len(number), pair % len(number)
            self._place(parent, word)
            slots = self.base[parent] + word
            self.check[slots] = parent
            state[on] = slots[back]
            done = on[length[on] == depth + 1]
            self.value[state[done][::-1]] = done[::-1]
        self.depth = int(length.max(initial=0))
        used = max(self.end, int(np.flatnonzero(self.check != -1).max()) + 1)
        self.base, self.check, self.value = self.base[:used].astype(np.int32), self.check[:used].astype(np.int32), self.value[:used].astype(np.int32)

    def _room(self, most: int) -> None:
        if most >= len(self.check):
            more = most + 1 - len(self.check) + len(self.check) // 2
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check, self.value = (np.append(x, np.full(more, -1, np.int64)) for x in (self.check, self.value))

    def _place(self, parent: np.ndarray, word: np.ndarray) -> None:
        """Bases of the states in ``parent`` (sorted, with their children's words)."""
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(parent) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(parent)))
        many = np.flatnonzero((count > 1) & (parent[first] > 0))
        for turn, k in enumerate(many[np.argsort(-count[many], kind="stable")].tolist()):
            own = word[first[k] : first[k] + count[k]]
            shape = own - own[0]
            if turn % 64 == 0:
                gaps = np.flatnonzero(self.check[: self.end] == -1)
            at = self.end
            if len(gaps):
                # the first gaps, and as many spread over all
                some = np.unique(np.concatenate([gaps[:TRIES], gaps[np.linspace(0, len(gaps) - 1, min(TRIES, len(gaps))).astype(np.int64)]]))
                self._room(int(some[-1] + shape[-1]))
                fits = np.flatnonzero((self.check[some[:, None] + shape] == -1).all(axis=1))
                at = int(some[fits[0]]) if len(fits) else at
            self._room(at + int(shape[-1]))
            self.base[parent[first[k]]] = at - own[0]
            self.check[at + shape] = parent[first[k]]
            self.end = max(self.end, at + int(shape[-1]) + 1)
        lone = first[(count == 1) & (parent[first] > 0)]
        if len(lone):
            gaps = np.flatnonzero(self.check[: self.end] == -1)[: len(lone)]
            slots = np.append(gaps, self.end + np.arange(len(lone) - len(gaps)))
            self._room(int(slots[-1]))
            self.base[parent[lone]] = slots - word[lone]
            self.check[slots] = parent[lone]
            self.end = max(self.end, int(slots[-1]) + 1)

    def walk(self, words: pa.Array, row_end: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(positions, n, numbers): the keys of n words that start at positions; ``row_end``: where each word's row ends."""
        known = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.flatnonzero(known >= 0)
        state = np.zeros(len(at), np.int64)
        for depth in range(self.depth):
            here = at + depth < row_end[at]
            at, state = at[here], state[here]
            word = known[at + depth]
            slot = self.base[state] + word
            ok = (word >= 0) & (slot >= 0) & (slot < len(self.check))
            at, state, slot = at[ok], state[ok], slot[ok]
            ok = self.check[slot] == state
            at, state = at[ok], slot[ok]
            hit = self.value[state] >= 0
            if hit.any():
                yield at[hit], depth + 1, self.value[state[hit]]


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words, each one's row, and each row's first word (with the end of all)."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), np.repeat(np.arange(len(lists)), size), np.concatenate([[0], np.cumsum(size)])


def _sliced(lists: pa.Array, one: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``one`` of slices of rows, so that its memory is that of a slice's words and not of a batch's."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    if len(lists) == 0 or total[-1] <= MOST_WORDS:
        return one(lists)
    parts, at = [], 0
    while at < len(lists):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + MOST_WORDS, side="right")))
        parts.append(one(lists.slice(at, end - at)))
        at = end
    return pa.concat_arrays(parts)


def keys_in(lists: pa.Array, trie: Trie) -> pa.Array:
    """Of each word list the numbers of the keys in it, once each, ascending."""
    words, row, first = _flat(lists)
    found = [(row[at], number) for at, _, number in trie.walk(words, first[row + 1])]
    n = np.int64(1 << 32)
    both = np.unique(np.concatenate([r * n + k for r, k in found])) if found else np.zeros(0, np.int64)
    offsets = np.searchsorted(both // n, np.arange(len(lists) + 1))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array((both % n).astype(np.int32)))


def without_keys(lists: pa.Array, trie: Trie) -> pa.Array:
    """Word lists without the keys: longer keys go first, equally long ones from the left, and no word goes twice."""
    words, row, first = _flat(lists)
    found = list(trie.walk(words, first[row + 1]))
    gone = np.zeros(len(words), bool)
    for at, n, _ in reversed(found):
        if n == 1:
            gone[at] = True
            continue
        free = at[~gone[at[:, None] + np.arange(n)].any(axis=1)]
        # those that no other of this length can touch go at once, the rest from the left
        near = np.zeros(len(free), bool)
        near[1:] = np.diff(free) < n
        alone = ~near & ~np.append(near[1:], False)
        gone[free[alone][:, None] + np.arange(n)] = True
        for k in free[~alone].tolist():
            if not gone[k : k + n].any():
                gone[k : k + n] = True
    keep = ~gone
    offsets = np.concatenate([[0], np.cumsum(keep)])[first]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words.filter(pa.array(keep)))


class Parts:
    """Which keys have all their words among those of a longer key: numbers as in the trie, words between white space."""

    def __init__(self, keys: list[str]) -> None:
        self.words = [tuple(re.split(r"[ \t\n\x0b\f\r]+", k)) for k in keys]
        self.size = np.array([len(w) for w in self.words], np.int64)
        # one bit a word; a key whose bits are not all among another's is no part of it
        self.bits = np.array([reduce(lambda x, w: x | 1 << zlib.crc32(w.encode()) % 64, k, 0) for k in self.words], np.uint64)

    def within(self, a: int, b: int) -> bool:
        return set(self.words[a]) <= set(self.words[b])


def without_parts(lists: pa.Array, parts: Parts) -> pa.Array:
    """Of each list of key numbers those that are no part of a longer one in it, once each, ascending.

    A number ``-1 - n`` is key ``n`` whatever else is there, and no other key is a part of it.
    """
    flat, row, _ = _flat(lists)
    x, n = flat.to_numpy(zero_copy_only=False).astype(np.int64), np.int64(1 << 32)
    free = x < 0
    own = np.unique(row[~free] * n + x[~free])
    row_, key = own // n, own % n
    first = np.searchsorted(row_, np.arange(len(lists) + 1))
    count = (first[1:] - first[:-1])[row_]
    gone = np.zeros(len(own), bool)
    long = np.flatnonzero((count > 1) & (parts.size[key] > 1))
    total, at = np.cumsum(count[long]), 0
    while at < len(long):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + MOST_WORDS, side="right")))
        each = count[long[at:end]]
        b = np.repeat(long[at:end], each)
        a = np.repeat(first[row_[long[at:end]]] - (np.cumsum(each) - each), each) + np.arange(len(b))
        ok = (parts.size[key[a]] < parts.size[key[b]]) & (parts.bits[key[a]] & ~parts.bits[key[b]] == 0)
        a, b = a[ok], b[ok]
        pairs, back = np.unique(key[a] * n + key[b], return_inverse=True)
        inside = np.array([parts.within(p // int(n), p % int(n)) for p in pairs.tolist()], bool)
        gone[a[inside[back]]] = True
        at = end
    both = np.unique(np.concatenate([own[~gone], row[free] * n - 1 - x[free]]))
    offsets = np.searchsorted(both // n, np.arange(len(lists) + 1))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array((both % n).astype(np.int32)))


def _split(lines: pa.Array) -> pa.Array:
    """Words between ASCII white space; none of a line that has nothing else."""
    lines = pc.ascii_trim_whitespace(lines)
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(lines, ""), pa.scalar(None, lines.type), lines))


def _signs(lines: pa.Array, signs: tuple[str, ...]) -> pa.Array:
    """Bit k: pattern k may be found; a line with other than ASCII characters has all bits, as there engines differ in what a word is."""
    other = pc.fill_null(pc.invert(pc.string_is_ascii(lines)), True).to_numpy(zero_copy_only=False)
    bits = np.zeros(len(lines), np.int32)
    for k, pattern in enumerate(signs):
        bits |= (other | pc.fill_null(pc.match_substring_regex(lines, pattern), True).to_numpy(zero_copy_only=False)).astype(np.int32) << k
    return pa.array(bits)


def found_keys(spark: SparkSession, trie: Trie, sentence: Column, words: Column, signs: tuple[str, ...] = ()) -> Column:
    """(keys, signs): the numbers of the keys in ``words``, and which patterns a sentence may have.

    words: an array, or a line that stands for the sentence where it isn't null.
    """
    shared = spark.sparkContext.broadcast(trie)

    def one(lines: pa.Array, words: pa.Array) -> pa.Array:
        lists = words if pa.types.is_list(words.type) else _split(pc.coalesce(words, lines))
        return pa.StructArray.from_arrays([_sliced(lists, lambda part: keys_in(part, shared.value)), _signs(lines, signs)], ["keys", "signs"])

    return F.arrow_udf(one, "keys array<int>, signs int")(sentence, words)


def own_keys(spark: SparkSession, parts: Parts, numbers: Column) -> Column:
    """``without_parts`` of an array of key numbers."""
    shared = spark.sparkContext.broadcast(parts)
    return F.arrow_udf(lambda lists: without_parts(lists, shared.value), "array<int>")(numbers)


def removed_keys(spark: SparkSession, trie: Trie, words: Column) -> Column:
    """A word array without the keys in it."""
    shared = spark.sparkContext.broadcast(trie)
    return F.arrow_udf(lambda lists: _sliced(lists, lambda part: without_keys(part, shared.value)), "array<string>")(words)
