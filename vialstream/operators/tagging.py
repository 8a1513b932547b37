"""A part-of-speech tagger (hidden Markov model) counted by Spark, and lemmas by word and tag.

Counts are grouped sums over all tagged rows: tags after tags, tags of words, tags of word endings (words that occur
``RARE`` times at most teach endings).  A word's tags mix its own counts with those of its endings, the longest known
ending weighing most, so an unknown word is tagged by its ending and its neighbours.  Sentences of an Arrow batch are
decoded together, by length, with exact Viterbi steps.

The driver holds ``MOST_WORDS`` words at most, the most frequent ones (ties by code point); rarer ones are tagged by
their endings.  Cases: null words in training go; a null sentence has null tags, an empty one none; of equally good paths the one
whose tags come first in code point order, from the end, is taken; a model without rows is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vialstream.functions import stem

ENDING, RARE, SMOOTH = 4, 10, 0.1
MOST_WORDS, MOST_LEMMAS = 500_000, 1_000_000
#: Sentences decoded together.
GROUP = 512
_KEY = "\x1f"


def word_tags(tagged: DataFrame) -> DataFrame:
    """(word, tag, n) of rows (id, n, word, tag); words in lower case."""
    return tagged.filter("word IS NOT NULL AND tag IS NOT NULL").groupBy(F.lower("word").alias("word"), "tag").agg(F.count("*").alias("n"))


def ending_tags(words: DataFrame) -> DataFrame:
    """(ending, tag, n) from word_tags rows: of rare words the last 0 to ``ENDING`` letters."""
    rare = words.withColumn("all", F.sum("n").over(Window.partitionBy("word"))).filter(F.col("all") <= RARE)
    cut = rare.select(F.explode(F.transform(F.sequence(F.lit(0), F.least(F.lit(ENDING), F.length("word"))), lambda k: F.right("word", k))).alias("ending"), "tag", "n")
    return cut.groupBy("ending", "tag").agg(F.sum("n").alias("n"))


def tag_pairs(tagged: DataFrame) -> DataFrame:
    """(before, tag, n): tags after tags in the order of ``n`` within an id; the first has none before it."""
    w = Window.partitionBy("id").orderBy("n")
    rows = tagged.filter("word IS NOT NULL AND tag IS NOT NULL").select("tag", F.lag("tag").over(w).alias("before"))
    return rows.groupBy("before", "tag").agg(F.count("*").alias("n"))


class Tagger:
    def __init__(self, words: list[tuple], endings: list[tuple], pairs: list[tuple]) -> None:
        self.tags = sorted({t for _, t, _ in pairs})
        if not self.tags:
            raise ValueError("a tagger needs tagged rows")
        at = {t: k for k, t in enumerate(self.tags)}
        n = len(self.tags)
        start, after = np.full(n, SMOOTH), np.full((n, n), SMOOTH)
        total = np.full(n, SMOOTH)
        for before, tag, c in pairs:
            total[at[tag]] += c
            if before is None:
                start[at[tag]] += c
            else:
                after[at[before], at[tag]] += c
        self.start, self.after = np.log(start / start.sum()), np.log(after / after.sum(axis=1, keepdims=True))
        prior = total / total.sum()
        counts: dict[str, np.ndarray] = {}
        for e, tag, c in endings:
            counts.setdefault(e, np.zeros(n))[at[tag]] += c
        self.endings: dict[str, np.ndarray] = {}
        for e in sorted(counts, key=len):
            up = self.endings.get(e[1:], prior) if e else prior
            self.endings[e] = (counts[e] / counts[e].sum() + up) / 2
        own: dict[str, np.ndarray] = {}
        for w, tag, c in words:
            own.setdefault(w, np.zeros(n))[at[tag]] += c
        self.known = pa.array(sorted(own), pa.string())
        self.prior = prior
        self.own = np.array([self._mixed(own[w], self._by_ending(w)) for w in self.known.to_pylist()]).reshape(len(own), n)

    def _mixed(self, own: np.ndarray, ending: np.ndarray) -> np.ndarray:
        return np.log((own + SMOOTH * ending) / (own.sum() + SMOOTH)) - np.log(self.prior)

    def _by_ending(self, word: str) -> np.ndarray:
        for k in range(min(ENDING, len(word)), -1, -1):
            if (found := self.endings.get(word[len(word) - k :])) is not None:
                return found
        return self.prior

    def scores(self, words: pa.Array) -> np.ndarray:
        """Of each word the log of P(tag | word) / P(tag)."""
        low = pc.utf8_lower(words)
        at = pc.fill_null(pc.index_in(low, value_set=self.known), -1).to_numpy(zero_copy_only=False)
        out = self.own[np.maximum(at, 0)] if len(self.known) else np.zeros((len(at), len(self.tags)))
        new = np.flatnonzero(at < 0)
        some = low.take(pa.array(new)).dictionary_encode()
        if len(new):
            table = np.array([np.log(self._by_ending(w or "")) - np.log(self.prior) for w in some.dictionary.to_pylist()] or [np.zeros(len(self.tags))])
            out[new] = table[pc.fill_null(some.indices, 0).to_numpy(zero_copy_only=False)]
        return out

    def paths(self, scores: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The best tag numbers of all words; sentences start at ``first`` and have ``size`` words."""
        out = np.zeros(len(scores), np.int64)
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        for lo in range(0, len(order), GROUP):
            rows = order[lo : lo + GROUP]
            f, n = first[rows], size[rows]
            best = self.start + scores[f]
            back = np.zeros((int(n[0]), len(rows), len(self.tags)), np.int16)
            for k in range(1, int(n[0])):
                live = int(np.searchsorted(-n, -k, "left"))  # sentences of more than k words come first
                way = best[:live, :, None] + self.after[None]
                back[k, :live] = way.argmax(axis=1)
                best[:live] = way.max(axis=1) + scores[f[:live] + k]
            tag = best.argmax(axis=1)
            for k in range(int(n[0]) - 1, -1, -1):
                live = int(np.searchsorted(-n, -k, "left"))
                out[f[:live] + k] = tag[:live]
                if k:
                    tag[:live] = back[k, np.arange(live), tag[:live]]
        return out


def train(tagged: DataFrame) -> Tagger:
    """A tagger from rows (id, n, word, tag)."""
    words = word_tags(tagged).persist()
    most = words.groupBy("word").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "word").limit(MOST_WORDS)
    rows = lambda df, *cols: [tuple(r) for r in df.select(*cols).collect()]
    try:
        ends = ending_tags(words).groupBy("ending").agg(F.sum("n").alias("all"), F.collect_list(F.struct("tag", "n")).alias("t")).orderBy(F.desc("all"), "ending").limit(MOST_WORDS)
        return Tagger(rows(words.join(most.select("word"), "word"), "word", "tag", "n"), rows(ends.select("ending", F.explode("t").alias("t")), "ending", "t.tag", "t.n"), rows(tag_pairs(tagged), "before", "tag", "n"))
    finally:
        words.unpersist()


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), np.cumsum(size) - size, size


def _like(lists: pa.Array, size: np.ndarray, values: pa.Array) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=lists.is_null()) if lists.null_count else pa.ListArray.from_arrays(offsets, values)


def tags_of(lists: pa.Array, tagger: Tagger) -> pa.Array:
    words, first, size = _flat(lists)
    numbers = tagger.paths(tagger.scores(words), first, size)
    return _like(lists, size, pa.array(tagger.tags, pa.string()).take(pa.array(numbers)))


class Lemmas:
    """Lemmas of (token, tag, lemma) triples; of several the first by code point.  Words that have none stay."""

    def __init__(self, triples: list[tuple]) -> None:
        table: dict[str, str] = {}
        for token, tag, lemma in sorted(t for t in triples if None not in t):
            table.setdefault(f"{token.lower()}{_KEY}{tag}", lemma)
        self.keys, self.values = pa.array(table.keys(), pa.string()), pa.array(table.values(), pa.string())

    def of(self, lists: pa.Array, tagger: Tagger) -> pa.Array:
        words, _, size = _flat(lists)
        keys = pc.binary_join_element_wise(pc.utf8_lower(words), tags_of(lists, tagger).flatten(), _KEY)
        found = self.values.take(pc.index_in(keys, value_set=self.keys))
        return _like(lists, size, pc.coalesce(found, words))


def lemma_dictionary(triples: DataFrame) -> Lemmas:
    rows = triples.select("token", "tag", "lemma").distinct().limit(MOST_LEMMAS + 1).collect()
    if len(rows) > MOST_LEMMAS:
        raise ValueError(f"a dictionary of more than {MOST_LEMMAS} lemmas")
    return Lemmas([tuple(r) for r in rows])


@F.pandas_udf(T.StringType())
def _lemma(word, kind):
    return word.combine(kind, lambda w, k: None if w is None or k is None else stem.lemma(w, k[:1]))


def rule_triples(words: DataFrame) -> DataFrame:
    """(token, tag, lemma) of word_tags rows, by the rules of each part of speech; tags start with N, V, J or A, others keep their word."""
    kind = F.replace(F.upper(F.left("tag", F.lit(1))), F.lit("J"), F.lit("A"))
    lemma = F.when(kind.isin("N", "V", "A"), _lemma(F.col("word"), kind)).otherwise(F.col("word"))
    return words.select(F.col("word").alias("token"), "tag", lemma.alias("lemma")).distinct()


def tags(spark: SparkSession, tagger: Tagger, words: Column) -> Column:
    """The tags of a word array."""
    shared = spark.sparkContext.broadcast(tagger)
    return F.arrow_udf(lambda lists: tags_of(lists, shared.value), "array<string>")(words)


def lemmatised(spark: SparkSession, tagger: Tagger, lemmas: Lemmas, words: Column) -> Column:
    """A word array with each word's lemma under its tag."""
    shared = spark.sparkContext.broadcast((tagger, lemmas))
    return F.arrow_udf(lambda lists: shared.value[1].of(lists, shared.value[0]), "array<string>")(words)
