"""Document fingerprints by I-Match, with DataFrame functions only.

A text's terms are its distinct lower-cased words as 64-bit hashes.  The lexicon holds the terms that occur
in a share of ``LOW`` to ``HIGH`` of all distinct sets of terms (a band of inverse document frequency).  It is cut into
randomised subsets, by bits of the hash: ``SUBSETS`` lists (bits, subsets), each subset with one term in
2 ** bits.  Each subset's terms of a text, sorted, are hashed; the fingerprint is the list of all hashes.
Sparse subsets survive edits of long texts, dense ones those of short texts.

The likeness of two fingerprints is the share of subsets, of those with a term on either side, whose hashes
are equal.  The lexicon has at most mean terms a document / low share members, and the low share is raised
where that bound would pass ``MOST_TERMS``; it reaches the tasks as one constant of ``BUCKETS`` lists.

Cases: null and empty texts have one fingerprint; a text with fewer than one band term in ``FEW`` terms
(all of a crowded group of near copies may be above the band) has subsets of all its terms instead; one document is its own next; equal ids are ordered by the
text's hash; null ids come last; repeated rows stay; extra columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import own_columns, range_shards, table, written

LOW, HIGH = 0.001, 0.05
MOST_TERMS = 400_000
BUCKETS = 1 << 16
FEW = 16
SUBSETS = ((1, 2), (3, 6), (5, 12), (7, 24), (9, 36))
SHARD_DOCS = 512


def terms(text: Column) -> Column:
    """The sorted distinct hashes of a text's words."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.sort_array(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> Column:
    """A constant array of buckets, each with the lexicon terms that fall in it; ``MOST_TERMS`` at most."""
    sets = docs.select(terms(F.coalesce("text", F.lit(""))).alias("a")).groupBy(F.xxhash64("a").alias("h")).agg(F.first("a").alias("a"))
    sets = written(sets, "sets")  # copies count once
    n = sets.count()
    df = written(sets.select(F.explode("a").alias("t")).groupBy("t").count(), "df")
    total = df.agg(F.sum("count")).first()[0] or 0
    low = max(low, total / max(1, n) / MOST_TERMS)
    buckets: list[list[int]] = [[] for _ in range(BUCKETS)]
    for r in df.filter((F.col("count") >= low * n) & (F.col("count") <= max(high * n, 1))).select("t").toLocalIterator():
        buckets[r["t"] % BUCKETS].append(r["t"])
    return F.from_json(F.lit(json.dumps([sorted(b) for b in buckets], separators=(",", ":"))), "array<array<bigint>>")


def fingerprint_columns(df: DataFrame, texts: dict[str, str], buckets: Column) -> DataFrame:
    """``df`` with the fingerprint (an array of hashes; empty strings for empty subsets) of each named text."""
    held = [F.col(f"`{c}`") for c in df.columns]
    df = df.select(*held, F.array(*[terms(F.coalesce(F.col(t), F.lit(""))) for t in texts.values()]).alias("_all"))
    df = df.select("*", F.transform("_all", lambda a: F.filter(a, lambda t: F.array_contains(F.element_at(buckets, (F.pmod(t, F.lit(BUCKETS)) + 1).cast("int")), t))).alias("_in"))
    df = df.select(*held, *[F.col(c)[k].alias(f"{c}_{n}") for k, n in enumerate(texts) for c in ("_all", "_in")])
    df = df.withColumns({f"_in_{n}": F.when(F.size(f"_in_{n}") * FEW >= F.size(f"_all_{n}"), F.col(f"_in_{n}")).otherwise(F.col(f"_all_{n}")) for n in texts})
    shift, levels = 16, []  # the low 16 bits choose the bucket
    for bits, count in SUBSETS:
        levels.append((bits, count, shift))
        shift += bits

    def key(t: Column, bits: int, shift: int) -> Column:
        return F.shiftright(t, shift).bitwiseAND(F.lit((1 << bits) - 1))

    def level(n: str, bits: int, count: int, shift: int) -> Column:
        return F.filter(f"_in_{n}", lambda t: key(t, bits, shift) < count).alias(f"_l{bits}_{n}")

    df = df.select("*", *[level(n, b, c, s) for n in texts for b, c, s in levels])

    def subset(n: str, bits: int, shift: int, k: int) -> Column:
        part = F.filter(f"_l{bits}_{n}", lambda t: key(t, bits, shift) == k)
        return F.when(F.size(part) > 0, F.lower(F.hex(F.xxhash64(part)))).otherwise("")

    def whole(n: str) -> Column:
        hashes = F.array(*[subset(n, b, s, k) for b, c, s in levels for k in range(c)])
        return F.when(F.size(f"_in_{n}") > 0, hashes).otherwise(F.array(F.lower(F.hex(F.xxhash64(F.col(f"_all_{n}"))))))

    return df.select(*held, *[whole(n).alias(n) for n in texts])


def likeness(a: Column, b: Column) -> Column:
    """The share of equal subsets among those with a term on either side."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    either = F.size(F.filter(pairs, lambda p: (F.coalesce(p["a"], F.lit("")) != "") | (F.coalesce(p["b"], F.lit("")) != "")))
    both = F.size(F.filter(pairs, lambda p: (p["a"] == p["b"]) & (p["a"] != "")))
    same_kind = F.size(a) == F.size(b)
    return F.when(a == b, F.lit(1.0)).when(~same_kind | (either == 0), F.lit(0.0)).otherwise(both / F.greatest(either, F.lit(1)))


def with_next(docs: DataFrame, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(doc_id, text, next_text): the text that follows in descending order of doc_id, the first after the last.

    Documents are dealt to ranges of ids, and a window inside each range finds the next text.  The first row of a
    range joins the range before it as a last row of its own, so texts move only in that one shuffle.
    """
    rows, _ = range_shards(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), shard_docs)
    rows = rows.withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc(), F.col("text")]
    low = F.lit(-(2**63))
    tops = written(rows.groupBy("shard").agg(F.max(F.coalesce("doc_id", low)).alias("top")), "tops")  # numbers, a row for each range
    down = Window.orderBy(F.desc("shard"))
    before = tops.select("shard", "top", F.coalesce(F.lag("shard").over(down), F.min("shard").over(Window.partitionBy())).alias("before"))
    heads = rows.join(F.broadcast(before), "shard").filter(F.coalesce("doc_id", low) == F.col("top"))
    heads = heads.withColumn("rn", F.row_number().over(Window.partitionBy("shard").orderBy(*order))).filter("rn = 1")
    both = rows.withColumn("extra", F.lit(0)).unionByName(heads.select("doc_id", "text", F.col("before").alias("shard"), "h", F.lit(1).alias("extra")))
    found = both.withColumn("next_text", F.lead("text").over(Window.partitionBy("shard").orderBy("extra", *order)))
    return found.filter("extra = 0").select("doc_id", "text", "next_text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each document."""
    rows = own_columns(docs, "doc_id", "text")
    return fingerprint_columns(rows, {"fingerprint": "text"}, lexicon(rows)).select("doc_id", F.array_join("fingerprint", "-").alias("fingerprint"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = own_columns(table(spark, sf_dir, "documents"), "doc_id", "text")
    lex = lexicon(docs)
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    rows = fingerprint_columns(rows, {"own": "text", "changed": "edited", "following": "next_text"}, lex)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("own", "-").alias("fingerprint"), F.array_join("changed", "-").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
