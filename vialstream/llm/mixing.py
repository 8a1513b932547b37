"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weight's share of all sizes, at most ``ceiling`` times its own size; what is
cut off is shared again by weight.  Within a source a document is owed copies in proportion to its own weight,
at most ``ceiling``; the level is set so that the copies owed make up the target.  The whole part of what is
owed is allotted outright, and the rest is an order sample with unequal inclusion probabilities.  Documents are
ranked by random odds over inclusion odds and taken in that order up to the words still owed; one closing
document, the one whose size is nearest to what is then left, brings the sum near the target.

A document's weight is a column of the caller's, or else its size to the power ``POWER``: longer documents are
likelier.  Weights count to a sixteenth of an octave, so the level comes from a table of about a thousand rows
a source at any size.

The order sample never sorts a whole source: words are summed in ``BINS`` bins of the rank, and only
the bin in which the target falls is ordered.  Random numbers come from md5 of id and seed, so reruns
agree.  Cases: a null text has size 0; null sources are one source, the last; a null id draws like an
empty one; repeated rows are separate documents (in equal ranks the larger first); no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import numbered, own_columns, released, small, table, written

CEILING = 3
WEIGHTS = (5, 2, 1)
BINS = 4096
POWER = 0.25
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, ceiling: float = CEILING) -> DataFrame:
    """Sources' targets from (source, source_size), a row for each source: the water level in closed form.

    Sources by cap over weight, ascending: one is capped while the level that the rest would share is
    above its own; the others get their weight times the level.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), (number % len(weights) + 1).cast("int"))
    a = sizes.select("source", "source_size", w.alias("w"), (F.col("source_size") * float(ceiling)).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    a = a.withColumn("level", level).withColumn("capped", F.col("level") * F.col("w") >= F.col("cap"))
    free = F.max(F.when(~F.col("capped"), F.struct(-F.col("cap") / F.col("w"), "level"))).over(Window.partitionBy())["level"]
    return a.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * free).alias("target"))


def levels(masses: DataFrame, goal: DataFrame, ceiling: float = CEILING) -> DataFrame:
    """(source, share, owed): the copies owed to a document, from masses (source, share, m: words) and targets.

    Shares by falling size: one is at the ceiling while the level that it and the rest would get puts it there.
    """
    same = masses.join(goal.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    order = Window.partitionBy("source").orderBy(F.desc("share"))
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = F.try_divide(F.col("target") - float(ceiling) * F.coalesce(F.sum("m").over(before), F.lit(0)), F.sum(F.col("m") * F.col("share")).over(rest))
    a = same.withColumn("level", level).withColumn("full", F.coalesce(F.col("level") * F.col("share") >= float(ceiling), F.lit(False)))
    free = F.max(F.when(~F.col("full"), F.struct("share", "level"))).over(Window.partitionBy("source"))["level"]
    owed = F.when(F.col("full"), float(ceiling)).otherwise(F.least(F.greatest(F.coalesce(free, F.lit(0.0)), F.lit(0.0)) * F.col("share"), F.lit(float(ceiling))))
    return a.select("source", "share", "source_size", "target", owed.alias("owed"))


def mixture(docs: DataFrame, weights: tuple = WEIGHTS, ceiling: float = CEILING, seed: str = "mix", weight: str | None = None, keep: tuple = ()) -> DataFrame:
    """A row for each document: size, source_size, target, copies and taken (copies * size)."""
    odds = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"|{seed}"))), 1, 12), 16, 10).cast("double")
    u = (odds + 0.5) / float(1 << 48)
    extra = [F.col(f"`{c}`") for c in keep]
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    share = F.coalesce(F.col(f"`{weight}`").cast("double"), F.lit(0.0)) if weight else F.pow(F.col("size").cast("double"), F.lit(POWER))
    rows = docs.select("doc_id", "source", size.alias("size"), u.alias("u"), *([F.col(f"`{weight}`")] if weight and weight not in keep else []), *extra)
    rows = rows.withColumn("share", F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(share, F.lit(1e-9))) * 16) / 16))
    rows = written(rows.select("doc_id", "source", "size", "u", "share", *extra).withColumn("n", F.monotonically_increasing_id()), "mix")
    masses = written(rows.groupBy("source", "share").agg(F.sum("size").alias("m")), "masses")
    goal = targets(masses.groupBy("source").agg(F.sum("m").alias("source_size")), weights, ceiling)
    goal = small(levels(masses, goal, ceiling).select(F.col("source").alias("s"), F.col("share").alias("s_share"), "source_size", "target", "owed"))
    r = rows.join(goal, F.col("source").eqNullSafe(F.col("s")) & (F.col("share") == F.col("s_share"))).drop("s_share")
    r = r.withColumn("whole", F.floor("owed").cast("long")).withColumn("part", F.col("owed") - F.floor("owed"))
    rank = F.when(F.col("part") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("part") / (1 - F.col("part"))))
    r = r.withColumn("rank", rank).withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int"))
    bins = r.groupBy("s", "bin").agg(F.sum("size").alias("b"), F.sum(F.col("size") * F.col("whole")).alias("certain"), F.first("target").alias("target"))
    by_source = Window.partitionBy("s")
    left = F.col("target") - F.sum("certain").over(by_source)
    bins = bins.withColumn("left", left).filter("bin is not null").withColumn("low", F.coalesce(F.sum("b").over(by_source.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # the bin in which the owed words end
    edge = bins.filter((F.col("low") <= F.col("left")) & (F.col("low") + F.col("b") >= F.col("left"))).groupBy("s").agg(F.min(F.struct("bin", "low", "left")).alias("e"))
    past = bins.groupBy("s").agg(F.max("left").alias("left"))
    edge = past.join(edge, past["s"].eqNullSafe(edge["s"]), "left").select(past["s"].alias("es"), F.col("e.bin").alias("edge"), F.col("e.low").alias("low"), past["left"].alias("left"))
    r = r.join(small(edge), F.col("source").eqNullSafe(F.col("es")), "left").drop("es")
    order = Window.partitionBy("s", "edge").orderBy("rank", F.col("size").desc(), "n").rowsBetween(Window.unboundedPreceding, -1)
    inside = r.filter("bin = edge").withColumn("before", F.col("low") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    inside = inside.withColumn("chosen", F.col("before") + F.col("size") <= F.col("left")).drop("before")
    outside = r.filter("bin is null or edge is null or bin <> edge").withColumn("chosen", F.coalesce(F.when(F.col("edge").isNull(), F.col("left") > 0).otherwise(F.col("bin") < F.col("edge")), F.lit(False)) & F.col("bin").isNotNull())
    r = written(inside.unionByName(outside), "order")
    # the closing document: what is owed after the order sample, met by the nearest size
    rest = r.groupBy("s").agg((F.max("target") - F.sum(F.col("size") * (F.col("whole") + F.col("chosen").cast("long")))).alias("rest")).select(F.col("s").alias("rs"), "rest")
    r2 = r.join(small(rest), F.col("s").eqNullSafe(F.col("rs"))).drop("rs")
    gap = F.abs(F.col("rest") - F.col("size"))
    close = r2.filter("not chosen and bin is not null and rest > 0 and size > 0").filter(gap < F.col("rest")).groupBy("s").agg(F.min(F.struct(gap.alias("gap"), "rank", "n")).alias("c"))
    close = close.select(F.col("s").alias("cs"), F.col("c.n").alias("c_n"))
    r3 = r2.join(small(close), F.col("s").eqNullSafe(F.col("cs")), "left")
    released(rows, masses)
    copies = F.col("whole") + (F.col("chosen") | F.coalesce(F.col("n") == F.col("c_n"), F.lit(False))).cast("long")
    return r3.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), copies.alias("copies"), (copies * F.col("size")).alias("taken"), *extra)


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each row as many times as the mix takes it (0 to 3).

    The mix is drawn on rows without text; the texts meet their copies by row number.
    """
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = numbered(own_columns(docs, *cols))
    drawn = small(mixture(rows, keep=("rid",)).filter("copies > 0").select("rid", "copies"), "drawn")
    mixed = rows.join(drawn, "rid")
    return mixed.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*cols)
