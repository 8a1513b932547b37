"""Label events: earliest dates, their reconciliation, precedence between sections, and safety changes.

Events are long rows: product, section (IND, AE, BOX), match (exact, nlp), aui, cui, pt_key, first_added, sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def earliest(rows: DataFrame, keys: list[str], date: str = "d", source: str = "source") -> DataFrame:
    """One row for each key: the least date (nulls only if all are) and the sorted set of sources."""
    return rows.groupBy(*keys).agg(F.min(date).alias("first_added"), F.array_sort(F.collect_set(source)).alias("sources"))


def _known(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != "")


def reconcile_bucket(rows: DataFrame, bucket: list[str]) -> DataFrame:
    """Each date falls to the least of its concept and of its preferred term in the bucket, in one pass.

    Null or empty concepts and terms group nothing.
    """
    by = lambda k: F.when(_known(F.col(k)), F.min("first_added").over(Window.partitionBy(*bucket, k)))
    return rows.withColumn("first_added", F.least("first_added", by("cui"), by("pt_key")))


def reconcile_across(rows: DataFrame, product: str = "product") -> DataFrame:
    """Dates fall to the concept's least within indications, and within events and boxed warnings together."""
    group = F.when(F.col("section") == "IND", "IND").otherwise("EVENT")
    return rows.withColumn("_g", group).withColumn("first_added", F.min("first_added").over(Window.partitionBy(product, "_g", "cui"))).drop("_g")


def resolve(rows: DataFrame, product: str = "product") -> DataFrame:
    """Precedence: exact indications, then the other indications, push a code out of events and boxed warnings;
    exact matches push out the looser ones of their section.  A code may stay both an event and boxed."""
    w = Window.partitionBy(product, "aui")
    has = lambda s, m: F.max(((F.col("section") == s) & (F.col("match") == m)).cast("int")).over(w) == 1
    flagged = rows.withColumn("_ei", has("IND", "exact")).withColumn("_ni", has("IND", "nlp")).withColumn("_ea", has("AE", "exact")).withColumn("_eb", has("BOX", "exact"))
    is_ind = F.col("section") == "IND"
    loose = F.col("match") == "nlp"
    gone = (is_ind & loose & F.col("_ei")) | (~is_ind & (F.col("_ei") | F.col("_ni"))) | ((F.col("section") == "AE") & loose & F.col("_ea")) | ((F.col("section") == "BOX") & loose & F.col("_eb"))
    return flagged.filter(~gone).drop("_ei", "_ni", "_ea", "_eb")


def apply_changes(events: DataFrame, changes: DataFrame, keys: list[str], own: str = "guid") -> DataFrame:
    """Safety changes: known codes take the earlier date and keep their sources; new ones come with the product's own guid.

    events (keys, first_added, sources), changes (keys, first_added, ``own``).
    """
    new = changes.groupBy(*keys).agg(F.min("first_added").alias("_d"), F.min(own).alias("_own"))
    j = events.join(new, keys, "full_outer")
    return j.select(*keys, F.least("first_added", "_d").alias("first_added"), F.coalesce("sources", F.array("_own")).alias("sources"))


def without_death(rows: DataFrame) -> DataFrame:
    """Indications never hold terms with "death"; other sections do."""
    return rows.filter((F.col("section") != "IND") | ~F.lower("term").contains("death") | F.col("term").isNull())


def in_window(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    """Strictly between two dates."""
    return rows.filter((F.col("first_added") > start) & (F.col("first_added") < end))


def new_in_window(rows: DataFrame, section: str, other: str, start: Column, end: Column, product: str = "product") -> DataFrame:
    """A section's events in the window, but those that the other section had before it."""
    prior = rows.filter((F.col("section") == other) & (F.col("first_added") < start)).select(product, "aui").distinct()
    return in_window(rows.filter(F.col("section") == section), start, end).join(prior, [product, "aui"], "left_anti")


def products_before(rows: DataFrame, date: Column, product: str = "product") -> DataFrame:
    return rows.filter(F.col("first_added") < date).select(product).distinct()


def with_codes(changes: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Only changes that have some code."""
    return changes.join(found.select(key).distinct(), key, "left_semi")


def counts_by_pass(rows: DataFrame, section: str = "section", match: str = "match") -> DataFrame:
    """(section, pass, n): events by section and kind of match."""
    return rows.groupBy(F.col(section).alias("section"), F.col(match).alias("pass")).agg(F.count("*").alias("n"))


def code_lists(rows: DataFrame, key: str, code: str) -> DataFrame:
    """(key, codes): each key's distinct codes, sorted."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(code)).alias("codes"))
