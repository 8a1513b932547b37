"""The manifest of archives' entries: batches and streams add to one state, each batch exactly once.

A batch's entries and its number appear in one transaction, so a batch that comes again (a stream's rerun after a
failure) finds its number and adds nothing.  The state of an entry is that of its last version: a file that comes in
two batches is one row, and one that is rejected later is gone.  Of equal entries in one batch a kept one counts, then
the one with the greatest values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialstream.sources import commit

KEY = ("zip_name", "source_type", "xml_name")
_ROW = ("zip_name", "source_type", "year", "xml_name", "label_class", "product_name", "reason")


def has(spark: SparkSession, root: str, batch: tuple[str, int]) -> bool:
    if not commit.versions(root):
        return False
    done = commit.read(spark, root, "batches", every=True)
    return not done.filter((F.col("source") == batch[0]) & (F.col("number") == batch[1])).isEmpty()


def record(entries: DataFrame, root: str, batch: tuple[str, int], tries: int = 5) -> bool:
    """Adds a batch of ``zips.entries`` rows (their bytes are left out); False if its (source, number) is there already."""
    spark = entries.sparkSession
    for _ in range(tries):
        if has(spark, root, batch):
            return False
        try:
            with commit.Transaction(spark, root) as t:
                t.write("entries", entries.select(*_ROW).withColumn("version", F.lit(t.number).cast("long")))
                t.write("batches", spark.createDataFrame([batch], "source string, number long").coalesce(1))
        except commit.Conflict:
            continue
        return True
    raise commit.Conflict(f"{root}: others committed {tries} times")


def _last(spark: SparkSession, root: str) -> DataFrame:
    rows = commit.read(spark, root, "entries", every=True)
    key = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in KEY]
    order = F.struct("version", F.col("reason").isNull().alias("ok"), "product_name", "label_class", "year", "reason")
    return rows.select(*key, order.alias("o")).groupBy(*KEY).agg(F.max("o").alias("o")).select(*KEY, "o.year", "o.label_class", "o.product_name", "o.reason", "o.version")


def current(spark: SparkSession, root: str) -> DataFrame:
    """(zip_name, source_type, xml_name, year, label_class, product_name, version) of kept entries."""
    return _last(spark, root).filter("reason IS NULL").drop("reason")


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """The same of rejected entries, with their reasons; a broken archive's name of the entry is empty."""
    return _last(spark, root).filter("reason IS NOT NULL")
