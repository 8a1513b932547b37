"""CSV, TSV, JDBC and pipe-file inputs with explicit schemas; configuration."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialstream.functions import codes
from vialstream.operators import products

T = TypeVar("T")
_ROW = F.monotonically_increasing_id


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, where its scan has fewer tasks than the session has cores (small files); else as it is.

    Only the number of tasks is asked for, so a large input is never shuffled for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(4 * cores)


def _read(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """All columns as strings, in file order (column ``_row``); malformed fields are null."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("sep", sep).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True).csv(path).withColumn("_row", _ROW())


def zip_manifest(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ["zip_name", "xml_name", "source_type"]).drop("_row")


def product_manifest(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ["zip_name", "product_name"]).drop("_row")


def changes(spark: SparkSession, path: str) -> DataFrame:
    """Safety-change metadata: the last row of an application number wins, rows without a number go."""
    r = _read(spark, path, ["drug_name", "active_ingredient", "application", "application_type", "supplement", "updated", "link"])
    r = r.select("drug_name", "active_ingredient", F.expr("try_cast(application as int)").alias("application_number"), F.expr("try_to_date(supplement, 'MM/dd/yyyy')").alias("supplement_date"), F.expr("try_to_date(updated, 'MM/dd/yyyy')").alias("database_updated"), "link", codes.change_id(F.col("link")).alias("drug_id"), "_row")
    best = r.filter("application_number IS NOT NULL").groupBy("application_number").agg(F.max_by(F.struct("drug_name", "active_ingredient", "supplement_date", "database_updated", "link", "drug_id"), "_row").alias("r"))
    return best.select("application_number", "r.*")


def approvals(spark: SparkSession, path: str) -> DataFrame:
    """(appl_no, approved) of a submissions TSV."""
    r = _read(spark, path, ["ApplNo", "SubmissionClassCodeID", "SubmissionType", "SubmissionNo", "SubmissionStatus", "SubmissionStatusDate", "SubmissionsPublicNotes", "ReviewPriority"], "\t")
    r = r.select(F.expr("try_cast(trim(ApplNo) as int)").alias("appl_no"), F.col("SubmissionType").alias("submission_type"), F.col("SubmissionStatus").alias("status"), codes.first_match_date(F.col("SubmissionStatusDate")).alias("status_date"))
    return products.first_approvals(r.filter("appl_no IS NOT NULL AND status_date IS NOT NULL"))


def sponsors(spark: SparkSession, path: str) -> DataFrame:
    """(appl_no, sponsor) of an applications TSV whose header names the columns; the last row wins."""
    r = spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path).withColumn("_row", _ROW())
    r = r.select(F.expr("try_cast(trim(ApplNo) as int)").alias("appl_no"), F.col("SponsorName").alias("sponsor"), "_row").filter("appl_no IS NOT NULL AND trim(sponsor) <> ''")
    return products.last_row_wins(r, "appl_no", "sponsor", "_row")


def prior_ids(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(guid, substance_id), the first positive id of each guid, and the guids with several."""
    r = _read(spark, path, ["guid", "id"]).select(F.trim("guid").alias("guid"), F.expr("try_cast(trim(id) as int)").alias("substance_id"), "_row").filter("guid <> '' AND substance_id > 0")
    return products.first_row_wins(r, "guid", "substance_id", "_row"), products.conflicts(r, "guid", "substance_id")


def stop_phrases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("phrase")).filter("phrase <> '' AND NOT startswith(phrase, '#')").distinct()


def suffix_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(suffix, base_name, example_term, source, updated) of a catalogue of four-letter suffixes; the last row of a suffix counts."""
    r = _read(spark, path, ["suffix", "base_name", "example_term", "source", "updated"]).withColumn("suffix", F.lower(F.trim("suffix"))).filter("suffix RLIKE '^[a-z]{4}$'")
    r = r.withColumn("updated", F.expr("try_to_date(updated, 'yyyy-MM-dd')"))
    return r.groupBy("suffix").agg(F.max_by(F.struct("base_name", "example_term", "source", "updated"), "_row").alias("r")).select("suffix", "r.*")


def pipe_file(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A terminology table from its public pipe-delimited file (a trailing pipe ends each line)."""
    parts = F.split("value", r"\|")
    return spark.read.text(path).select(*[F.nullif(parts[k], F.lit("")).alias(c) for k, c in enumerate(columns) if c])


def retried(act: Callable[[], T], tries: int = 4, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """``act()``, again after 1, 2, 4 ... times ``wait`` seconds if it fails; the last failure is raised.

    For what the driver asks of a database; tasks that fail are run again by Spark.
    """
    for k in range(tries):
        try:
            return act()
        except Exception:
            if k == tries - 1:
                raise
            sleep(wait * 2**k)
    raise ValueError("tries is below 1")


def range_predicates(counts: DataFrame, column: str, parts: int, integral: bool = True) -> list[str]:
    """At most ``parts`` conditions that part the rows of (key, n) counts evenly, whatever the keys' spread.

    Cuts are quantiles of the keys weighted by their counts.  A key with more rows than a part is in a part with as few
    others as can be, since a condition on the key can't part it; null keys are in the first part.
    """
    probs = [k / parts for k in range(1, parts)]
    if not probs:
        return ["1 = 1"]
    cuts = counts.filter("key IS NOT NULL").agg(F.percentile("key", probs, F.col("n")).alias("q")).first()["q"] or []
    cuts = sorted({math.ceil(c) if integral else c for c in cuts})
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def jdbc_table(spark: SparkSession, url: str, table: str, column: str | None = None, parts: int = 16, fetch: int = 5000, tries: int = 4, wait: float = 1.0, **options: str) -> DataFrame:
    """A database table, read in at most ``parts`` ranges of equal row counts of a numeric column where one is named.

    The database counts its keys, Spark takes quantiles of these counts.  Rows of other columns that no plan needs are not
    fetched, filters reach the database in each range.
    """
    how = {"fetchsize": str(fetch), **options}
    read = lambda source: spark.read.format("jdbc").option("url", url).options(**how).option("dbtable", source).load()
    if column is None:
        return retried(lambda: read(table), tries, wait)
    counts = lambda: read(f"(SELECT {column} AS key_, COUNT(*) AS n_ FROM {table} GROUP BY {column}) counts_")

    def predicates() -> list[str]:
        c = counts()
        integral = dict(c.dtypes)[c.columns[0]] in ("tinyint", "smallint", "int", "bigint")
        return range_predicates(c.toDF("key", "n"), column, parts, integral)

    found = retried(predicates, tries, wait)
    return retried(lambda: spark.read.jdbc(url, table, predicates=found, properties=how), tries, wait)


@dataclass
class Settings:
    """Where a build reads and writes, and how it filters other labels."""

    labels: str = ""
    changes_csv: str = ""
    change_pages: str = ""
    output: str = ""
    code_mode: str = "include"
    codes: tuple[str, ...] = field(default_factory=tuple)

    @classmethod
    def from_text(cls, text: str) -> Settings:
        """``key = value`` lines; ``#`` starts a comment; unknown keys are errors."""
        got: dict[str, object] = {}
        for line in text.splitlines():
            line = line.strip()
            if line and not line.startswith("#"):
                k, _, v = line.partition("=")
                k, v = k.strip().replace(".", "_"), v.strip()
                if k not in cls.__dataclass_fields__:
                    raise ValueError(f"unknown setting: {k}")
                got[k] = tuple(x.strip() for x in v.split(",") if x.strip()) if k == "codes" else v
        return cls(**got)

    def check(self) -> None:
        missing = [k for k in ("labels", "output") if not getattr(self, k)]
        if missing:
            raise ValueError(f"settings missing: {', '.join(missing)}")
        if self.code_mode not in ("include", "exclude", "off"):
            raise ValueError(f"code_mode: {self.code_mode}")
