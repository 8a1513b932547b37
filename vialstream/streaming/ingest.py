"""Incremental ingest: new label archives as a stream of files, each batch through the same parsing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialstream.sources import manifest, spl, zips


def archive_stream(spark: SparkSession, root: str, per_batch: int = 1000) -> DataFrame:
    """New zips below ``root``; the stream's checkpoint remembers which were read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_batch).load(root)


def named(files: DataFrame) -> DataFrame:
    kind = F.lower(F.regexp_extract("path", r"/(prescription|other|otc)/[^/]*$", 1))
    year = F.expr("try_cast(nullif(regexp_extract(path, '/([0-9]{4})/(?:prescription|other|otc)/[^/]*$', 1), '') as int)")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("zip_name"), kind.alias("source_type"), year.alias("year"), "length", "content")


def parsed(files: DataFrame) -> DataFrame:
    return spl.labels(zips.right_class(zips.expand(named(files))))


def into_manifest(stream: DataFrame, root: str, checkpoint: str, name: str) -> list[dict]:
    """All files there are into the manifest below ``root``, each batch once, even if the stream runs it again.

    Returns what each batch that ran has counted: entries, kept ones, and those of each reason.
    """
    sink = lambda b, n: manifest.record(b, root, (name, n))
    rows = zips.watched(zips.entries(named(stream)))
    q = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return [p.observedMetrics["entries"].asDict() for p in q.recentProgress if "entries" in p.observedMetrics]


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """All files there are, in batches; ``sink`` gets each batch's labels and number (it should overwrite by number)."""
    q = stream.writeStream.foreachBatch(lambda b, n: sink(parsed(b), n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
