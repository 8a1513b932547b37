"""Label archives: zip files to documents, manifests and product names, without writing to any disk."""

from __future__ import annotations

import datetime
import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vialstream.sources import spl

#: Fixed value: the first year of archives.
FIRST_YEAR = 2005

ENTRY = T.StructType([T.StructField("xml_name", T.StringType()), T.StructField("xml", T.BinaryType()), T.StructField("label_class", T.StringType()), T.StructField("product_name", T.StringType()), T.StructField("reason", T.StringType())])
REASONS = ("not xml", "unsafe name", "too large", "broken entry", "broken archive")


#: Bytes of entries that a task holds before it hands them on; one entry may be more.
MOST_HELD = 4 << 20


def _below(root: str) -> str:
    """A pattern of the root within a path, whatever its scheme."""
    return re.escape(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", root).rstrip("/"))


def year_folders(spark: SparkSession, root: str, first: int = FIRST_YEAR, last: int | None = None, pattern: str = "*.zip") -> list[tuple[int, str]]:
    """(year, folder) of the folders right below ``root`` that hold archives and whose names are years within bounds.

    Paths only are listed, no content is read; ``last`` is the next year if none is named.
    """
    last = last or datetime.date.today().year + 1
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root).select("path")
    folder = F.regexp_extract("path", f"^(.*{_below(root)}/[0-9]+)/", 1)
    year = F.expr("try_cast(nullif(regexp_extract(folder, '([0-9]+)$', 1), '') as int)")
    rows = files.select(folder.alias("folder")).filter("folder <> ''").distinct().select(year.alias("year"), "folder").filter(F.col("year").between(first, last))
    return sorted((r["year"], r["folder"]) for r in rows.collect())  # one row a year


def archives(spark: SparkSession, root: str, pattern: str = "*.zip", first: int = FIRST_YEAR, last: int | None = None) -> DataFrame:
    """(zip_name, source_type, year, length, content) of the zips in the year folders of ``root`` within bounds; only these are scanned."""
    folders = [f for _, f in year_folders(spark, root, first, last, pattern)]
    kind = F.lower(F.regexp_extract("path", r"/(prescription|other|otc)/[^/]*$", 1))
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folders) if folders else spark.createDataFrame([], schema)
    year = F.regexp_extract("path", f"{_below(root)}/([0-9]+)/", 1).cast("int")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("zip_name"), kind.alias("source_type"), year.alias("year"), "length", "content")


def not_yet_mapped(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Archives without a manifest row of the same source type."""
    return files.join(manifest.select("zip_name", "source_type").distinct(), ["zip_name", "source_type"], "left_anti")


def safe_entry(name: str) -> bool:
    """Whether an entry's name stays below its folder."""
    parts = name.replace("\\", "/").split("/")
    return bool(name) and not name.startswith(("/", "\\")) and ".." not in parts and ":" not in parts[0]


def _read(z: zipfile.ZipFile, info: zipfile.ZipInfo, most: int) -> tuple[bytes | None, str | None]:
    """An entry's bytes, or the reason why there are none; what a header says of the size isn't trusted."""
    if not safe_entry(info.filename):
        return None, "unsafe name"
    if not info.filename.lower().endswith(".xml"):
        return None, "not xml"
    if info.file_size > most:
        return None, "too large"
    try:
        with z.open(info) as f:
            data = f.read(most + 1)
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, OSError):
        return None, "broken entry"
    return (None, "too large") if len(data) > most else (data, None)


def _entries(content: bytes | None, most: int) -> list[dict]:
    out = []
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
            for info in z.infolist():
                if not info.is_dir():
                    xml, reason = _read(z, info, most)
                    doc = spl.parse(xml)
                    out.append({"xml_name": info.filename, "xml": xml, "label_class": spl.label_class(doc), "product_name": spl.product_name(doc), "reason": reason})
    except (zipfile.BadZipFile, EOFError, NotImplementedError, ValueError, OSError):
        out.append({"xml_name": None, "xml": None, "label_class": None, "product_name": None, "reason": "broken archive"})
    return out


def _batches(batch: pa.RecordBatch, schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of the files in a batch of archives (three columns and the content)."""
    rows: list[tuple] = []
    held = 0
    table = lambda: pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    for n in range(batch.num_rows):
        own = [batch.column(c)[n].as_py() for c in range(3)]
        for e in _entries(batch.column(3)[n].as_py(), most):
            rows.append((*own, *(e[c] for c in ENTRY.fieldNames())))
            held += len(e["xml"] or b"") + 256
            if held > MOST_HELD:
                yield table()
                rows, held = [], 0
    if rows:
        yield table()


def entries(files: DataFrame, most: int = spl.MOST_BYTES) -> DataFrame:
    """A row for each file in each archive, kept (``reason`` null) or rejected (one of ``REASONS``, without bytes).

    An archive that can't be read is one rejected row without a name; folders are no files.  Rows go on as soon as they hold
    ``MOST_HELD`` bytes, so a task never has the files of a whole batch of archives.
    """
    own = files.select("zip_name", "source_type", "year")
    made = T.StructType([*(T.StructField(f.name, f.dataType) for f in own.schema.fields), *ENTRY.fields])
    schema = to_arrow_schema(made)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(batch, schema, most)

    return files.select(*own.columns, "content").mapInArrow(found, made)


def _counts() -> list[Column]:
    each = [F.count_if(F.col("reason") == r).alias(r.replace(" ", "_")) for r in REASONS]
    return [F.count(F.lit(1)).alias("entries"), F.count_if(F.col("reason").isNull()).alias("kept"), *each]


def counted(rows: DataFrame) -> DataFrame:
    """One row: how many ``entries`` rows there are, how many are kept, and how many have each reason."""
    return rows.agg(*_counts())


def watched(rows: DataFrame, name: str = "entries") -> DataFrame:
    """``entries`` rows of a stream; each batch's progress has the counts among its observed metrics, without a pass of their own."""
    return rows.observe(name, *_counts())


def expand(files: DataFrame, most: int = spl.MOST_BYTES) -> DataFrame:
    """The kept entries; ``entries`` has the others too."""
    return entries(files, most).filter("reason IS NULL").drop("reason")


def right_class(rows: DataFrame) -> DataFrame:
    """Labels whose class fits the archive's source type; bulk ingredients and animal drugs never do."""
    c = F.lower(F.coalesce("label_class", F.lit("")))
    otc = c.contains("otc drug")
    wrong = ((F.col("source_type") == "prescription") & otc) | ((F.col("source_type") == "otc") & ~otc) | c.contains("bulk ingredient") | c.contains("animal drug")
    return rows.filter(~wrong)


def label_guids(manifest: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(guid, source_type, xml_names) of manifest rows (zip_name, xml_name, source_type) without blanks; with ``existing``
    (xml_name) only of files that are there."""
    guid = F.regexp_replace(F.regexp_extract("zip_name", r"_(.*)$", 1), r"\.zip$", "")
    ok = manifest.filter("trim(zip_name) <> '' AND trim(xml_name) <> '' AND trim(source_type) <> ''").withColumn("guid", guid).filter("guid <> ''")
    ok = ok if existing is None else ok.join(existing.select("xml_name").distinct(), "xml_name", "left_semi")
    return ok.groupBy("guid", "source_type").agg(F.array_sort(F.collect_set("xml_name")).alias("xml_names"))
