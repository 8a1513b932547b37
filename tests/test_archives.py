"""Archives by year, rejected entries, and the manifest's state."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from vialstream.sources import commit, manifest, zips
from vialstream.streaming import ingest


def zipped(*files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files:
            z.writestr(name, data)
    return b.getvalue()


def put(root, path, *files, raw=None):
    at = root / path
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_bytes(zipped(*files) if raw is None else raw)


@pytest.fixture
def root(tmp_path):
    top = tmp_path / "labels 2019" / "1999"  # years above the root don't count
    for year in ("2004", "2005", "2020", "2031", "x2020", "20200"):
        put(top, f"{year}/otc/{year}_a.zip", ("a.xml", "<a/>"))
    put(top, "2020/other/deep/2020_b.zip", ("b.xml", "<a/>"))
    put(top, "2020_top.zip", ("t.xml", "<a/>"))
    return top


def test_years_within_bounds_are_scanned_only(spark, root):
    assert [y for y, _ in zips.year_folders(spark, str(root), last=2030)] == [2005, 2020]
    for uri in (str(root), f"file://{root}/"):
        files = zips.archives(spark, uri, last=2030)
        assert {(r["zip_name"], r["year"], r["source_type"]) for r in files.collect()} == {("2005_a.zip", 2005, "otc"), ("2020_a.zip", 2020, "otc"), ("2020_b.zip", 2020, "")}
        assert all("/2005/" in f or "/2020/" in f for f in files.inputFiles()) and len(files.inputFiles()) == 3
    some = zips.archives(spark, str(root), first=2006, last=2030)
    assert {r["year"] for r in some.select("year").collect()} == {2020} and len(some.inputFiles()) == 2
    assert zips.archives(spark, str(root), first=2021, last=2022).collect() == []
    # a listing of paths reads no content
    plan = spark.read.format("binaryFile").load(f"{root}/2020/otc").select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_every_entry_is_kept_or_rejected(spark, tmp_path):
    good = zipped(("a.xml", "<a/>"), ("b.XML", "<b/>"), ("c.txt", "x"), ("../d.xml", "<a/>"), ("big.xml", "x" * 5000), ("f/", ""))
    broken = bytearray(zipped(("ok.xml", "<a/>"), ("bad.xml", "<a>" + "y" * 500 + "</a>")))
    at = broken.index(b"bad.xml") + len(b"bad.xml")
    broken[at : at + 6] = b"\xff" * 6
    # a header that tells a small size for a large entry
    small = bytearray(zipped(("lie.xml", "z" * 4000)))
    for sign, skip in ((b"PK\x03\x04", 22), (b"PK\x01\x02", 24)):
        k = small.index(sign) + skip
        small[k : k + 4] = (10).to_bytes(4, "little")
    rows = spark.createDataFrame([("g.zip", bytearray(good)), ("b.zip", broken), ("l.zip", small), ("n.zip", bytearray(b"none")), ("0.zip", None)], "zip_name string, content binary").select("zip_name", F.lit("otc").alias("source_type"), F.lit(2020).alias("year"), "content")
    found = zips.entries(rows, 3000)
    got = {(r["zip_name"], r["xml_name"]): r["reason"] for r in found.collect()}
    assert got == {
        ("g.zip", "a.xml"): None, ("g.zip", "b.XML"): None, ("g.zip", "c.txt"): "not xml", ("g.zip", "../d.xml"): "unsafe name", ("g.zip", "big.xml"): "too large",
        ("b.zip", "ok.xml"): None, ("b.zip", "bad.xml"): "broken entry", ("l.zip", "lie.xml"): got[("l.zip", "lie.xml")], ("n.zip", None): "broken archive", ("0.zip", None): "broken archive",
    }
    assert got[("l.zip", "lie.xml")] in ("too large", "broken entry")
    n = zips.counted(found).first().asDict()
    assert n["entries"] == len(got) == n["kept"] + sum(n[r.replace(" ", "_")] for r in zips.REASONS) and n["kept"] == 3 and n["broken_archive"] == 2
    assert {r["xml_name"] for r in zips.expand(rows, 3000).collect()} == {"a.xml", "b.XML", "ok.xml"}
    assert zips.entries(rows.filter("false")).collect() == []


def test_a_file_in_two_batches_is_one_row(spark, root, tmp_path):
    store = str(tmp_path / "store")
    files = zips.entries(zips.archives(spark, str(root), last=2030))
    assert manifest.record(files, store, ("batch", 0)) and not manifest.record(files, store, ("batch", 0))
    assert len(commit.versions(store)) == 1
    assert manifest.record(files.filter("year = 2020").withColumn("product_name", F.lit("NEW")), store, ("batch", 1))
    got = {(r["zip_name"], r["product_name"], r["version"]) for r in manifest.current(spark, store).collect()}
    assert got == {("2005_a.zip", None, 1), ("2020_a.zip", "NEW", 2), ("2020_b.zip", "NEW", 2)}
    assert manifest.record(files.filter("zip_name = '2020_b.zip'").withColumn("reason", F.lit("too large")), store, ("batch", 2))
    assert manifest.current(spark, store).count() == 2 and [r["reason"] for r in manifest.rejects(spark, store).collect()] == ["too large"]
    left = zips.not_yet_mapped(zips.archives(spark, str(root), last=2030), manifest.current(spark, store))
    assert [r["zip_name"] for r in left.select("zip_name").collect()] == ["2020_b.zip"]


def test_a_stream_and_a_batch_share_the_state(spark, root, tmp_path):
    store, at = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    stream = lambda: ingest.archive_stream(spark, str(root / "2020"), per_batch=1)
    put(root, "2020/otc/2020_c.zip", raw=b"none")
    counts = ingest.into_manifest(stream(), store, at, "labels")
    assert sum(c["entries"] for c in counts) == 3 and sum(c["kept"] for c in counts) == 2 and sum(c["broken_archive"] for c in counts) == 1
    ingest.into_manifest(stream(), store, at, "labels")  # nothing new
    assert len(commit.versions(store)) == 3 and manifest.current(spark, store).count() == 2
    # the stream forgets what it read: its batches are there already
    ingest.into_manifest(stream(), store, str(tmp_path / "other"), "labels")
    assert len(commit.versions(store)) == 3
    manifest.record(zips.entries(zips.archives(spark, str(root), last=2030)), store, ("batch", 0))
    got = {(r["zip_name"], r["version"]) for r in manifest.current(spark, store).collect()}
    assert got == {("2005_a.zip", 4), ("2020_a.zip", 4), ("2020_b.zip", 4)}


def test_entries_go_on_before_a_batch_is_done(monkeypatch):
    """A batch of archives gives several batches of files, none of which holds more than the bound and one file."""
    import io
    import zipfile

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    from vialstream.sources import zips

    def zipped(k):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            z.writestr("a.xml", b"<a>" + b"x" * 5000 + b"</a>")
            z.writestr("b.txt", b"x")
        return b.getvalue() if k % 7 else b"broken"

    content = [zipped(k) for k in range(50)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array([f"z{k}" for k in range(51)]), pa.array(["otc"] * 51), pa.array([2020] * 51, pa.int32()), pa.array(content, pa.binary())], ["zip_name", "source_type", "year", "content"])
    schema = pa.schema([*(batch.schema.field(c) for c in range(3)), *to_arrow_schema(zips.ENTRY)])
    monkeypatch.setattr(zips, "MOST_HELD", 20_000)
    out = list(zips._batches(batch, schema, 10_000))
    assert len(out) > 8 and max(x.nbytes for x in out) < 30_000
    rows = pa.Table.from_batches(out).to_pylist()
    assert [(x["zip_name"], x["xml_name"], x["reason"]) for x in rows] == [
        y for k in range(51) for y in ([(f"z{k}", None, "broken archive")] if k % 7 == 0 or k == 50 else [(f"z{k}", "a.xml", None), (f"z{k}", "b.txt", "not xml")])
    ]
