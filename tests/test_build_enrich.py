"""Approvals, sponsors, classes, brand names and the section classifier inside the build."""

from datetime import date

from pyspark.sql import functions as F

from vialstream.operators import products, training
from vialstream.plans import build


def test_approvals_fill_and_never_override(spark):
    labels = spark.createDataFrame(
        [("p", "a", None, date(2019, 1, 1)), ("p", "b", 2, None), ("p", "c", 3, None), ("p", "c", 3, date(2018, 5, 5)), ("p", "c", None, date(2018, 6, 6)), ("p", "d", 9, None), ("q", "e", 9, None), ("r", "f", 3, None)],
        "product string, guid string, appl_no int, label_date date",
    )
    approvals = spark.createDataFrame([(2, date(2001, 2, 3)), (3, date(1999, 1, 1))], "appl_no int, approved date")
    sponsors = spark.createDataFrame([(2, "Two"), (3, "Three"), (8, "Eight")], "appl_no int, sponsor string")
    got = {r["guid"]: (r["application_number"], r["approval_date"], r["sponsor"]) for r in products.approved_labels(labels, approvals, sponsors).collect()}
    # b is the first label of p with an approval: its date fills d as well; c is the last with a sponsor
    assert got == {
        "a": (0, date(2019, 1, 1), "Three"), "b": (2, date(2001, 2, 3), "Three"), "c": (3, date(2018, 5, 5), "Three"), "d": (9, date(2001, 2, 3), "Three"),
        "e": (9, None, None), "f": (3, date(1999, 1, 1), "Three"),
    }
    assert products.approved_labels(labels.limit(0), approvals, sponsors).count() == 0


def test_classes_keep_the_raw_code(spark):
    own = spark.createDataFrame([("g", "1234-5678"), ("g", "1234-5678"), ("g", "12345-67-89"), ("h", None)], "product string, ndc string")
    classes = spark.createDataFrame([("012345678", "A"), ("012345678", "B")], "ndc string, class_aui string")
    assert [tuple(r) for r in products.classes_of(own, classes, raw=True).collect()] == [("g", "1234-5678", "B")]
    assert [tuple(r) for r in products.classes_of(own, classes).collect()] == [("g", "012345678", "B")]


def test_brands_join_links_once(spark):
    links = spark.createDataFrame([("g", "D1"), ("g", "B1"), ("h", "D2"), ("i", None)], "product string, aui string")
    brands = spark.createDataFrame([("D1", "B1"), ("D1", "B2"), ("D1", "B2"), ("D9", "B9")], "drug_aui string, brand_aui string")
    got = sorted(((r[0], r[1] or "") for r in products.with_brands(links, brands).collect()))
    assert got == [("g", "B1"), ("g", "B2"), ("g", "D1"), ("h", "D2"), ("i", "")]


def test_copies_of_brands_go_before_the_join(spark):
    """2e9 rows would come from this join with its copies, 4 without."""
    links = spark.range(40_000).selectExpr("'g' AS product", "concat('D', id % 2) AS aui")
    brands = spark.range(100_000).selectExpr("concat('D', id % 2) AS drug_aui", "concat('B', id % 4) AS brand_aui")
    out = products.with_brands(links, brands)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join Inner") :]
    assert below.count("Aggregate") == 2, plan
    assert sorted(r["aui"] for r in out.collect()) == ["B0", "B1", "B2", "B3", "D0", "D1"]


def test_source_files_without_labels_rows(spark):
    """A file whose guid no label row has keeps its row, with number 0; without approvals and sponsors nothing is filled."""
    events = spark.createDataFrame([], "product string, section string, match string, aui string, first_added date, sources array<string>")
    atoms = spark.createDataFrame([], "aui string, cui string, code string, pt_code string, term string, tty string, sab string")
    more = {
        "files": spark.createDataFrame([("g", "/x/otc/g.xml"), ("h", "/x/otc/h.xml")], "guid string, path string"),
        "labels": spark.createDataFrame([("g", 5, None)], "guid string, appl_no int, label_date date"),
    }
    winners = spark.createDataFrame([("g", "g"), ("h", "g")], "guid string, winner string")
    t = build.tables(events, atoms, winners, more)["spl_srcfile"]
    assert sorted((r["guid"], r["application_number"], r["approval_date"], r["nda_sponsor"]) for r in t.collect()) == [("g", 5, None, None), ("h", 0, None, None)]


def test_classifier_in_the_build(spark):
    rows = spark.createDataFrame([("indicated for treatment of pain", "IND"), ("adverse reactions were rash", "AE")] * 8, "text string, label string")
    model = training.section_model(rows)
    s = spark.createDataFrame([("g", "Indicated for TREATMENT of pain"), ("g", "Adverse reactions were rash")], "guid string, sentence string")
    left = lambda section, **k: [r["sentence"] for r in build.gated(s, model, section, **k).collect()]
    assert left("IND") == ["Indicated for TREATMENT of pain"] and left("AE") == ["Adverse reactions were rash"]
    assert len(left("BOX")) == 2 and build.gated(s, None, "IND") is s and build.gated(s, model, "IND").columns == s.columns
    assert left("BOX", box=True) == []  # the model has no such section: nothing is left for it
    section = "struct<section:string,found_by:int,section_date:string,text:string>"
    schema = f"guid string, label struct<label_date:string,sections:array<{section}>>"
    text = "Indicated for treatment of pain. Adverse reactions were rash."
    labels = spark.createDataFrame([("g", ("20200101", [("AE", 1, None, text)]))], schema)
    atoms = spark.createDataFrame([("A1", "C1", "1", "1", "Pain", "PT", "MDR"), ("A2", "C2", "2", "2", "Rash", "PT", "MDR")], "aui string, cui string, code string, pt_code string, term string, tty string, sab string")
    found = lambda m: {r["aui"] for r in build.label_events(labels, atoms, model=m).collect()}
    assert found(None) == {"A1", "A2"} and found(model) == {"A2"}


def test_drugs_by_code_once_without_a_shuffle_of_the_pairs(spark):
    labels = spark.createDataFrame([("g", "1"), ("g", "1"), ("g", "2"), ("h", "2"), ("i", "9"), ("j", None), (None, "3")], "guid string, ndc string")
    concepts = spark.createDataFrame([("C1", "1"), ("C2", "2"), ("C2", "2"), ("C3", "3"), ("C1", "2"), (None, "2")], "cui string, ndc string")
    drugs = spark.createDataFrame([("C1", "a"), ("C2", "a"), ("C2", "a"), ("C2", "b"), ("C3", "c"), ("C4", "d"), (None, "e")], "cui string, aui string")
    out = products.drugs_by_ndc(labels, concepts, drugs)
    assert sorted(((r["guid"] or "", r["aui"]) for r in out.collect())) == [("", "c"), ("g", "a"), ("g", "b"), ("h", "a"), ("h", "b")]
    top = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in top[: top.index("Join")], top


def test_drugs_by_code_in_small_files_of_many_tasks(spark, tmp_path):
    """All pairs of one concept: their files take a fraction of a byte a row, and not one task makes them all."""
    labels = spark.range(400).select(F.col("id").alias("guid"), F.lit("1").alias("ndc"))
    concepts = spark.createDataFrame([("C1", "1")], "cui string, ndc string")
    drugs = spark.range(9001).select(F.lit("C1").alias("cui"), F.col("id").alias("aui"))
    products.drugs_by_ndc(labels, concepts, drugs).write.parquet(str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.distinct().count() == out.count() == 3_600_400
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < 3_600_400 * 0.6
    assert out.select(F.input_file_name()).distinct().count() >= 4


def test_drugs_by_code_in_blocks(spark, monkeypatch):
    """Blocks that are full, begun and in several lanes, with rows of several concepts, give what the plain join gives."""
    for k, v in (("LANES", 3), ("DRUGS", 2), ("LABELS", 3)):
        monkeypatch.setattr(products, k, v)
    h = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    labels = spark.range(300).select(F.when(h(1, 90) > 0, h(1, 90)).alias("guid"), h(2, 12).cast("string").alias("ndc"))
    concepts = spark.range(30).select(F.when(h(3, 9) > 0, h(3, 9)).cast("string").alias("cui"), h(4, 12).cast("string").alias("ndc"))
    drugs = spark.range(200).select(h(5, 9).cast("string").alias("cui"), F.when(h(6, 80) > 0, h(6, 80)).alias("aui"))
    out = products.drugs_by_ndc(labels, concepts, drugs)
    plain = labels.join(concepts, "ndc").join(drugs, "cui").select("guid", "aui").distinct()
    rows = lambda df: sorted((r["guid"] or 0, r["aui"] or 0) for r in df.collect())
    assert rows(out) == rows(plain) and out.dtypes == plain.dtypes and len(rows(out)) > 1000
