import io
import zipfile

import pytest
from pyspark.sql import functions as F

from vialstream.functions import codes
from vialstream.operators import persist
from vialstream.plans import build
from vialstream.sources import commit, html, spl, tabular, zips
from vialstream.streaming import ingest

XML = """<document xmlns="urn:hl7-org:v3"><code code="34391-3" displayName="HUMAN PRESCRIPTION DRUG LABEL"/><title>Drug. Initial U.S. Approval: 1998</title><effectiveTime value="20200102"/>
<id root="2.16.840.1.113883.3.150" extension="NDA020123"/><component><structuredBody><manufacturedProduct><name> Some
 Drug </name><code code="12345-678-90" codeSystem="2.16.840.1.113883.6.69"/></manufacturedProduct>
<section ID="INDICATIONS"><code code="34067-9"/><text><paragraph>Indicated for treatment of rash.</paragraph><table><tr><td>a</td><td>b</td></tr></table>rest</text></section>
<section><code code="34084-4"/><text><paragraph>Patients had headache. Rash was seen.</paragraph></text></section></structuredBody></component></document>"""


def zipped(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, data in files.items():
            z.writestr(name.replace("__", "/").replace("_xml", ".xml"), data)
    return b.getvalue()


@pytest.fixture()
def archive(tmp_path):
    for kind, name, data in (("prescription", "20200101_g1.zip", zipped(a_xml=XML, b_txt="x")), ("otc", "20200101_g2.zip", zipped(a_xml=XML)), ("other", "bad.zip", b"no zip")):
        (tmp_path / "2020" / kind).mkdir(parents=True)
        (tmp_path / "2020" / kind / name).write_bytes(data)
    return tmp_path


def test_label_parts():
    d = spl.parse(XML.encode())
    assert spl.product_name(d) == "SOME DRUG" and spl.application_number(d) == 20123 and spl.approval_date(d) == "19980101"
    assert spl.section_text(d, *spl.SECTIONS["IND"]) == ("Indicated for treatment of rash.\na b\nrest", 1)
    assert spl.section_text(d, *spl.SECTIONS["AE"])[1] == 2 and spl.section_text(d, *spl.SECTIONS["BOX"]) == ("", 0)
    assert spl.ndc_codes(d, "and 1234-5678-9") == ["12345-678-90", "1234-5678-9"]
    assert spl.parse(b"<!DOCTYPE a [<!ENTITY x 'y'>]><a>&x;</a>") is None and spl.parse(b"<a>") is None and spl.parse(None) is None
    assert spl.sane_date("18000101") is None and spl.sane_date("20201301") is None


def test_filters():
    assert zips.safe_entry("a/b.xml") and not zips.safe_entry("../a.xml") and not zips.safe_entry("/a.xml") and not zips.safe_entry("c:\\a.xml")


def test_archives(spark, archive):
    files = zips.archives(spark, str(archive))
    assert {(r["zip_name"], r["source_type"], r["year"]) for r in files.collect()} == {("20200101_g1.zip", "prescription", 2020), ("20200101_g2.zip", "otc", 2020), ("bad.zip", "other", 2020)}
    rows = zips.right_class(zips.expand(files))
    assert [(r["zip_name"], r["product_name"]) for r in rows.collect()] == [("20200101_g1.zip", "SOME DRUG")]
    done = spark.createDataFrame([("20200101_g1.zip", "prescription")], "zip_name string, source_type string")
    assert {r["zip_name"] for r in zips.not_yet_mapped(files, done).collect()} == {"20200101_g2.zip", "bad.zip"}
    m = spark.createDataFrame([("d_g1.zip", "a.xml", "otc"), ("d_g1.zip", "b.xml", "otc"), (" ", "c.xml", "otc")], "zip_name string, xml_name string, source_type string")
    assert [(r["guid"], r["xml_names"]) for r in zips.label_guids(m).collect()] == [("g1", ["a.xml", "b.xml"])]


def test_stream(spark, archive, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):  # a second run finds nothing new
        ingest.run_available(ingest.archive_stream(spark, str(archive / "2020")), lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"), str(tmp_path / "ckpt"))
    assert spark.read.parquet(out).select("zip_name").collect()[0][0] == "20200101_g1.zip"


def test_build(spark, archive):
    labels = spl.labels(zips.right_class(zips.expand(zips.archives(spark, str(archive))))).withColumn("guid", F.lit("g1"))
    atoms = spark.createDataFrame([("A1", "C1", "1", "1", "Rash", "PT", "MDR"), ("A2", "C2", "2", "2", "Headache", "PT", "MDR")], "aui string, cui string, code string, pt_code string, term string, tty string, sab string")
    e = build.label_events(labels, atoms)
    got = {(r["section"], r["match"], r["aui"]) for r in e.collect()}
    assert ("IND", "exact", "A1") in got and ("AE", "exact", "A2") in got and not any(s == "AE" and a == "A1" for s, _, a in got)
    t = build.tables(e, atoms, spark.createDataFrame([("g1", "g1")], "guid string, winner string"))
    assert t["substance"].collect()[0][0] == 100 and persist.orphans(t["product_ae"], "meddra_id", t["meddra"], "id").count() == 0


def test_build_with_changes_and_all_tables(spark, archive, tmp_path):
    labels = spl.labels(zips.right_class(zips.expand(zips.archives(spark, str(archive))))).withColumn("guid", F.lit("g1"))
    atoms = spark.createDataFrame([("A1", "C1", "1", "1", "Rash", "PT", "MDR"), ("A2", "C2", "2", "2", "Headache", "PT", "MDR"), ("A3", "C3", "3", "3", "Fever", "PT", "MDR")], "aui string, cui string, code string, pt_code string, term string, tty string, sab string")
    page = "<h3>05/06/2019</h3><h4>6 Adverse Reactions</h4><p>Headache and fever came: later.<h4>Boxed Warning</h4>Entire Box Warning was deleted. Rash"
    pages = spark.createDataFrame([(7, page), (8, page)], "drug_id int, html string")
    changes = build.change_events(pages, spark.createDataFrame([("g1", "g1", 7), ("g1", "g1", -1)], "product string, guid string, drug_id int"), atoms)
    assert {(r["section"], r["aui"], str(r["first_added"])) for r in changes.collect()} == {("AE", "A2", "2019-05-06"), ("AE", "A3", "2019-05-06")}
    plain = {(r["section"], r["match"], r["aui"]): str(r["first_added"]) for r in build.label_events(labels, atoms).collect()}
    e = build.label_events(labels, atoms, changes)
    got = {(r["section"], r["match"], r["aui"]): (str(r["first_added"]), r["sources"]) for r in e.collect()}
    assert plain[("AE", "exact", "A2")] == "2020-01-02" and got[("AE", "exact", "A2")] == ("2019-05-06", ["g1"]) and got[("AE", "exact", "A3")] == ("2019-05-06", ["g1"])
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    terms = one([("R1", "C", "1", "drug", "IN")], "aui string, cui string, code string, term string, tty string")
    link = one([("g1", "R1")], "guid string, aui string")
    more = {
        "files": one([("g1", "/x/prescription/a.xml")], "guid string, path string"), "names": one([("g1", "R1", "111", "drug")], "guid string, aui string, ndc string, name string"), "classes": one([("g1", "111", 5)], "guid string, ndc string, atc_id int"),
        "changes": one([("g1", 7, 1, "d", "i", None, None, "u")], "guid string, drug_id int, application_number int, drug_name string, active_ingredient string, supplement_date date, database_updated date, url string"),
        "rxnorm_terms": terms, "snomed_terms": terms, "atc_terms": terms, "texts": spl.section_texts(labels), "brands": one([("g1", "Brand")], "guid string, name string"),
        "rxnorm": link, "ingredient": link, "snomed_pt": link, "snomed_parent": link,
    }
    t = build.tables(e, atoms, one([("g1", "g1")], "guid string, winner string"), more, ids=str(tmp_path / "ids"), version="2025A")
    assert len(t) == 24 and all(df.columns for df in t.values())
    version = build.write(t, str(tmp_path / "out"))
    assert len(commit.contents(version)) == 24
    n = {name: sum(rows for _, rows, _ in files) for name, files in commit.contents(version).items()}
    assert n["substance_rxnorm"] == n["rxnorm"] == n["spl_ae_text"] == n["srlc"] == n["umls_version"] == 1 and n["source_type"] == 3 and n["spl_box_text"] == 0 and n["ndc_code"] == 2
    assert [r["name"] for r in commit.read(spark, str(tmp_path / "out"), "ndc_code").filter("ndc = ''").collect()] == ["Brand"]


def test_pages():
    page = """<div id=accordion><h3>01/02/2020</h3><div><h4>6 Adverse Reactions</h4><p>Rash &amp; pain<p>more<h4>6.1 Trials</h4>x<h4>7 Other</h4>no</div><h3>01/03/2020</h3><div><h4>Boxed Warning</h4><p>death</div></div>"""
    got = {(r["date"], r["section"]): r["text"] for r in html.change_sections(page)}
    assert got == {("01/02/2020", "AE"): "Rash & pain more x", ("01/03/2020", "BOX"): "death"}
    assert html.page_text("<p>a<script>no</script><b>b</b>") == "ab" and html.page_text(None) == ""


def test_tables(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Drug Name,Active Ingredient,Application Number,Application Type,Supplement Date,Database Updated,Link\nA,a,00123,NDA,01/02/2020,01/03/2020,https://x.example/?e=s&DrugNameID=7\nB,b,123,NDA,bad,01/03/2020,x\nC,c,none,NDA,,,\n")
    got = tabular.changes(spark, str(tmp_path / "c.csv")).collect()
    assert len(got) == 1 and got[0]["drug_name"] == "B" and got[0]["supplement_date"] is None and got[0]["drug_id"] == -1
    (tmp_path / "p.csv").write_text("GUID,SUBSTANCE_ID\ng1,5\ng1,6\ng2,x\ng3,-1\n")
    first, twice = tabular.prior_ids(spark, str(tmp_path / "p.csv"))
    assert [tuple(r) for r in first.collect()] == [("g1", 5)] and [r["guid"] for r in twice.collect()] == ["g1"]
    (tmp_path / "s.tsv").write_text("ApplNo\tSponsorName\n1\tX\n1\tY\n")
    assert [tuple(r) for r in tabular.sponsors(spark, str(tmp_path / "s.tsv")).collect()] == [(1, "Y")]
    (tmp_path / "a.tsv").write_text("ApplNo\tSubmissionClassCodeID\tSubmissionType\tSubmissionNo\tSubmissionStatus\tSubmissionStatusDate\tSubmissionsPublicNotes\tReviewPriority\n1\t\tORIG\t1\tAP\t2001-02-03T00:00:00\t\t\n1\t\tORIG\t2\tAP\t2000-01-01\t\t\n")
    assert [str(r["approved"]) for r in tabular.approvals(spark, str(tmp_path / "a.tsv")).collect()] == ["2000-01-01"]
    (tmp_path / "r.rrf").write_text("C1|ENG||A1|\n")
    assert [tuple(r) for r in tabular.pipe_file(spark, str(tmp_path / "r.rrf"), ["CUI", "LAT", "", "AUI"]).collect()] == [("C1", "ENG", "A1")]
    (tmp_path / "x.csv").write_text("suffix,base_name,example_term,source,last_updated\nAbcd,one,one-abcd,a,2020-01-02\nabcd,two,two-abcd,b,bad\nabc,no,,,\n")
    assert [tuple(r) for r in tabular.suffix_catalogue(spark, str(tmp_path / "x.csv")).collect()] == [("abcd", "two", "two-abcd", "b", None)]
    (tmp_path / "m.csv").write_text("ZipFileName,XmlFileName,SourceType\n2020_g1.zip,a.xml,otc\n2020_g1.zip,b.xml,otc\n2020_g2.zip,,otc\n")
    there = spark.createDataFrame([("a.xml",)], "xml_name string")
    assert [tuple(r) for r in zips.label_guids(tabular.zip_manifest(spark, str(tmp_path / "m.csv")), there).collect()] == [("g1", "otc", ["a.xml"])]
    (tmp_path / "n.csv").write_text("ZipFileName,ManufactureProductName\n2020_g1.zip,A\n")
    assert [tuple(r) for r in tabular.product_manifest(spark, str(tmp_path / "n.csv")).collect()] == [("2020_g1.zip", "A")]
    (tmp_path / "w.txt").write_text("# c\nThe\n\nas well as\n")
    assert {r[0] for r in tabular.stop_phrases(spark, str(tmp_path / "w.txt")).collect()} == {"the", "as well as"}


def test_settings():
    s = tabular.Settings.from_text("# x\nlabels = /a\noutput=/b\ncodes = 1, 2\ncode.mode = exclude")
    s.check()
    assert s.codes == ("1", "2") and s.code_mode == "exclude"
    for bad in ("nonsense = 1", "labels = /a"):
        with pytest.raises(ValueError):
            tabular.Settings.from_text(bad).check()


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "id int, name string")
    persist.write_export(df, str(tmp_path / "e"))
    assert spark.read.text(str(tmp_path / "e")).collect()[0][0] == "id|name"
    a = spark.createDataFrame([("A1", "C1", "9", "9", "Rash", "PT", "MDR")], "aui string, cui string, code string, pt_code string, term string, tty string, sab string")
    assert a.select(persist.concept_line()).first()[0].count("|") == 18
    assert spark.createDataFrame([("Ab", "x")], "c string, n string").select(codes.name_hash(F.col("c"), F.col("n"))).first()[0].startswith("")
