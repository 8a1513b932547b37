from pyspark.sql import functions as F

from vialstream.functions import text
from vialstream.operators import merge, star
from vialstream.sources import spl


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


def test_terms_go_whole_and_in_their_case(spark):
    cut = lambda t, terms: one(spark, text.remove_terms(F.col("t"), F.col("w")), t=t, w=terms)
    assert cut("severe headache, Headache or headaches", ["headache", "severe headache"]) == ", Headache or headaches"
    assert cut("a.b acb", ["a.b"]) == "acb" and cut("x y", [" ", None, ""]) == "x y" and cut("a\\Eb c", ["a\\Eb"]) == "c"
    assert cut("x", []) == "x" and cut(None, ["x"]) is None


def test_change_text(spark):
    clean = lambda t: one(spark, text.clean_change_text(F.col("t")), t=t)
    assert clean("6.2 Postmarketing Experience: rash, pain\u2026  seen\n(Additions and/or revisions underlined)") == "rash pain seen"
    assert clean(None) == "" and clean(" : ") == ""
    gone = lambda t: one(spark, text.deleted_box(F.col("t")), t=t)
    assert gone("ENTIRE box warning was Deleted") and not gone("box warning deleted") and not gone(None) and not gone(" " * 4096 + "entire box warning deleted")


def test_other_labels(spark):
    ok = lambda code, *a: one(spark, spl.allowed_codes(F.col("c"), *a), c=code)
    assert ok("1", "include", ("1",)) and not ok("2", "include", ("1",)) and ok("2", "exclude", ("1",)) and not ok("1", "exclude", ("1",))
    assert ok("9", "off", ()) and not any(ok(c, m, ("1",)) for c in (None, "", "  ") for m in ("include", "exclude", "off"))


def test_file_guards(spark):
    rows = [("/a/b/2016/xml_files/OTC/x.xml", "otc", 5), ("/a/c/xml_files/otc/x.xml", "otc", 5), ("/a/b/../c/xml_files/otc/x.xml", "otc", 5), ("/a/b/xml_files/other/x.xml", "otc", 5), ("/a/b/xml_files/otc", "otc", 5),
            ("/a/b/xml_files/otc/x.xml", "otc", 16 << 20), ("/a/b/xml_files/otc/y.xml", "otc", None), ("/a/bb/xml_files/otc/x.xml", "otc", 5), (None, "otc", 1)]
    got = spl.guarded_files(spark.createDataFrame(rows, "path string, source_type string, length long"), "/a/b/").collect()
    assert [r["barred"] for r in got] == [None, "outside root", "outside root", "outside subtree", "outside subtree", "too large", "too large", "outside root", "outside root"]


def test_section_dates():
    d = spl.parse(b"""<document><effectiveTime value="20200101"/><section><code code="34084-4"/><section><code code="34067-9"/></section></section>
    <section><code code="34067-9"/><effectiveTime value="20190305"/></section></document>""")
    assert spl.section_date(d, "34067-9") == "20190305" and spl.section_date(d, "34084-4") is None and spl.section_date(None, "x") is None


def test_changes(spark):
    rows = [(2, 7, 1, "b"), (1, 7, 1, "z"), (1, 7, 1, "a"), (3, 0, 1, "x"), (3, -1, 1, "x"), (3, None, 1, "x")]
    links = spark.createDataFrame(rows, "product int, drug_id int, application_number int, drug_name string").withColumns({c: F.lit(None).cast("string") for c in star.CHANGE[2:]})
    table, bridge = star.change_tables(links)
    assert [(r["drug_id"], r["drug_name"]) for r in table.collect()] == [(7, "a")]
    assert sorted(map(tuple, bridge.collect())) == [(1, 7), (2, 7)]


def test_files_and_facts(spark):
    files = star.source_files(spark.createDataFrame([(1, "g1", "/r/2016/prescription/b.xml"), (2, "g1", "/r/OTC/a.xml"), (1, "g2", "/r/x.xml"), (1, "g3", " "), (1, None, "y")], "product int, guid string, path string"), "/r/")
    got = sorted(map(tuple, files.collect()))
    assert got == [(100, 1, "g1", "2016/prescription/b.xml", 1, True), (101, 1, "g2", "x.xml", None, True), (102, 2, "g1", "OTC/a.xml", 3, False)]
    facts = spark.createDataFrame([(1, 5, ["g1", "NDA0001", "g1"]), (1, 4, ["g2"]), (2, 4, [])], "product_id int, aui int, sources array<string>")
    table, links = star.fact_tables(facts, files, ["product_id", "aui"])
    assert sorted(map(tuple, table.select("fact_id", "aui").collect())) == [(100, 4), (101, 5), (102, 4)]
    assert sorted(map(tuple, links.collect())) == [(100, 101), (101, 100)]


def test_codes(spark):
    names = spark.createDataFrame([(1, "A1", " 11 ", "Old"), (2, "A2", "11", "New"), (2, "A3", None, "Bare"), (3, "A3", "", "bare"), (3, "A4", "", "Bare")], "product int, aui string, ndc string, name string")
    classes = spark.createDataFrame([(1, "11", 5), (1, "11", 5), (2, "22", 6), (2, "22", None), (2, " ", 6)], "product int, ndc string, atc_id int")
    table, links, atc = star.code_tables(names, classes)
    got = {r["ndc_id"]: (r["ndc"], r["name"], r["hash"]) for r in table.collect()}
    assert sorted(v[:2] for v in got.values()) == [("", "Bare"), ("", "Bare"), ("11", "Old"), ("22", "")] and len({v[2] for v in got.values()}) == 4
    assert links.count() == 5 and sorted((r["product"], got[r["ndc_id"]][0], r["atc_id"]) for r in atc.collect()) == [(1, "11", 5), (2, "22", 6)]


def test_lines(spark):
    a = spark.createDataFrame([(7, "A1", "C1", "9", None, "It's", "PT")], "id int, aui string, cui string, code string, pt_code string, term string, tty string")
    assert a.select(star.atom_line(star.TERM_LINE), star.atom_line(star.CODE_LINE, ";"), star.short_concept_line()).first()[:] == ("7|A1|C1|9||It's|PT", "7;A1;C1;9;It's;PT", "C1|||||||A1||||MDR|PT|9|It's|")
    got = [r[0] for r in star.sql_file(a.select("id", "term"), "T").collect()]
    assert got == ["SET autocommit = OFF;", "INSERT INTO T (id, term) VALUES (7, 'It''s');", "COMMIT;"]
    same = lambda *v: one(spark, star.same_atom(*map(F.col, "abcdef")), **dict(zip("abcdef", v, strict=True)))
    assert same("C1", "PT", " Rash", "C1", "PT", "rash ") and not same("C1", "PT", "x", "C2", "PT", "x") and not same(None, "PT", "x", None, "PT", "x") and same("C", "P", None, "C", "P", " ")
    p = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, save boolean")
    assert [r["id"] for r in star.kept(p).collect()] == [1]


def test_shared_labels_merge(spark):
    rows = [("a", 1, ["x"], ["C1"]), ("b", 1, ["x", "y"], ["C1"]), ("c", 1, ["y"], ["C1", "C2"]), ("d", 2, ["x"], ["C1"]), ("e", 2, ["x"], ["C9"]), ("f", 1, None, ["C8"])]
    p = spark.createDataFrame(rows, "guid string, source_type int, labels array<string>, cuis array<string>").withColumn("copack", F.lit(False))
    for s in ("parents", "ingredients", "ndas", "ndcs"):
        p = p.withColumn(s, F.array(F.lit("N")) if s == "ndas" else F.array().cast("array<string>"))
    apart = p.withColumn("ndas", F.array(F.col("guid")))
    got = {r["guid"]: r["winner"] for r in merge.merge_products(apart).collect()}
    # b goes to a by label; c is barred there (its concepts aren't among a's) and takes a in by containment; d and e are of another kind than x's owner
    assert got == {"a": "c", "b": "c", "c": "c", "d": "d", "e": "e", "f": "f"}


def test_label_merge_by_gate(spark):
    """Without a shared key but the label, and no concepts on the later one, the label alone brings two products together."""
    p = spark.createDataFrame([("a", ["C1"], ["x"]), ("b", [], ["x"]), ("c", [], ["z"])], "guid string, cuis array<string>, labels array<string>")
    p = p.withColumns({"source_type": F.lit(1), "copack": F.lit(False)} | {s: F.array().cast("array<string>") for s in ("parents", "ingredients", "ndas", "ndcs")})
    assert {r["guid"]: r["winner"] for r in merge.merge_products(p).collect()} == {"a": "a", "b": "a", "c": "c"}


def test_remaining_text(spark):
    s = spark.createDataFrame([("g", "AE", "rash and Rash"), ("g", "IND", "rash"), ("h", "AE", None)], "guid string, section string, text string")
    found = spark.createDataFrame([("g", "AE", "rash"), ("g", "AE", "rash")], "guid string, section string, term string")
    assert {(r["guid"], r["section"]): r["text"] for r in star.remaining_text(s, found).collect()} == {("g", "AE"): "and Rash", ("g", "IND"): "rash", ("h", "AE"): None}


def test_section_texts(spark):
    xml = b"""<document><effectiveTime value="20200101"/><section ID="indications"><code code="34067-9"/><effectiveTime value="20190305"/><text>It's for rash.</text></section>
    <section ID="Other_Adverse_Reactions"><code code="34084-4"/><text>Pain.</text></section></document>"""
    labels = spl.labels(spark.createDataFrame([("g", bytearray(xml)), ("h", bytearray(b"<broken")), ("i", None)], "guid string, xml binary"))
    got = {(r["guid"], r["section"]): (str(r["label_date"]), r["spl_text"]) for r in spl.section_texts(labels).collect()}
    assert got == {("g", "IND"): ("2019-03-05", "It''s for rash."), ("g", "AE"): ("2020-01-01", "Pain.")}
    found = {s["section"]: s["found_by"] for s in labels.first()["label"]["sections"]}
    assert found == {"IND": 1, "AE": 2}


def test_same_atoms_meet_by_all_keys(spark):
    rows = [(1, "C1", "PT", "Rash "), (2, "C1", "PT", " RASH"), (3, "C1", "PT", "pain"), (4, "C1", "LLT", "rash"), (5, None, "PT", "rash"), (6, "C2", "PT", None), (7, "C2", "PT", "  ")]
    a = spark.createDataFrame(rows, "a int, cui string, tty string, term string")
    b = spark.createDataFrame(rows, "b int, cui string, tty string, of_term string")
    out = star.same_atoms(a, b)
    assert sorted((r["a"], r["b"]) for r in out.collect() if r["a"] < r["b"]) == [(1, 2), (6, 7)]
    # the term is a key of the join, not a filter on all pairs of a concept and type
    join = next(line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line)
    assert "_plain" in join, join
